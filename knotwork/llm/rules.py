"""Quality rules with risk-controlled cutoffs (operator 11), in built-in functions only.

Four shares of a text are held against cutoffs: symbols a word, repeated lines, words in repeated windows, capitals. The
cutoffs move together through ``LEVELS`` levels, from lenient to strict, that are fixed beforehand; so every labelled
document is a holdout for all of them. In each stratum the levels are tested in that order: of the n good documents that
pass the base rules k are rejected at a level, and the level holds if ``P(Binomial(n, risk) <= k)`` is at most
``confidence / strata``, which is the exact (Clopper-Pearson) upper bound of the false rejections lying at or under
``risk``. The first level that does not hold ends the sequence; so no correction is needed within a stratum, and the
division by the number of strata is the one between them. With probability ``1 - confidence`` no stratum rejects over
``risk`` of its good documents, whichever of the levels that hold is picked; picked is the one that best parts the
labelled documents, with ``HARM`` for good ones rejected, the most lenient among equals. A stratum in which none holds rejects by the base rules alone.

Null and wordless texts have no words and fail the base rules. Very long texts are counted whole: a text is one row and is
sorted in its task. Rows that are repeated have equal results and count as often; several labels of a document are
averaged, null ones and those of a null doc_id are left out. Without labels every level fails its test. Columns of any name
may stand beside doc_id and text. An empty table stays empty."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.operators.normalization import small
from knotwork.plans.lineage import cut

#: Most of the good documents of a stratum that may be rejected, and the probability of being wrong in any stratum.
RISK, CONFIDENCE = 0.05, 0.05
#: Cutoffs in thousandths at the first and last level: symbols a word, repeated lines, repeated words, capitals.
LEVELS = 16
RANGES = {"symbols": (400, 25), "lines": (900, 100), "repeats": (500, 250), "capitals": (900, 225)}
#: Words from which on a text is in the next class of length, the default stratum.
LENGTHS = (200, 400)
#: How much worse a rejected good document is than a bad one that is kept, as shares of their labels.
HARM = 4
MIN_WORDS, REPEATED = 50, 50
WINDOW = 3

SPACE = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"


def cutoffs(name: str) -> list[int]:
    """The cutoffs of a rule from the first level to the last."""
    first, last = RANGES[name]
    return [round(first * (last / first) ** (k / (LEVELS - 1))) for k in range(LEVELS)]


def _repeated_words(docs: DataFrame) -> DataFrame:
    """``docs`` (with ``words``) with ``n_repeat_words``.

    A window's hash, cut to make room for its place, sorts as one long; only windows whose cut hash has a neighbour are then
    sorted by their words themselves."""
    n, w = F.size("words"), F.col("words")
    bits = F.length(F.bin(n.cast("long")))
    place = F.call_function("shiftleft", F.lit(1).cast("long"), bits) - 1
    none = F.array().cast("array<bigint>")
    keyed = F.transform(F.sequence(F.lit(0), n - WINDOW), lambda i: F.xxhash64(*(w[i + k] for k in range(WINDOW))).bitwiseAND(F.bitwise_not(F.col("place"))).bitwiseOR(i.cast("long")))
    out = docs.withColumns({"n": n, "bits": bits, "place": place})
    out = out.withColumn("keys", F.sort_array(F.when(F.col("n") >= WINDOW, keyed).otherwise(none)))
    s = F.col("keys")
    head = lambda x: F.call_function("shiftright", x, F.col("bits"))
    out = out.withColumn("keys", F.filter(s, lambda x, i: (head(x) == head(F.get(s, i - 1))) | (head(x) == head(F.get(s, i + 1)))))
    at = lambda x: x.bitwiseAND(F.col("place")).cast("int")
    out = out.withColumn("near", F.sort_array(F.transform("keys", lambda x: F.struct(*(w[at(x) + k].alias(f"w{k}") for k in range(WINDOW)), at(x).alias("i"))))).drop("words", "keys")
    near = F.col("near")
    same = lambda a, b: F.struct(*(a[f"w{k}"] for k in range(WINDOW))) == F.struct(*(b[f"w{k}"] for k in range(WINDOW)))
    twice = F.filter(near, lambda e, i: F.coalesce((i > 0) & same(e, F.get(near, i - 1)), F.lit(False)) | F.coalesce(same(e, F.get(near, i + 1)) & (i + 1 < F.size(near)), F.lit(False)))
    out = out.withColumn("places", F.sort_array(F.transform(twice, lambda e: e["i"]))).drop("near")
    step = lambda acc, i: F.struct((acc["n"] + F.least(i - acc["last"], F.lit(WINDOW))).alias("n"), i.alias("last"))
    covered = F.aggregate("places", F.struct(F.lit(0).alias("n"), F.lit(-WINDOW).alias("last")), step, lambda acc: acc["n"])
    return out.withColumn("n_repeat_words", covered.cast("long")).drop("places", "bits", "place", "n")


def signals(docs: DataFrame) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_capitals, base_failed: counts of each whole text.

    ``n_lines`` are lines with a word, ``n_dup_lines`` those of them that an earlier line equals."""
    text = F.col("text")
    words = F.filter(F.split("text", SPACE + "+"), lambda w: w != "")
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD))
    out = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumns({"words": words, "lines": lines})
    counts = {
        "n_words": F.size("words").cast("long"),
        "word_chars": (F.length(text) - F.regexp_count(text, F.lit(SPACE))).cast("long"),
        "n_symbols": F.regexp_count(text, F.lit(r"[#*$%&|<>]")).cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_capitals": F.regexp_count(text, F.lit(r"\p{Lu}")).cast("long"),
    }
    out = _repeated_words(out.select("doc_id", "words", *(c.alias(k) for k, c in counts.items())))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEATED * F.col("n_words"))
    return out.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "n_lines", "n_capitals", failed.alias("base_failed"))


def first_rejecting() -> Column:
    """The first level whose cutoffs reject a row of ``signals``; ``LEVELS`` if none does."""

    def share(part: str, whole: str) -> Column:
        return F.floor(F.col(part) * 1000 / F.greatest(F.col(whole), F.lit(1).cast("long")))

    shares = {"symbols": share("n_symbols", "n_words"), "lines": share("n_dup_lines", "n_lines"), "repeats": share("n_repeat_words", "n_words"), "capitals": share("n_capitals", "word_chars")}
    def passed(name: str, x: Column) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cutoffs(name))), lambda c: x <= c))

    return F.least(*(passed(k, x) for k, x in shares.items()))


def length_class() -> Column:
    """The class of ``n_words``: the least number of words in it, as text."""
    out = F.lit("0")
    for k in LENGTHS:
        out = F.when(F.col("n_words") >= k, F.lit(str(k))).otherwise(out)
    return out


def binomial_tail(n: Column, k: Column, p: float) -> Column:
    """``P(Binomial(n, p) <= k)``, summed term by term from the exact ratio of neighbours; 1 where k is at or over the mean."""
    import math

    odds, first = math.log(p / (1 - p)), n * math.log(1 - p)

    def step(acc, j):
        log = acc["log"] + F.log((n - j + 1) / j) + odds
        return F.struct(log.alias("log"), (acc["sum"] + F.exp(log)).alias("sum"))

    start = F.struct(first.cast("double").alias("log"), F.exp(first).cast("double").alias("sum"))
    terms = F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.when(k >= n * p, F.lit(1.0)).otherwise(F.aggregate(terms, start, step, lambda acc: acc["sum"]))


def risk_controlled(rows: DataFrame, labels: DataFrame, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """stratum, n_good, n_bad, holding, level of ``rows`` (doc_id, stratum, level, base_failed) and ``labels`` (doc_id, quality).

    ``holding`` is the number of levels whose false rejections are bounded, ``level`` the one picked, -1 if none is. Rows of
    a document are added up before they meet its label."""
    good = labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.avg(F.col("quality").cast("double")) >= 0.5).alias("good"))
    slim = rows.where(~F.col("base_failed")).groupBy("doc_id", "stratum", "level").agg(F.count("*").alias("rows"))
    met = slim.join(good, "doc_id")
    by = {side: [F.coalesce(F.sum(F.when((F.col("good") == is_good) & (F.col("level") <= k), F.col("rows"))), F.lit(0)) for k in range(LEVELS + 1)] for side, is_good in (("false", True), ("true", False))}
    stats = cut(met.groupBy("stratum").agg(*(F.array(*cols[:-1]).alias(side) for side, cols in by.items()), by["false"][-1].alias("n_good"), by["true"][-1].alias("n_bad")))
    most = confidence / max(1, stats.count())
    n = F.col("n_good")
    tests = stats.withColumn("fails", F.transform("false", lambda k: binomial_tail(n, k, risk) > most))
    first = F.array_position("fails", True).cast("int")
    tests = tests.withColumn("holding", F.when(first > 0, first - 1).otherwise(LEVELS))
    worth = F.transform(F.slice("false", F.lit(1), F.col("holding")), lambda k, i: F.struct((F.get(F.col("true"), i) * n - HARM * k * F.col("n_bad")).alias("worth"), (-i).alias("i")))
    best = F.array_max(worth)
    return tests.select("stratum", "n_good", "n_bad", "holding", F.coalesce(-best["i"], F.lit(-1)).alias("level"))


def apply_rules(docs: DataFrame, labels: DataFrame, stratum: Column | None = None, risk: float = RISK, confidence: float = CONFIDENCE) -> DataFrame:
    """doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, stratum, level: a row for each row of ``docs``.

    ``stratum`` is an expression over the columns of ``signals``, by default the class of length. ``level`` is the first
    level that would reject the row; it is kept if it passes the base rules and this lies beyond its stratum's level. The
    counts are written once, as slim rows, for the labelled rows among them decide on all."""
    of = F.coalesce((length_class() if stratum is None else stratum).cast("string"), F.lit("(none)"))
    rows = cut(signals(docs).withColumn("level", first_rejecting()).withColumn("stratum", of))
    picked = cut(risk_controlled(rows, labels, risk, confidence).select("stratum", F.col("level").alias("picked")))
    met = rows.join(small(picked), "stratum", "left")
    kept = ~F.col("base_failed") & (F.col("level") > F.coalesce("picked", F.lit(-1)))
    return met.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", kept.alias("kept"), "stratum", F.col("level").cast("int").alias("level"))
