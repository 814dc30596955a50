"""A time-varying mix of sources (operator 2).

A source's weight follows a schedule over the training, here linear in time: ``w (1 + a (2 t - 1))``. Its integral, scaled
to the source's target, is the words it must have given by time ``t``. The documents of a source, in a fixed
pseudo-random order and passed over again where the target asks for it, meet that demand one after another, so the
inverse of the integral at the words given before a document is the document's training position. The training order is
a range sort by position.

Targets: the words asked for are shared by weight; a share stops at a multiple of its source's words and the excess is
shared anew among the others. That fixed point is found at once, from the sources in the order in which they would stop.

Prefix sums have two levels, the source's parts by key and the rows of a part, so no source is gathered into one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.plans.lineage import cut

#: Runs of bytes other than white space.
WORD = r"[^\x20\x09-\x0D]+"
WEIGHTS = (5, 2, 1)
#: The slope of each weight's schedule, between -1 and 1.
SLOPES = (-0.5, 0.0, 0.5)
SHARE, MOST = 1.5, 2.0


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, share: float = SHARE, most: float = MOST, weights: tuple[int, ...] = WEIGHTS, slopes: tuple[float, ...] = SLOPES) -> DataFrame:
    """source, source_size, target, slope from (source, source_size), one row for each source."""
    every = Window.partitionBy(F.lit(0))
    ranked = sizes.withColumn("k", (F.row_number().over(every.orderBy(F.asc_nulls_last("source"))) - 1) % len(weights))
    ranked = ranked.select("source", "source_size", *(F.element_at(F.array(*map(F.lit, x)), F.col("k") + 1).cast("double").alias(n) for n, x in (("weight", weights), ("slope", slopes))))
    ranked = ranked.withColumn("cap", F.col("source_size") * F.lit(float(most)))
    by_stop = every.orderBy(F.col("cap") / F.col("weight"), F.asc_nulls_last("source"))
    level = (F.sum("source_size").over(every) * F.lit(float(share)) - F.coalesce(F.sum("cap").over(by_stop.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))) / F.sum("weight").over(by_stop.rowsBetween(0, Window.unboundedFollowing))
    ranked = ranked.withColumn("level", level)
    open_level = F.min(F.when(F.col("cap") / F.col("weight") > F.col("level"), F.struct((F.col("cap") / F.col("weight")).alias("at"), "source", "level"))).over(every)["level"]
    return ranked.select("source", "source_size", F.least("cap", F.coalesce(open_level * F.col("weight"), F.col("cap"))).alias("target"), "slope")


def _position(share: Column, slope: Column) -> Column:
    """The time at which the schedule has given ``share`` of its demand: the inverse of ``(1 - a) t + a t**2``."""
    return 2 * share / ((1 - slope) + F.sqrt((1 - slope) * (1 - slope) + 4 * slope * share))


def mix(docs: DataFrame, whole_rows: bool = False, share: float = SHARE, most: float = MOST) -> DataFrame:
    """doc_id, size, source_size, target, taken and ``takes`` (pass, words, position) for each row of ``docs``.

    ``taken`` sums a source to its rounded target: full passes, and in the last pass the rows up to the target, the last of
    them in part; a target under half a word takes nothing. A null text has size 0 and is never taken. A null source is a
    source, after all others, and a null doc_id is ordered by its text. A very long text is one row whose size may be more
    than its source's target. Rows repeated in full are ordered among themselves at will; all of them look alike. An empty
    table gives an empty table. With ``whole_rows`` the input row is kept as the struct ``row``, whatever its columns are
    called."""
    key = F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"), F.coalesce("text", F.lit(""))).cast("binary"))
    rows = docs.select("doc_id", "source", word_count(F.col("text")).alias("size"), key.alias("key"), *([F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")] if whole_rows else []))
    # a name without nulls for the source, so that the join and the window deal rows by the same columns
    named = F.coalesce(F.concat(F.lit("="), "source"), F.lit("")).alias("s")
    rows = rows.select("*", named, F.substring("key", 1, 3).alias("part"))
    if not whole_rows:
        rows = cut(rows)
    parts = cut(rows.groupBy("source", "part").agg(F.sum("size").alias("words")))
    targets = source_targets(parts.groupBy("source").agg(F.sum("words").alias("source_size")), share, most)
    ahead = Window.partitionBy("source").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.withColumn("before", F.coalesce(F.sum("words").over(ahead), F.lit(0))).alias("p")
    parts = parts.join(targets.alias("t"), F.col("p.source").eqNullSafe(F.col("t.source"))).select(F.coalesce(F.concat(F.lit("="), "p.source"), F.lit("")).alias("s"), "p.part", "before", "source_size", "target", "slope")
    joined = rows.join(parts, ["s", "part"])
    within = Window.partitionBy("s", "part").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    out = joined.withColumn("before", F.col("before") + F.coalesce(F.sum("size").over(within), F.lit(0)))
    out = out.withColumn("goal", F.floor(F.col("target") + 0.5))
    passes = F.sequence(F.lit(0), F.lit(int(-(-most // 1))))
    given = lambda p: F.greatest(F.lit(0), F.least(F.col("size"), F.col("goal") - p * F.col("source_size") - F.col("before")))
    takes = F.transform(passes, lambda p: F.struct(p.alias("pass"), given(p).alias("words"), _position(F.try_divide(p * F.col("source_size") + F.col("before"), F.col("goal")), F.col("slope")).alias("position")))
    out = out.withColumn("takes", F.when(F.col("size") > 0, F.filter(takes, lambda t: t["words"] > 0)).otherwise(F.slice(takes, 1, 0)))
    taken = F.aggregate("takes", F.lit(0).cast("long"), lambda s, t: s + t["words"])
    return out.select("doc_id", "size", "source_size", "target", taken.alias("taken"), "takes", *(["row"] if whole_rows else []))


def training_order(mixed: DataFrame) -> DataFrame:
    """A row for each take of a mix, with pass, words and position, range-sorted by position."""
    kept = [c for c in mixed.columns if c != "takes"]
    return mixed.select(*kept, F.explode("takes").alias("take")).select(*kept, "take.*").orderBy("position", "doc_id", "pass")


def mixed_documents(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` in training order, each as often as the mix takes it; a part taken counts as one take."""
    return training_order(mix(docs, whole_rows=True).select("doc_id", "takes", "row")).select("row.*")
