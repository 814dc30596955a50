"""Counts by brute force, and cutoffs by the exact binomial distribution."""

import math
import random
import re
from collections import Counter

import duckdb
import pytest
from pyspark.sql import functions as F

from knotwork.llm import queries, rules, sql

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def counts(text):
    w = WORD.findall(text or "")
    seen = Counter(zip(w, w[1:], w[2:]))
    inside = {i + k for i in range(len(w) - 2) if seen[tuple(w[i : i + 3])] > 1 for k in range(3)}
    lines = [x for x in (text or "").split("\n") if WORD.search(x)]
    failed = len(w) < 50 or 100 * len(inside) > 50 * len(w)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), len(lines) - len(set(lines)), len(inside), failed


def texts():
    rng = random.Random(11)
    rows = []
    for i in range(150):
        words = [rng.choice("ab ab c über Éa the of and 𝔘x # $$".split()) + rng.choice(["", str(rng.randrange(40))]) for _ in range(rng.randrange(160))]
        rows.append((i, "".join(w + rng.choice([" ", " ", "  ", "\n", "\t", "\x0b", "\r\n"]) for w in words)))
    rows += [(200, None), (201, ""), (202, " \n\t"), (203, "a b"), (204, "a b c a b c"), (205, "a " * 700), (206, ("same line of words\n" * 30)), (207, "\n".join(["x y"] * 3 + [" x y", "x y "])), (None, "no id " * 20), (5, rows[5][1])]
    return rows


def test_counts_against_brute_force(spark):
    rows = texts()
    got = rules.signals(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect()
    mine = Counter((r["doc_id"], r["n_words"], r["word_chars"], r["n_symbols"], r["n_dup_lines"], r["n_repeat_words"], r["base_failed"]) for r in got)
    assert mine == Counter((i, *counts(t)) for i, t in rows)


def test_no_python_in_the_plan(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1)], "doc_id long, quality int")
    for df in (rules.signals(docs), rules.apply_rules(docs, labels)):
        assert not re.search("Python|Pandas|InArrow", df._jdf.queryExecution().toString())


def tail(n, k, p):
    return sum(math.comb(n, j) * p**j * (1 - p) ** (n - j) for j in range(k + 1))


def test_binomial_tail(spark):
    rows = [(n, k) for n in (1, 7, 90, 400) for k in (0, 1, 3, 15, 19) if k <= n]
    got = spark.createDataFrame(rows, "n long, k long").select("n", "k", rules.binomial_tail(F.col("n"), F.col("k"), 0.05).alias("p")).collect()
    for r in got:
        want = 1.0 if r["k"] >= r["n"] * 0.05 else tail(r["n"], r["k"], 0.05)
        assert math.isclose(r["p"], want, rel_tol=1e-9), r


def test_cutoffs_hold_their_risk(spark):
    """Strata with plenty of, few and unlucky good documents, against the tests written out."""
    rng = random.Random(2)
    rows, labels, i = [], [], 0
    for stratum, good, bad in (("much", 400, 60), ("little", 60, 30), ("none", 0, 12), ("unlucky", 300, 40)):
        for k in range(good + bad):
            level = rng.choice([16] * 40 + [9, 12, 15]) if k < good else rng.choice([0, 3, 7])
            if stratum == "unlucky" and k < good and k % 10 == 0:
                level = 0
            rows.append((i, stratum, level, False))
            labels.append((i, int(k < good)))
            i += 1
    rows += [(i, "much", 0, True), (None, "much", 0, False)]
    labels += [(i, 1), (None, 1), (3, None), (10_000, 0)]
    got = {r["stratum"]: r for r in rules.risk_controlled(spark.createDataFrame(rows, "doc_id long, stratum string, level int, base_failed boolean"), spark.createDataFrame(labels, "doc_id long, quality int")).collect()}
    label = {d: q for d, q in labels if d is not None and q is not None}
    for stratum, r in got.items():
        of = [(level, label[d]) for d, s, level, failed in rows if s == stratum and not failed and d in label]
        n, m = sum(q for _, q in of), sum(1 - q for _, q in of)
        holding = 0
        for k in range(rules.LEVELS):
            x = sum(q for level, q in of if level <= k)
            if x >= n * rules.RISK or tail(n, x, rules.RISK) > rules.CONFIDENCE / 4:
                break
            holding += 1
        worth = [sum(1 - q for level, q in of if level <= k) * n - rules.HARM * m * sum(q for level, q in of if level <= k) for k in range(holding)]
        assert (r["n_good"], r["n_bad"], r["holding"], r["level"]) == (n, m, holding, worth.index(max(worth)) if worth else -1), stratum
    assert got["much"]["level"] == 7 and got["little"]["level"] == got["none"]["level"] == got["unlucky"]["level"] == -1


def test_query_and_sql_on_hard_rows(spark, tmp_path):
    rows = texts()
    labels = [(i, int(i % 9 > 0), 0) for i in range(150)] + [(7, 0, 0), (None, 1, 0), (8, None, 0)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{tmp_path}/{t}.parquet/*.parquet')")
    df = queries.op11_rules(spark, str(tmp_path))
    got = con.execute(sql.op11_rules())
    names = [c[0] for c in got.description]
    assert Counter(map(tuple, df.select(names).collect())) == Counter(got.fetchall())


def test_strata_of_ones_own(spark):
    docs = spark.createDataFrame(texts(), "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int")
    got = rules.apply_rules(docs, none, stratum=F.when(F.col("n_lines") > 1, F.lit("many"))).collect()
    assert {r["stratum"] for r in got} == {"many", "(none)"}
    assert all(r["kept"] == (not r["base_failed"]) for r in got)


@pytest.mark.parametrize("name", sorted(rules.RANGES))
def test_cutoffs_go_from_lenient_to_strict(name):
    got = rules.cutoffs(name)
    assert len(got) == rules.LEVELS and got == sorted(got, reverse=True) and (got[0], got[-1]) == rules.RANGES[name]
