"""The machine of terms against single patterns, the index of references against every pair."""

import random
import re

import pytest
from pyspark.sql import functions as F

from knotwork.functions import vocabulary
from knotwork.functions.automaton import Terms, folded
from knotwork.functions.text import context, mentions
from knotwork.operators import concepts, graph


def vocabulary_table(spark, terms):
    return spark.createDataFrame([("service", t.upper(), t, k) for k, t in enumerate(terms)], "category string, name string, term string, ordinal int")


TERMS = ["VPC", "vpc", "EC2 instance", "größe", "STRASSE", "Straße", "É", ".NET", "C++", "a b", "µm", "ſ", "naïve", "x_y", "2", "Ⅷ", "İ", "ς", "", "the", "e"]
TEXTS = ["A vpc, (VPC) xVPC VPCy VPC_", "GRÖSSE Größe strasse STRASSE straße", "é É e éa", "use .NET and .net; x.NET C++ c++x C++", "a  b a b A B", "μm µM ſ s S", "NAÏVE naïve", "X_Y x_yz 2 22 2. Ⅷ ⅷ İ i̇ i ς σ Σ", "", " the\n the\tthe", "the" * 50 + " e"]


def test_terms_against_single_patterns(spark):
    rows = [(str(i), t) for i, t in enumerate(TEXTS)] + [("none", None)]
    docs = spark.createDataFrame(rows, "file_path string, content string")
    got = {(r["file_path"], r["term"], r["description"]) for r in concepts.term_hits(docs, vocabulary_table(spark, TERMS)).collect()}
    pairs = docs.crossJoin(spark.createDataFrame([(t,) for t in TERMS if t], "term string"))
    want = {tuple(r) for r in pairs.where(mentions(F.col("content"), F.col("term"))).select("file_path", "term", context(F.col("content"), F.col("term"))).collect()}
    assert got == want


def test_a_hundred_thousand_terms(spark, monkeypatch):
    monkeypatch.setattr(concepts, "TERMS", 40_000)  # three passes
    terms = spark.range(100_000).selectExpr("'service' AS category", "concat('N', id) AS name", "concat('Term ', id) AS term", "CAST(id AS INT) AS ordinal")
    docs = spark.createDataFrame([("a", "term 7, TERM 99999 and xTerm 5 term 12345678"), ("b", "none")], "file_path string, content string")
    assert sorted((r["file_path"], r["name"]) for r in concepts.term_hits(docs, terms).collect()) == [("a", "N7"), ("a", "N99999")]


def test_no_terms_and_no_texts(spark):
    docs = spark.createDataFrame([("a", "x"), ("b", None)], "file_path string, content string")
    assert concepts.term_hits(docs, vocabulary_table(spark, [])).count() == 0
    assert concepts.term_hits(docs, vocabulary_table(spark, [""])).count() == 0
    assert concepts.term_hits(docs.where("false"), vocabulary_table(spark, ["x"])).count() == 0
    assert list(Terms([]).find("x")) == []


def test_the_order_of_steps(spark):
    docs = spark.createDataFrame([("a", "A subnet, Subnets; a VPC Endpoint in the VPC by s3 bucket")], "file_path string, content string")
    got = concepts.concepts(docs, vocabulary.service_vocabulary(spark), vocabulary.technology_vocabulary(spark), vocabulary.ARCHITECTURE_TERMS).orderBy("seq").collect()
    assert [(r["name"], r["type"]) for r in got] == [("Amazon S3", "service"), ("Amazon VPC", "service"), ("AWS PrivateLink", "service"), ("Subnet", "technology"), ("VPC Endpoint", "concept")]


def test_folding_keeps_places():
    for t in [*TEXTS, "İIıſßﬁ" * 3, "".join(map(chr, range(0x20, 0x2100)))]:
        assert len(folded(t)) == len(t)


def test_containing_against_every_pair(spark):
    rng = random.Random(3)
    texts = [(i, "".join(rng.choice("abé/.") for _ in range(rng.randrange(0, 30)))) for i in range(150)] + [(500, None), (501, ""), (502, "a" * 400)]
    wanted = ["".join(rng.choice("abé/.") for _ in range(rng.randrange(0, 7))) for _ in range(120)] + ["", "a", "zzz", "a" * 399, "a" * 401, None, "b/"]
    df = spark.createDataFrame(texts, "key long, text string").repartition(3)
    found = graph.containing(df, spark.createDataFrame([(w,) for w in wanted], "ref string"))
    want = {(k, w) for k, t in texts for w in set(wanted) if t is not None and w and w in t}
    got = [tuple(r) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == want and len(want) > 300
    assert graph.containing(df, spark.createDataFrame([("",)], "ref string")).count() == 0


@pytest.mark.parametrize("forward", [True, False])
def test_references(spark, forward):
    docs = spark.createDataFrame([("d/a.md", "Alpha guide"), ("d/b.md", None), ("d/c.md", "b.md and Alpha")], "file_path string, title string")
    refs = spark.createDataFrame([("d/b.md", "Alpha"), ("d/b.md", "a.md"), ("d/a.md", "b.md"), ("d/a.md", "")], "file_path string, ref string")
    want = {("d/b.md", "d/a.md"), ("d/b.md", "d/c.md"), ("d/a.md", "d/b.md"), ("d/a.md", "d/c.md")}
    assert {tuple(r) for r in graph.reference_edges(docs, refs, forward).collect()} == {(s, t) for s, t in want if forward or t <= s}


def test_pairs_of_a_frequent_reference_are_made_once_and_not_shuffled(spark):
    docs = spark.createDataFrame([(f"{'de' if i % 2 else 'en'}/x/{i}", "t") for i in range(400)], "file_path string, title string")
    refs = spark.createDataFrame([(f"s{i % 300}", r) for i in range(600) for r in ("de/", "/x/", f"/{i}")], "file_path string, ref string")
    out = graph.reference_edges(docs, refs)
    p = out._jdf.queryExecution().executedPlan().toString()
    assert "Aggregate" not in p  # a pair that two references make was dealt to tasks by its texts, to be made distinct
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) == 300 * 400


def test_references_are_read_once(spark):
    read = spark.sparkContext.accumulator(0)

    def told(ref):
        read.add(1)
        return ref

    docs = spark.createDataFrame([(f"d/{i}.md", "t") for i in range(30)], "file_path string, title string")
    refs = spark.createDataFrame([(f"s{i}", f"/{i % 40}.md") for i in range(200)], "file_path string, ref string").withColumn("ref", F.udf(told)("ref"))
    assert graph.reference_edges(docs, refs).count() == 150
    assert read.value == 200  # 1200 times before; the text of a page is read as often


def test_sources_and_blocks_are_dealt_before_they_are_copied(spark, monkeypatch):
    for name, n in (("SLICE", 7), ("BLOCK", 5), ("PAIRS", 100), ("ROWS", 40)):
        monkeypatch.setattr(graph, name, n)
    docs = spark.createDataFrame([(f"{'de' if i % 3 else 'en'}/x/{i}", "t") for i in range(60)] + [(None, "/x/ and en/")], "file_path string, title string")
    refs = spark.createDataFrame([(f"s{i}" if i else None, r) for i in range(50) for r in (("/x/",) if i % 2 else ("de/", "en/"))], "file_path string, ref string")
    out = graph.reference_edges(docs, refs)
    plan = out._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"hashpartitioning\(([^)]*), (\d+)\), REPARTITION_BY_NUM", plan)
    # a copy of a source for each block, or of a block for each slice, was made where few rows lay: by one task of a large table
    assert {(re.sub(r"#\d+L?", "", keys), n) for keys, n in dealt if "i#" not in keys} == {("src", "16"), ("class, j", "16")}
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(set(got)) == 50 * 61
    assert {d for _, d in got} == {r[0] for r in docs.collect()} and {s for s, _ in got} == {None} | {f"s{i}" for i in range(1, 50)}
