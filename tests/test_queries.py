"""Every query of the package against its SQL, and the plans of some."""

import math
import os
import re
from collections import Counter

import duckdb
import pytest

from knotwork.plans import queries as Q

DATA = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{DATA}/{t}.parquet')")
    return con


def plain(v):
    return f"{v:.9g}" if isinstance(v, float) and not math.isnan(v) else repr(v)


@pytest.mark.parametrize("name", sorted(Q.ORACLE))
def test_against_sql(spark, duck, name):
    df = Q.QUERIES[name](spark, DATA)
    cols = sorted(df.columns)
    ours = sorted(tuple(map(plain, r)) for r in df.select(*cols).collect())
    got = duck.execute(Q.ORACLE[name])
    names = [c[0] for c in got.description]
    theirs = sorted(tuple(plain(r[names.index(c)]) for c in cols) for r in got.fetchall())
    assert sorted(names) == cols
    assert ours == theirs


@pytest.mark.parametrize("name", sorted(set(Q.QUERIES) - set(Q.ORACLE)))
def test_without_sql(spark, name):
    assert Q.QUERIES[name](spark, DATA).count() > 0


def plan(df):
    return df._jdf.queryExecution().toString()


def test_label_filters_reach_the_scan(spark, tmp_path):
    from knotwork.operators import graph, matching

    graph.write_graph(graph.merge_nodes(Q.trade_nodes(spark, DATA).selectExpr("*", "0L AS seq")), graph.merge_edges(Q.trade_edges(spark, DATA).selectExpr("*", "0L AS seq")), str(tmp_path))
    nodes, edges = graph.read_graph(spark, str(tmp_path))
    p = plan(matching.match(nodes, edges, "USES", "Supplier", "Part"))
    assert "PartitionFilters: [isnotnull(label" in p and "PartitionFilters: [isnotnull(rel_type" in p


def test_no_cartesian_product(spark):
    for name in ("validate_triples", "merge_triples", "normalize_rule", "match_three_way", "diff_status", "references_contains_join", "known_concepts"):
        p = plan(Q.QUERIES[name](spark, DATA))
        assert "CartesianProduct" not in p and "BroadcastNestedLoopJoin" not in p, name


def fixture(spark, folder):
    """Documents of four languages and none, and a small trade graph of two regions."""
    texts = [("en", "With, extraordinarily the whou, thhere."), ("fr", "été the naïveté; WITH thhe thhe"), (None, "that; motherofthousands the counterrevolutionary."), ("de", "größe the größe, über the maß"), ("es", "nothere withal"), ("fr", None)]
    write = lambda rows, schema, name: spark.createDataFrame(rows, schema).write.parquet(f"{folder}/{name}.parquet")
    write([(i, t, lang, "s", len(t or "")) for i, (lang, t) in enumerate(texts)], "doc_id long, text string, lang string, source string, n_chars long", "documents")
    write([(0, "ASIA"), (1, "AFRICA")], "r_regionkey int, r_name string", "region")
    write([(3, "A", 0), (9, "B", 0), (20, "C", 0), (1, "D", 1)], "n_nationkey int, n_name string, n_regionkey int", "nation")
    write([(i, f"c{i}", k, 1.0, "X") for i, k in enumerate([3, 9, 9, 20, 1])], "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string", "customer")
    write([(1, "s1", 9), (2, "s2", 20)], "s_suppkey long, s_name string, s_nationkey int", "supplier")
    write([], "l_suppkey long, l_partkey long", "lineitem")
    write([], "p_partkey long, p_name string, p_brand string", "part")
    return texts


def test_whole_queries_against_brute_force(spark, tmp_path):
    texts, d = fixture(spark, tmp_path), str(tmp_path)
    docs = [(str(i), t or "") for i, (_, t) in enumerate(texts)]
    rows = lambda name, *cols: Counter(tuple(r) for r in Q.QUERIES[name](spark, d).select(*cols).collect())
    hits = {(i, n, t, k) for i, text in docs for k, (n, t) in enumerate(Q._WORDS) if re.search(rf"(?i)\b{t}\b", text)}
    assert rows("tech_concepts", "file_path", "name", "term", "ordinal") == Counter(hits)
    assert rows("service_concepts", "file_path", "name", "description") == Counter((i, n, " ".join(dict(docs)[i].split())) for i, n in {(i, n.lower()) for i, n, _, _ in hits})
    terms = Counter((i, m) for i, text in docs for m in re.findall("(?i)thhe(?:re|th)?", text))
    assert rows("term_concepts", "file_path", "name", "n") == Counter((i, m, n) for (i, m), n in terms.items())
    pairs = Counter((i, *map(str.lower, m.groups())) for i, text in docs for run in re.findall(r"[\w\s]+", text) if (m := re.fullmatch(r"(?i)\s*(\w+)\s+the\s+(\w+)\s*", run)) and m[1].lower() != m[2].lower())
    assert len(pairs) == 4 and rows("concept_relationships", "file_path", "src", "dst", "n") == Counter((*p, n) for p, n in pairs.items())
    out = {"ASIA": [("CONTAINS", x) for x in "ABC"], "AFRICA": [("CONTAINS", "D")], "D": [("IN", "AFRICA")], "A": [("IN", "ASIA"), ("CONTAINS", "c0")]}
    out |= {"B": [("IN", "ASIA"), ("CONTAINS", "c1"), ("CONTAINS", "c2"), ("CONTAINS", "s1")], "C": [("IN", "ASIA"), ("CONTAINS", "c3"), ("CONTAINS", "s2")]}
    kind = lambda x: "Region" if x in ("ASIA", "AFRICA") else {"c": "Customer", "s": "Supplier"}.get(x[0], "Nation")
    want, frontier = Counter(), [("ASIA", ())]
    for _ in range(8):
        frontier = [(y, (*path, e)) for x, path in frontier for r, y in out.get(x, []) if (e := f"{kind(x)}:{x}>{r}>{kind(y)}:{y}") not in path]
        want.update((f"{kind(x)}:{x}", len(path), ";".join(path)) for x, path in frontier)
    assert rows("var_length_trails", "end_id", "depth", "path") == want


def test_lists_of_evidence_are_dealt_once(spark):
    assert plan(Q.QUERIES["merge_triples_segments"](spark, DATA)).count("Exchange hashpartitioning") == 2  # rows for the summary, evidence; lists and digests were dealt again


def test_tasks_follow_the_rows(spark):
    from knotwork.plans.lineage import dealt

    assert [dealt(spark.range(n), "id", rows=3).rdd.getNumPartitions() for n in (0, 3, 10)] == [1, 1, 4]
    for name in ("known_concepts", "top_degree", "graph_sql"):  # these dealt all rows to a number of tasks that stays as tables grow
        assert "REPARTITION_BY_NUM" in plan(Q.QUERIES[name](spark, DATA)), name


def test_tasks_take_in_little_at_once(spark):
    from knotwork.plans.lineage import SMALLER

    docs = spark.createDataFrame([(str(i), f"the {i}") for i in range(1200)], "file_path string, content string").coalesce(1)
    batch = "spark.sql.execution.arrow.maxBytesPerBatch"
    for before, after in ((None, "8m"), ("1m", "1m")):
        for name in SMALLER:
            spark.conf.unset(name)
        if before:
            spark.conf.set(batch, before)
        hits = Q.concepts.term_hits(docs, Q.word_vocabulary(spark))
        assert spark.conf.get(batch) == after
        assert {(r["file_path"], r["description"]) for r in hits.collect()} == {(str(i), f"the {i}") for i in range(1200)}
