"""Versions of the store, the stateful stream, and lists in segments."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from knotwork.functions.text import fingerprint
from knotwork.operators import graph, matching, merging, segments, store
from knotwork.plans.lineage import shared_dir
from knotwork.streaming import upserts


def triples(spark, rows):
    full = [(seq, s, "Service", "uses", o, "Component", f"e{seq}", False, None, 1.0, None, None, f"2024-01-{seq % 28 + 1:02d}") for seq, s, o in rows]
    return spark.createDataFrame(full, upserts.TRIPLE)


def entries(df):
    return {(r["subject"], r["object"]): (r["update_count"], r["first_seen"], r["last_seen"], [e["evidence"] for e in r["evidence_sources"]]) for r in df.collect()}


def test_a_batch_touches_its_own_buckets(spark, tmp_path):
    root = str(tmp_path / "store")
    first = [(i, f"s{i}", "o") for i in range(2000)]
    assert store.newest(spark, root) == 0 and store.current(spark, root).count() == 0
    assert store.commit(triples(spark, first), root) == 1
    before = {p: os.path.getmtime(p) for p in glob.glob(f"{root}/v1/**/*.parquet", recursive=True)}
    second = [(3000 + i, f"S{i}", "o") for i in range(10)]
    assert store.commit(triples(spark, second), root) == 2
    assert len(glob.glob(f"{root}/v2/data/bucket=*")) <= 10
    assert before == {p: os.path.getmtime(p) for p in glob.glob(f"{root}/v1/**/*.parquet", recursive=True)}
    want = store.upsert(store.new_entries(triples(spark, first)), triples(spark, second))
    assert entries(store.current(spark, root)) == entries(want)
    assert store.read(spark, f"{root}/v1").count() == 2000  # an old version stays as it was
    one = spark.range(1).select(fingerprint(F.lit("s3"), F.lit("uses"), F.lit("o"))).first()[0]
    bucket = store.current(spark, root, one)
    assert bucket.count() < 100 and store.get(bucket, one).first()["update_count"] == 2


def test_a_batch_that_broke_off_and_one_that_runs_again(spark, tmp_path):
    root = str(tmp_path / "store")
    store.commit(triples(spark, [(1, "a", "b")]), root, writer="w", number=0)
    store._write_buckets(store.new_entries(triples(spark, [(9, "lost", "b")])), f"{root}/v2")  # no manifest
    assert store.newest(spark, root) == 1 and entries(store.current(spark, root)).keys() == {("a", "b")}
    for _ in range(2):
        assert store.commit(triples(spark, [(2, "a", "b"), (3, "c", "d")]), root, writer="w", number=1) == 2
    assert {k: v[0] for k, v in entries(store.current(spark, root)).items()} == {("a", "b"): 2, ("c", "d"): 1}
    assert store.commit(triples(spark, [(4, "a", "b")]), root, writer="other", number=0) == 3
    assert store.commit(triples(spark, []), root, writer="w", number=2) == 4
    assert {k: v[0] for k, v in entries(store.current(spark, root)).items()} == {("a", "b"): 3, ("c", "d"): 1}


def test_a_new_stream_on_an_old_store(spark, tmp_path):
    root = str(tmp_path / "store")
    for k in range(2):
        triples(spark, [(k, "a", "b"), (10 + k, "x", str(k))]).coalesce(1).write.parquet(str(tmp_path / f"in{k}"))
        upserts.start(upserts.read_triples(spark, str(tmp_path / f"in{k}")), root, str(tmp_path / f"cp{k}")).awaitTermination()
    assert {k: v[0] for k, v in entries(store.current(spark, root)).items()} == {("a", "b"): 2, ("x", "0"): 1, ("x", "1"): 1}


def test_stateful_changes(spark, tmp_path):
    batches = [[(1, "a", "b"), (2, "A", "b"), (3, "c", "d")], [(4, "a", "B"), (5, "e", "f")]]
    folder, seen = str(tmp_path / "in"), []
    for k, rows in enumerate(batches):
        triples(spark, rows).coalesce(1).write.mode("append").parquet(folder)
        stream = upserts.changes(upserts.read_triples(spark, folder))
        q = stream.writeStream.foreachBatch(lambda df, n: seen.extend(map(tuple, df.collect()))).outputMode("update").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        q.awaitTermination()
    fp = {x: spark.range(1).select(fingerprint(F.lit(x[0]), F.lit("uses"), F.lit(x[1]))).first()[0] for x in ("ab", "cd", "ef")}
    assert sorted(seen) == sorted([(fp["ab"], "new", 2, 2, "2024-01-02", "2024-01-03"), (fp["cd"], "new", 1, 1, "2024-01-04", "2024-01-04"), (fp["ab"], "updated", 1, 3, "2024-01-02", "2024-01-05"), (fp["ef"], "new", 1, 1, "2024-01-06", "2024-01-06")])


def test_segments_of_a_hot_key(spark):
    n = 60_000
    rows = spark.range(n).select(F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"), (n - F.col("id")).alias("seq")).repartition(7, "seq")
    held = segments.segments(rows, ["k"], [F.col("seq")], F.col("seq"), 1000)
    sizes = {r["k"]: (r["most"], r["n"]) for r in held.groupBy("k").agg(F.max("n").alias("most"), F.sum("n").alias("n")).collect()}
    assert sizes["hot"][0] <= 1000 and sizes["hot"][1] == n - n // 3 and len(sizes) == 501
    last = 0
    for r in held.where("k = 'hot'").orderBy("segment").toLocalIterator():
        assert r["items"] == sorted(r["items"]) and r["items"][0] > last
        last = r["items"][-1]
    whole = segments.assembled(held.where("k <> 'hot'"), ["k"]).collect()
    assert all(r["items"] == sorted(r["items"]) and len(r["items"]) == r["n"] for r in whole) and sum(r["n"] for r in whole) == n // 3
    assert {r["k"]: r["n"] for r in segments.lengths(held, ["k"]).collect()} == {k: v[1] for k, v in sizes.items()}


@pytest.mark.parametrize("size", [2, 10_000])
def test_evidence_as_it_is_when_collected(spark, size):
    rows = [("a", "b", "USES", e, i) for i, e in enumerate(["x", None, "y", "x", None])] + [("a", "c", "USES", None, 1), ("q", "b", "USES", "only", 9), (None, "b", "USES", "e", 1)]
    edges = spark.createDataFrame(rows, "src_id string, dst_id string, rel_type string, evidence string, seq long")
    got = {tuple(r) for r in graph.assembled_evidence(graph.evidence_segments(edges.where("src_id is not null"), size)).collect()}
    want = {tuple(r) for r in graph.merge_edges(edges).select("src_id", "dst_id", "rel_type", "evidence").where("src_id is not null and evidence is not null").collect()}
    assert got == want
    t = triples(spark, [(1, "a", "b"), (2, "A", "b"), (3, "c", "d")])
    whole = segments.assembled(merging.evidence_segments(t, size=size), ["fingerprint"]).select("fingerprint", F.col("items").alias("evidence_sources"))
    met = merging.merge_summary(t).join(whole, "fingerprint")
    merged = merging.merge_triples(t)
    assert sorted(map(str, met.select(merged.columns).collect())) == sorted(map(str, merged.collect()))


def test_summary_and_evidence_meet_where_they_are_dealt(spark):
    rows = [(i, f"S{i % 40}", "b") for i in range(100)] + [(i, "HOT" if i % 2 else "hot", "b") for i in range(100, 160)] + [(5, "S5", "b"), (7, None, "b"), (7, None, "b"), (8, "x", None), (9, None, None), (3, "X", None)]
    for rows, size, n, sorts in ((rows, 2, 1, False), (rows, 100, 0, True), (rows[:40], 100, 0, False)):  # some are crowded, none is, each is alone
        t = triples(spark, rows)
        merged = merging.merge_triples(t)
        want = sorted(map(str, merged.collect()))
        crowds = merging.crowded(t, size)
        lists = segments.assembled(merging.evidence_segments(t, size=size, crowds=crowds), ["fingerprint"]).select("fingerprint", F.col("items").alias("evidence_sources"))
        met = merging.merge_summary(t, crowds=crowds).join(lists.hint("merge"), "fingerprint").select(merged.columns)
        assert len(crowds.hashes) == n and (crowds.rows > 2 * crowds.keys) == sorts and sorted(map(str, met.collect())) == want
        shuffles = met._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[-1].count("Exchange hashpartitioning")
        assert shuffles == 2 + 3 * n  # rows and evidence as they are; sums of crowded triples, their segments, and these again


def test_segments_of_short_lists_are_not_written_before(spark):
    def held():
        sc = spark.sparkContext
        at = sc._jvm.org.apache.hadoop.fs.Path(shared_dir(spark))
        return at.getFileSystem(sc._jsc.hadoopConfiguration()).getContentSummary(at).getLength()

    rows = spark.range(20_000).select((F.col("id") % 5_000).alias("k"), F.col("id").alias("seq"), F.repeat(F.md5(F.col("id").cast("string")), 4).alias("v"))
    before = held()
    got = segments.segments(rows, ["k"], [F.col("seq")], F.col("v"), 10)
    assert held() - before < 200_000  # the rows were written in full, 2.5 MB
    assert {(r["k"], r["n"], len(r["items"])) for r in got.collect()} == {(k, 4, 4) for k in range(5_000)}
    mixed = rows.where("k < 50").unionByName(rows.select(F.lit(None).cast("long").alias("k"), "seq", "v"))
    lists = {r["k"]: (r["n"], [x for part in sorted((s["segment"], s["items"]) for s in r["all"]) for x in part[1]]) for r in segments.segments(mixed, ["k"], [F.col("seq")], F.col("v"), 10).groupBy("k").agg(F.sum("n").alias("n"), F.collect_list(F.struct("segment", "items")).alias("all")).collect()}
    want = [r["v"] for r in rows.orderBy("seq").collect()]
    assert len(lists) == 51 and lists[None] == (20_000, want) and all(lists[k] == (4, want[k::5_000]) for k in range(50))


def test_trails_without_a_bound_and_with_a_limit(spark):
    edges = spark.createDataFrame([("n:a", "n:b", "T", None), ("n:b", "n:a", "T", None), ("n:b", "n:c", "T", None), ("n:c", "n:c", "T", None), ("n:c", "n:d", "U", None)], graph.EDGES)
    nodes = spark.createDataFrame([(f"n:{x}", "n", x, {}) for x in "abcd"], graph.NODES)

    def walk(at, path, out):
        for s, t, r, _ in [tuple(e) for e in edges.collect()]:
            e = f"{s}>{r}>{t}"
            if s == at and r == "T" and e not in path:
                out.append((t, len(path) + 1, (*path, e)))
                walk(t, (*path, e), out)
        return out

    want = walk("n:a", (), [])
    rows = lambda df: [(r["end_id"], r["depth"], tuple(r["path"])) for r in df.collect()]
    assert sorted(rows(matching.trails(nodes, edges, ["T"], F.col("name") == "a"))) == sorted(want)
    for k in (0, 1, 3, 100):
        assert rows(matching.trails(nodes, edges, ["T"], F.col("name") == "a", limit=k)) == sorted(want, key=lambda x: (x[1], x[2]))[:k]
    assert matching.trails(nodes, edges, ["T"], F.col("name") == "zz").count() == 0
