import os

import pytest

corpus_pipeline = pytest.importorskip("corpus_pipeline")
DATA = "/root/testdata/sf0.001"


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")
def test_stages_and_run(spark):
    from collections import Counter

    from tests.llm.test_tables import components_of, shingles

    docs = spark.read.parquet(f"{DATA}/documents.parquet")
    columns = docs.columns
    rows, items = docs.collect(), spark.read.parquet(f"{DATA}/benchmark.parquet").collect()
    now, kept = docs, []
    for name, stage in corpus_pipeline.STAGES[:-1]:
        now = stage(spark, now, DATA)
        assert now.columns == columns, name
        now = spark.createDataFrame(now.collect(), docs.schema)
        kept.append(Counter(r["doc_id"] for r in now.collect()))
    assert set(kept[0]) == {r["doc_id"] for r in rows if any(c.isalpha() for c in r["text"] or "")}
    left = [r for r in rows if r["doc_id"] in kept[0]]
    root = components_of([shingles(r["text"], 5) for r in left], 80)
    assert set(kept[1]) == {min(left[i]["doc_id"] for i in range(len(left)) if root[i] == k) for k in set(root)}
    dirty = {r["doc_id"] for r in rows if any(x["text"] in (r["text"] or "") for x in items)}
    assert set(kept[2]) == set(kept[1]) - dirty
    assert set(kept[3]) <= set(kept[2]) and max(kept[3].values()) <= 2
    got = corpus_pipeline.run(spark, DATA).collect()
    assert Counter(r["doc_id"] for r in got) == kept[3]
    shard = {}
    for r in got:
        assert 0 <= r["shard"] < 16 and shard.setdefault(r["doc_id"], r["shard"]) == r["shard"]


def test_stages_on_hard_rows(spark, docs, clashing, nothing, tmp_path):
    """Nulls, empty and long texts, ties, repeated rows, clashing names and empty tables."""
    spark.createDataFrame([(1, "a row without a number"), (2, None), (3, "")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, nothing, str(tmp_path)).count() == 0, name
        got = stage(spark, clashing, str(tmp_path))
        assert got.columns == clashing.columns and 0 < got.count() <= 2 * clashing.count(), name
        assert sorted(map(str, got.select(docs.columns).collect())) == sorted(map(str, stage(spark, docs, str(tmp_path)).collect())), name
    last = corpus_pipeline.STAGES[-1][1]
    assert last(spark, nothing, str(tmp_path)).count() == 0
    assert last(spark, clashing, str(tmp_path)).count() == docs.count()
