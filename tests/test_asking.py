"""Clients that fail, and the nearest of many vectors."""

import json
import os
from collections import Counter

import numpy as np
import pytest

from knotwork.functions import vocabulary
from knotwork.operators import asking, extraction, nearest, normalization


def flaky(log, every=3, never="never"):
    """A client that notes what it is asked, fails every so many calls and always for some texts."""

    def client():
        calls = [0]

        def ask(texts):
            calls[0] += 1
            with open(f"{log}/{os.getpid()}", "a") as f:
                f.writelines(json.dumps(t) + "\n" for t in texts)
            if calls[0] % every == 0 or any(never in t for t in texts):
                raise OSError("busy")
            return [f"<{t}>" for t in texts]

        return ask

    return client


def asked(log):
    return Counter(json.loads(x) for p in os.listdir(log) for x in open(f"{log}/{p}"))


def test_no_row_is_lost_and_nothing_is_asked_twice(spark, tmp_path):
    os.mkdir(tmp_path / "log")
    rows = [(i, f"p{i % 40}", "x") for i in range(60)] + [(100, None, "x"), (101, "never me", "x")]
    chunks = spark.createDataFrame(rows, "id long, prompt string, payload_of string").repartition(5)
    cache, client = str(tmp_path / "cache"), flaky(str(tmp_path / "log"))
    for run in range(2):
        got = extraction.extract(chunks, client, cache=cache, wait=0.0)
        found = {r["id"]: (r["payload"], r["failure"]) for r in got.collect()}
        assert len(found) == 62 and found[100] == (None, None)
        assert found[101] == (None, "OSError: busy")
        assert all(found[i] == (f"<p{i % 40}>", None) for i in range(60))
        assert [r["id"] for r in extraction.failures(got).collect()] == [101]
        counts = asked(tmp_path / "log")
        if not run:
            first = counts
    assert {k: v for k, v in counts.items() if v != first[k]}.keys() == {"never me"}


def test_without_a_cache(spark, tmp_path):
    os.mkdir(tmp_path / "log")
    chunks = spark.createDataFrame([(i, f"p{i}") for i in range(20)], "id long, prompt string").repartition(2)
    got = extraction.extract(chunks, flaky(str(tmp_path / "log"), 2), wait=0.0).collect()
    assert {r["id"]: r["payload"] for r in got} == {i: f"<p{i}>" for i in range(20)}
    short = extraction.extract(chunks, lambda: lambda texts: [], tries=1, wait=0.0).collect()
    assert all(r["payload"] is None and "0 answers" in r["failure"] for r in short)
    assert asking.ready(lambda: lambda texts: texts) is None and "OSError" in asking.ready(flaky(str(tmp_path / "log"), 1))


VECTORS = "name string, entity_type string, embedding array<double>"


@pytest.mark.parametrize("sent", [4000, 10])
def test_nearest_against_all_pairs(spark, monkeypatch, sent):
    for k, v in (("SENT", sent), ("CELL", 20), ("PART", 30)):
        monkeypatch.setattr(nearest, k, v)
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 5))
    make = lambda n, t: [(f"{t}{i:03d}", t, (centres[rng.integers(0, 12)] + rng.normal(size=5) * 0.2).tolist()) for i in range(n)]
    canonical = make(300, "a") + make(7, "b") + [("a_zero", "a", [0.0] * 5), ("a_null", "a", None), ("A_copy", "b", None)]
    canonical += [("AA", "a", canonical[4][2])]  # a tie: the first name
    names = make(90, "a") + make(20, "b") + make(5, "c") + [("z", "a", [0.0] * 5), ("n", "a", None), ("w", "a", [1.0]), ("t", "a", canonical[4][2])]
    report = {}
    got = {(r["name"], r["entity_type"]): (r["canonical"], round(r["confidence"], 9)) for r in normalization.nearest_canonical(spark.createDataFrame(names, VECTORS), spark.createDataFrame(canonical, VECTORS), 0.8, report).collect()}
    want = {}
    unit = lambda v: np.array(v) / np.linalg.norm(v)
    for n, t, v in names:
        if v is None or len(v) != 5 or not any(v):
            continue
        near = [(-round(float(unit(v) @ unit(w)), 12), c) for c, k, w in canonical if k == t and w is not None and any(w)]
        if near and -min(near)[0] >= 0.8:
            want[n, t] = (min(near)[1], round(-min(near)[0], 9))
    assert got == want and len(want) > 60 and got["t", "a"][0] == "AA"
    if sent == 10:
        assert 0 < report["compared"] < 0.6 * report["pairs"], report


def test_semantic_names(spark, tmp_path):
    def client():
        return lambda names: [[1.0, float(len(n)), float("bucket" in n.lower())] for n in names]

    names = spark.createDataFrame([("S3", "Service"), ("my odd bucket", "Service"), ("?", "Metric")], "name string, entity_type string")
    for cache in (None, str(tmp_path / "vectors")):
        got = {r["name"]: r for r in normalization.normalize_semantic(names, vocabulary.registry_table(spark), client, 0.9, cache).collect()}
        assert got["S3"]["method"] == "exact" and got["S3"]["canonical"] == "Amazon S3"
        assert got["my odd bucket"]["method"] == "semantic" and 0.9 <= got["my odd bucket"]["confidence"] <= 1
        assert got["?"]["method"] == "none" and got["?"]["canonical"] is None
