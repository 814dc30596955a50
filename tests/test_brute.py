"""Queries that have no SQL, over their whole tables, against brute force."""

import os
from collections import defaultdict
from difflib import SequenceMatcher

import numpy as np
import pytest

from knotwork.functions import vocabulary
from knotwork.plans import queries as Q
from tests.test_clustering import naive_average, naive_density

DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="no test tables here")


def vectors(spark):
    types = defaultdict(list)
    for r in spark.read.parquet(f"{DATA}/embeddings.parquet").collect():
        types[str(r["label"])].append((str(r["vec_id"]), r["embedding"]))
    return {t: (np.array([n for n, _ in rows]), [v for _, v in rows]) for t, rows in types.items()}


def groups(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r["entity_type"], r["cluster_id"]].add(r["name"])
    return sorted((t, sorted(v)) for (t, _), v in out.items())


def test_cluster_entities(spark):
    want = [(t, sorted(names[p].tolist())) for t, (names, vs) in vectors(spark).items() for p in naive_average(vs, 0.25)]
    assert groups(Q.cluster_entities(spark, DATA)) == sorted(want)


def test_density_clusters(spark):
    want = [(t, sorted(names[p].tolist())) for t, (names, vs) in vectors(spark).items() for p in naive_density(vs, 2, 1)]
    assert groups(Q.density_clusters(spark, DATA)) == sorted(want) and want


def test_relation_normalize_fuzzy(spark):
    names = [*vocabulary.RELATIONS, *vocabulary.PLAIN_RELATIONS]
    known = {"_".join(p.lower().split()): r for r, ps in vocabulary.PARAPHRASES.items() for p in ps}

    def canonical(relation):
        key = "_".join(relation.lower().replace("_", " ").split())
        if key in known:
            return known[key]
        if key in names:
            return key
        ratio, _, best = max((SequenceMatcher(None, key, n.lower()).ratio(), -k, n) for k, n in enumerate(names))
        if ratio >= 0.8:
            return best
        return next((n for n in names if n.lower() in key or key in n.lower()), None)

    got = {r["relation"]: r["canonical"] for r in Q.relation_normalize_fuzzy(spark, DATA).collect()}
    asked = {r[0] for t, c in (("events", "event_type"), ("part", "p_type")) for r in spark.read.parquet(f"{DATA}/{t}.parquet").select(c).collect()} | {"related to", "recommend_by", "contains", "recommends"}
    assert got == {a: canonical(a) for a in asked}
