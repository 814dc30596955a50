import random

import numpy as np
from knotwork.functions import vocabulary as V
from knotwork.operators import clustering, concepts, extraction, merging, normalization, store, validation
from knotwork.plans.components import components
from pyspark.sql import functions as F

TRIPLE = "seq long, subject string, subject_type string, relation string, object string, object_type string, evidence string, inferred boolean, source string, confidence double, section string, url string, timestamp string"


def triples(spark, *rows):
    full = [(i, *(list(r) + ["a b c", False, None, 1.0, None, None, None][len(r) - 5 :])) for i, r in enumerate(rows)]
    return spark.createDataFrame(full, TRIPLE)


def test_concepts(spark):
    text = "Use EC2, EC2x and S3 bucket. S3 uses Subnets here. Route tables and route table"
    df = spark.createDataFrame([("d", text), ("e", "nothing"), ("f", None)], "file_path string, content string")
    got = concepts.concepts(df, V.service_vocabulary(spark), V.technology_vocabulary(spark), V.ARCHITECTURE_TERMS).orderBy("seq").collect()
    assert [(r["name"], r["type"]) for r in got] == [("Amazon EC2", "service"), ("Amazon S3", "service"), ("Subnet", "technology"), ("Route table", "concept")]
    assert all(r["file_path"] == "d" and r["description"] for r in got)


def test_concept_relations(spark):
    df = spark.createDataFrame([("d", "Alpha uses Beta. Alpha uses Alpha. x Alpha connects to Beta, Beta peers with\nGamma. uses Beta. Alpha uses")], "file_path string, content string")
    names = spark.createDataFrame([("d", n) for n in ("Alpha", "Beta", "GAMMA")], "file_path string, name string")
    got = concepts.concept_relations(df, names, V.CONCEPT_VERBS)
    assert {(r["src"], r["rel_type"], r["dst"]) for r in got.collect()} == {("Alpha", "USES", "Beta"), ("Beta", "PEERS_WITH", "GAMMA")}


def test_relations_merge_only_names_that_a_verb_parts(spark):
    texts = [("d", "Alpha uses Beta. ALPHA uses  beta"), ("d", "x. Alpha uses Beta"), ("d", "Alpha uses Beta gamma"), (None, "Alpha uses Beta"), ("e", None), ("f", ""), ("g", "Alpha uses Beta"), ("h", "uses")]
    found = [("d", "Alpha", 1), ("d", "ALPHA", 2), ("d", "Beta", 1), ("d", "Beta", 1), ("d", "beta", None), ("d", None, 3), (None, "Alpha", 1), (None, "Beta", 1), ("g", "Alpha", 1), ("e", "Beta", 1)]
    docs = spark.createDataFrame(texts, "file_path string, content string")
    names = spark.createDataFrame([*found, *(("d", f"n{i}", i) for i in range(1000))], "file_path string, name string, seq int")
    for df, src, dst in ((names.drop("seq"), "Alpha", "beta"), (names, "ALPHA", "Beta")):
        got = concepts.concept_relations(docs, df, V.CONCEPT_VERBS)
        assert sorted(map(tuple, got.collect())) == [("d", src, "USES", dst, k) for k in (1, 2, 3)]
        plan = got._jdf.queryExecution().toString()
        assert "ShuffledHashJoin" in plan and "LeftSemi" in plan  # all names were sorted and merged before


def test_registry(spark):
    asked = [("Amazon EC2", "Service"), ("S3 bucket", "Service"), ("VPC Endpoint", "Component"), ("VPC Endpoint", "Service"), ("AWS Direct Connect", "Service"), ("Simple Storage Service", "Service"), (" ", "Service"), (None, "Role")]
    names = spark.createDataFrame(asked, "name string, entity_type string")
    registry = V.registry_table(spark)
    got = {(r["name"], r["entity_type"]): r["canonical"] for r in normalization.normalize_names(names, registry).collect()}
    assert [got[k] for k in asked] == ["Amazon EC2", "Amazon S3", "VPC Endpoint", "Amazon VPC", None, None, None, None]
    raw = {(r["name"], r["entity_type"]): r["canonical"] for r in normalization.normalize_names(names, registry, try_raw_first=True).collect()}
    assert raw["AWS Direct Connect", "Service"] == "AWS Direct Connect" and raw["Simple Storage Service", "Service"] == "Amazon S3"
    more = normalization.add_entities(registry, spark.createDataFrame([("Downtime", "Risk", ["Outage"], 9)], registry.schema))
    assert normalization.find_canonical(spark.createDataFrame([("OUTAGE", "Risk")], "name string, entity_type string"), more).first()["canonical"] == "Downtime"
    assert normalization.variants(registry).count() == 152


def test_relation_labels(spark):
    want = {"utilizes": "uses", "Depends On": "depends_on", "related to": "RELATES_TO", "recommend_by": "recommended_by", "contains": "CONTAINS", "recommends": None, "used_by": None, "protects": None, "makes use of": "uses", " ": None}
    df = spark.createDataFrame([(k,) for k in want], "relation string")
    assert {r["relation"]: r["canonical"] for r in normalization.normalize_relations(df, V.paraphrase_table(spark)).collect()} == want
    raw = {r["relation"]: r["canonical"] for r in normalization.normalize_relations(df, V.paraphrase_table(spark), keys_too=False).collect()}
    assert raw["makes use of"] is None


def test_normalized_triples(spark):
    df = triples(spark, ("EC2", "Service", "uses", "EBS", "Component"), ("EC2", "Service", "uses", "nothing", "Component"))
    names = df.select(F.col("subject").alias("name"), F.col("subject_type").alias("entity_type")).union(df.select("object", "object_type"))
    mapping = normalization.normalize_names(names, V.registry_table(spark))
    got = normalization.normalize_triples(df, mapping).orderBy("seq").collect()
    assert [(r["subject"], r["object"], r["confidence"]) for r in got] == [("Amazon EC2", "EBS Volume", 1.0), ("Amazon EC2", "nothing", 0.0)]
    assert [r["name"] for r in normalization.first_mappings(df, mapping).orderBy("first_seq", "role").collect()] == ["EC2", "EBS"]


def test_payloads(spark):
    cases = {
        "fenced": 'Here:\n```json\n[{"subject": "S3", "object": "EBS", "object_type": "Component", "relation": "Depends On", "evidence": " e "}]\n```',
        "defaults": '[{"subject": "a", "object": "b"}]', "type": '[{"subject": "a", "object": "b", "subject_type": "No"}]', "relation": '[{"subject": "a", "object": "b", "relation": "no such"}]',
        "prose": 'see [1] then [{"subject": "a", "object": "b"}]', "object": '{"subject": "a"}', "broken": "[{", "null": None, "blank": '[{"subject": " ", "object": "b"}]',
    }
    df = spark.createDataFrame([(k, None, None, None, v) for k, v in cases.items()], "source string, section string, url string, timestamp string, payload string")
    got = {}
    for r in extraction.parse_triples(df).collect():
        got.setdefault(r["source"], []).append((r["status"], r["relation"], r["subject_type"], r["evidence"]))
    assert got["fenced"] == [(None, "depends_on", "Service", "e")]
    assert got["defaults"] == [(None, "uses", "Service", "a uses b")]
    assert [got[k][0][0] for k in ("type", "relation", "blank")] == ["unknown type", "unknown relation", "missing name"]
    assert all(r[0] == "missing name" for k in ("prose", "object", "broken", "null") for r in got.get(k, []))
    spans = extraction.parse_triples(df.where("source = 'prose'"), require_objects=True).collect()
    assert [(r["subject"], r["object"]) for r in spans] == [("a", "b")]


def test_json_round_trip(spark):
    df = triples(spark, ("a", "Service", "uses", "b", "Component", "e", True, "s", 0.5, "sec", "u", "t"))
    assert extraction.from_json(extraction.to_json(df)).collect() == df.select("seq", *df.columns[1:]).collect()


def test_validation(spark):
    df = triples(
        spark, ("", "Service", "uses", "b", "Component"), ("a", "Service", "uses", None, "Component"), ("a", "Service", "uses", "b", "Component", " "), ("a", "Service", "implements", "b", "Service"), ("a", "Service", "uses", "b", "Component", "two words"),
        ("a", "Service", "uses", "b", "Component", "two words", True), ("a", "Pattern", "recommended_by", "b", "Pillar"), ("a", "Role", "CONTAINS", "b", "Role"), ("a", "No", "uses", "b", "Component"),
    )
    got = validation.validate(df, V.rule_table(spark))
    assert [r["error_type"] for r in got.orderBy("seq").collect()] == ["required_field", "required_field", "required_field", "schema", "evidence", None, "schema", None, "schema"]
    assert validation.valid(got).count() + validation.errors(got).count() == df.count()
    assert "invalid 7" in validation.report(got, shown=2) and "and 5 more" in validation.report(got, shown=2)
    free = V.rule_table(spark).where("relation <> 'recommended_by'")
    assert validation.validate(df, free).where("seq = 6").first()["error_type"] == "business_rule"
    assert {r[0] for r in validation.allowed_objects(V.rule_table(spark), "uses", "Service").collect()} == {"Component", "Service"}
    assert {r[0] for r in validation.allowed_subjects(V.rule_table(spark), "addresses", "Risk").collect()} == {"Mitigation", "BestPractice"}
    assert validation.compatible(V.rule_table(spark), df).count() == 7 - 1


def test_merging(spark):
    df = triples(spark, ("S3", "Service", "uses", "EBS", "Component", "e1", False, None, 1.0, None, None, "2024-02"), ("s3", "Role", "USES", "ebs", "Risk", "e2", True, "x", 0.5, None, None, "2024-01"), ("q", "Service", "uses", "r", "Component"))
    merged = merging.merge_triples(df, "now")
    r = merged.where("total_count = 2").first()
    assert (r["subject"], r["object_type"], r["inferred_count"], r["first_seen"], r["last_seen"]) == ("S3", "Component", 1, "2024-02", "2024-01")
    assert [(e["source"], e["score"], e["evidence"]) for e in r["evidence_sources"]] == [("unknown", 1.0, "e1"), ("x", 0.5, "e2")]
    assert merging.merge_conflicts(merged).count() == 1 and merged.where("subject = 'q'").first()["first_seen"] == "now"
    shuffled = merging.merge_triples(df.orderBy(F.desc("seq")), "now")
    assert sorted(shuffled.collect()) == sorted(merged.collect())
    assert merging.merge_stats(merged.where("false")).first()["avg_evidence"] == 0


def test_merging_deals_rows_as_they_are(spark):
    df = triples(spark, ("a", "Service", "uses", "b", "Component", "e1", False, None, 1.0, None, "long url"), ("A", "Service", "uses", "b", "Component", "e2", False, "x"), (None, "Service", "uses", "b", "Component"))
    merged = merging.merge_triples(df, fields=["source"])
    below = merged._jdf.queryExecution().executedPlan().toString().split("Exchange hashpartitioning(")
    assert len(below) == 2 and "Aggregate" not in below[1] and "url" not in below[1].split("Scan")[0]
    assert sorted(([e.asDict() for e in r["evidence_sources"]] for r in merged.collect()), key=len) == [[{"source": "unknown"}], [{"source": "unknown"}, {"source": "x"}]]


def test_store_and_diff(spark, tmp_path):
    df = triples(spark, ("a", "Service", "uses", "b", "Component", "one"), ("A", "Service", "uses", "B", "Component", "two"), ("c", "Service", "uses", "d", "Component", "three"))
    empty = store.empty_store(spark)
    assert store.diff_stats(store.diff(empty, df)).first().asDict() == {"new_triples": 3, "added": 2, "updated": 0, "unchanged": 0, "conflicts": 0}
    once = store.upsert(empty, df, "t")
    twice = store.upsert(once, df, "u")
    assert store.diff_stats(store.diff(once, df)).first()["updated"] == 3
    assert {r["subject"]: (r["update_count"], r["first_seen"], r["last_seen"]) for r in twice.collect()} == {"a": (4, "t", "u"), "c": (2, "t", "u")}
    store.write(twice, str(tmp_path / "s"))
    back = store.read(spark, str(tmp_path / "s"))
    assert sorted(back.select(twice.columns).collect()) == sorted(twice.collect())
    assert store.find(back, "A", "Uses", "b").first()["update_count"] == 4 and store.get(back, "no").count() == 0
    assert "new 3" in store.diff_report(store.diff(empty, df), shown=1) and "and 2 more" in store.diff_report(store.diff(empty, df), shown=1)


def slow_linkage(vectors, threshold):
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    d = 1 - unit @ unit.T
    groups = [[i] for i in range(len(d))]
    while len(groups) > 1:
        best = min((np.mean([[d[p][q] for q in groups[j]] for p in groups[i]]), i, j) for i in range(len(groups)) for j in range(i + 1, len(groups)))
        if best[0] > threshold:
            break
        groups[best[1]] += groups.pop(best[2])
    return sorted(sorted(g) for g in groups)


def test_average_linkage():
    rng = np.random.default_rng(1)
    for n in (1, 2, 5, 25):
        x = rng.normal(size=(n, 3)) + rng.integers(0, 3, (n, 1))
        of = clustering.average_linkage(x, 0.2)
        assert sorted(sorted(np.flatnonzero(of == k).tolist()) for k in set(of.tolist())) == slow_linkage(x, 0.2)


def test_clusters_by_type(spark):
    rng = np.random.default_rng(2)
    x = rng.normal(size=(30, 3))
    rows = [("A" if i % 2 else "B", f"n{i:02d}", x[i].tolist()) for i in range(30)] + [("C", "alone", [1.0, 0.0, 0.0]), ("A", "none", None)]
    got = clustering.cluster_entities(spark.createDataFrame(rows, "entity_type string, name string, embedding array<double>"), 0.8).collect()
    assert not any(r["entity_type"] == "C" or r["name"] == "none" for r in got)
    for t in "AB":
        own = [i for i in range(30) if ("A" if i % 2 else "B") == t]
        want = [sorted(f"n{own[k]:02d}" for k in g) for g in slow_linkage(x[own], 0.2)]
        found = {}
        for r in got:
            if r["entity_type"] == t:
                found.setdefault(r["cluster_id"], []).append(r["name"])
        assert sorted(map(sorted, found.values())) == sorted(want)
    canonical = clustering.cluster_canonical(spark.createDataFrame([("k", "bb"), ("k", "Aa"), ("k", "ccc")], "cluster_id string, name string"))
    assert canonical.first()["canonical"] == "Aa"


def test_components(spark):
    rng = random.Random(3)
    pairs = [(rng.randrange(60), rng.randrange(60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(40)] + [(5, 5), (None, 3)]
    root = {}
    find = lambda x: x if root.setdefault(x, x) == x else find(root[x])
    for a, b in pairs:
        if a is not None and a != b:
            a, b = sorted((find(a), find(b)))
            root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(pairs, "u long, v long")).collect()}
    assert got == {k: find(k) for k in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
