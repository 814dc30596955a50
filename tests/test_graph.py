import json

from knotwork.operators import graph, matching
from knotwork.plans import cli
from knotwork.plans.imports import import_documents, import_triples
from knotwork.plans.settings import Settings, Templates, env_file
from knotwork.sources.markdown_files import read_markdown
from knotwork.streaming import upserts
from pyspark.sql import functions as F


def small_graph(spark):
    nodes = [("Service", "EC2"), ("Service", "S3"), ("Component", "EBS"), ("Pattern", "P"), ("Pillar", "Security"), ("BestPractice", "B1"), ("BestPractice", "B2"), ("Risk", "R"), ("Role", "alone")]
    edges = [("Service:EC2", "Component:EBS", "uses", "e"), ("Service:EC2", "Service:S3", "depends_on", "f"), ("Service:S3", "Service:EC2", "depends_on", None), ("Component:EBS", "Pattern:P", "implements", "g"), ("BestPractice:B1", "Pillar:Security", "recommended_by", "h"), ("BestPractice:B2", "Pillar:Security", "recommended_by", "h"), ("BestPractice:B1", "Risk:R", "addresses", "i")]
    return spark.createDataFrame([(f"{a}:{b}", a, b, {}) for a, b in nodes], graph.NODES), spark.createDataFrame(edges, graph.EDGES)


def test_matches(spark):
    nodes, edges = small_graph(spark)
    assert [r["src_name"] for r in matching.match(nodes, edges, "uses", "Service", "Component", dst_name="EBS").collect()] == ["EC2"]
    base = matching.match(nodes, edges, "recommended_by", "BestPractice", "Pillar", dst_name="Security")
    got = {r["src_name"]: r["collected"] for r in matching.optional_collect(nodes, edges, base, "addresses", "Risk", ["src_name"]).collect()}
    assert got == {"B1": ["R"], "B2": []}
    assert [r["name"] for r in matching.isolated(nodes, edges).collect()] == ["alone"]
    assert matching.with_evidence(nodes, edges).count() == 6
    assert matching.match_three(nodes, edges, ("Service", "implements", "Pattern"), ("BestPractice", "recommended_by", "Pillar"), "example_of").count() == 0


def test_trails_take_no_edge_twice(spark):
    nodes, edges = small_graph(spark)
    got = matching.trails(nodes, edges, ["uses", "implements", "depends_on"], F.col("name") == "EC2")
    assert {(r["end_id"], r["depth"]) for r in got.collect()} == {("Component:EBS", 1), ("Pattern:P", 2), ("Service:S3", 1), ("Service:EC2", 2), ("Component:EBS", 3), ("Pattern:P", 4)}
    assert matching.trails(nodes, edges, ["none"], F.col("name") == "EC2").count() == 0


def test_merging_and_names_of_types(spark):
    rows = spark.createDataFrame([(1, "a", "x y", None), (2, "a", "x y", "two"), (3, "a", "x-y", "three"), (4, "a", "__", "four")], "seq long, k string, t string, e string")
    edges = graph.merge_edges(graph.edge(rows, F.col("k"), graph.relation_type(F.col("t")), F.col("k"), F.col("e"), F.col("seq")))
    assert {(r["rel_type"], r["evidence"]) for r in edges.collect()} == {("X_Y", " | two"), (None, "three | four")}
    nodes = graph.merge_nodes(graph.node(rows, "N", F.col("k"), F.col("k"), F.col("seq"), e=F.col("e")))
    assert [r["props"] for r in nodes.collect()] == [{"e": "four"}]


def test_clear_and_migrate(spark, tmp_path):
    nodes, edges = small_graph(spark)
    counts, kept, rest = graph.clear_domain(nodes, edges, "unknown")
    assert counts.first().asDict() == {"domains": 0, "categories": 0, "documents": 0, "sections": 0}
    assert kept.count() == nodes.count() and rest.count() == edges.count()
    from knotwork.functions.vocabulary import registry_table

    more = nodes.unionByName(spark.createDataFrame([("Concept:ebs", "Concept", "ebs", {"type": "t"}), ("Concept:zzz", "Concept", "zzz", {})], graph.NODES))
    wired = edges.unionByName(spark.createDataFrame([("Concept:zzz", "Concept:ebs", "USES", None)], graph.EDGES))
    moved, nodes2, edges2 = graph.migrate_concepts(more, wired, registry_table(spark))
    assert [tuple(r) for r in moved.collect()] == [("Concept:ebs", "ebs", "EBS Volume", "Component")]
    assert {r["node_id"] for r in nodes2.where("name IN ('EBS Volume', 'zzz')").collect()} == {"Component:EBS Volume", "Concept:zzz"}
    assert edges2.where("rel_type = 'USES'").first()["dst_id"] == "Component:EBS Volume"


FILES = {
    "dom/cat/A.md": "# Alpha\nEC2 uses Subnet here.\n## Part\nSee [b](./B.md) and S3.\n",
    "dom/cat/B.md": "# Beta\r\nAmazon S3 stores things.\r\n",
    "top.md": "no heading",
    "dom/skip.txt": "not read",
}


def folder(tmp_path):
    for name, text in FILES.items():
        p = tmp_path / "in" / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(text.encode())
    return str(tmp_path / "in")


def test_reading_and_importing(spark, tmp_path):
    files = read_markdown(spark, folder(tmp_path))
    assert [r["file_path"] for r in files.orderBy("file_path").collect()] == ["dom/cat/A.md", "dom/cat/B.md", "top.md"]
    assert "\r" not in files.where("file_path LIKE '%B.md'").first()["content"]
    client = lambda: lambda prompts: ['{"entities": ["X", {"name": "Y", "type": "T"}], "relations": [["X", "links to", "Y"], ["X", "Y"]]}' for _ in prompts]
    got = import_documents(files.select("file_path", "content"), client=client)
    labels = {r["label"]: r["n"] for r in matching.count_by_label(got.nodes).collect()}
    assert labels["Document"] == 3 and labels["Section"] == 3 and labels["Domain"] == 1 and labels["Category"] == 1 and labels["Entity"] == 2
    types = {r["rel_type"] for r in got.edges.select("rel_type").distinct().collect()}
    assert {"CONTAINS", "DOCUMENTS", "MENTIONS", "REFERENCES", "EXTRACTS", "LINKS_TO", "RELATES_TO"} <= types
    assert [r["heading"] for r in matching.structure(got.nodes, got.edges, "Alpha").collect()] == ["Alpha", "Part"]


def test_triple_import_and_the_store(spark, tmp_path):
    files = spark.createDataFrame([("a.md", "# A\ntext"), ("b.md", "# B\ntext")], "file_path string, content string")
    payload = json.dumps([{"subject": "S3", "relation": "uses", "object": "EBS", "object_type": "Component", "evidence": "S3 uses EBS volumes"}, {"subject": "x", "object": "y", "relation": "implements", "evidence": "a b c"}])
    client = lambda: lambda prompts: [payload for p in prompts if p.startswith("Go")]
    templates = Templates("Go\n")
    got = import_triples(files, client, Settings(run_ts="t"), templates)
    assert (got.stats["chunks"], got.stats["triples"], got.stats["valid"], got.stats["merged"], got.stats["added"]) == (2, 4, 2, 1, 1)
    assert [(r["src_id"], r["rel_type"], r["dst_id"], r["evidence"]) for r in got.edges.collect()] == [("Service:Amazon S3", "uses", "Component:EBS Volume", "S3 uses EBS volumes | S3 uses EBS volumes")]
    again = import_triples(files, client, Settings(run_ts="u"), templates, stored=got.tables["store"])
    assert again.stats["updated"] == 2 and again.tables["store"].first()["update_count"] == 4
    assert templates.get("unknown") == "Go\n"


def test_settings():
    s = Settings.from_env(environ={"KNOTWORK_MIN_TOKENS": "5", "KNOTWORK_STRICT": "yes", "KNOTWORK_SIMILARITY": "0.5", "OTHER": "x"})
    assert (s.min_tokens, s.strict, s.similarity, s.max_tokens) == (5, True, 0.5, 3000) and s.to_dict()["strict"] is True


def test_settings_of_a_file(tmp_path):
    (tmp_path / "e").write_text("# comment\n\nKNOTWORK_MIN_TOKENS=7\nexport KNOTWORK_URL_BASE='http://h/#a'\nKNOTWORK_RUN_TS = t1 # now\nnothing\n")
    got = Settings.from_env(environ=env_file(str(tmp_path / "e")))
    assert (got.min_tokens, got.url_base, got.run_ts) == (7, "http://h/#a", "t1") and env_file(str(tmp_path / "no")) == {}


def test_command_line(spark, tmp_path, capsys):
    g = str(tmp_path / "graph")
    assert cli.main(["--graph", g, "import", folder(tmp_path)], spark) == 0
    n = graph.read_graph(spark, g)[0].count()
    assert cli.main(["--graph", g, "import", str(tmp_path / "in")], spark) == 0
    assert graph.read_graph(spark, g)[0].count() == n
    assert cli.main(["--graph", g, "migrate", "--dry-run"], spark) == 0 and "Amazon S3" in capsys.readouterr().out
    assert cli.main(["--graph", g, "clear", "--domain", "dom", "--confirm"], spark) == 0
    assert graph.read_graph(spark, g)[0].where("label = 'Document'").count() == 1
    assert cli.main(["--graph", g, "import", str(tmp_path / "nowhere")], spark) == 1


def test_a_graph_is_never_half_written(spark, tmp_path):
    g = f"file://{tmp_path}/graph"
    assert [t.count() for t in graph.read_graph(spark, g)] == [0, 0]
    nodes = spark.createDataFrame([("n:a", "n", "a", {}), ("n:b", "n", "b", {})], graph.NODES)
    edges = spark.createDataFrame([("n:a", "n:b", "T", None)], graph.EDGES)
    assert graph.write_graph(nodes, edges, g) == 1
    nodes.where("name = 'a'").write.partitionBy("label").parquet(f"{g}/v2/nodes")  # a run that ended here
    assert [t.count() for t in graph.read_graph(spark, g)] == [2, 1]
    for n in (2, 3, 4):  # from what is read
        old_nodes, old_edges = graph.read_graph(spark, g)
        assert graph.write_graph(old_nodes.where("name = 'a'"), old_edges, g) == n
    assert [t.count() for t in graph.read_graph(spark, g)] == [1, 1]
    assert sorted(p.name for p in (tmp_path / "graph").iterdir()) == ["v3", "v4"]


def test_an_import_runs_no_job_that_only_counts(spark, tmp_path):
    files = spark.createDataFrame([(f"d/{i}.md", f"# T{i}\nEC2 uses S3 and more\n## P\ntext") for i in range(6)], "file_path string, content string")
    client = lambda: lambda prompts: ['{"entities": ["X"], "relations": [["X", "Y"]]}' for _ in prompts]
    got = import_documents(files, client=client, answers=str(tmp_path / "answers"))
    assert got.stats == {k: got.tables[k].count() for k in got.stats}
    assert (got.stats["documents"], got.stats["entities"], got.stats["failures"]) == (6, 6, 0)


def test_stream_of_triples(spark, tmp_path):
    rows = [(i, "a", "Service", "uses", "b" if i % 2 else "c", "Component", f"e{i}", False, None, 1.0, None, None, "2024-01-01") for i in range(4)]
    for k in range(2):
        spark.createDataFrame(rows[2 * k : 2 * k + 2], upserts.TRIPLE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    q = upserts.start(upserts.read_triples(spark, str(tmp_path / "in"), 1), str(tmp_path / "store"), str(tmp_path / "cp"))
    q.awaitTermination()
    from knotwork.operators import store

    last = store.read(spark, str(tmp_path / "store" / "v2"))
    assert {r["object"]: r["update_count"] for r in last.collect()} == {"b": 2, "c": 2}
    store.write(last, str(tmp_path / "copy"))
    upserts.upsert_batches(str(tmp_path / "store"))(spark.read.schema(upserts.TRIPLE).parquet(str(tmp_path / "in")).where("seq >= 2"), 1)
    assert {r["object"]: r["update_count"] for r in store.read(spark, str(tmp_path / "store" / "v2")).collect()} == {"b": 2, "c": 2}


def test_scans_look_up_edges_of_the_first_nodes_only(spark):
    ids = [f"{label}:{i:03d}" for label in ("A", "B") for i in range(150)] + ["C:x", "C:y"]
    nodes = spark.createDataFrame([(x, x[0], x[2:] if x != "C:y" else None, {}) for x in ids], graph.NODES)
    edges = spark.createDataFrame([(f"B:{i:03d}", f"A:{j:03d}", "T", None) for i in range(100, 150) for j in range(i % 7)] + [("A:000", "gone", "T", None), ("gone", "A:001", "T", None), ("C:x", "C:y", "U", None), ("C:y", "C:x", "U", None)], graph.EDGES)
    known = {r["node_id"]: (r["label"], r["name"]) for r in nodes.collect()}
    want = sorted(((*known[s], t, *known[d]) for s, d, t, _ in map(tuple, edges.collect()) if s in known and d in known), key=lambda r: [(x is not None, x or "") for x in r])
    for limit in (3, 40, 70, 1000):
        assert [tuple(r) for r in matching.edge_scan(nodes, edges, limit).collect()] == want[:limit]
    p = matching.edge_scan(nodes, edges, 70)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in p  # all edges met all nodes twice


def test_sql_sorts_only_beside_large_sides(spark):
    from knotwork.plans.lineage import HASHED, SMALLER

    ends = [("a", "A", "x"), ("b", "B", None), ("c", "C", "no"), ("d", "D", "y"), ("d", "D", "y"), (None, "N", "z")]
    links = [("a", "b"), ("a", "b"), ("a", "d"), ("d", "a"), ("b", "a"), ("c", "a"), (None, "a"), ("a", None), ("a", "gone"), *(("a", "c") for _ in range(500))]
    nodes = spark.createDataFrame([(i, label, name, {}) for i, label, name in ends], graph.NODES)
    edges = spark.createDataFrame([(s, t, "T", None) for s, t in links], graph.EDGES)
    text = "SELECT s.label AS a, t.label AS b, count(*) AS n FROM {edges} e JOIN {nodes} s ON e.src_id = s.node_id JOIN {nodes} t ON e.dst_id = t.node_id WHERE s.name <> :but GROUP BY 1, 2"
    broadcast = "spark.sql.autoBroadcastJoinThreshold"
    try:
        spark.conf.set(broadcast, "-1")
        for own, join in ((None, "ShuffledHashJoin"), ("1b", "SortMergeJoin")):  # by default both sides of each join were sorted
            spark.conf.unset(HASHED)
            if own:
                spark.conf.set(HASHED, own)
            got = matching.sql(nodes, edges, text, but="no")
            assert sorted(map(tuple, got.collect())) == [("A", "B", 2), ("A", "C", 500), ("A", "D", 2), ("D", "A", 2)]
            final = got._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
            assert final.count(join) == 2 and final.count("Sort [") == (4 if own else 0)
            assert own is None or spark.conf.get(HASHED) == own
    finally:
        for name in (broadcast, HASHED, *SMALLER):
            spark.conf.unset(name)
