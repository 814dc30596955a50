"""Queries over the driver's tables, each with SQL that gives the same rows.

The tables become a graph: regions, nations, customers, suppliers, segments, parts and brands as nodes, what the keys say
as edges; markdown comes of documents, triples of line items and orders."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions import vocabulary
from knotwork.operators import chunking, clustering, concepts, extraction, graph, markdown, matching, merging, normalization, store, validation
from knotwork.plans.lineage import dealt, in_small_tasks
from knotwork.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLE: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            ORACLE[f.__name__] = sql
        return f

    return register


# --- the graph of the trade tables


def trade_nodes(spark: SparkSession, d: str) -> DataFrame:
    t = lambda name: table(spark, d, name)
    parts = t("part")
    return graph._union(
        [
            graph.node(t("region"), "Region", F.col("r_name"), F.col("r_name")),
            graph.node(t("nation"), "Nation", F.col("n_name"), F.col("n_name")),
            graph.node(t("customer"), "Customer", F.col("c_name"), F.col("c_name"), type=F.col("c_mktsegment"), description=F.concat(F.lit("Nation "), F.col("c_nationkey").cast("string"))),
            graph.node(t("supplier"), "Supplier", F.col("s_name"), F.col("s_name")),
            graph.node(t("customer").select("c_mktsegment").distinct(), "Segment", F.col("c_mktsegment"), F.col("c_mktsegment")),
            graph.node(parts, "Part", F.col("p_partkey").cast("string"), F.col("p_name")),
            graph.node(parts.select("p_brand").distinct(), "Brand", F.col("p_brand"), F.col("p_brand")),
        ]
    ).drop("seq")


def trade_edges(spark: SparkSession, d: str) -> DataFrame:
    in_small_tasks(spark)
    t = lambda name: table(spark, d, name)
    n = graph.node_id
    nation = t("nation").join(t("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customer = t("customer").join(t("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    supplier = t("supplier").join(t("nation"), F.col("s_nationkey") == F.col("n_nationkey"))
    supply = dealt(t("lineitem").select("l_suppkey", "l_partkey"), "l_suppkey", "l_partkey").distinct().join(t("supplier"), F.col("l_suppkey") == F.col("s_suppkey"))
    part = F.col("l_partkey").cast("string")
    return graph._union(
        [
            graph.edge(nation, n("Region", "r_name"), "CONTAINS", n("Nation", "n_name")),
            graph.edge(nation, n("Nation", "n_name"), "IN", n("Region", "r_name")),
            graph.edge(customer, n("Nation", "n_name"), "CONTAINS", n("Customer", "c_name")),
            graph.edge(supplier, n("Nation", "n_name"), "CONTAINS", n("Supplier", "s_name")),
            graph.edge(t("customer"), n("Customer", "c_name"), "AFFECTS", n("Segment", "c_mktsegment"), F.when(F.col("c_acctbal") > 0, F.concat(F.col("c_name"), F.lit(" is in credit")))),
            graph.edge(supply, n("Supplier", "s_name"), "USES", n("Part", part)),
            graph.edge(supply, n("Part", part), "SUPPLIED_BY", n("Supplier", "s_name")),
            graph.edge(t("part"), n("Part", F.col("p_partkey").cast("string")), "EXAMPLE_OF", n("Brand", "p_brand")),
        ]
    ).drop("seq")


NODES = """nodes AS (
    SELECT 'Region:' || r_name AS node_id, 'Region' AS label, r_name AS name, NULL::VARCHAR AS type, NULL::VARCHAR AS description FROM region
    UNION ALL SELECT 'Nation:' || n_name, 'Nation', n_name, NULL, NULL FROM nation
    UNION ALL SELECT 'Customer:' || c_name, 'Customer', c_name, c_mktsegment, 'Nation ' || c_nationkey FROM customer
    UNION ALL SELECT 'Supplier:' || s_name, 'Supplier', s_name, NULL, NULL FROM supplier
    UNION ALL SELECT DISTINCT 'Segment:' || c_mktsegment, 'Segment', c_mktsegment, NULL, NULL FROM customer
    UNION ALL SELECT 'Part:' || p_partkey, 'Part', p_name, NULL, NULL FROM part
    UNION ALL SELECT DISTINCT 'Brand:' || p_brand, 'Brand', p_brand, NULL, NULL FROM part)"""
EDGES = """supply AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem),
edges AS (
    SELECT 'Region:' || r_name AS src_id, 'Nation:' || n_name AS dst_id, 'CONTAINS' AS rel_type, NULL::VARCHAR AS evidence FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'Nation:' || n_name, 'Region:' || r_name, 'IN', NULL FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'Nation:' || n_name, 'Customer:' || c_name, 'CONTAINS', NULL FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'Nation:' || n_name, 'Supplier:' || s_name, 'CONTAINS', NULL FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'Customer:' || c_name, 'Segment:' || c_mktsegment, 'AFFECTS', CASE WHEN c_acctbal > 0 THEN c_name || ' is in credit' END FROM customer
    UNION ALL SELECT 'Supplier:' || s_name, 'Part:' || l_partkey, 'USES', NULL FROM supply JOIN supplier ON l_suppkey = s_suppkey
    UNION ALL SELECT 'Part:' || l_partkey, 'Supplier:' || s_name, 'SUPPLIED_BY', NULL FROM supply JOIN supplier ON l_suppkey = s_suppkey
    UNION ALL SELECT 'Part:' || p_partkey, 'Brand:' || p_brand, 'EXAMPLE_OF', NULL FROM part)"""
GRAPH = f"WITH {NODES},\n{EDGES}\n"


@query("""SELECT 'Customer:' || o_custkey AS node_id, 'Customer' AS label, CAST(o_custkey AS VARCHAR) AS name, arg_max(o_orderstatus, o_orderkey) AS status, arg_max(o_orderpriority, o_orderkey) AS priority
FROM orders GROUP BY o_custkey""")
def graph_nodes_merge(spark: SparkSession, d: str) -> DataFrame:
    key = F.col("o_custkey").cast("string")
    merged = graph.merge_nodes(graph.node(table(spark, d, "orders"), "Customer", key, key, F.col("o_orderkey"), status=F.col("o_orderstatus"), priority=F.col("o_orderpriority")))
    return merged.select("node_id", "label", "name", F.col("props")["status"].alias("status"), F.col("props")["priority"].alias("priority"))


@query("""SELECT DISTINCT 'Supplier:' || l_suppkey AS src_id, 'Part:' || l_partkey AS dst_id, 'USES' AS rel_type
FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey WHERE p_size > 25 AND s_acctbal > 0""")
def graph_edges_merge(spark: SparkSession, d: str) -> DataFrame:
    parts = graph.node(table(spark, d, "part").where("p_size > 25"), "Part", F.col("p_partkey").cast("string"), F.col("p_name"))
    suppliers = graph.node(table(spark, d, "supplier").where("s_acctbal > 0"), "Supplier", F.col("s_suppkey").cast("string"), F.col("s_name"))
    rows = table(spark, d, "lineitem")
    edges = graph.edge(rows, graph.node_id("Supplier", F.col("l_suppkey").cast("string")), "USES", graph.node_id("Part", F.col("l_partkey").cast("string")))
    return graph.merge_edges(edges, parts.unionByName(suppliers)).select("src_id", "dst_id", "rel_type")


_EVIDENCE = """SELECT 'Supplier:' || l_suppkey AS src_id, 'Flag:' || l_returnflag AS dst_id, 'USES' AS rel_type,
    string_agg(CASE WHEN l_tax > 0 THEN l_linestatus || l_linenumber ELSE '' END, ' | ' ORDER BY l_orderkey * 100 + l_linenumber, CASE WHEN l_tax > 0 THEN l_linestatus || l_linenumber END NULLS FIRST) AS evidence
FROM lineitem GROUP BY l_suppkey, l_returnflag"""


@query(_EVIDENCE)
def edge_evidence_append(spark: SparkSession, d: str) -> DataFrame:
    evidence = F.when(F.col("l_tax") > 0, F.concat("l_linestatus", F.col("l_linenumber").cast("string")))
    edges = graph.edge(table(spark, d, "lineitem"), graph.node_id("Supplier", F.col("l_suppkey").cast("string")), "USES", graph.node_id("Flag", "l_returnflag"), evidence, F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return graph.merge_edges(edges)


@query(_EVIDENCE)
def edge_evidence_segments(spark: SparkSession, d: str) -> DataFrame:
    evidence = F.when(F.col("l_tax") > 0, F.concat("l_linestatus", F.col("l_linenumber").cast("string")))
    edges = graph.edge(table(spark, d, "lineitem"), graph.node_id("Supplier", F.col("l_suppkey").cast("string")), "USES", graph.node_id("Flag", "l_returnflag"), evidence, F.col("l_orderkey") * 100 + F.col("l_linenumber"))
    return graph.assembled_evidence(graph.evidence_segments(edges, 50))


@query(GRAPH + """SELECT s.name AS service, p.name AS component, count(*) AS n FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes p ON e.dst_id = p.node_id
WHERE e.rel_type = 'USES' AND s.label = 'Supplier' AND p.label = 'Part' AND p.name = 'red widget' GROUP BY 1, 2""")
def match_one_hop(spark: SparkSession, d: str) -> DataFrame:
    met = matching.match(trade_nodes(spark, d), trade_edges(spark, d), "USES", "Supplier", "Part", dst_name="red widget")
    return met.groupBy(F.col("src_name").alias("service"), F.col("dst_name").alias("component")).agg(F.count("*").alias("n"))


@query(GRAPH + """SELECT s.label AS entity_type, s.name AS entity, t.name AS metric FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes t ON e.dst_id = t.node_id
WHERE e.rel_type = 'AFFECTS' AND t.label = 'Segment' AND t.name = 'BUILDING'""")
def match_any_label(spark: SparkSession, d: str) -> DataFrame:
    met = matching.match(trade_nodes(spark, d), trade_edges(spark, d), "AFFECTS", None, "Segment", dst_name="BUILDING")
    return met.select(F.col("src_label").alias("entity_type"), F.col("src_name").alias("entity"), F.col("dst_name").alias("metric"))


@query(GRAPH + """, a AS MATERIALIZED (SELECT n.name AS a, s.name AS b, s.node_id AS k FROM edges e JOIN nodes n ON e.src_id = n.node_id AND n.label = 'Nation' JOIN nodes s ON e.dst_id = s.node_id AND s.label = 'Supplier' WHERE e.rel_type = 'CONTAINS'),
b AS MATERIALIZED (SELECT p.name AS c, b.name AS d, p.node_id AS k FROM edges e JOIN nodes p ON e.src_id = p.node_id AND p.label = 'Part' JOIN nodes b ON e.dst_id = b.node_id AND b.label = 'Brand' WHERE e.rel_type = 'EXAMPLE_OF'),
m AS MATERIALIZED (SELECT src_id, dst_id FROM edges WHERE rel_type = 'SUPPLIED_BY')
SELECT a.a, a.b, b.c, b.d FROM m JOIN a ON m.dst_id = a.k JOIN b ON m.src_id = b.k""".replace("\n, a AS", ", a AS"))
def match_three_way(spark: SparkSession, d: str) -> DataFrame:
    return matching.match_three(trade_nodes(spark, d), trade_edges(spark, d), ("Nation", "CONTAINS", "Supplier"), ("Part", "EXAMPLE_OF", "Brand"), "SUPPLIED_BY")


@query(GRAPH + """SELECT n.name AS best_practice, r.name AS pillar, coalesce(string_agg(DISTINCT s.name, ',' ORDER BY s.name), '') AS addressed
FROM edges e JOIN nodes n ON e.src_id = n.node_id AND n.label = 'Nation' JOIN nodes r ON e.dst_id = r.node_id AND r.label = 'Region'
LEFT JOIN (SELECT e2.src_id, s.name FROM edges e2 JOIN nodes s ON e2.dst_id = s.node_id AND s.label = 'Supplier' WHERE e2.rel_type = 'CONTAINS') s ON s.src_id = e.src_id
WHERE e.rel_type = 'IN' GROUP BY 1, 2""")
def optional_collect_distinct(spark: SparkSession, d: str) -> DataFrame:
    nodes, edges = trade_nodes(spark, d), trade_edges(spark, d)
    base = matching.match(nodes, edges, "IN", "Nation", "Region")
    got = matching.optional_collect(nodes, edges, base, "CONTAINS", "Supplier", ["src_name", "dst_name"])
    return got.select(F.col("src_name").alias("best_practice"), F.col("dst_name").alias("pillar"), F.array_join("collected", ",").alias("addressed"))


@query("""SELECT 'Customer' AS label, c_name AS name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'F')""")
def isolated_nodes(spark: SparkSession, d: str) -> DataFrame:
    nodes = graph.node(table(spark, d, "customer"), "Customer", F.col("c_custkey").cast("string"), F.col("c_name"))
    edges = graph.edge(table(spark, d, "orders").where("o_orderstatus = 'F'"), graph.node_id("Customer", F.col("o_custkey").cast("string")), "HAS", F.lit("Status:F"))
    return matching.isolated(nodes, edges).select("label", "name")


@query(GRAPH + """SELECT s.name AS src, e.rel_type, t.name AS dst FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes t ON e.dst_id = t.node_id
WHERE e.rel_type IN ('AFFECTS', 'EXAMPLE_OF') AND (contains(s.name, 'blue') OR contains(t.name, 'MACH'))""")
def match_name_contains(spark: SparkSession, d: str) -> DataFrame:
    met = matching.name_contains(matching.match(trade_nodes(spark, d), trade_edges(spark, d), ["AFFECTS", "EXAMPLE_OF"]), "blue")
    more = matching.name_contains(matching.match(trade_nodes(spark, d), trade_edges(spark, d), ["AFFECTS", "EXAMPLE_OF"]), "MACH")
    return met.unionByName(more).select(F.col("src_name").alias("src"), "rel_type", F.col("dst_name").alias("dst"))


@query(GRAPH + """SELECT s.label AS subject_type, s.name AS subject, e.rel_type AS relation, t.label AS object_type, t.name AS object, e.evidence
FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes t ON e.dst_id = t.node_id WHERE e.evidence IS NOT NULL ORDER BY subject, relation, object LIMIT 20""")
def edges_with_evidence(spark: SparkSession, d: str) -> DataFrame:
    return matching.with_evidence(trade_nodes(spark, d), trade_edges(spark, d)).orderBy("subject", "relation", "object").limit(20)


@query(GRAPH + "SELECT label, count(*) AS n FROM nodes GROUP BY label")
def count_by_label(spark: SparkSession, d: str) -> DataFrame:
    return matching.count_by_label(trade_nodes(spark, d))


@query(GRAPH + "SELECT label, name, count(*) AS n FROM edges JOIN nodes ON src_id = node_id GROUP BY 1, 2 ORDER BY n DESC, label, name LIMIT 20")
def top_degree(spark: SparkSession, d: str) -> DataFrame:
    return matching.top_degree(trade_nodes(spark, d), trade_edges(spark, d))


@query(GRAPH + "SELECT (SELECT count(*) FROM nodes) AS nodes, (SELECT count(*) FROM edges) AS edges")
def graph_counts(spark: SparkSession, d: str) -> DataFrame:
    return graph.graph_counts(trade_nodes(spark, d), trade_edges(spark, d))


@query(GRAPH + "SELECT name, type, description FROM nodes WHERE label = 'Customer' ORDER BY name, type, description LIMIT 1000")
def concept_scan(spark: SparkSession, d: str) -> DataFrame:
    return matching.scan(trade_nodes(spark, d), "Customer")


@query(GRAPH + """SELECT s.label AS src_label, s.name AS src_name, e.rel_type, t.label AS dst_label, t.name AS dst_name FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes t ON e.dst_id = t.node_id
ORDER BY 1, 2, 3, 4, 5 LIMIT 1000""")
def edge_scan(spark: SparkSession, d: str) -> DataFrame:
    return matching.edge_scan(trade_nodes(spark, d), trade_edges(spark, d))


_REGION = "'AFRICA'"


@query(GRAPH + f""", t AS (SELECT n.node_id FROM edges e JOIN nodes n ON e.dst_id = n.node_id WHERE e.rel_type = 'CONTAINS' AND e.src_id = 'Region:' || {_REGION})
SELECT (SELECT count(*) FROM nodes WHERE label = 'Region' AND name = {_REGION}) AS domains, (SELECT count(DISTINCT node_id) FROM t) AS categories,
    (SELECT count(DISTINCT dst_id) FROM edges WHERE rel_type = 'CONTAINS' AND src_id IN (SELECT node_id FROM t)) AS documents, 0::BIGINT AS sections""".replace("\n, t AS", ", t AS"))
def clear_domain_counts(spark: SparkSession, d: str) -> DataFrame:
    nodes = trade_nodes(spark, d).withColumn("label", F.when(F.col("label") == "Region", "Domain").otherwise(F.col("label")))
    return graph.clear_domain(nodes, trade_edges(spark, d), "AFRICA")[0]


@query(GRAPH + f""", gone AS (
    SELECT 'Region:' || {_REGION} AS id UNION SELECT dst_id FROM edges WHERE rel_type = 'CONTAINS' AND src_id = 'Region:' || {_REGION}
    UNION SELECT dst_id FROM edges WHERE rel_type = 'CONTAINS' AND src_id IN (SELECT dst_id FROM edges WHERE rel_type = 'CONTAINS' AND src_id = 'Region:' || {_REGION}))
SELECT 'node' AS kind, label AS what, count(*) AS n FROM nodes WHERE node_id NOT IN (SELECT id FROM gone) GROUP BY 2
UNION ALL SELECT 'edge', rel_type, count(*) FROM edges WHERE src_id NOT IN (SELECT id FROM gone) AND dst_id NOT IN (SELECT id FROM gone) GROUP BY 2""")
def clear_domain_survivors(spark: SparkSession, d: str) -> DataFrame:
    nodes = trade_nodes(spark, d).withColumn("label", F.when(F.col("label") == "Region", "Domain").otherwise(F.col("label")))
    _, kept, rest = graph.clear_domain(nodes, trade_edges(spark, d), "AFRICA")
    label = F.when(F.col("label") == "Domain", "Region").otherwise(F.col("label"))
    left = kept.groupBy(label.alias("what")).agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), "what", "n")
    return left.unionByName(rest.groupBy(F.col("rel_type").alias("what")).agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), "what", "n"))


@query("""WITH RECURSIVE e AS (
    SELECT 'Region:' || r_name AS s, 'Nation:' || n_name AS t, 'CONTAINS' AS r FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'Nation:' || n_name, 'Customer:' || c_name, 'CONTAINS' FROM customer JOIN nation ON c_nationkey = n_nationkey
    UNION ALL SELECT 'Nation:' || n_name, 'Supplier:' || s_name, 'CONTAINS' FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'Nation:' || n_name, 'Region:' || r_name, 'IN' FROM nation JOIN region ON n_regionkey = r_regionkey),
w AS (
    SELECT s AS start_id, t AS end_id, 1 AS depth, [s || '>' || r || '>' || t] AS path FROM e WHERE s = 'Region:ASIA'
    UNION ALL SELECT w.start_id, e.t, w.depth + 1, list_append(w.path, e.s || '>' || e.r || '>' || e.t) FROM w JOIN e ON w.end_id = e.s
    WHERE NOT list_contains(w.path, e.s || '>' || e.r || '>' || e.t) AND w.depth < 8)
SELECT start_id, end_id, depth, array_to_string(path, ';') AS path FROM w""")
def var_length_trails(spark: SparkSession, d: str) -> DataFrame:
    found = matching.trails(trade_nodes(spark, d), trade_edges(spark, d), ["CONTAINS", "IN"], F.col("node_id") == "Region:ASIA", max_depth=8)
    return found.select("start_id", "end_id", "depth", F.array_join("path", ";").alias("path"))


_TRAILS = """WITH RECURSIVE e AS (
    SELECT 'Region:' || r_name AS s, 'Nation:' || n_name AS t, 'CONTAINS' AS r FROM nation JOIN region ON n_regionkey = r_regionkey
    UNION ALL SELECT 'Nation:' || n_name, 'Supplier:' || s_name, 'CONTAINS' FROM supplier JOIN nation ON s_nationkey = n_nationkey
    UNION ALL SELECT 'Nation:' || n_name, 'Region:' || r_name, 'IN' FROM nation JOIN region ON n_regionkey = r_regionkey),
w AS (
    SELECT s AS start_id, t AS end_id, 1 AS depth, [s || '>' || r || '>' || t] AS path FROM e WHERE s LIKE 'Region:A%'
    UNION ALL SELECT w.start_id, e.t, w.depth + 1, list_append(w.path, e.s || '>' || e.r || '>' || e.t) FROM w JOIN e ON w.end_id = e.s
    WHERE NOT list_contains(w.path, e.s || '>' || e.r || '>' || e.t))
SELECT start_id, end_id, depth, array_to_string(path, ';') AS path FROM w"""


def _supply_trails(spark: SparkSession, d: str, limit: int | None = None) -> DataFrame:
    edges = trade_edges(spark, d).where("dst_id NOT LIKE 'Customer:%'")
    found = matching.trails(trade_nodes(spark, d), edges, ["CONTAINS", "IN"], F.col("node_id").like("Region:A%"), limit=limit)
    return found.select("start_id", "end_id", "depth", F.array_join("path", ";").alias("path"))


@query(_TRAILS)
def unbounded_trails(spark: SparkSession, d: str) -> DataFrame:
    return _supply_trails(spark, d)


@query(_TRAILS + " ORDER BY depth, w.path LIMIT 50")
def limited_trails(spark: SparkSession, d: str) -> DataFrame:
    return _supply_trails(spark, d, 50)


# --- markdown

_MD = """md AS (
    SELECT lang || '/' || source || '/doc_' || doc_id || '.md' AS file_path,
        CASE WHEN n_chars % 7 = 0 THEN '' ELSE '# ' || source || ' ' || lang || chr(10) END || replace(replace(text, chr(10), chr(10) || '## '), '. ', '.' || chr(10))
        || chr(10) || '```' || chr(10) || '# code' || chr(10) || '```' || chr(10) || '---' || chr(10) || '[next](./' || source || '.md) and [top](#top), [web](http://h.example/a)' || chr(10) AS content
    FROM documents)"""
_TRIM = r"regexp_replace({}, '^\s+|\s+$', '', 'g')"


def markdown_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    path = F.concat("lang", F.lit("/"), "source", F.lit("/doc_"), F.col("doc_id").cast("string"), F.lit(".md"))
    head = F.when(F.col("n_chars") % 7 == 0, "").otherwise(F.concat(F.lit("# "), "source", F.lit(" "), "lang", F.lit("\n")))
    body = F.replace(F.replace("text", F.lit("\n"), F.lit("\n## ")), F.lit(". "), F.lit(".\n"))
    tail = F.concat(F.lit("\n```\n# code\n```\n---\n[next](./"), "source", F.lit(".md) and [top](#top), [web](http://h.example/a)\n"))
    return docs.select(path.alias("file_path"), F.concat(head, body, tail).alias("content"))


@query(f"""WITH {_MD},
l AS (SELECT file_path, string_split(content, chr(10)) AS ls FROM md),
x AS (SELECT file_path, len(ls) AS n, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l),
h AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s+.+$') AS head FROM x),
g AS (SELECT *, sum(head::INT) OVER (PARTITION BY file_path ORDER BY pos) AS k FROM h),
s AS (SELECT file_path, k - 1 AS section_idx, {_TRIM.format("max(CASE WHEN head THEN regexp_extract(line, '^#{1,6}\\s+(.+)$', 1) END)")} AS heading,
    max(CASE WHEN head THEN len(regexp_extract(line, '^(#{{1,6}})', 1)) END) AS level,
    {_TRIM.format("coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT head), '')")} AS content, min(pos) AS start_line, max(pos) AS end_line FROM g WHERE k > 0 GROUP BY file_path, k)
SELECT file_path, CAST(section_idx AS INT) AS section_idx, heading, CAST(level AS INT) AS level, md5(content) AS content, CAST(start_line AS INT) AS start_line, CAST(end_line AS INT) AS end_line FROM s""")
def sections_parse(spark: SparkSession, d: str) -> DataFrame:
    return markdown.sections(markdown_documents(spark, d)).withColumn("content", F.md5(F.col("content").cast("binary")))


@query(f"""WITH {_MD}
SELECT file_path, CASE WHEN regexp_matches(content, '(?m)^#\\s+(.+)$') THEN {_TRIM.format("regexp_extract(content, '(?m)^#\\s+(.+)$', 1)")}
    ELSE 'Doc ' || regexp_extract(file_path, 'doc_(\\d+)', 1) END AS title FROM md""")
def title_parse(spark: SparkSession, d: str) -> DataFrame:
    docs = markdown_documents(spark, d)
    return docs.select("file_path", markdown.title(F.col("content"), F.col("file_path")).alias("title"))


@query(f"""WITH {_MD}
SELECT file_path, list_filter(list_transform(string_split(content, chr(10)), lambda x: {_TRIM.format("x")}), lambda x: x <> '' AND NOT starts_with(x, '#') AND NOT starts_with(x, '```'))[1] AS first_line FROM md""")
def first_line(spark: SparkSession, d: str) -> DataFrame:
    return markdown_documents(spark, d).select("file_path", markdown.first_line(F.col("content")).alias("first_line"))


_CLEAN = f"""l AS (SELECT file_path, string_split(content, chr(10)) AS ls FROM md),
x AS (SELECT file_path, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l),
b AS (SELECT *, {_TRIM.format("line")} AS bare FROM x),
f AS (SELECT *, sum(starts_with(bare, '```')::INT) OVER (PARTITION BY file_path ORDER BY pos) % 2 AS fence FROM b),
k AS (SELECT * FROM f WHERE NOT starts_with(bare, '```') AND fence = 0 AND (bare = '' OR NOT regexp_matches(bare, '(?i)^---$|^\\[.*\\]\\(.*\\)$|^Table of Contents|^Navigation'))),
clean AS (SELECT file_path, {_TRIM.format("string_agg(CASE WHEN bare = '' THEN '' ELSE line END, chr(10) ORDER BY pos)")} AS content FROM k GROUP BY file_path)"""


@query(f"WITH {_MD}, {_CLEAN} SELECT file_path, md5(content) AS content, CAST(length(content) AS INT) AS n FROM clean")
def boilerplate_clean(spark: SparkSession, d: str) -> DataFrame:
    c = markdown.clean(F.col("content"))
    return markdown_documents(spark, d).select("file_path", c.alias("content")).select("file_path", F.md5(F.col("content").cast("binary")).alias("content"), F.length("content").alias("n"))


@query(f"WITH {_MD}, {_CLEAN} SELECT file_path, md5(content) AS content FROM clean")
def boilerplate_clean_lines(spark: SparkSession, d: str) -> DataFrame:
    return markdown.clean_lines(markdown_documents(spark, d)).select("file_path", F.md5(F.col("content").cast("binary")).alias("content"))


@query("""SELECT doc_id, 'https://kb.example/' || 'doc_' || doc_id || '#' || replace(lower(source || ' Part'), ' ', '-') || '#' || replace(lower(lang), ' ', '-') AS url FROM documents""")
def section_url(spark: SparkSession, d: str) -> DataFrame:
    path = F.concat(F.lit("a/doc_"), F.col("doc_id").cast("string"), F.lit(".md"))
    return table(spark, d, "documents").select("doc_id", markdown.section_url(path, F.array(F.concat("source", F.lit(" Part")), F.col("lang")), "https://kb.example").alias("url"))


@query(r"""WITH md AS (SELECT page_id, regexp_replace(html, '<a href="([^"]*)">([^<]*)</a>', '[\2](\1)', 'g') AS content FROM pages),
l AS (SELECT page_id, list_filter(regexp_extract_all(content, '\[([^\]]+)\]\(([^)]+)\)', 2), lambda x: ends_with(x, '.md') OR starts_with(x, './') OR contains(x, '/')) AS links FROM md),
u AS (SELECT page_id, unnest(list_transform(links, lambda x: replace(replace(x, './', ''), '.md', ''))) AS ref FROM l)
SELECT DISTINCT page_id, ref FROM u""")
def link_extract(spark: SparkSession, d: str) -> DataFrame:
    content = F.regexp_replace("html", r'<a href="([^"]*)">([^<]*)</a>', "[$2]($1)")
    return markdown.references(table(spark, d, "pages").select(F.col("page_id").alias("file_path"), content.alias("content"))).select(F.col("file_path").alias("page_id"), "ref")


@query(r"""WITH r AS (SELECT url AS src, unnest(list_distinct(regexp_extract_all(html, 'href="([^"]+)"', 1))) AS ref FROM pages), q AS (SELECT DISTINCT ref FROM r),
m AS (SELECT ref, url AS dst FROM q JOIN pages ON contains(url, ref))
SELECT DISTINCT src, dst FROM r JOIN m USING (ref)""")
def references_contains_join(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages")
    refs = pages.select(F.col("url").alias("file_path"), F.explode(F.array_distinct(F.regexp_extract_all("html", F.lit('href="([^"]+)"'), F.lit(1)))).alias("ref"))
    return graph.reference_edges(pages.select(F.col("url").alias("file_path"), F.lit("").alias("title")), refs)


_LEAST, _MOST = 200, 600
_TOKENS = "length(" + _TRIM.format("{}") + ") // 4"
_FLUSH = "w.n > 0 AND " + _TOKENS.format("w.held") + f" >= {_LEAST}"
_OVER = "w.n > 0 AND " + _TOKENS.format("w.held || chr(10) || l.line") + f" > {_MOST}"
_PATH = "array_to_string(list_transform({}, lambda h: h.name), ' > ')"


# a fold over lines as recursion: a step takes the next line of every document; what a step gives out is in ``out``
@query(f"""WITH RECURSIVE {_MD}, {_CLEAN},
titles AS (SELECT file_path, CASE WHEN regexp_matches(content, '(?m)^#\\s+(.+)$') THEN {_TRIM.format("regexp_extract(content, '(?m)^#\\s+(.+)$', 1)")} ELSE 'Doc ' || regexp_extract(file_path, 'doc_(\\d+)', 1) END AS title FROM md),
s AS (SELECT md.file_path, titles.title, string_split(coalesce(clean.content, ''), chr(10)) AS ls FROM md JOIN titles USING (file_path) LEFT JOIN clean USING (file_path)),
ll AS (SELECT file_path, title, len(ls) AS lines, unnest(ls) AS line, unnest(range(len(ls))) AS i FROM s),
rows_of AS (SELECT *, regexp_matches(line, '^#{{1,6}}\\s+.+$') AS head, len(regexp_extract(line, '^(#{{1,6}})', 1)) AS level, {_TRIM.format("regexp_extract(line, '^#{1,6}\\s+(.+)$', 1)")} AS name FROM ll),
w AS (
    SELECT file_path, title, len(ls) AS lines, CAST(0 AS BIGINT) AS i, CAST([] AS STRUCT(level BIGINT, name VARCHAR)[]) AS headings, '' AS held, 0 AS n, CAST(0 AS BIGINT) AS start, 0 AS given, title AS section,
        CAST(NULL AS STRUCT(body VARCHAR, section VARCHAR, path VARCHAR, level BIGINT, start BIGINT, stop BIGINT)) AS out FROM s
    UNION ALL
    SELECT w.file_path, w.title, w.lines, w.i + 1, CASE WHEN l.head THEN x.headings ELSE w.headings END,
        CASE WHEN w.n = 0 THEN l.line WHEN l.head THEN CASE WHEN {_FLUSH} THEN l.line ELSE w.held || chr(10) || l.line END
            WHEN {_OVER} THEN CASE WHEN {_FLUSH} THEN l.line ELSE w.held END ELSE w.held || chr(10) || l.line END,
        1, CASE WHEN (l.head OR {_OVER}) AND {_FLUSH} THEN w.i ELSE w.start END, CASE WHEN (l.head OR {_OVER}) AND {_FLUSH} THEN w.given + 1 ELSE w.given END, CASE WHEN l.head THEN l.name ELSE w.section END,
        CASE WHEN l.head AND {_FLUSH} THEN {{'body': {_TRIM.format("w.held")}, 'section': l.name, 'path': {_PATH.format("x.headings")}, 'level': CAST(l.level AS BIGINT), 'start': w.start, 'stop': w.i - 1}}
            WHEN NOT l.head AND {_OVER} AND {_FLUSH} THEN {{'body': {_TRIM.format("w.held")}, 'section': w.section, 'path': {_PATH.format("w.headings")}, 'level': CAST(NULL AS BIGINT), 'start': w.start, 'stop': w.i - 1}} END
    FROM w JOIN rows_of l ON l.file_path = w.file_path AND l.i = w.i, LATERAL (SELECT list_append(list_filter(w.headings, lambda h: h.level < l.level), {{'level': CAST(l.level AS BIGINT), 'name': l.name}}) AS headings) x),
c AS (
    SELECT file_path, title, given - 1 AS chunk_idx, out.body AS body, out.section AS section, out.path AS path, out.level AS level, out.start AS start_line, out.stop AS end_line FROM w WHERE out IS NOT NULL
    UNION ALL SELECT file_path, title, given, {_TRIM.format("held")}, section, {_PATH.format("headings")}, NULL, start, lines - 1 FROM w WHERE i = lines AND n > 0 AND ({_TOKENS.format("held")} >= {_LEAST} OR given = 0))
SELECT file_path AS source, CAST(chunk_idx AS INT) AS chunk_idx, md5(body) AS text, section, path AS heading_path, CAST(level AS INT) AS level,
    'https://kb.example/' || regexp_extract(file_path, '([^/]+)\\.md$', 1) || '#' || replace(replace(lower(path), ' > ', '#'), ' ', '-') AS url,
    title, CAST(start_line AS INT) AS start_line, CAST(end_line AS INT) AS end_line, CAST(length(body) // 4 AS INT) AS token_count FROM c""")
def chunk_documents(spark: SparkSession, d: str) -> DataFrame:
    docs = markdown_documents(spark, d)
    titled = docs.select("file_path", markdown.title(F.col("content"), F.col("file_path")).alias("title"), "content")
    made = chunking.chunk_documents(titled, _LEAST, _MOST, "https://kb.example")
    return made.withColumns({"text": F.md5(F.col("text").cast("binary")), "heading_path": F.array_join("heading_path", " > ")})


@query("""SELECT doc_id, md5('---SOURCE: ' || source || '---' || chr(10) || 'Section: ' || lang || ' > ' || source || chr(10) || CASE WHEN n_chars % 2 = 0 THEN 'URL: http://h/' || doc_id || chr(10) ELSE '' END
    || 'Date: 2024-01-01' || chr(10) || chr(10) || 'Text:' || chr(10) || chr(10) || text || chr(10) || chr(10) || '---') AS chunk FROM documents""")
def chunk_format(spark: SparkSession, d: str) -> DataFrame:
    url = F.when(F.col("n_chars") % 2 == 0, F.concat(F.lit("http://h/"), F.col("doc_id").cast("string")))
    chunk = chunking.format_chunk(F.col("source"), F.lit("x"), F.array("lang", "source"), url, F.lit("2024-01-01"), F.col("text"))
    return table(spark, d, "documents").select("doc_id", F.md5(chunk.cast("binary")).alias("chunk"))


@query("""SELECT doc_id, md5('Extract triples.' || chr(10) || 'Source: ' || source || chr(10) || 'Section: ' || lang || chr(10) || chr(10) || text) AS prompt, CAST(length(text) // 4 AS INT) AS tokens FROM documents""")
def prompt_build(spark: SparkSession, d: str) -> DataFrame:
    from knotwork.functions.text import token_estimate

    made = chunking.prompt("Extract triples.\n", F.col("text"), F.col("source"), F.col("lang"), F.lit(None).cast("string"))
    return table(spark, d, "documents").select("doc_id", F.md5(made.cast("binary")).alias("prompt"), token_estimate(F.col("text")).alias("tokens"))


# --- concepts: vocabularies of words that the documents have; letters of all languages are in words

_WORDS = [("the", "The"), ("with", "With"), ("whou", "Whou"), ("that", "That"), ("that", "This"), ("ndea", "Ndea"), ("nothere", "Nothere")]
_VOCABULARY = "v AS (SELECT * FROM (VALUES " + ", ".join(f"('{n}', '{t}', {k})" for k, (n, t) in enumerate(_WORDS)) + ") AS v(name, term, ordinal))"


def word_vocabulary(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([("service", n, t, k) for k, (n, t) in enumerate(_WORDS)], "category string, name string, term string, ordinal int")


def all_documents(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("file_path"), F.col("text").alias("content"))


_W = r"\p{L}\p{M}\p{Nd}\p{Pc}"
_HAS = "CASE ordinal " + " ".join(rf"WHEN {k} THEN regexp_matches(text, '(?i)(?:^|[^{_W}]){t}(?:$|[^{_W}])')" for k, (_, t) in enumerate(_WORDS)) + " END"


_CONTEXT = r"trim(regexp_replace(substr(text, greatest(strpos(lower(text), lower(term)) - 120, 1), strpos(lower(text), lower(term)) + length(term) + 120 - greatest(strpos(lower(text), lower(term)) - 120, 1)), '\s+', ' ', 'g'))"


@query(f"""WITH {_VOCABULARY}, h AS (
    SELECT doc_id, name, ordinal, {_CONTEXT} AS description FROM documents JOIN v ON {_HAS})
SELECT CAST(doc_id AS VARCHAR) AS file_path, name, arg_min(description, ordinal) AS description FROM h GROUP BY 1, 2""")
def service_concepts(spark: SparkSession, d: str) -> DataFrame:
    empty = word_vocabulary(spark).where("false")
    return concepts.concepts(all_documents(spark, d), word_vocabulary(spark), empty, []).select("file_path", "name", "description")


@query(f"""WITH {_VOCABULARY} SELECT CAST(doc_id AS VARCHAR) AS file_path, name, term, ordinal FROM documents JOIN v ON {_HAS}""")
def tech_concepts(spark: SparkSession, d: str) -> DataFrame:
    return concepts.term_hits(all_documents(spark, d), word_vocabulary(spark)).select("file_path", "name", "term", "ordinal")


@query("""WITH m AS (SELECT doc_id, unnest(regexp_extract_all(text, '(?i)thhe(?:re|th)?')) AS name FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS file_path, name, count(*) AS n FROM m GROUP BY 1, 2""")
def term_concepts(spark: SparkSession, d: str) -> DataFrame:
    return concepts.pattern_hits(all_documents(spark, d), ["thhe(?:re|th)?"]).groupBy("file_path", "name").agg(F.count("*").alias("n"))


_PARTED = rf"(?is)^\s*([{_W}]+)\s+the\s+([{_W}]+)\s*$"


@query(rf"""WITH r AS (SELECT doc_id, unnest(regexp_extract_all(text, '[{_W}\s]+')) AS run FROM documents),
p AS (SELECT doc_id, lower(regexp_extract(run, '{_PARTED}', 1)) AS a, lower(regexp_extract(run, '{_PARTED}', 2)) AS b FROM r WHERE regexp_matches(run, '{_PARTED}'))
SELECT CAST(doc_id AS VARCHAR) AS file_path, a AS src, b AS dst, count(*) AS n FROM p WHERE a <> b GROUP BY 1, 2, 3""")
def concept_relationships(spark: SparkSession, d: str) -> DataFrame:
    docs = all_documents(spark, d)
    names = docs.select("file_path", F.explode(F.array_distinct(F.regexp_extract_all(F.lower("content"), F.lit(r"(?U)\w+"), F.lit(0)))).alias("name"))
    return concepts.concept_relations(docs, names, {"the": "THE"}).groupBy("file_path", "src", "dst").agg(F.count("*").alias("n"))


# The real vocabularies, in texts of line items' parts that name some of them: apart, in other cases, and inside words.

_KNOWN = {"service": [(n, t) for n, ts in vocabulary.SERVICE_TERMS.items() for t in [*ts, n]], "technology": [(n, t) for t, n in vocabulary.TECHNOLOGY_TERMS.items()]}
_NAMED = [t for rows in _KNOWN.values() for _, t in rows] + vocabulary.ARCHITECTURE_TERMS
_TERM = "list_extract([" + ", ".join(f"'{t}'" for t in _NAMED) + "], CAST({} % " + str(len(_NAMED)) + " AS INT) + 1)"
_KNOWN_TEXT = f"""d AS (SELECT CAST(p_partkey AS VARCHAR) AS file_path, p_name || '. Uses ' || {_TERM.format("p_partkey")} || ', x' || {_TERM.format("(p_partkey * 7 + 3)")} || 'y and ' || lower({_TERM.format("(p_partkey * 13 + 5)")}) || chr(10) || 'behind ' || upper({_TERM.format("(p_partkey * p_size)")}) || '/' || p_brand AS text FROM part)"""
_KNOWN_HAS = "CASE step * 1000 + ordinal " + " ".join(rf"WHEN {step * 1000 + k} THEN regexp_matches(text, '(?i)(?:^|[^{_W}]){t}(?:$|[^{_W}])')" for step, rows in enumerate(_KNOWN.values()) for k, (_, t) in enumerate(rows)) + " END"
_ROWS = ", ".join(f"({step}, '{kind}', '{n}', '{t}', {k})" for step, (kind, rows) in enumerate(_KNOWN.items()) for k, (n, t) in enumerate(rows))


def known_texts(spark: SparkSession, d: str) -> DataFrame:
    def term(at: F.Column) -> F.Column:
        return F.element_at(F.array(*map(F.lit, _NAMED)), (at % len(_NAMED)).cast("int") + 1)

    k = F.col("p_partkey")
    text = F.concat("p_name", F.lit(". Uses "), term(k), F.lit(", x"), term(k * 7 + 3), F.lit("y and "), F.lower(term(k * 13 + 5)), F.lit("\nbehind "), F.upper(term(k * F.col("p_size"))), F.lit("/"), "p_brand")
    parts = dealt(table(spark, d, "part").select("p_partkey", "p_name", "p_brand", "p_size"), "p_partkey", rows=50_000)
    return parts.select(k.cast("string").alias("file_path"), text.alias("content"))


@query(rf"""WITH {_KNOWN_TEXT}, v AS (SELECT * FROM (VALUES {_ROWS}) AS v(step, type, name, term, ordinal)),
h AS (SELECT file_path, text, step, type, name, term, ordinal FROM d JOIN v ON {_KNOWN_HAS}
    {" ".join(f"UNION ALL SELECT file_path, text, 2, 'concept', name, name, {k} * 1000000 + pos FROM (SELECT file_path, text, unnest(regexp_extract_all(text, '(?i){t}')) AS name, unnest(range(len(regexp_extract_all(text, '(?i){t}')))) AS pos FROM d)" for k, t in enumerate(vocabulary.ARCHITECTURE_TERMS))}),
f AS (SELECT *, {_CONTEXT} AS description FROM h QUALIFY row_number() OVER (PARTITION BY file_path, lower(name) ORDER BY step, ordinal) = 1)
SELECT file_path, CAST(row_number() OVER (PARTITION BY file_path ORDER BY step, ordinal) AS INT) AS seq, name, type, description, lower(name) AS canonical FROM f""")
def known_concepts(spark: SparkSession, d: str) -> DataFrame:
    in_small_tasks(spark)
    return concepts.concepts(known_texts(spark, d), vocabulary.service_vocabulary(spark), vocabulary.technology_vocabulary(spark), vocabulary.ARCHITECTURE_TERMS)


@query("""WITH v AS (SELECT * FROM (VALUES ('the'), ('with'), ('ing')) AS v(name)), s AS (SELECT doc_id, unnest(string_split(text, chr(10))) AS content, unnest(range(len(string_split(text, chr(10))))) AS section_idx FROM documents)
SELECT CAST(doc_id AS VARCHAR) AS file_path, CAST(section_idx AS INT) AS section_idx, name FROM s JOIN v ON contains(lower(content), name)""")
def section_mentions(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.col("doc_id").cast("string").alias("file_path"), "text")
    sections = docs.select("file_path", F.posexplode(F.split("text", "\n", -1)).alias("section_idx", "content"), F.lit("").alias("heading"))
    names = docs.select("file_path", F.explode(F.array(F.lit("the"), F.lit("with"), F.lit("ing"))).alias("name"))
    return concepts.section_mentions(sections, names).select("file_path", "section_idx", "name")


# --- triples

_LINE_TRIPLES = """t AS (SELECT l_orderkey * 10 + l_linenumber AS seq, CASE WHEN l_tax > 0.04 THEN 'Supplier ' ELSE 'SUPPLIER ' END || l_suppkey AS subject,
    CASE l_returnflag WHEN 'A' THEN 'Service' WHEN 'N' THEN 'Component' ELSE 'Role' END AS subject_type, CASE l_linestatus WHEN 'F' THEN 'uses' ELSE 'implements' END AS relation,
    CASE WHEN l_quantity > 48 THEN ' ' ELSE 'Part ' || l_partkey END AS object, CASE WHEN l_discount > 0.05 THEN 'Component' ELSE 'Pattern' END AS object_type,
    CASE WHEN l_discount = 0.03 THEN 'two words' WHEN l_discount = 0.01 THEN '' ELSE 'a part of ' || l_orderkey END AS evidence, l_tax > 0.06 AS inferred,
    CASE WHEN l_linenumber > 1 THEN 'order ' || l_orderkey END AS source, strftime(l_shipdate, '%Y-%m-%d') AS timestamp FROM lineitem)"""


def line_triples(spark: SparkSession, d: str) -> DataFrame:
    c = F.col
    text = lambda x: c(x).cast("string")
    return table(spark, d, "lineitem").select(
        (c("l_orderkey") * 10 + c("l_linenumber")).alias("seq"), F.concat(F.when(c("l_tax") > 0.04, "Supplier ").otherwise("SUPPLIER "), text("l_suppkey")).alias("subject"),
        F.when(c("l_returnflag") == "A", "Service").when(c("l_returnflag") == "N", "Component").otherwise("Role").alias("subject_type"), F.when(c("l_linestatus") == "F", "uses").otherwise("implements").alias("relation"),
        F.when(c("l_quantity") > 48, " ").otherwise(F.concat(F.lit("Part "), text("l_partkey"))).alias("object"), F.when(c("l_discount") > 0.05, "Component").otherwise("Pattern").alias("object_type"),
        F.when(c("l_discount") == 0.03, "two words").when(c("l_discount") == 0.01, "").otherwise(F.concat(F.lit("a part of "), text("l_orderkey"))).alias("evidence"), (c("l_tax") > 0.06).alias("inferred"),
        F.when(c("l_linenumber") > 1, F.concat(F.lit("order "), text("l_orderkey"))).alias("source"), F.lit(1.0).alias("confidence"), F.lit(None).cast("string").alias("section"), F.lit(None).cast("string").alias("url"),
        F.date_format("l_shipdate", "yyyy-MM-dd").alias("timestamp"),
    )


_CHECKED = """x AS (SELECT *, CASE WHEN trim(subject) = '' OR trim(object) = '' OR trim(evidence) = '' THEN 'required_field'
    WHEN NOT (relation = 'uses' AND subject_type IN ('Service', 'Component') AND object_type IN ('Service', 'Component') OR relation = 'implements' AND subject_type IN ('Service', 'Component') AND object_type = 'Pattern') THEN 'schema'
    WHEN len(list_filter(string_split(evidence, ' '), lambda w: w <> '')) < 3 AND NOT inferred THEN 'evidence' END AS error_type FROM t)"""


@query(f"WITH {_LINE_TRIPLES} SELECT seq, subject, subject_type, relation, object, object_type, evidence, inferred, source, timestamp FROM t")
def triples_round_trip(spark: SparkSession, d: str) -> DataFrame:
    return extraction.from_json(extraction.to_json(line_triples(spark, d))).select("seq", "subject", "subject_type", "relation", "object", "object_type", "evidence", "inferred", "source", "timestamp")


@query(f"WITH {_LINE_TRIPLES}, {_CHECKED} SELECT seq, subject, relation, object, error_type FROM x")
def validate_triples(spark: SparkSession, d: str) -> DataFrame:
    return validation.validate(line_triples(spark, d), vocabulary.rule_table(spark)).select("seq", "subject", "relation", "object", "error_type")


@query(f"WITH {_LINE_TRIPLES}, {_CHECKED} SELECT coalesce(error_type, 'valid') AS error_type, count(*) AS n FROM x GROUP BY 1")
def validation_summary(spark: SparkSession, d: str) -> DataFrame:
    return validation.validation_summary(validation.validate(line_triples(spark, d), vocabulary.rule_table(spark)))


_RULES = "rules AS (SELECT * FROM (VALUES " + ", ".join(f"('{s}', '{r}', '{o}')" for r, (ss, oo) in vocabulary.RULES.items() for s in ss for o in oo) + ") AS v(subject_type, relation, object_type))"


@query(f"""WITH {_LINE_TRIPLES}, {_RULES}, u AS (SELECT subject_type, relation, object_type, count(*) AS n FROM t GROUP BY 1, 2, 3)
SELECT u.subject_type, u.relation, u.object_type, n, r.relation IS NOT NULL AS allowed,
    (SELECT string_agg(DISTINCT object_type, ',' ORDER BY object_type) FROM rules x WHERE x.relation = u.relation AND x.subject_type = u.subject_type) AS objects
FROM u LEFT JOIN rules r ON r.subject_type = u.subject_type AND r.relation = u.relation AND r.object_type = u.object_type""")
def allowed_types(spark: SparkSession, d: str) -> DataFrame:
    rules = vocabulary.rule_table(spark)
    used = line_triples(spark, d).groupBy("subject_type", "relation", "object_type").agg(F.count("*").alias("n"))
    objects = rules.groupBy("subject_type", "relation").agg(F.array_join(F.array_sort(F.collect_set("object_type")), ",").alias("objects"))
    met = used.join(rules.withColumn("allowed", F.lit(True)), ["subject_type", "relation", "object_type"], "left").join(objects, ["subject_type", "relation"], "left")
    return met.select("subject_type", "relation", "object_type", "n", F.coalesce("allowed", F.lit(False)).alias("allowed"), "objects")


_FP = "md5(lower(subject) || '|' || lower(relation) || '|' || lower(object))"
_MERGED = f"""m AS (SELECT {_FP} AS fingerprint, arg_min(subject, seq) AS subject, arg_min(subject_type, seq) AS subject_type, arg_min(relation, seq) AS relation, arg_min(object, seq) AS object, arg_min(object_type, seq) AS object_type,
    string_agg(coalesce(source, 'unknown'), ';' ORDER BY seq) AS sources, count(*) FILTER (inferred) AS inferred_count, count(*) AS total_count, arg_min(timestamp, seq) AS first_seen, arg_max(timestamp, seq) AS last_seen FROM t GROUP BY 1)"""


@query(f"WITH {_LINE_TRIPLES}, {_MERGED} SELECT * FROM m")
def merge_triples(spark: SparkSession, d: str) -> DataFrame:
    merged = merging.merge_triples(line_triples(spark, d), fields=["source"])
    return merged.withColumn("sources", F.array_join("evidence_sources.source", ";")).drop("evidence_sources")


@query(f"WITH {_LINE_TRIPLES}, {_MERGED} SELECT * FROM m")
def merge_triples_segments(spark: SparkSession, d: str) -> DataFrame:
    from knotwork.operators import segments

    triples = line_triples(spark, d)
    crowds = merging.crowded(triples, 50)
    evidence = segments.assembled(merging.evidence_segments(triples, size=50, fields=["source"], crowds=crowds), ["fingerprint"])
    return merging.merge_summary(triples, crowds=crowds).join(evidence.select("fingerprint", F.array_join("items.source", ";").alias("sources")), "fingerprint")


@query(f"WITH {_LINE_TRIPLES}, {_MERGED} SELECT fingerprint, subject, relation, object, 'mixed_inference' AS conflict, inferred_count, total_count - inferred_count AS explicit_count FROM m WHERE inferred_count > 0 AND total_count > inferred_count")
def merge_conflicts(spark: SparkSession, d: str) -> DataFrame:
    return merging.merge_conflicts(merging.merge_summary(line_triples(spark, d)))


@query(f"WITH {_LINE_TRIPLES}, {_MERGED} SELECT count(*) AS total_triples, CAST(sum(total_count) AS BIGINT) AS total_evidence, round(avg(total_count), 6) AS avg_evidence, count(*) FILTER (inferred_count > 0 AND total_count > inferred_count) AS conflicts FROM m")
def merge_stats(spark: SparkSession, d: str) -> DataFrame:
    return merging.merge_stats(merging.merge_summary(line_triples(spark, d))).withColumn("avg_evidence", F.round("avg_evidence", 6))


_ORDER_TRIPLES = "o AS (SELECT o_orderkey AS seq, 'Customer ' || o_custkey AS subject, 'depends_on' AS relation, o_orderpriority AS object, o_orderdate < TIMESTAMP '1998-01-01' AS old, strftime(o_orderdate, '%Y-%m-%d') AS ts, o_orderstatus AS evidence FROM orders)"


def order_triples(spark: SparkSession, d: str, old: bool) -> DataFrame:
    orders = table(spark, d, "orders").where((F.col("o_orderdate") < F.lit("1998-01-01").cast("timestamp")) == F.lit(old))
    none = F.lit(None).cast("string")
    return orders.select(
        F.col("o_orderkey").alias("seq"), F.concat(F.lit("Customer "), F.col("o_custkey").cast("string")).alias("subject"), F.lit("Service").alias("subject_type"), F.lit("depends_on").alias("relation"), F.col("o_orderpriority").alias("object"),
        F.lit("Service").alias("object_type"), F.col("o_orderstatus").alias("evidence"), F.lit(False).alias("inferred"), none.alias("source"), F.lit(1.0).alias("confidence"), none.alias("section"), none.alias("url"), F.date_format("o_orderdate", "yyyy-MM-dd").alias("timestamp"),
    )


@query(f"""WITH {_ORDER_TRIPLES}, s AS (SELECT DISTINCT {_FP} AS fp FROM o WHERE old)
SELECT seq, subject, object, {_FP} AS fingerprint, CASE WHEN s.fp IS NULL THEN 'new' ELSE 'updated' END AS status, row_number() OVER (PARTITION BY {_FP} ORDER BY seq) = 1 AS first FROM o LEFT JOIN s ON s.fp = {_FP} WHERE NOT old""")
def diff_status(spark: SparkSession, d: str) -> DataFrame:
    return store.diff(store.new_entries(order_triples(spark, d, True)), order_triples(spark, d, False)).select("seq", "subject", "object", "fingerprint", "status", "first")


@query(f"""WITH {_ORDER_TRIPLES}, s AS (SELECT DISTINCT {_FP} AS fp FROM o WHERE old), n AS (SELECT {_FP} AS fp FROM o WHERE NOT old)
SELECT count(*) FILTER (s.fp IS NULL) AS new_triples, count(DISTINCT n.fp) FILTER (s.fp IS NULL) AS added, count(s.fp) AS updated, count(s.fp) AS unchanged, 0::BIGINT AS conflicts FROM n LEFT JOIN s ON s.fp = n.fp""")
def diff_apply_stats(spark: SparkSession, d: str) -> DataFrame:
    return store.diff_stats(store.diff(store.new_entries(order_triples(spark, d, True)), order_triples(spark, d, False)))


@query(f"""WITH {_ORDER_TRIPLES} SELECT {_FP} AS fingerprint, arg_min(subject, (NOT old, seq)) AS subject, string_agg(evidence, ';' ORDER BY NOT old, seq) AS evidence, arg_min(ts, (NOT old, seq)) AS first_seen, arg_max(ts, (NOT old, seq)) AS last_seen, count(*) AS update_count FROM o GROUP BY 1""")
def store_upsert(spark: SparkSession, d: str) -> DataFrame:
    after = store.upsert(store.new_entries(order_triples(spark, d, True)), order_triples(spark, d, False))
    return after.select("fingerprint", "subject", F.array_join("evidence_sources.evidence", ";").alias("evidence"), "first_seen", "last_seen", "update_count")


@query(f"WITH {_ORDER_TRIPLES}, s AS (SELECT {_FP} AS fp, count(*) AS n FROM o GROUP BY 1) SELECT count(*) AS total_triples, CAST(sum(n) AS BIGINT) AS total_evidence, round(avg(n), 6) AS avg_evidence FROM s")
def store_stats(spark: SparkSession, d: str) -> DataFrame:
    after = store.upsert(store.new_entries(order_triples(spark, d, True)), order_triples(spark, d, False))
    return store.store_stats(after).withColumn("avg_evidence", F.round("avg_evidence", 6))


@query("""WITH p AS (SELECT event_id, event_type, user_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT CAST(event_id AS VARCHAR) AS source, CASE WHEN k % 5 = 0 THEN NULL WHEN k % 5 = 1 THEN 'unknown relation' END AS status, 'User ' || user_id AS subject, 'Service' AS subject_type, CASE WHEN k % 5 = 0 THEN 'depends_on' WHEN k % 5 = 1 THEN NULL ELSE 'uses' END AS relation,
    event_type AS object, CASE WHEN k % 5 = 0 THEN 'Component' ELSE 'Service' END AS object_type, CASE WHEN k % 5 = 0 THEN 'seen by a user' WHEN k % 5 = 1 THEN 'User ' || user_id || ' ' || event_type ELSE 'User ' || user_id || ' uses ' || event_type END AS evidence, k % 5 = 0 AS inferred FROM p WHERE k % 5 <> 4""")
def triples_from_json(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").cast("long")
    head = F.concat(F.lit('{"subject": "User '), F.col("user_id").cast("string"), F.lit('", "object": "'), "event_type", F.lit('"'))
    full = F.concat(F.lit("Here:\n```json\n["), head, F.lit(', "object_type": "Component", "relation": "Depends On", "evidence": "seen by a user", "inferred": true}]\n```'))
    odd = F.concat(F.lit("["), head, F.lit(', "relation": "no such"}]'))
    plain = F.concat(F.lit("["), head, F.lit("}] and more ["))
    made = F.when(k % 5 == 0, full).when(k % 5 == 1, odd).when(k % 5 == 4, F.lit("[1] then nothing {")).otherwise(plain)
    none = F.lit(None).cast("string")
    rows = table(spark, d, "events").select(F.col("event_id").cast("string").alias("source"), none.alias("section"), none.alias("url"), none.alias("timestamp"), made.alias("payload"))
    parsed = extraction.parse_triples(rows).where("status is null or status <> 'missing name'")
    return parsed.select("source", "status", "subject", "subject_type", "relation", "object", "object_type", "evidence", "inferred")


# --- names

_REGISTRY = "reg AS (SELECT * FROM (VALUES " + ", ".join(f"('{v.lower()}', '{n}', '{t}', {k})" for k, (t, names) in enumerate(vocabulary.REGISTRY.items()) for n, vs in names.items() for v in dict.fromkeys(x.lower() for x in [*vs, n])) + ") AS v(variant, canonical, entity_type, priority)), variants AS (SELECT variant, arg_max(canonical, priority) AS canonical, arg_max(entity_type, priority) AS entity_type FROM reg GROUP BY variant)"
_ASKED = """asked AS (SELECT DISTINCT name, entity_type FROM (
    SELECT unnest(['AWS ' || name, name || ' service', name, upper(name), 'Amazon ' || name || ' instance', name || ' bucket', ' ' || name || ' ']) AS name, entity_type FROM (
        SELECT p_name AS name, 'Service' AS entity_type FROM part UNION ALL SELECT n_name, 'Component' FROM nation UNION ALL SELECT variant, entity_type FROM reg UNION ALL SELECT canonical, 'Service' FROM reg)))"""


def asked_names(spark: SparkSession, d: str) -> DataFrame:
    registry = vocabulary.registry_table(spark)
    variant = registry.select(F.explode(F.array_distinct(F.transform(F.concat("synonyms", F.array("name")), F.lower))).alias("name"), "entity_type")
    base = table(spark, d, "part").select(F.col("p_name").alias("name"), F.lit("Service").alias("entity_type")).unionByName(table(spark, d, "nation").select(F.col("n_name").alias("name"), F.lit("Component").alias("entity_type"))).unionByName(variant).unionByName(registry.select("name", F.lit("Service").alias("entity_type")))
    n = F.col("name")
    forms = F.array(F.concat(F.lit("AWS "), n), F.concat(n, F.lit(" service")), n, F.upper(n), F.concat(F.lit("Amazon "), n, F.lit(" instance")), F.concat(n, F.lit(" bucket")), F.concat(F.lit(" "), n, F.lit(" ")))
    return base.select(F.explode(forms).alias("name"), "entity_type").distinct()


@query(f"WITH {_REGISTRY}, {_ASKED} SELECT name, asked.entity_type, CASE WHEN v.entity_type = asked.entity_type THEN canonical END AS canonical FROM asked LEFT JOIN variants v ON lower(trim(name)) = v.variant")
def registry_lookup(spark: SparkSession, d: str) -> DataFrame:
    return normalization.find_canonical(asked_names(spark, d), vocabulary.registry_table(spark))


_RULED = rf"""b AS (SELECT *, regexp_replace(regexp_replace(lower(trim(name)), '^(aws|amazon)\s+', ''), '\s+(service|aws|amazon)$', '') AS bare FROM asked),
c AS (SELECT name, entity_type, 0 AS rank, bare AS variant FROM b UNION ALL SELECT name, entity_type, k, trim(left(bare, length(bare) - length(s))) FROM b, (VALUES {", ".join(f"({k}, '{s}')" for k, s in enumerate(vocabulary.SERVICE_SUFFIXES, 1))}) AS x(k, s) WHERE entity_type = 'Service' AND ends_with(bare, s)),
ruled AS (SELECT a.name, a.entity_type, arg_min(v.canonical, rank) AS canonical FROM asked a LEFT JOIN (SELECT c.name, c.entity_type, c.rank, v.canonical FROM c JOIN variants v USING (variant, entity_type)) v USING (name, entity_type) GROUP BY 1, 2)"""


@query(f"WITH {_REGISTRY}, {_ASKED}, {_RULED} SELECT name, entity_type, canonical, CASE WHEN canonical IS NULL THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS confidence, CASE WHEN canonical IS NULL THEN 'none' ELSE 'exact' END AS method FROM ruled")
def normalize_rule(spark: SparkSession, d: str) -> DataFrame:
    return normalization.normalize_names(asked_names(spark, d), vocabulary.registry_table(spark))


@query(f"""WITH {_REGISTRY}, {_ASKED}, {_RULED}, t AS (SELECT a.name AS subject, a.entity_type AS subject_type, 'S3' AS object, CASE WHEN length(a.name) % 2 = 0 THEN 'Service' ELSE 'Pillar' END AS object_type FROM asked a)
SELECT coalesce(r.canonical, t.subject) AS subject, subject_type, CASE WHEN object_type = 'Service' THEN 'Amazon S3' ELSE object END AS object, object_type, CASE WHEN r.canonical IS NOT NULL AND object_type = 'Service' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS confidence, t.subject AS was
FROM t LEFT JOIN ruled r ON r.name = t.subject AND r.entity_type = t.subject_type""")
def normalize_triples(spark: SparkSession, d: str) -> DataFrame:
    asked = asked_names(spark, d)
    triples = asked.select(F.col("name").alias("subject"), F.col("entity_type").alias("subject_type"), F.lit("S3").alias("object"), F.when(F.length("name") % 2 == 0, "Service").otherwise("Pillar").alias("object_type"), F.col("name").alias("was"))
    names = triples.select(F.col("subject").alias("name"), F.col("subject_type").alias("entity_type")).unionByName(triples.select(F.col("object").alias("name"), F.col("object_type").alias("entity_type")))
    return normalization.normalize_triples(triples, normalization.normalize_names(names, vocabulary.registry_table(spark))).select("subject", "subject_type", "object", "object_type", "confidence", "was")


@query("""WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings), c AS (SELECT label, min(vec_id) AS k FROM e GROUP BY label UNION SELECT label, max(vec_id) FROM e GROUP BY label),
m AS (SELECT e.vec_id AS name, e.label, c.k AS canonical, list_cosine_similarity(e.v, x.v) AS s FROM e JOIN c ON e.label = c.label JOIN e x ON x.vec_id = c.k)
SELECT CAST(name AS VARCHAR) AS name, CAST(label AS VARCHAR) AS entity_type, CAST(arg_max(canonical, s) AS VARCHAR) AS canonical, round(max(s), 6) AS confidence FROM m WHERE s >= 0.2 GROUP BY 1, 2""")
def nearest_canonical(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("vec_id").cast("string").alias("name"), F.col("label").cast("string").alias("entity_type"), "embedding", "vec_id")
    ends = e.groupBy("entity_type").agg(F.min("vec_id").alias("a"), F.max("vec_id").alias("b")).select(F.explode(F.array_distinct(F.array("a", "b"))).alias("vec_id"))
    canonical = e.join(F.broadcast(ends), "vec_id", "left_semi").drop("vec_id")
    return normalization.nearest_canonical(e.drop("vec_id"), canonical, 0.2).withColumn("confidence", F.round("confidence", 6))


_PARAPHRASES = "p AS (SELECT * FROM (VALUES " + ", ".join(f"('{w.replace(' ', '_')}', '{r}')" for r, ws in vocabulary.PARAPHRASES.items() for w in ws) + ") AS v(k, r))"


_ASKED_RELATION = "list_extract([" + ", ".join(f"'{w}'" for ws in vocabulary.PARAPHRASES.values() for w in ws) + "], CAST(event_id % " + str(sum(map(len, vocabulary.PARAPHRASES.values()))) + " AS INT) + 1)"


@query(f"""WITH {_PARAPHRASES}, a AS (
    SELECT DISTINCT CASE user_id % 4 WHEN 0 THEN {_ASKED_RELATION} WHEN 1 THEN upper(replace({_ASKED_RELATION}, '_', ' ')) WHEN 2 THEN '  ' || replace({_ASKED_RELATION}, ' ', '_') || ' ' ELSE event_type || 'zzzzzzzzzzzzzz' END AS relation FROM events)
SELECT relation, r AS canonical FROM a LEFT JOIN p ON regexp_replace(lower(trim(relation)), '[_\\s]+', '_', 'g') = k""")
def relation_normalize(spark: SparkSession, d: str) -> DataFrame:
    words = [w for ws in vocabulary.PARAPHRASES.values() for w in ws]
    w = F.element_at(F.array(*map(F.lit, words)), (F.col("event_id") % len(words)).cast("int") + 1)
    form = F.when(F.col("user_id") % 4 == 0, w).when(F.col("user_id") % 4 == 1, F.upper(F.replace(w, F.lit("_"), F.lit(" ")))).when(F.col("user_id") % 4 == 2, F.concat(F.lit("  "), F.replace(w, F.lit(" "), F.lit("_")), F.lit(" "))).otherwise(F.concat("event_type", F.lit("z" * 14)))
    return normalization.normalize_relations(table(spark, d, "events").select(form.alias("relation")), vocabulary.paraphrase_table(spark))


@query()
def relation_normalize_fuzzy(spark: SparkSession, d: str) -> DataFrame:
    asked = table(spark, d, "events").select(F.col("event_type").alias("relation")).unionByName(table(spark, d, "part").select(F.col("p_type").alias("relation"))).unionByName(spark.createDataFrame([("related to",), ("recommend_by",), ("contains",), ("recommends",)], "relation string"))
    return normalization.normalize_relations(asked, vocabulary.paraphrase_table(spark))


@query()
def cluster_entities(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("label").cast("string").alias("entity_type"), F.col("vec_id").cast("string").alias("name"), "embedding")
    return clustering.cluster_entities(e, 0.75)


@query()
def density_clusters(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select(F.col("label").cast("string").alias("entity_type"), F.col("vec_id").cast("string").alias("name"), "embedding")
    return clustering.density_clusters(e)


@query(f"""WITH {_REGISTRY}, c AS (SELECT DISTINCT name FROM (SELECT unnest(['AWS ' || variant, variant, canonical]) AS name FROM reg UNION ALL SELECT p_name FROM part)),
b AS (SELECT name, regexp_replace(regexp_replace(lower(trim(name)), '^(aws|amazon)\\s+', ''), '\\s+(service|aws|amazon)$', '') AS bare FROM c),
k AS (SELECT name, 0 AS rank, bare AS variant FROM b UNION ALL SELECT name, k, trim(left(bare, length(bare) - length(s))) FROM b, (VALUES {", ".join(f"({k}, '{s}')" for k, s in enumerate(vocabulary.SERVICE_SUFFIXES, 1))}) AS x(k, s) WHERE ends_with(bare, s)),
f AS (SELECT k.name, v.canonical, v.entity_type, CASE v.entity_type WHEN 'Service' THEN 0 WHEN 'Component' THEN 100 ELSE 200 END + rank AS o FROM k JOIN variants v USING (variant) WHERE v.entity_type = 'Service' OR rank = 0 AND v.entity_type IN ('Component', 'Pattern'))
SELECT name, arg_min(canonical, o) AS canonical, arg_min(entity_type, o) AS entity_type FROM f GROUP BY name""")
def migrate_concepts(spark: SparkSession, d: str) -> DataFrame:
    registry = vocabulary.registry_table(spark)
    variant = registry.select(F.explode(F.array_distinct(F.transform(F.concat("synonyms", F.array("name")), F.lower))).alias("v"), "name")
    names = variant.select(F.explode(F.array(F.concat(F.lit("AWS "), F.col("v")), F.col("v"), F.col("name"))).alias("name")).unionByName(table(spark, d, "part").select(F.col("p_name").alias("name"))).distinct()
    nodes = graph.node(names, "Concept", F.col("name"), F.col("name")).drop("seq")
    moved, _, _ = graph.migrate_concepts(nodes, spark.createDataFrame([], graph.EDGES), registry)
    return moved.select("name", "canonical", "entity_type")


@query(f"""WITH {_MD}, l AS (SELECT file_path, string_split(content, chr(10)) AS ls FROM md), x AS (SELECT file_path, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l), h AS (SELECT file_path, regexp_replace(regexp_extract(line, '^#{{1,6}}\\s+(.+)$', 1), '^\\s+|\\s+$', '', 'g') AS heading FROM x WHERE regexp_matches(line, '^#{{1,6}}\\s+.+$')), n AS (
    SELECT DISTINCT 'Domain' AS label, split_part(file_path, '/', 1) AS k FROM md UNION ALL SELECT DISTINCT 'Category', split_part(file_path, '/', 1) || ':' || split_part(file_path, '/', 2) FROM md
    UNION ALL SELECT 'Document', file_path FROM md UNION ALL SELECT DISTINCT 'Section', file_path || '::' || heading FROM h)
SELECT 'node' AS kind, label AS what, count(*) AS n FROM n GROUP BY 2
UNION ALL SELECT 'edge', 'CONTAINS', (SELECT count(*) FROM n WHERE label <> 'Domain')""")
def document_graph(spark: SparkSession, d: str) -> DataFrame:
    docs = markdown.documents(markdown_documents(spark, d))
    sections = markdown.sections(docs)
    none = spark.createDataFrame([], "file_path string, seq int, name string, type string, description string, canonical string")
    relations = spark.createDataFrame([], "file_path string, src string, rel_type string, dst string, seq int")
    mentions = spark.createDataFrame([], "file_path string, section_idx int, heading string, name string")
    refs = spark.createDataFrame([], "file_path string, pos int, ref string")
    nodes, edges = graph.document_graph(docs, sections, none, relations, mentions, refs)
    left = nodes.groupBy(F.col("label").alias("what")).agg(F.count("*").alias("n")).select(F.lit("node").alias("kind"), "what", "n")
    return left.unionByName(edges.groupBy(F.col("rel_type").alias("what")).agg(F.count("*").alias("n")).select(F.lit("edge").alias("kind"), "what", "n"))


@query(f"""WITH {_MD}, l AS (SELECT file_path, string_split(content, chr(10)) AS ls FROM md WHERE regexp_matches(content, '^# src1 ')),
x AS (SELECT file_path, unnest(ls) AS line, unnest(range(len(ls))) AS pos FROM l),
h AS (SELECT *, {_TRIM.format("regexp_extract(line, '^#{1,6}\\s+(.+)$', 1)")} AS heading, len(regexp_extract(line, '^(#{{1,6}})', 1)) AS level FROM x WHERE regexp_matches(line, '^#{{1,6}}\\s+.+$')),
f AS (SELECT file_path, heading, arg_max(level, pos) AS level, max(pos) AS start_line FROM h GROUP BY file_path, heading)
SELECT heading, CAST(level AS INT) AS level, CAST(start_line AS INT) AS start_line FROM f JOIN md USING (file_path) WHERE {_TRIM.format("regexp_extract(content, '(?m)^#\\s+(.+)$', 1)")} = 'src1 en'""")
def document_structure(spark: SparkSession, d: str) -> DataFrame:
    docs = markdown.documents(markdown_documents(spark, d))
    sections = markdown.sections(docs)
    none = {"concepts": "file_path string, seq int, name string, type string, description string, canonical string", "relations": "file_path string, src string, rel_type string, dst string, seq int", "mentions": "file_path string, section_idx int, heading string, name string", "refs": "file_path string, pos int, ref string"}
    nodes, edges = graph.document_graph(docs, sections, **{k: spark.createDataFrame([], v) for k, v in none.items()})
    return matching.structure(nodes, edges, "src1 en")


@query(GRAPH + "SELECT s.label AS src_label, e.rel_type, t.label AS dst_label, count(*) AS n FROM edges e JOIN nodes s ON e.src_id = s.node_id JOIN nodes t ON e.dst_id = t.node_id WHERE s.name <> 'NATION_1' GROUP BY 1, 2, 3")
def graph_sql(spark: SparkSession, d: str) -> DataFrame:
    text = "SELECT s.label AS src_label, e.rel_type, t.label AS dst_label, count(*) AS n FROM {edges} e JOIN {nodes} s ON e.src_id = s.node_id JOIN {nodes} t ON e.dst_id = t.node_id WHERE s.name <> :but GROUP BY 1, 2, 3"
    return matching.sql(trade_nodes(spark, d), trade_edges(spark, d), text, but="NATION_1")


@query("""SELECT CAST(event_id AS VARCHAR) AS source, 'User ' || user_id AS name, 'Concept' AS type, NULL::VARCHAR AS description FROM events
UNION ALL SELECT CAST(event_id AS VARCHAR), event_type, 'Event', 'seen' FROM events""")
def entities_from_json(spark: SparkSession, d: str) -> DataFrame:
    made = F.concat(F.lit('["User '), F.col("user_id").cast("string"), F.lit('", {"name": " '), "event_type", F.lit('", "type": "Event", "description": "seen"}, " "]'))
    return extraction.parse_entities(table(spark, d, "events").select(F.col("event_id").cast("string").alias("source"), made.alias("entities")))


@query("""SELECT CAST(event_id AS VARCHAR) AS source, 'User ' || user_id AS src, CASE WHEN value > 20 THEN 'did' ELSE 'RELATES_TO' END AS rel_type, event_type AS dst FROM events""")
def relations_from_json(spark: SparkSession, d: str) -> DataFrame:
    user = F.concat(F.lit('[["User '), F.col("user_id").cast("string"), F.lit('", '))
    made = F.concat(user, F.when(F.col("value") > 20, '"did", "').otherwise('"'), F.col("event_type"), F.lit('"], ["alone"]]'))
    return extraction.parse_relations(table(spark, d, "events").select(F.col("event_id").cast("string").alias("source"), made.alias("relations")))


@query("""WITH c AS (SELECT split_part(p_name, ' ', 1) AS k, arg_min(p_name, (length(p_name), lower(p_name), p_name)) AS canonical FROM part GROUP BY 1)
SELECT p_partkey AS seq, canonical AS subject, p_brand AS object FROM part JOIN c ON split_part(p_name, ' ', 1) = k""")
def cluster_substitution(spark: SparkSession, d: str) -> DataFrame:
    part = table(spark, d, "part")
    clusters = part.select(F.lit("Part").alias("entity_type"), F.split("p_name", " ")[0].alias("cluster_id"), F.col("p_name").alias("name")).distinct()
    triples = part.select(F.col("p_partkey").alias("seq"), F.col("p_name").alias("subject"), F.lit("Part").alias("subject_type"), F.col("p_brand").alias("object"), F.lit("Brand").alias("object_type"))
    return merging.substitute_clusters(triples, clusters, clustering.cluster_canonical(clusters)).select("seq", "subject", "object")


@query("""WITH o AS (SELECT c_custkey AS k, c_mktsegment AS canonical FROM customer), n AS (SELECT c_custkey AS k, CASE WHEN c_acctbal > 5000 THEN 'RICH' ELSE c_mktsegment END AS canonical FROM customer)
SELECT CAST(k AS VARCHAR) AS name, 'Customer' AS entity_type, o.canonical AS existing_canonical, n.canonical AS new_canonical FROM o JOIN n USING (k) WHERE o.canonical <> n.canonical""")
def mapping_conflicts(spark: SparkSession, d: str) -> DataFrame:
    base = table(spark, d, "customer").select(F.col("c_custkey").cast("string").alias("name"), F.lit("Customer").alias("entity_type"), F.col("c_mktsegment").alias("canonical"), "c_acctbal")
    new = base.withColumn("canonical", F.when(F.col("c_acctbal") > 5000, "RICH").otherwise(F.col("canonical")))
    return normalization.mapping_conflicts(base.drop("c_acctbal"), new.drop("c_acctbal"))
