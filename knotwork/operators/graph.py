"""A property graph as two tables.

nodes: node_id, label, name, props (map of strings). edges: src_id, dst_id, rel_type, evidence. A node_id is its label, a
colon and its key. Rows of one key are merged; ``seq``, of any type that has an order, tells which came last."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from knotwork.functions.text import relation_type
from knotwork.operators import segments
from knotwork.operators.normalization import small
from knotwork.plans.lineage import ROWS, cut
from knotwork.sources import versions

NODES = "node_id string, label string, name string, props map<string, string>"
EDGES = "src_id string, dst_id string, rel_type string, evidence string"
#: Characters of a text that a node keeps, and of a description.
CONTENT, DESCRIPTION = 1000, 500
#: Characters of a stretch in the index that references are looked up in.
GRAM = 4
#: Sources, and members of a class, that meet in one cell; pairs that a task makes, about; and rows with references that go to every task at most.
SLICE, BLOCK, PAIRS, FEW = 4000, 250, 2_000_000, 20_000


def node_id(label: Column | str, key: Column | str) -> Column:
    label = F.lit(label) if isinstance(label, str) else label
    return F.concat(label, F.lit(":"), F.col(key) if isinstance(key, str) else key)


def props(**columns: Column) -> Column:
    """A map of the properties that are not null."""
    if not columns:
        return F.create_map().cast("map<string,string>")
    pairs = F.array(*(F.struct(F.lit(k).alias("key"), v.cast("string").alias("value")) for k, v in columns.items()))
    return F.map_from_entries(F.filter(pairs, lambda p: p["value"].isNotNull()))


def node(rows: DataFrame, label: str, key: Column, name: Column, seq: Column | None = None, **columns: Column) -> DataFrame:
    """Rows as nodes with ``seq``."""
    return rows.select(node_id(label, key).alias("node_id"), F.lit(label).alias("label"), name.alias("name"), props(**columns).alias("props"), (seq if seq is not None else F.lit(0).cast("long")).alias("seq"))


def merge_nodes(nodes: DataFrame) -> DataFrame:
    """A node for each node_id; of its properties the last one that was set."""
    return nodes.groupBy("node_id").agg(F.max_by(F.struct("label", "name", "props"), F.struct("seq", F.to_json("props"))).alias("n")).select("node_id", "n.label", "n.name", "n.props")


def edge(rows: DataFrame, src: Column, rel_type: Column | str, dst: Column, evidence: Column | None = None, seq: Column | None = None) -> DataFrame:
    return rows.select(src.alias("src_id"), dst.alias("dst_id"), (F.lit(rel_type) if isinstance(rel_type, str) else rel_type).alias("rel_type"), (evidence if evidence is not None else F.lit(None).cast("string")).alias("evidence"), (seq if seq is not None else F.lit(0).cast("long")).alias("seq"))


def merge_edges(edges: DataFrame, nodes: DataFrame | None = None) -> DataFrame:
    """An edge for each source, type and target. Evidence that is given is joined in order by bars, null among it as empty; with ``nodes`` both ends must be among them."""
    if nodes is not None:
        ids = nodes.select("node_id")
        edges = edges.join(ids.withColumnRenamed("node_id", "src_id"), "src_id", "left_semi").join(ids.withColumnRenamed("node_id", "dst_id"), "dst_id", "left_semi")
    merged = edges.groupBy("src_id", "dst_id", "rel_type").agg(F.array_sort(F.collect_list(F.struct("seq", "evidence"))).alias("all"), F.count("evidence").alias("given"))
    evidence = F.array_join(F.transform("all", lambda e: F.coalesce(e["evidence"], F.lit(""))), " | ")
    return merged.select("src_id", "dst_id", "rel_type", F.when(F.col("given") > 0, evidence).alias("evidence"))


def evidence_segments(edges: DataFrame, size: int = segments.SIZE) -> DataFrame:
    """src_id, dst_id, rel_type, segment, n, items: the evidence of edges in ordered segments, for edges with more of it than a row should hold.

    An edge without any evidence has none; where there is some, what is null is empty, as in ``merge_edges``."""
    key = ["src_id", "dst_id", "rel_type"]
    given = edges.groupBy(*key).agg(F.count("evidence").alias("given")).where("given > 0").drop("given")
    told = edges.join(given, key, "left_semi")
    return segments.segments(told, key, [F.col("seq"), F.col("evidence")], F.coalesce("evidence", F.lit("")), size)


def assembled_evidence(held: DataFrame) -> DataFrame:
    """src_id, dst_id, rel_type, evidence, joined by bars, of ``evidence_segments``."""
    whole = segments.assembled(held, ["src_id", "dst_id", "rel_type"])
    return whole.select("src_id", "dst_id", "rel_type", F.array_join("items", " | ").alias("evidence"))


def path_parts(path: Column) -> tuple[Column, Column]:
    """(domain, category): the first two folders of a path below the root, null where it has fewer."""
    parts = F.split(F.regexp_replace(path, r"^(\./|/)+", ""), "/+")
    return F.when(F.size(parts) >= 2, F.element_at(parts, 1)), F.when(F.size(parts) >= 3, F.try_element_at(parts, F.lit(2)))


def triple_graph(triples: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of triples with ``seq``: both ends under the labels of their types, an edge of the relation in one form, its evidence appended in order."""
    ends = triples.select(F.explode(F.array(F.struct(F.col("subject_type").alias("label"), F.col("subject").alias("name")), F.struct(F.col("object_type").alias("label"), F.col("object").alias("name")))).alias("e")).select("e.*").distinct()
    nodes = ends.select(node_id(F.col("label"), "name").alias("node_id"), "label", "name", props(name=F.col("name")).alias("props"))
    edges = edge(triples, node_id(F.col("subject_type"), "subject"), F.lower(F.coalesce(relation_type(F.col("relation")), F.lit("relates_to"))), node_id(F.col("object_type"), "object"), F.coalesce("evidence", F.lit("")), F.col("seq"))
    return nodes, merge_edges(edges)


def _grams(text: Column, length: Column | int) -> Column:
    """The distinct stretches of ``length`` characters of a text; none in a shorter one."""
    length = F.lit(length) if isinstance(length, int) else length
    last = F.length(text) - length
    return F.when(last >= 0, F.array_distinct(F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0))), lambda i: F.substring(text, i + 1, length)))).otherwise(F.array().cast("array<string>"))


def containing(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """key, ref: rows of ``texts`` (key, text) that have a text of ``wanted`` (ref) in them, once each.

    An inverted index of stretches of ``GRAM`` characters: each wanted text is looked up by that of its stretches which the
    fewest texts have, and only what is found is compared. A wanted text that is shorter than a stretch is one itself, so
    stretches of its length are in the index too. Texts and wanted ones should be distinct."""
    wanted = wanted.select("ref").where("ref <> ''").distinct()
    size = F.least(F.length("ref"), F.lit(GRAM))
    own = wanted.select("ref", F.explode(_grams(F.col("ref"), size)).alias("gram"))
    sizes = [r[0] for r in own.select(F.length("gram").alias("n")).distinct().collect()]  # GRAM at most
    if not sizes:
        return texts.select("key").crossJoin(wanted).where("false")
    index = texts.where("text is not null").select("key", "text", F.explode(F.flatten(F.array(*(_grams(F.col("text"), n) for n in sizes)))).alias("gram"))
    counts = index.groupBy("gram").agg(F.count("*").alias("n"))
    rarest = own.join(counts, "gram", "left").groupBy("ref").agg(F.min_by(F.struct("gram", "n"), F.struct(F.coalesce("n", F.lit(0)), "gram")).alias("r")).where("r.n is not null").select("ref", "r.gram")
    return index.join(small(cut(rarest)), "gram").where(F.col("text").contains(F.col("ref"))).select("key", "ref").distinct()


def reference_edges(docs: DataFrame, refs: DataFrame, forward: bool = True) -> DataFrame:
    """src, dst: documents whose path or title has a reference's text in it, once each. With ``forward`` off only those before it by path, itself included.

    References are made distinct, written once, and looked up in an index of the paths and titles. Documents with the same
    references in them are a class: sources meet classes, and a class has its members in the end, so that no pair is made
    twice and none is shuffled. Sources are dealt in slices of ``SLICE`` and members of a class in blocks of ``BLOCK``, each
    meeting each. A block is one row, and a source is followed by all of it: targets come again and again in the same order,
    which files of columns hold in little room."""
    named = docs.select(F.col("file_path").alias("key"), F.explode(F.array("file_path", "title")).alias("text"))
    refs = cut(refs.select(F.col("file_path").alias("src"), "ref").distinct())
    met = cut(containing(named, cut(refs.select("ref").distinct())))
    held = cut(met.groupBy("key").agg(F.array_sort(F.collect_set("ref")).alias("refs")))
    classes = cut(held.groupBy("refs").agg(F.count("*").alias("members")).withColumn("class", F.monotonically_increasing_id()))
    linked = cut(refs.join(small(classes.select("class", F.explode("refs").alias("ref")), FEW), "ref").select("src", "class").distinct())
    parts = lambda n, size: F.ceil(F.col(n) / size)
    dealt = cut(linked.groupBy("class").agg(F.count("*").alias("sources")).join(classes, "class").withColumns({"a": parts("sources", SLICE), "b": parts("members", BLOCK)}))
    pairs = int(dealt.agg(F.sum(F.col("sources") * F.col("members"))).first()[0] or 1)
    n, copying = -(-pairs // PAIRS), -(-pairs // (BLOCK * ROWS))  # tasks that make pairs, and that copy sources for each block and blocks for each slice
    each = lambda count: F.explode(F.sequence(F.lit(0).cast("long"), F.col(count) - 1))
    sources = linked.repartition(copying, "src").join(small(dealt.select("class", "a", "b")), "class").select("class", "src", F.pmod(F.xxhash64("src"), "a").alias("i"), each("b").alias("j"))
    told = held.join(small(dealt.select("refs", "class", "a", "b"), FEW), "refs").groupBy("class", "a", F.pmod(F.xxhash64("key"), "b").alias("j"))
    blocks = cut(told.agg(F.collect_list(F.struct("key")).alias("m")).select("class", "a", "j", F.col("m.key").alias("dsts")))  # in structs, or a null would go
    copied = blocks.repartition(copying, "class", "j").select("class", each("a").alias("i"), "j", "dsts")
    cell = ["class", "i", "j"]
    meeting = sources.repartition(n, *cell).join(copied.repartition(n, *cell).hint("merge"), cell)  # in the order of cells
    out = meeting.select("src", F.explode("dsts").alias("dst"))
    return out if forward else out.where("dst <= src")


def document_graph(docs: DataFrame, sections: DataFrame, concepts: DataFrame, relations: DataFrame, mentions: DataFrame, refs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of documents (file_path, title, content), their sections, concepts, concept relations, mentions and references."""
    domain, category = path_parts(F.col("file_path"))
    placed = docs.withColumns({"domain": domain, "category": category})
    both = F.concat_ws(":", "domain", "category")
    in_domain, in_category = placed.where("domain is not null").select("domain").distinct(), placed.where("category is not null").select("domain", "category").distinct()
    section = F.concat_ws("::", "file_path", "heading")
    nodes = [
        node(in_domain, "Domain", F.col("domain"), F.col("domain")),
        node(in_category, "Category", both, F.col("category"), domain=F.col("domain")),
        node(docs, "Document", F.col("file_path"), F.col("title"), title=F.col("title"), content=F.substring("content", 1, CONTENT), full_content=F.col("content")),
        node(sections, "Section", section, F.col("heading"), F.col("section_idx"), heading=F.col("heading"), level=F.col("level"), content=F.substring("content", 1, CONTENT), start_line=F.col("start_line"), end_line=F.col("end_line")),
        merge_nodes(node(concepts, "Concept", F.col("name"), F.col("name"), F.struct("file_path", "seq"), type=F.col("type"), description=F.substring("description", 1, DESCRIPTION))).withColumn("seq", F.lit(0).cast("long")),
    ]
    document = node_id("Document", "file_path")
    edges = [
        edge(in_category, node_id("Domain", "domain"), "CONTAINS", node_id("Category", both)),
        edge(placed.where("category is not null"), node_id("Category", both), "CONTAINS", document),
        edge(sections, document, "CONTAINS", node_id("Section", section)),
        edge(concepts, document, "DOCUMENTS", node_id("Concept", "name")),
        edge(mentions, node_id("Section", section), "MENTIONS", node_id("Concept", "name")),
        edge(relations, node_id("Concept", "src"), relation_type(F.col("rel_type")), node_id("Concept", "dst")).where("rel_type is not null"),
        edge(reference_edges(docs, refs), node_id("Document", "src"), "REFERENCES", node_id("Document", "dst")),
    ]
    return merge_nodes(_union(nodes)), merge_edges(_union(edges))


def entity_graph(entities: DataFrame, relations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of extracted entities (source, name, type, description) and relations (src, rel_type, dst); a relation whose name will not do is RELATES_TO."""
    nodes = merge_nodes(node(entities, "Entity", F.col("name"), F.col("name"), type=F.col("type"), description=F.substring("description", 1, DESCRIPTION), source_document=F.col("source")))
    edges = edge(entities, node_id("Document", "source"), "EXTRACTS", node_id("Entity", "name")).unionByName(edge(relations, node_id("Entity", "src"), F.coalesce(relation_type(F.col("rel_type")), F.lit("RELATES_TO")), node_id("Entity", "dst")))
    return nodes, merge_edges(edges)


def _union(frames: list[DataFrame]) -> DataFrame:
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def clear_domain(nodes: DataFrame, edges: DataFrame, domain: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(counts, nodes, edges): what a domain holds down to its sections, one row, and the graph without that. Concepts and entities stay; an unknown domain has nothing."""
    found = nodes.where((F.col("label") == "Domain") & (F.col("name") == domain)).select("node_id")
    down, levels = edges.where("rel_type = 'CONTAINS'").select(F.col("src_id").alias("node_id"), "dst_id"), [found]
    for _ in range(3):
        levels.append(levels[-1].join(down, "node_id").select(F.col("dst_id").alias("node_id")).distinct())
    names = ["domains", "categories", "documents", "sections"]
    counts = _union([x.select(F.lit(n).alias("what"), "node_id") for n, x in zip(names, levels)]).groupBy().pivot("what", names).agg(F.countDistinct("node_id"))
    gone = _union(levels).distinct()
    kept = nodes.join(gone, "node_id", "left_anti")
    rest = edges.join(gone.withColumnRenamed("node_id", "src_id"), "src_id", "left_anti").join(gone.withColumnRenamed("node_id", "dst_id"), "dst_id", "left_anti").select(edges.columns)
    return counts.select(*(F.coalesce(n, F.lit(0)).alias(n) for n in names)), kept, rest


def graph_counts(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes, edges: one row."""
    none = F.lit(None).cast("long")
    both = nodes.agg(F.count("*").alias("nodes")).select("nodes", none.alias("edges")).unionByName(edges.agg(F.count("*").alias("edges")).select(none.alias("nodes"), "edges"))
    return both.agg(F.max("nodes").alias("nodes"), F.max("edges").alias("edges"))


def migrate_concepts(nodes: DataFrame, edges: DataFrame, registry: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(moved, nodes, edges): Concept nodes that the registry knows as Service, Component or Pattern, in that order, under the
    canonical name and the type's label, with their edges; others stay. ``moved`` has node_id, name, canonical, entity_type."""
    from knotwork.operators.normalization import normalize_names

    order = ["Service", "Component", "Pattern"]
    concepts = nodes.where("label = 'Concept'")
    tried = concepts.select("name").distinct().select("name", F.explode(F.array(*map(F.lit, order))).alias("entity_type"))
    found = normalize_names(tried, registry).where("canonical is not null")
    rank = F.array_position(F.array(*map(F.lit, order)), F.col("entity_type"))
    best = found.groupBy("name").agg(F.min_by(F.struct("canonical", "entity_type"), rank).alias("b")).select("name", "b.canonical", "b.entity_type")
    moved = concepts.join(best, "name").select("node_id", "name", "canonical", "entity_type")
    to = moved.select(F.col("node_id").alias("__old"), node_id(F.col("entity_type"), "canonical").alias("__new"))
    changed = concepts.join(moved.select("node_id", "canonical", "entity_type"), "node_id")
    changed = changed.select(node_id(F.col("entity_type"), "canonical").alias("node_id"), F.col("entity_type").alias("label"), F.col("canonical").alias("name"), F.map_concat("props", F.map_from_arrays(F.array(F.lit("migrated_from"), F.lit("original_name")), F.array(F.lit("Concept"), F.col("name")))).alias("props"), F.lit(1).cast("long").alias("seq"))
    kept = nodes.join(moved.select("node_id"), "node_id", "left_anti").select("node_id", "label", "name", "props", F.lit(2).cast("long").alias("seq"))
    rest = edges
    for side in ("src_id", "dst_id"):
        rest = rest.join(to, rest[side] == to["__old"], "left").select(*(F.coalesce("__new", c).alias(c) if c == side else F.col(c) for c in edges.columns))
    return moved, merge_nodes(kept.unionByName(changed)), merge_edges(rest.withColumn("seq", F.lit(0).cast("long")))


def write_graph(nodes: DataFrame, edges: DataFrame, folder: str) -> int:
    """A new version of the graph in ``folder``, and its number: Parquet by label and by type of relation, which filters on these then skip.

    Nodes come first and edges last; a version whose edges were not written to their end is as if it were not there, so a
    graph is never half old and half new. The tables may come from the version before, which stays until the next one; those
    before it are removed."""
    spark = nodes.sparkSession
    n = versions.newest(spark, folder, "edges") + 1
    nodes.write.mode("overwrite").partitionBy("label").parquet(f"{folder}/v{n}/nodes")
    edges.write.mode("overwrite").partitionBy("rel_type").parquet(f"{folder}/v{n}/edges")
    if n > 2:
        versions.drop_version(spark, folder, n - 2)
    return n


def read_graph(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(nodes, edges) of the newest whole version in ``folder``; both empty without one. The folder may lie anywhere that Spark reads."""
    n = versions.newest(spark, folder, "edges")
    if not n:
        return clear_all(spark)
    nodes, edges = spark.read.schema(NODES).parquet(f"{folder}/v{n}/nodes"), spark.read.schema(EDGES).parquet(f"{folder}/v{n}/edges")
    return nodes.select("node_id", "label", "name", "props"), edges.select("src_id", "dst_id", "rel_type", "evidence")


def clear_all(spark: SparkSession) -> tuple[DataFrame, DataFrame]:
    return spark.createDataFrame([], NODES), spark.createDataFrame([], EDGES)
