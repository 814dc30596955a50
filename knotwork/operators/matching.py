"""Pattern queries over the tables of a graph."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from knotwork.operators.normalization import SMALL, small
from knotwork.plans.lineage import cut, hashed_where_small


def _ends(nodes: DataFrame, label: str | None, name: str | None, side: str) -> DataFrame:
    if label is not None:
        nodes = nodes.where(F.col("label") == label)
    if name is not None:
        nodes = nodes.where(F.col("name") == name)
    return nodes.select(F.col("node_id").alias(f"{side}_id"), F.col("label").alias(f"{side}_label"), F.col("name").alias(f"{side}_name"), F.col("props").alias(f"{side}_props"))


def match(nodes: DataFrame, edges: DataFrame, rel_types: str | list[str] | None = None, src: str | None = None, dst: str | None = None, src_name: str | None = None, dst_name: str | None = None) -> DataFrame:
    """One hop: edges of the given types between nodes of the given labels and names, None for any. Columns of both ends are prefixed."""
    if rel_types is not None:
        edges = edges.where(F.col("rel_type").isin([rel_types] if isinstance(rel_types, str) else list(rel_types)))
    return edges.join(_ends(nodes, src, src_name, "src"), "src_id").join(_ends(nodes, dst, dst_name, "dst"), "dst_id")


def match_three(nodes: DataFrame, edges: DataFrame, first: tuple[str, str, str], second: tuple[str, str, str], third: str) -> DataFrame:
    """a, b, c, d names of ``(a)-first->(b)``, ``(c)-second->(d)``, ``(c)-third->(b)``; a pattern is (label, type, label)."""
    ab = match(nodes, edges, first[1], first[0], first[2]).select(F.col("src_name").alias("a"), F.col("dst_id").alias("b_id"), F.col("dst_name").alias("b"))
    cd = match(nodes, edges, second[1], second[0], second[2]).select(F.col("src_id").alias("c_id"), F.col("src_name").alias("c"), F.col("dst_name").alias("d"))
    cb = edges.where(F.col("rel_type") == third).select(F.col("src_id").alias("c_id"), F.col("dst_id").alias("b_id"))
    return ab.join(cb, "b_id").join(cd, "c_id").select("a", "b", "c", "d")


def optional_collect(nodes: DataFrame, edges: DataFrame, base: DataFrame, rel_type: str, dst: str, keep: list[str]) -> DataFrame:
    """``base`` (a match) grouped by ``keep``, with ``collected``: the sorted distinct names that its sources reach by another hop, empty without any."""
    more = match(nodes, edges, rel_type, None, dst).select("src_id", F.col("dst_name").alias("__found"))
    return base.join(more, "src_id", "left").groupBy(*keep).agg(F.array_sort(F.collect_set("__found")).alias("collected"))


def isolated(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes without an edge in either direction."""
    touched = edges.select(F.explode(F.array("src_id", "dst_id")).alias("node_id")).distinct()
    return nodes.join(touched, "node_id", "left_anti")


def name_contains(matched: DataFrame, text: str) -> DataFrame:
    """Matches of which either end's name has ``text``."""
    return matched.where(F.col("src_name").contains(text) | F.col("dst_name").contains(text))


def with_evidence(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Labels, names, type and evidence of edges that have evidence."""
    return match(nodes, edges.where("evidence is not null")).select(F.col("src_label").alias("subject_type"), F.col("src_name").alias("subject"), F.col("rel_type").alias("relation"), F.col("dst_label").alias("object_type"), F.col("dst_name").alias("object"), "evidence")


def count_by_label(nodes: DataFrame) -> DataFrame:
    """label, n, the most frequent first."""
    return nodes.groupBy("label").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "label")


def top_degree(nodes: DataFrame, edges: DataFrame, k: int = 20) -> DataFrame:
    """label, name, n of the ``k`` nodes with the most outgoing edges. Edges are counted before they meet nodes."""
    out = edges.groupBy(F.col("src_id").alias("node_id")).agg(F.count("*").alias("n"))
    return out.join(nodes, "node_id").groupBy("label", "name").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), "label", "name").limit(k)


def scan(nodes: DataFrame, label: str, limit: int = 1000) -> DataFrame:
    """name, type, description of a label's nodes, in order of name."""
    found = nodes.where(F.col("label") == label).select("name", F.col("props")["type"].alias("type"), F.col("props")["description"].alias("description"))
    return found.orderBy("name", "type", "description").limit(limit)


def edge_scan(nodes: DataFrame, edges: DataFrame, limit: int = 1000) -> DataFrame:
    """src_label, src_name, rel_type, dst_label, dst_name of the first ``limit`` edges in this order.

    Edges come in the order of their sources. So those of the first few nodes are looked up, then of ten times as many, until
    there are enough of them; the last try takes all nodes."""
    order = ["src_label", "src_name", "rel_type", "dst_label", "dst_name"]
    take = 4 * limit
    while True:
        last = nodes.select("label", "name").orderBy("label", "name").limit(take).agg(F.count("*").alias("n"), F.max(F.struct("label", "name")).alias("x")).select("n", "x.*").first()
        if last["n"] < take or take > 10 * SMALL:
            return match(nodes, edges).select(*order).orderBy(*order).limit(limit)
        near = nodes.where(F.struct("label", "name") <= F.struct(F.lit(last["label"]).cast("string"), F.lit(last["name"]).cast("string")))
        out = small(cut(edges.join(small(_ends(near, None, None, "src").drop("src_props")), "src_id")))
        found = cut(out.join(_ends(nodes, None, None, "dst").drop("dst_props"), "dst_id").select(*order).orderBy(*order).limit(limit))
        if found.count() == limit:
            return found.orderBy(*order)
        take *= 10


def structure(nodes: DataFrame, edges: DataFrame, title: str) -> DataFrame:
    """heading, level, start_line of the sections of documents with a title, in order."""
    met = match(nodes, edges, "CONTAINS", "Document", "Section").where(F.col("src_props")["title"] == title)
    return met.select(F.col("dst_props")["heading"].alias("heading"), F.col("dst_props")["level"].cast("int").alias("level"), F.col("dst_props")["start_line"].cast("int").alias("start_line")).orderBy("start_line")


def trails(nodes: DataFrame, edges: DataFrame, rel_types: list[str], start: Column, max_depth: int | None = None, limit: int | None = None) -> DataFrame:
    """start_id, end_id, depth, path (edges as "src>type>dst"): all trails over edges of the types, none twice, from the nodes that satisfy ``start``.

    Each step joins the frontier with the edges and is cut in the shared folder. Without a ``max_depth`` the steps go on until
    no trail can be made longer, which ends, since none takes an edge twice. With a ``limit`` they end as soon as that many
    trails are found; given are the shortest, of these the first by path."""
    own = edges.where(F.col("rel_type").isin(rel_types)).select("src_id", F.col("dst_id").alias("next_id"), F.concat_ws(">", "src_id", "rel_type", "dst_id").alias("edge")).distinct()
    frontier = nodes.where(start).select(F.col("node_id").alias("start_id"), F.col("node_id").alias("end_id"), F.array().cast("array<string>").alias("path"))
    out = frontier.where("false").select("start_id", "end_id", F.lit(0).alias("depth"), "path")
    if max_depth != 1:
        own = cut(own)
    depth = found = 0
    while depth != max_depth and (limit is None or found < limit):
        depth += 1
        step = frontier.join(own, frontier["end_id"] == own["src_id"]).where(~F.array_contains("path", F.col("edge")))
        frontier = cut(step.select("start_id", F.col("next_id").alias("end_id"), F.array_append("path", F.col("edge")).alias("path")))
        more = frontier.count()
        if not more:
            break
        found += more
        out = out.unionByName(frontier.select("start_id", "end_id", F.lit(depth).alias("depth"), "path"))
    return out if limit is None else out.orderBy("depth", "path").limit(limit)


def sql(nodes: DataFrame, edges: DataFrame, text: str, **values) -> DataFrame:
    """What SQL over ``{nodes}`` and ``{edges}`` gives; ``:name`` in it stands for the value of that name, which is never read as SQL.

    Edges, far more than nodes, are not sorted where what they meet is small in each part."""
    hashed_where_small(nodes.sparkSession)
    return nodes.sparkSession.sql(text, args=values, nodes=nodes, edges=edges)
