"""Entities of one type in clusters of similar embeddings.

Every pair of a type has to be looked at once. A type's entities are dealt to parts by hash, and each two parts meet in a
task as a product of two matrices; what such a task hands on is linear in its rows. So memory is that of two parts, whatever
the type, and only the number of tasks grows with the square of its parts."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.operators.density import condensed_labels, spanning_edges
from knotwork.operators.normalization import small
from knotwork.plans.components import components
from knotwork.plans.lineage import cut

#: Clusters whose linkage a task takes, with a matrix of their distances.
MOST = 4000
#: Entities of a part, and the rows of a product.
PART, ROWS = 2000, 500
#: Edges of a type that a task takes to find its spanning tree.
EDGES = 1_000_000


def unit_vectors(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    vectors = np.array(column.to_pylist(), float).reshape(len(column), -1)
    return vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-300)


def average_linkage(vectors: np.ndarray, threshold: float, sizes: np.ndarray | None = None) -> np.ndarray:
    """Cluster numbers, by joining the two clusters of the least mean cosine distance while that is at most ``threshold``.

    With ``sizes`` the vectors are means of the unit vectors of clusters of these sizes, and not scaled."""
    n = len(vectors)
    unit = vectors / np.maximum(np.linalg.norm(vectors, axis=1, keepdims=True), 1e-12) if sizes is None else vectors
    distance = 1 - unit @ unit.T
    np.fill_diagonal(distance, np.inf)
    size, of = np.ones(n) if sizes is None else sizes.astype(float), np.arange(n)
    nearest, least = distance.argmin(axis=1), distance.min(axis=1)
    while n > 1:
        i = int(least.argmin())
        if not least[i] <= threshold:
            break
        i, j = sorted((i, int(nearest[i])))
        mean = (size[i] * distance[i] + size[j] * distance[j]) / (size[i] + size[j])
        mean[[i, j]] = np.inf
        distance[i], distance[:, i] = mean, mean
        distance[j], distance[:, j] = np.inf, np.inf
        size[i] += size[j]
        size[j] = 0
        of[of == j] = i
        for k in np.flatnonzero((size > 0) & ((nearest == i) | (nearest == j) | (distance[i] <= least))).tolist() + [i]:
            nearest[k], least[k] = distance[k].argmin(), distance[k].min()
        least[j] = np.inf
    return np.unique(of, return_inverse=True)[1]


def _numbered(entities: DataFrame, min_entities: int) -> DataFrame:
    """entity_type, name, embedding, id: a row for each entity with an embedding, of types that have enough of them.

    Written to the shared folder, for the numbers are those of the rows as they lie there."""
    known = entities.where("embedding is not null").groupBy("entity_type", "name").agg(F.first("embedding").alias("embedding"))
    many = small(known.groupBy("entity_type").agg(F.count("*").alias("n")).where(F.col("n") >= min_entities).select("entity_type"))
    return cut(known.join(many, "entity_type", "left_semi").withColumn("id", F.monotonically_increasing_id()))


def _dealt(rows: DataFrame, group: str) -> DataFrame:
    """``rows`` (with ``id``) once for each block i, j of two parts, or of one, of its ``group`` that it is in; ``own`` is its part."""
    parts = small(rows.groupBy(group).agg(F.ceil(F.count("*") / PART).cast("int").alias("parts")))
    own = F.pmod(F.xxhash64("id"), F.col("parts")).cast("int")
    others = F.transform(F.sequence(F.lit(0), F.col("parts") - 1), lambda k: F.struct(F.least(F.col("own"), k).alias("i"), F.greatest(F.col("own"), k).alias("j")))
    met = rows.join(parts, group).withColumn("own", own)
    return met.select(*(met[c] for c in rows.columns), "own", F.explode(others).alias("p")).select(*rows.columns, "own", "p.i", "p.j")


def _sides(key: tuple, table: pa.Table) -> tuple[pa.Table, pa.Table]:
    """The rows of a block's first part and of its second; the same rows twice where the parts are one. ``key`` is the block's (group, i, j)."""
    own = table["own"].to_numpy()
    return table.filter(pa.array(own == key[1].as_py())), table.filter(pa.array(own == key[2].as_py()))


def _ordered(key: tuple, table: pa.Table) -> list[tuple[pa.Table, pa.Table]]:
    """A block's (rows, rows to be searched for them), both ways round where its parts differ."""
    left, right = _sides(key, table)
    return [(left, right)] if key[1] == key[2] else [(left, right), (right, left)]


def _similar(rows: DataFrame, similarity: float) -> DataFrame:
    """u, v: ids of pairs of a type whose cosine reaches ``similarity``, as many as connect what they connect."""

    def near(key: tuple, table: pa.Table) -> pa.Table:
        left, right = _sides(key, table)
        a, b = unit_vectors(left["embedding"]), unit_vectors(right["embedding"])
        ia, ib = left["id"].to_numpy(), right["id"].to_numpy()
        root: dict[int, int] = {}

        def find(x: int) -> int:
            while (up := root.get(x, x)) != x:
                root[x] = root.get(up, up)
                x = up
            return x

        u, v = [], []
        for k in range(0, len(a), ROWS):
            x, y = np.nonzero(a[k : k + ROWS] @ b.T >= similarity)
            for p, q in zip(ia[x + k].tolist(), ib[y].tolist()):
                if p != q and (r := find(p)) != (s := find(q)):
                    root[r] = s
                    u.append(p)
                    v.append(q)
        return pa.table({"u": pa.array(u, pa.int64()), "v": pa.array(v, pa.int64())})

    return _dealt(rows, "entity_type").groupBy("entity_type", "i", "j").applyInArrow(near, "u long, v long")


def _nearest(live: DataFrame) -> DataFrame:
    """id, near, distance: for each cluster of ``live`` (part, id, mean, size) that of its part at the least mean distance, of equals the least id."""

    def best(key: tuple, table: pa.Table) -> pa.Table:
        out: dict[int, tuple[float, int]] = {}
        for x, y in _ordered(key, table):
            if not y.num_rows:
                continue
            y = y.sort_by("id")
            ix, iy = x["id"].to_numpy(), y["id"].to_numpy()
            a, b = (np.array(t["mean"].to_pylist(), float).reshape(t.num_rows, -1) for t in (x, y))
            for k in range(0, len(a), ROWS):
                distance = np.round(1 - a[k : k + ROWS] @ b.T, 12)
                distance[ix[k : k + ROWS, None] == iy[None]] = np.inf
                at = distance.argmin(axis=1)
                for p, q, d in zip(ix[k : k + ROWS].tolist(), iy[at].tolist(), distance[np.arange(len(at)), at].tolist()):
                    if d < np.inf:
                        out[p] = min(out.get(p, (np.inf, 0)), (d, q))
        ids = list(out)
        return pa.table({"id": pa.array(ids, pa.int64()), "distance": pa.array([out[p][0] for p in ids], pa.float64()), "near": pa.array([out[p][1] for p in ids], pa.int64())})

    found = _dealt(live, "part").groupBy("part", "i", "j").applyInArrow(best, "id long, distance double, near long")
    return found.groupBy("id").agg(F.min(F.struct("distance", "near")).alias("b")).select("id", "b.near", "b.distance")


def _joined(live: DataFrame, threshold: float) -> tuple[DataFrame, DataFrame]:
    """(clusters left, pairs u, v joined) of one round: all pairs that are each other's nearest and near enough are joined.

    A cluster without another within ``threshold`` never gets one, since a mean over a joined cluster is no less than the
    lesser of its parts'; it is done and left out. Joining nearest pairs in any order gives the tree of average linkage."""
    near = cut(_nearest(live).where(F.col("distance") <= threshold))
    other = near.select(F.col("id").alias("near"), F.col("near").alias("id"))
    pairs = cut(near.join(other, ["id", "near"], "left_semi").where("id < near").select(F.col("id").alias("u"), F.col("near").alias("v")))
    to = pairs.select(F.col("v").alias("id"), F.col("u").alias("to")).unionByName(pairs.select(F.col("u").alias("id"), F.col("u").alias("to")))
    moved = live.join(near.select("id"), "id", "left_semi").join(to, "id", "left").withColumn("id", F.coalesce("to", "id"))
    one = moved.groupBy("part", "id").agg(F.sum("size").alias("size"), F.collect_list(F.struct("mean", F.col("size").alias("n"))).alias("two"))  # two at most
    weighed = F.transform("two", lambda x: F.transform(x["mean"], lambda y: y * x["n"]))
    total = F.when(F.size("two") == 1, weighed[0]).otherwise(F.zip_with(weighed[0], F.try_element_at(weighed, F.lit(2)), lambda x, y: x + y))
    return cut(one.select("part", "id", F.transform(total, lambda x: x / F.col("size")).alias("mean"), "size")), pairs


def _linked(rows: DataFrame, threshold: float) -> DataFrame:
    """u, v: pairs of ids that average linkage puts in one cluster, as many as connect each, of ``rows`` (part, id, embedding).

    A cluster is its number of entities and the mean of their unit vectors, of which the mean distance of two clusters
    follows; equal vectors begin as one. Parts of up to ``MOST`` clusters go to a task; larger ones are joined in rounds
    until they are no larger."""

    squares = F.aggregate(F.transform("embedding", lambda x: x.cast("double") * x.cast("double")), F.lit(0.0), lambda s, x: s + x)
    unit = F.transform("embedding", lambda x: x.cast("double") / F.col("norm"))
    same = rows.groupBy("part", "embedding").agg(F.min("id").alias("id"), F.count("*").alias("size"))
    copies = rows.join(same.select("part", "embedding", F.col("id").alias("u")), ["part", "embedding"]).where("id <> u").select("u", F.col("id").alias("v"))
    live = cut(same.withColumn("norm", F.greatest(F.sqrt(squares), F.lit(1e-300))).select("part", "id", unit.alias("mean"), F.col("size").cast("double").alias("size")))

    def link(table: pa.Table) -> pa.Table:
        table = table.sort_by("id")
        ids = table["id"].to_numpy()
        of = average_linkage(np.array(table["mean"].to_pylist(), float).reshape(len(ids), -1), threshold, table["size"].to_numpy())
        first = np.zeros(of.max() + 1, np.int64)
        first[of[::-1]] = ids[::-1]
        return pa.table({"u": first[of], "v": ids})

    found = [copies]
    while True:
        sizes = cut(live.groupBy("part").agg(F.count("*").alias("n")))
        fits = live.join(small(sizes.where(F.col("n") <= MOST).select("part")), "part", "left_semi")
        found.append(fits.groupBy("part").applyInArrow(link, "u long, v long").where("u <> v"))
        if sizes.where(F.col("n") > MOST).isEmpty():
            break
        live, pairs = _joined(live.join(small(sizes.where(F.col("n") > MOST).select("part")), "part", "left_semi"), threshold)
        found.append(pairs)
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return cut(out)


def _clusters(rows: DataFrame, links: DataFrame) -> DataFrame:
    """entity_type, cluster_id, name: connected ids are a cluster, named after its least name."""
    met = rows.join(components(links).withColumnRenamed("node", "id"), "id", "left").select("entity_type", "name", F.coalesce("root", "id").alias("root"))
    first = met.groupBy("entity_type", "root").agg(F.min("name").alias("first"))
    return met.join(first, ["entity_type", "root"]).select("entity_type", F.concat_ws("_cluster_", "entity_type", "first").alias("cluster_id"), "name")


def cluster_entities(entities: DataFrame, similarity: float = 0.75, min_entities: int = 2) -> DataFrame:
    """entity_type, cluster_id, name of (entity_type, name, embedding): average-linkage clusters of a cosine distance of at most ``1 - similarity``.

    Types with fewer entities with an embedding are left out. Clusters lie within the components of pairs of at least that
    similarity, since a mean is no less than the least distance, so each component is linked on its own, in a task or, if it
    is large, in rounds. An entity that is near none is a cluster by itself."""
    rows = _numbered(entities, min_entities)
    parts = components(_similar(rows, similarity))
    placed = rows.join(parts.withColumnRenamed("node", "id"), "id").select(F.col("root").alias("part"), "id", "embedding")
    return _clusters(rows, _linked(cut(placed), 1 - similarity))


# --- density


def _core_distances(rows: DataFrame, k: int) -> DataFrame:
    """id, core: the distance of each entity to its ``k``-th nearest other of its type."""

    def near(key: tuple, table: pa.Table) -> pa.Table:
        ids, rest = [], []
        for x, y in _ordered(key, table):
            a, b = unit_vectors(x["embedding"]), unit_vectors(y["embedding"])
            ix, iy = x["id"].to_numpy(), y["id"].to_numpy()
            for p in range(0, len(a), ROWS):
                d = np.round(1 - a[p : p + ROWS] @ b.T, 12)
                d[ix[p : p + ROWS, None] == iy[None]] = np.inf
                ids += ix[p : p + ROWS].tolist()
                rest += np.sort(np.partition(d, min(k, d.shape[1]) - 1, axis=1)[:, :k], axis=1).tolist() if d.shape[1] else [[]] * len(d)
        return pa.table({"id": pa.array(ids, pa.int64()), "near": pa.array(rest, pa.list_(pa.float64()))})

    found = _dealt(rows, "entity_type").groupBy("entity_type", "i", "j").applyInArrow(near, "id long, near array<double>")
    each = F.slice(F.array_sort(F.flatten(F.collect_list("near"))), 1, k)
    return found.groupBy("id").agg(F.array_max(F.filter(each, lambda d: d < float("inf"))).alias("core"))


def spanning_tree(rows: DataFrame, min_samples: int = 1) -> DataFrame:
    """entity_type, u, v, distance: a minimum spanning tree of each type's entities (entity_type, id, embedding).

    Distances are cosine distances, or the core distance of either end if that is greater. A block's own spanning forest has
    all its edges that the whole tree can have. Of these, while a type has over ``EDGES``, every component takes its least
    edge, in rounds (Borůvka); a task finishes the rest."""
    if min_samples > 1:
        rows = rows.join(_core_distances(rows, min_samples), "id", "left")
    else:  # no nearer than the nearest, so that it changes no distance
        rows = rows.withColumn("core", F.lit(0.0))
    rows = rows.select("entity_type", "id", "embedding", F.coalesce("core", F.lit(0.0)).alias("core"))

    def forest(key: tuple, table: pa.Table) -> pa.Table:
        left, right = _sides(key, table)
        one = key[1] == key[2]
        a, b = unit_vectors(left["embedding"]), unit_vectors(right["embedding"])
        ia, ib = left["id"].to_numpy(), right["id"].to_numpy()
        d = np.round(1 - a @ b.T, 12) if len(a) and len(b) else np.zeros((len(a), len(b)))
        d = np.maximum(d, np.maximum(left["core"].to_numpy()[:, None], right["core"].to_numpy()[None]))
        p, q, w = spanning_edges(d, one)
        u, v = ia[p], ib[q]
        return pa.table({"entity_type": pa.array([key[0].as_py()] * len(w), pa.string()), "u": np.minimum(u, v), "v": np.maximum(u, v), "distance": w})

    kind = "entity_type string, u long, v long, distance double"
    rows = rows.withColumn("entity_type", F.col("entity_type").cast("string"))
    edges = cut(_dealt(rows, "entity_type").groupBy("entity_type", "i", "j").applyInArrow(forest, kind))
    left = edges.select("*", F.col("u").alias("cu"), F.col("v").alias("cv"))
    chosen = None
    while not left.groupBy("entity_type").agg(F.count("*").alias("n")).where(F.col("n") > EDGES).isEmpty():
        least = F.min(F.struct("distance", "u", "v", "entity_type", "cu", "cv")).alias("e")
        ends = left.withColumn("c", F.explode(F.array("cu", "cv")))
        picked = cut(ends.groupBy("c").agg(least).select("e.*").distinct())
        root = components(picked.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        for c in ("cu", "cv"):
            left = left.join(root.withColumnRenamed("node", c), c, "left").withColumn(c, F.coalesce("root", c)).drop("root")
        left = left.where("cu <> cv").withColumns({"cu": F.least("cu", "cv"), "cv": F.greatest("cu", "cv")})
        left = cut(left.groupBy("entity_type", "cu", "cv").agg(F.min(F.struct("distance", "u", "v")).alias("e")).select("entity_type", "e.*", "cu", "cv"))
        picked = picked.select("entity_type", "u", "v", "distance")
        chosen = picked if chosen is None else chosen.unionByName(picked)

    def kruskal(table: pa.Table) -> pa.Table:
        d, u, v, cu, cv = (table[c].to_numpy() for c in ("distance", "u", "v", "cu", "cv"))
        names, at = np.unique(np.concatenate([cu, cv]), return_inverse=True)
        p, q = at[: len(cu)].tolist(), at[len(cu) :].tolist()
        root, kept = list(range(len(names))), []
        for k in np.lexsort((v, u, d)).tolist():
            x, y = p[k], q[k]
            while root[x] != x:
                root[x] = x = root[root[x]]
            while root[y] != y:
                root[y] = y = root[root[y]]
            if x != y:
                root[x] = y
                kept.append(k)
        return table.select(["entity_type", "u", "v", "distance"]).take(pa.array(kept, pa.int64()))

    rest = left.groupBy("entity_type").applyInArrow(kruskal, kind)
    return cut(rest if chosen is None else chosen.unionByName(rest))


def density_clusters(entities: DataFrame, min_cluster_size: int = 2, min_samples: int = 1, min_entities: int = 2) -> DataFrame:
    """entity_type, cluster_id, name of (entity_type, name, embedding): hierarchical density clusters of cosine distances; noise is left out.

    The spanning tree, cut at every distance from the greatest down, is a tree of clusters, in which parts of under
    ``min_cluster_size`` entities fall out of the cluster around them. Of a cluster and those inside it, the more stable are
    taken, by the sum over entities of how long, in inverse distance, they stay; never the whole type. Distances under 1e-9
    count as that. A type's tree is in one task: three numbers an entity, where the pairs looked at are the square of them."""
    rows = _numbered(entities, min_entities)
    tree = spanning_tree(rows.select("entity_type", "id", "embedding"), min_samples)

    def label(table: pa.Table) -> pa.Table:
        u, v, d = (table[c].to_numpy() for c in ("u", "v", "distance"))
        ids, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        of = condensed_labels(len(ids), at[: len(u)], at[len(u) :], d, min_cluster_size)
        return pa.table({"id": ids[of >= 0], "part": of[of >= 0]})

    labelled = tree.groupBy("entity_type").applyInArrow(label, "id long, part long")
    met = cut(rows.join(labelled, "id").select("entity_type", "name", "part"))
    first = met.groupBy("entity_type", "part").agg(F.min("name").alias("first"))
    return met.join(first, ["entity_type", "part"]).select("entity_type", F.concat_ws("_cluster_", "entity_type", "first").alias("cluster_id"), "name")


def cluster_canonical(clusters: DataFrame) -> DataFrame:
    """cluster_id, canonical: the shortest name, the first of these in lower case."""
    return clusters.groupBy("cluster_id").agg(F.min_by("name", F.struct(F.length("name"), F.lower("name"), F.col("name"))).alias("canonical"))
