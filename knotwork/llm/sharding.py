"""Best-fit-decreasing packing of indivisible groups into shards (operator 10).

Rows of equal text form a group. Groups in descending size enter the shard with the least remaining room that still
holds them, found in a balanced tree of remaining capacities. With a number of shards in place of a capacity, the
capacity is the least tried at which the packing needs no more shards than that; a group larger than the mean load of
the shards left has a shard of its own, and the others share the rest.

What the driver packs is bounded by the number of shards: groups of at least a grain (the target capacity divided by
``GRAINS``) are items on their own, and the smaller groups are items together, by hash, of about half a grain. No group
is ever split. Sizes of a shard then differ by about a grain, but for groups with a shard of their own. With a capacity
the number of shards grows with the table, and nothing is packed by the driver."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from knotwork.plans.lineage import cut

GRAINS = 512
#: Parts of a shard by hash, in which slots are numbered apart.
PARTS = 2048
#: Shards of a capacity that a task packs, and shards up to which what is told of them is broadcast.
CELL, BROADCAST = 64, 64


@dataclass
class _Node:
    key: tuple[int, int]
    left: "_Node | None" = None
    right: "_Node | None" = None
    height: int = 1


class CapacityTree:
    """An AVL tree of (remaining room, shard)."""

    def __init__(self):
        self.root: _Node | None = None

    def tightest(self, size: int) -> tuple[int, int] | None:
        """The least entry with room for ``size``."""
        node, best = self.root, None
        while node:
            if node.key >= (size, -1):
                best, node = node.key, node.left
            else:
                node = node.right
        return best

    def add(self, key: tuple[int, int]) -> None:
        self.root = self._add(self.root, key)

    def remove(self, key: tuple[int, int]) -> None:
        self.root = self._remove(self.root, key)

    @staticmethod
    def _height(node: _Node | None) -> int:
        return node.height if node else 0

    def _turn(self, node: _Node, left: bool) -> _Node:
        up = node.right if left else node.left
        if left:
            node.right, up.left = up.left, node
        else:
            node.left, up.right = up.right, node
        for x in (node, up):
            x.height = 1 + max(self._height(x.left), self._height(x.right))
        return up

    def _balanced(self, node: _Node) -> _Node:
        node.height = 1 + max(self._height(node.left), self._height(node.right))
        lean = self._height(node.left) - self._height(node.right)
        if lean > 1:
            if self._height(node.left.left) < self._height(node.left.right):
                node.left = self._turn(node.left, True)
            return self._turn(node, False)
        if lean < -1:
            if self._height(node.right.right) < self._height(node.right.left):
                node.right = self._turn(node.right, False)
            return self._turn(node, True)
        return node

    def _add(self, node: _Node | None, key: tuple[int, int]) -> _Node:
        if node is None:
            return _Node(key)
        if key < node.key:
            node.left = self._add(node.left, key)
        else:
            node.right = self._add(node.right, key)
        return self._balanced(node)

    def _remove(self, node: _Node | None, key: tuple[int, int]) -> _Node | None:
        if node is None:
            raise KeyError(key)
        if key < node.key:
            node.left = self._remove(node.left, key)
        elif key > node.key:
            node.right = self._remove(node.right, key)
        elif node.left and node.right:
            least = node.right
            while least.left:
                least = least.left
            node.key = least.key
            node.right = self._remove(node.right, least.key)
        else:
            return node.left or node.right
        return self._balanced(node)


def best_fit_decreasing(sizes: list[int], capacity: int, most: int | None = None) -> list[int] | None:
    """The shard of each item; an item above the capacity has a shard of its own. None if more than ``most`` shards are needed."""
    tree, out, shards = CapacityTree(), [0] * len(sizes), 0
    for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
        found = tree.tightest(sizes[i])
        if found is None:
            if shards == most:
                return None
            found, shards = (capacity, shards), shards + 1
        else:
            tree.remove(found)
        room, shard = found
        out[i] = shard
        if room > sizes[i]:
            tree.add((room - sizes[i], shard))
    return out


def pack_into(sizes: list[int], shards: int) -> list[int]:
    """A best-fit-decreasing packing into at most ``shards`` shards, at the least capacity tried that allows it.

    An item above the mean load of what is left has a shard of its own, and the mean is taken anew over the rest. A shard
    that the packing leaves empty takes half of the fullest one of several items."""
    order = sorted(range(len(sizes)), key=lambda i: (-sizes[i], i))
    left, alone = sum(sizes), 0
    while alone < min(shards - 1, len(sizes)) and sizes[order[alone]] * (shards - alone) > left:
        left -= sizes[order[alone]]
        alone += 1
    rest = sorted(order[alone:])
    least, over = max([-(-left // (shards - alone)), *(sizes[i] for i in rest), 1]), 0
    while (found := best_fit_decreasing([sizes[i] for i in rest], least + over, shards - alone)) is None:
        over = over * 3 // 2 + max(1, least >> 14)
    members: list[list[int]] = [[i] for i in order[:alone]] + [[] for _ in range(shards - alone)]
    for i, s in zip(rest, found):
        members[alone + s].append(i)
    for empty in (m for m in members if not m):
        full = max((m for m in members if len(m) > 1), key=lambda m: sum(sizes[i] for i in m), default=None)
        if full is None:
            break
        halves, loads = (empty, []), [0, 0]
        for i in sorted(full, key=lambda i: (-sizes[i], i)):
            k = int(loads[1] < loads[0])
            halves[k].append(i)
            loads[k] += sizes[i]
        full[:] = halves[1]
    shard = {i: s for s, m in enumerate(members) for i in m}
    return [shard[i] for i in range(len(sizes))]


def _pack_cell(capacity: int):
    """Best fit decreasing over the items of a cell, whose number is bounded."""

    def run(table: pa.Table) -> pa.Table:
        rows = table.to_pylist()
        rows.sort(key=_descending)
        placed = best_fit_decreasing([r["bytes"] for r in rows], capacity)
        return pa.table({"cell": table["cell"], **{c: pa.array([r[c] for r in rows], pa.int64()) for c in ("a", "b")}, "local": pa.array(placed, pa.int32())})

    return run


def _descending(r: dict) -> tuple:
    return -r["bytes"], r["b"] is None, r["a"], r["b"] or 0


def pack(docs: DataFrame, shards: int | None = 16, capacity: int | None = None, order: tuple[Column, Column] | None = None) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for each row of ``docs``.

    Give a number of shards, or None and a capacity in bytes, whose number of shards is then kept low: groups are dealt by
    hash to cells of about ``CELL`` shards, and a task packs each cell, so that a cell has at most one shard that is not full.
    ``slot`` counts the rows of a shard from 0 without gaps, by ``order`` (a run of rows, the place in it) where it is given,
    else by hash and doc_id. The law is ``bytes``.

    A null text counts as empty (size 1, checksum 0) and groups with the empty texts; a very long text is a group of its
    size, alone in a shard where that is above the mean or the capacity. Groups of equal size go by their hash. Null and
    repeated doc_ids are rows like any other, other columns are not read, an empty table gives an empty table."""
    text = F.coalesce("text", F.lit(""))
    run, place = order or (F.pmod(F.xxhash64("doc_id", text), F.lit(PARTS)), F.struct("doc_id"))
    rows = cut(docs.select("doc_id", (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.xxhash64(text).alias("a"), F.xxhash64(F.lit(1), text).alias("b"), run.alias("run"), place.alias("place")))
    groups = rows.groupBy("a", "b").agg(F.sum("size").alias("bytes"))
    total = rows.agg(F.sum("size")).first()[0] or 0
    wanted = shards or max(1, -(-total // capacity))
    cells = 1 if shards else -(-wanted // CELL)
    grain = max(1, (capacity or total // wanted) // GRAINS)
    bundles = 2 * GRAINS * min(wanted, CELL if not shards else wanted)
    cell, bundle, large = F.pmod("b", F.lit(cells)).alias("cell"), F.pmod("a", F.lit(bundles)), F.col("bytes") >= grain
    items = groups.groupBy(cell, F.when(large, F.col("a")).otherwise(bundle).alias("a"), F.when(large, F.col("b")).alias("b")).agg(F.sum("bytes").alias("bytes"))
    hint = F.broadcast if wanted <= BROADCAST else lambda df: df  # at most 3 * GRAINS + PARTS rows for each shard
    if shards:
        found = sorted(items.toArrow().to_pylist(), key=_descending)
        placed = docs.sparkSession.createDataFrame([(0, r["a"], r["b"], s) for r, s in zip(found, pack_into([r["bytes"] for r in found], shards))], "cell int, a long, b long, shard int")
    else:
        packed = cut(items.select(F.col("cell").cast("int"), "a", "b", "bytes").groupBy("cell").applyInArrow(_pack_cell(capacity), "cell int, a long, b long, local int"))
        used = packed.groupBy("cell").agg((F.max("local") + 1).alias("n"))
        ahead = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, -1)  # one row for each cell
        first = used.select("cell", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("first"))
        placed = packed.join(F.broadcast(first), "cell").select("cell", "a", "b", (F.col("first") + F.col("local")).cast("int").alias("shard"))
    whole = placed.where("b IS NOT NULL").select("a", "b", F.col("shard").alias("own"))
    bundled = placed.where("b IS NULL").select("cell", F.col("a").alias("bundle"), F.col("shard").alias("shared"))
    dealt = rows.join(hint(whole), ["a", "b"], "left").withColumn("cell", cell.cast("int")).withColumn("bundle", bundle).join(hint(bundled), ["cell", "bundle"], "left")
    dealt = dealt.select("doc_id", "size", "text_crc32", "a", F.coalesce("own", "shared").alias("shard"), "run", "place")
    before = dealt.groupBy("shard", "run").agg(F.count("*").alias("n"))
    ahead = Window.partitionBy("shard").orderBy("run").rowsBetween(Window.unboundedPreceding, -1)
    before = before.select("shard", "run", F.coalesce(F.sum("n").over(ahead), F.lit(0)).alias("before"))
    at = Window.partitionBy("shard", "run").orderBy("place", "text_crc32", "a")
    numbered = dealt.withColumn("at", F.row_number().over(at)).join(before if order else hint(before), ["shard", "run"])
    return numbered.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before") + F.col("at") - 1).alias("slot"), F.lit(None).cast("int").alias("grown_shard"))


def stored_order(docs: DataFrame) -> tuple[Column, Column] | None:
    """The order in which a range-sorted table was written, for ``pack``, if ``docs`` is one read from files: the writing task, and the file and row."""
    try:
        docs.select("_metadata.row_index")
    except AnalysisException:
        return None
    name = F.col("_metadata.file_name")
    task = F.regexp_extract(name, r"part-(\d+)", 1)
    return F.when(task != "", task.cast("long")).otherwise(0), F.struct(name, F.col("_metadata.row_index"))
