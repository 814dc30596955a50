"""The nearest of a table of vectors, exactly, without meeting all of them.

Few vectors are sent to every task. Many are dealt to cells around some of them, the seeds. For unit vectors angles are a
metric, so nothing in a cell is nearer to a vector than its angle to the seed less the cell's radius. A vector is first held
against the cell that may hold the nearest, then against those only that may hold one as near as what was found."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.plans.lineage import cut

#: Vectors that are sent to every task, and seeds.
SENT, SEEDS = 4000, 2048
#: Vectors of a cell that one seed is for, and of either side that meet in a task.
CELL, PART = 500, 4000
#: More than what rounding can take from a bound.
SLACK = 1e-9


def units(column: pa.Array | pa.ChunkedArray, width: int | None = None) -> np.ndarray:
    """Unit vectors as rows; what has no length, or another than ``width``, is all zeros."""
    lists = column.to_pylist()
    width = width if width is not None else max((len(x) for x in lists if x), default=0)
    out = np.array([x if x is not None and len(x) == width and None not in x else [0.0] * width for x in lists], float).reshape(len(lists), width)
    norm = np.linalg.norm(out, axis=1, keepdims=True)
    return np.divide(out, norm, out=np.zeros_like(out), where=norm > 0)


def _best(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row of ``y``, cosine) of the nearest for each row of ``x``, the first of equals."""
    at, of = np.zeros(len(x), np.int64), np.full(len(x), -np.inf)
    for a in range(0, len(x), 1000):
        near = np.round(x[a : a + 1000] @ y.T, 12)
        at[a : a + 1000] = near.argmax(axis=1)
        of[a : a + 1000] = near[np.arange(len(near)), at[a : a + 1000]]
    return at, of


def _by_type(rows: list) -> dict[str, tuple[list, np.ndarray]]:
    """Type to (names in order, unit vectors) of rows (name, entity_type, embedding)."""
    types: dict[str, list] = {}
    for r in sorted(rows, key=lambda r: r[0].encode()):
        types.setdefault(r[1], []).append(r)
    return {t: ([r[0] for r in rs], units(pa.array([list(r[2]) for r in rs], pa.list_(pa.float64())))) for t, rs in types.items()}


_FOUND = "name string, entity_type string, canonical string, confidence double"


def _against_all(names: DataFrame, rows: list, threshold: float) -> DataFrame:
    sent = names.sparkSession.sparkContext.broadcast([tuple(r) for r in rows])

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = _by_type(sent.value)
        for batch in batches:
            types = np.array(batch.column("entity_type").to_pylist(), object)
            out = []
            for t in set(types.tolist()) & known.keys():
                own = batch.filter(pa.array(types == t))
                canonical, y = known[t]
                at, of = _best(units(own.column("embedding"), y.shape[1]), y)
                out += [(n, t, canonical[k], float(c)) for n, k, c in zip(own.column("name").to_pylist(), at.tolist(), of.tolist()) if c >= threshold and c != 0]
            columns = list(zip(*out)) if out else [[], [], [], []]
            yield pa.record_batch([pa.array(c, k) for c, k in zip(columns, [pa.string(), pa.string(), pa.string(), pa.float64()])], names=["name", "entity_type", "canonical", "confidence"])

    return names.mapInArrow(search, _FOUND)


class Cells:
    """Vectors (canonical, entity_type, embedding) dealt to cells; ``seeds`` are (cell, type, seed), ``rows`` have a cell each, ``radius`` and ``size`` are by cell."""

    def __init__(self, vectors: DataFrame, n: int):
        spark = vectors.sparkSession
        hashed = F.pmod(F.xxhash64("entity_type", "canonical"), F.lit(1 << 30))
        share = int(min(1 / CELL, SEEDS / n) * (1 << 30))
        firsts = vectors.groupBy("entity_type").agg(F.min_by("embedding", F.struct(hashed, "canonical")).alias("embedding"))
        picked = vectors.where(hashed < share).select("entity_type", "embedding").unionByName(firsts).collect()  # about SEEDS at most, and one a type
        by = _by_type([(str(k), r["entity_type"], r["embedding"]) for k, r in enumerate(picked)])
        self.seeds = {t: (np.array([int(k) for k in ks]), x) for t, (ks, x) in by.items()}
        sent = spark.sparkContext.broadcast(self.seeds)

        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                types = np.array(batch.column("entity_type").to_pylist(), object)
                cell, angle = np.zeros(len(types), np.int64), np.zeros(len(types))
                for t in set(types.tolist()):
                    ids, x = sent.value[t]
                    own = np.flatnonzero(types == t)
                    at, of = _best(units(batch.column("embedding").take(pa.array(own)), x.shape[1]), x)
                    cell[own], angle[own] = ids[at], np.arccos(np.clip(of, -1, 1))
                yield batch.append_column("cell", pa.array(cell)).append_column("angle", pa.array(angle))

        self.rows = cut(vectors.mapInArrow(place, "canonical string, entity_type string, embedding array<double>, cell long, angle double"))
        told = self.rows.groupBy("cell").agg(F.max("angle").alias("radius"), F.count("*").alias("n")).collect()  # a row a seed
        self.radius = {r["cell"]: r["radius"] for r in told}
        self.size = {r["cell"]: r["n"] for r in told}

    def bounds(self, names: DataFrame, threshold: float) -> DataFrame:
        """``names`` with ``cells``, (bound, cell) of those that may hold a vector as near as ``threshold``, the most promising first."""
        sent = names.sparkSession.sparkContext.broadcast((self.seeds, self.radius))
        kind = pa.list_(pa.struct([("bound", pa.float64()), ("cell", pa.int64())]))

        def bound(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            seeds, radius = sent.value
            for batch in batches:
                types = np.array(batch.column("entity_type").to_pylist(), object)
                cells: list[list] = [[] for _ in types]
                for t in set(types.tolist()) & seeds.keys():
                    ids, x = seeds[t]
                    filled = np.array([i in radius for i in ids.tolist()])
                    ids, x = ids[filled], x[filled]
                    r = np.array([radius[i] for i in ids.tolist()])
                    own = np.flatnonzero(types == t)
                    v = units(batch.column("embedding").take(pa.array(own)), x.shape[1])
                    best = np.cos(np.maximum(0, np.arccos(np.clip(v @ x.T, -1, 1)) - r)) + SLACK
                    for i, row, zero in zip(own.tolist(), best, ~v.any(axis=1)):
                        at = np.flatnonzero(row >= threshold)
                        cells[i] = [] if zero else [{"bound": float(row[k]), "cell": int(ids[k])} for k in at[np.argsort(-row[at], kind="stable")].tolist()]
                yield batch.append_column("cells", pa.array(cells, kind))

        return names.mapInArrow(bound, "name string, entity_type string, embedding array<double>, cells array<struct<bound: double, cell: long>>")

    def search(self, asked: DataFrame, threshold: float) -> DataFrame:
        """name, entity_type, canonical, confidence of ``asked`` (name, entity_type, embedding, cell): the nearest in that cell.

        Names of a cell, and its vectors, are dealt to blocks, so that no task has more than ``PART`` of either."""
        spark = asked.sparkSession
        parts = spark.createDataFrame([(c, -(-n // PART)) for c, n in self.size.items()], "cell long, parts int")
        salts = cut(asked.groupBy("cell").agg(F.ceil(F.count("*") / PART).cast("int").alias("salts")))  # a row a seed
        each = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        own = lambda of, n: F.pmod(F.xxhash64(*of), F.col(n)).cast("int")
        left = asked.join(F.broadcast(parts), "cell").join(F.broadcast(salts), "cell").select("name", "entity_type", "embedding", "cell", own(["name", "entity_type"], "salts").alias("salt"), each("parts").alias("part"))
        right = self.rows.join(F.broadcast(parts), "cell").join(F.broadcast(salts), "cell").select("canonical", "embedding", "cell", own(["canonical"], "parts").alias("part"), each("salts").alias("salt"))

        def meet(x: pa.Table, y: pa.Table) -> pa.Table:
            y = y.sort_by("canonical")
            if not x.num_rows or not y.num_rows:
                return pa.table({"name": pa.array([], pa.string()), "entity_type": pa.array([], pa.string()), "canonical": pa.array([], pa.string()), "confidence": pa.array([], pa.float64())})
            vectors = units(y["embedding"])
            at, of = _best(units(x["embedding"], vectors.shape[1]), vectors)
            near = of >= threshold
            return pa.table({"name": x["name"].filter(pa.array(near)), "entity_type": x["entity_type"].filter(pa.array(near)), "canonical": y["canonical"].take(pa.array(at[near])), "confidence": of[near]})

        by = ["cell", "salt", "part"]
        found = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(meet, _FOUND)
        return _first(found)


def _first(found: DataFrame) -> DataFrame:
    best = F.min_by(F.struct("canonical", "confidence"), F.struct(-F.col("confidence"), "canonical"))
    return found.groupBy("name", "entity_type").agg(best.alias("b")).select("name", "entity_type", "b.canonical", "b.confidence")


def nearest(names: DataFrame, canonical: DataFrame, threshold: float, report: dict | None = None) -> DataFrame:
    """name, entity_type, canonical, confidence of ``names`` (name, entity_type, embedding): of the same type's rows of ``canonical`` that of the greatest cosine, if it reaches ``threshold``; the first name among equals.

    Vectors that are null, of no length or of another length than their type's have none. With a ``report``, a dictionary, it
    is told how many pairs there are and how many were compared."""
    doubles = F.col("embedding").cast("array<double>").alias("embedding")
    asked = names.where("embedding is not null and entity_type is not null").select("name", "entity_type", doubles)
    vectors = canonical.where("embedding is not null and entity_type is not null and name is not null").select(F.col("name").alias("canonical"), "entity_type", doubles)
    few = vectors.limit(SENT + 1).collect()
    if len(few) <= SENT:
        return _first(_against_all(asked, few, threshold))
    cells = Cells(vectors, vectors.count())
    bounded = cut(cells.bounds(asked, threshold))
    first = cut(cells.search(bounded.where(F.size("cells") > 0).select("name", "entity_type", "embedding", F.col("cells")[0]["cell"].alias("cell")), threshold))
    so_far = bounded.join(first.select("name", "entity_type", "confidence"), ["name", "entity_type"], "left")
    rest = F.filter(F.slice("cells", 2, F.greatest(F.size("cells"), F.lit(1))), lambda c: c["bound"] >= F.coalesce("confidence", F.lit(threshold)))
    more = cut(so_far.select("name", "entity_type", "embedding", F.explode(rest).alias("c")).select("name", "entity_type", "embedding", F.col("c.cell").alias("cell")))
    if report is not None:
        sizes = names.sparkSession.createDataFrame(list(cells.size.items()), "cell long, n long")
        visits = more.select("cell").unionByName(bounded.where(F.size("cells") > 0).select(F.col("cells")[0]["cell"].alias("cell")))
        types = vectors.groupBy("entity_type").agg(F.count("*").alias("n"))
        report["compared"] = visits.join(sizes, "cell").agg(F.sum("n")).first()[0] or 0
        report["pairs"] = asked.join(types, "entity_type").agg(F.sum("n")).first()[0] or 0
    return _first(first.unionByName(cells.search(more, threshold)))
