"""Vectors as short codes of the nearest codebook entries (operator 13), exact in integers.

A component x is the integer ``floor(1024 * x)``. Vectors are cut into equal parts; a part's codebook begins as that part of
the smallest ids and is moved to the means of its parts, rounded down, in some rounds.

Nearest entries are screened by a product of float32 matrices. With u = 2**-24, a product of w components, rounded when it
is read and summed in any order, is off by at most ``((w + 3) * u / (1 - (w + 3) * u)) * |x| * |c|``; that gives each entry an
interval for its distance. Every entry whose interval reaches below the least upper end is computed again in int64, and the
first of the least wins. So the result is that of integers alone, whatever the machine's order of summing.

Each round reads the vectors once. A task adds up its parts by entry, Spark adds up the tasks, and the driver gets sums of
the codebooks' own size (parts x entries x components), whatever the table's.

Rows whose vector is null or holds a null or non-finite component are dropped. Vectors of another length than that of the
smallest kept id have no parts to compare: they stay, with null code and error. Repeated rows count as often as they occur;
equal ids are ordered by their components, null ids come last. Labels and ids may be of any type; null labels are one
label. Columns of any name may stand beside vec_id, embedding and label. An empty table stays empty. A length that cannot be
cut, and components so large that 64 bits do not hold a distance, raise ValueError."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.operators.normalization import SMALL
from knotwork.plans.lineage import cut

SCALE = 1024
PARTS, ENTRIES, ROUNDS = 4, 256, 4
#: Rows of a product, and entries that are computed again at once.
ROWS, EXACT = 4096, 1 << 17
#: Parts that rows of one label are dealt to where the labels are too many to be sent to every task.
SALTS = 64


def integers(column: pa.Array, length: int | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(rows that are kept, those of them that have ``length`` components, their components as a matrix of integers).

    Without a length none has it."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    sizes = pc.list_value_length(column).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    values = column.flatten()
    numbers = values.cast(pa.float64()).fill_null(math.nan).to_numpy(zero_copy_only=False)
    there = np.flatnonzero(sizes >= 0)
    of = np.repeat(there, sizes[there])
    bad = np.zeros(len(sizes), bool)
    bad[of[~np.isfinite(numbers)]] = True
    kept = there[~bad[there]]
    if length is None:
        return kept, kept[:0], np.zeros((0, 0), np.int64)
    fits = kept[sizes[kept] == length]
    chosen = np.zeros(len(sizes), bool)
    chosen[fits] = True
    scaled = np.floor(numbers[chosen[of]] * SCALE)
    if len(scaled) and np.abs(scaled).max() >= most_component(length):
        raise ValueError(f"a component of over {most_component(length) // SCALE}: its distances do not fit 64 bits")
    return kept, fits, scaled.astype(np.int64).reshape(len(fits), length)


def most_component(width: int) -> int:
    """Components below this in size have squared distances below 2**63 in ``width`` dimensions."""
    return math.isqrt((1 << 63) // max(1, width)) // 2


def nearest(x: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest row of ``book`` for each row of ``x``, the first of equals."""
    index, distance = np.zeros(len(x), np.int64), np.zeros(len(x), np.int64)
    for a in range(0, len(x), ROWS):
        index[a : a + ROWS] = _screened(x[a : a + ROWS], book)
    for a in range(0, len(x), ROWS):
        distance[a : a + ROWS] = ((x[a : a + ROWS] - book[index[a : a + ROWS]]) ** 2).sum(axis=1)
    return index, distance


def _screened(x: np.ndarray, book: np.ndarray) -> np.ndarray:
    width = x.shape[1]
    unit = (width + 3) * 2.0**-24
    norm = lambda m: np.sqrt((m.astype(float) ** 2).sum(axis=1)) * (1 + 1e-9)
    product = (x.astype(np.float32) @ book.astype(np.float32).T).astype(float)
    squares = (book**2).sum(axis=1).astype(float)
    score = squares - 2 * product
    off = 2 * (unit / (1 - unit)) * norm(x)[:, None] * norm(book) + 2.0**-50 * (squares + 2 * np.abs(product))
    open_ = score - off <= (score + off).min(axis=1, keepdims=True)
    out, many = open_.argmax(axis=1), np.flatnonzero(open_.sum(axis=1) > 1)
    step = max(1, EXACT // max(1, len(book)))
    for a in range(0, len(many), step):
        rows, entries = np.nonzero(open_[many[a : a + step]])
        d = ((x[many[a + rows]] - book[entries]) ** 2).sum(axis=1)
        begins = np.flatnonzero(np.diff(rows, prepend=-1))
        least = np.repeat(np.minimum.reduceat(d, begins), np.diff(np.append(begins, len(rows))))
        at = np.flatnonzero(d == least)
        first = at[np.append(True, rows[at][1:] != rows[at][:-1])]
        out[many[a : a + step]] = entries[first]
    return out


def first_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES) -> list[np.ndarray]:
    """The parts of the smallest kept ids of ``vectors`` (vec_id, embedding), ascending; none without a kept vector."""

    def smallest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, _, _ = integers(batch.column("embedding"))
            yield batch.take(pa.array(kept))

    kept = vectors.select("vec_id", "embedding").mapInArrow(smallest, vectors.select("vec_id", "embedding").schema)
    ordered = kept.orderBy(F.col("vec_id").asc_nulls_last(), "embedding")
    rows = [r["embedding"] for r in ordered.limit(entries).collect()]
    if not rows:
        return []
    length = len(rows[0])
    if length % parts:
        raise ValueError(f"vectors of {length} components cannot be cut in {parts} equal parts")
    if any(len(r) != length for r in rows):
        rows = [r["embedding"] for r in ordered.where(F.size("embedding") == length).limit(entries).collect()]
    x = integers(pa.array(rows, pa.list_(pa.float64())), length)[2]
    return np.split(x, parts, axis=1)


def moved_books(vectors: DataFrame, books: list[np.ndarray]) -> list[np.ndarray]:
    """``books`` with every entry that is some part's nearest at the mean of these parts, rounded down."""
    parts, (entries, width) = len(books), books[0].shape

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((parts, entries, width + 1), np.int64)  # the last of a row is its count
        for batch in batches:
            x = integers(batch.column("embedding"), parts * width)[2]
            for p, part in enumerate(np.split(x, parts, axis=1)):
                index, _ = nearest(part, books[p])
                order = np.argsort(index, kind="stable")
                used, begins = np.unique(index[order], return_index=True)
                if len(used):
                    total[p, used, :width] += np.add.reduceat(part[order], begins, axis=0)
                    total[p, used, width] += np.diff(np.append(begins, len(order)))
        cells = np.flatnonzero(np.repeat((total[:, :, width] > 0).ravel(), width + 1))
        yield pa.record_batch({"cell": pa.array(cells), "total": pa.array(total.ravel()[cells])})

    sums = vectors.select("embedding").mapInArrow(add, "cell long, total long").groupBy("cell").agg(F.sum("total").alias("total")).toArrow()
    total = np.zeros(parts * entries * (width + 1), np.int64)
    total[sums["cell"].to_numpy()] = sums["total"].to_numpy()
    total = total.reshape(parts, entries, width + 1)
    return [np.where(t[:, width:] > 0, t[:, :width] // np.maximum(t[:, width:], 1), book) for t, book in zip(total, books)]


def trained_books(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> list[np.ndarray]:
    """A codebook for each part, after ``rounds`` rounds."""
    books = first_books(vectors, parts, entries)
    for _ in range(rounds if books else 0):
        books = moved_books(vectors, books)
    return books


def books_digest(books: list[np.ndarray]) -> str:
    """sha256 of all components as decimals, by part, entry and place, joined by commas."""
    return hashlib.sha256(",".join(str(v) for book in books for v in book.ravel().tolist()).encode()).hexdigest()


def encoded(vectors: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """vec_id, label, code, error of kept rows: two hex digits for each part, and the sum of squared distances."""
    parts = len(books)
    length = parts * books[0].shape[1] if books else None
    digits = max(2, math.ceil(math.log(max(2, len(books[0])), 16))) if books else 2

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, fits, x = integers(batch.column("embedding"), length)
            code, error = np.full(batch.num_rows, None, object), np.zeros(batch.num_rows, np.int64)
            if len(fits):
                found = [nearest(part, books[p]) for p, part in enumerate(np.split(x, parts, axis=1))]
                text = [f"{e:0{digits}x}" for e in range(max(map(len, books)))]
                code[fits] = ["".join(text[e] for e in row) for row in np.stack([i for i, _ in found], 1).tolist()]
                error[fits] = sum(d for _, d in found)
            known = np.zeros(batch.num_rows, bool)
            known[fits] = True
            take = pa.array(kept)
            yield pa.record_batch({"vec_id": batch.column("vec_id").take(take), "label": batch.column("label").take(take), "code": pa.array(code[kept].tolist(), pa.string()), "error": pa.array(error[kept], mask=~known[kept])})

    ids = vectors.select("vec_id", "label")
    return vectors.select("vec_id", "label", "embedding").mapInArrow(encode, f"vec_id {ids.schema[0].dataType.simpleString()}, label {ids.schema[1].dataType.simpleString()}, code string, error long")


def with_label_error(rows: DataFrame, most: int = SMALL) -> DataFrame:
    """``rows`` with ``label_error``, the sum of ``error`` over rows of an equal label.

    Sums are added up before they are shuffled. They go to every task where they are at most ``most`` rows; else each is sent
    to ``SALTS`` parts of its label's rows."""
    sums = rows.groupBy("label").agg(F.sum("error").alias("label_error")).withColumnRenamed("label", "__label")
    same = F.col("label").eqNullSafe(F.col("__label"))
    if sums.limit(most + 1).count() <= most:
        met = rows.join(F.broadcast(sums), same)
    else:
        dealt = sums.select("*", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("__salt"))
        met = rows.withColumn("__own", F.pmod(F.xxhash64("vec_id", "code"), F.lit(SALTS)).cast("int")).join(dealt, same & (F.col("__own") == F.col("__salt")))
    return met.select(*(rows[c] for c in rows.columns), "label_error")


def compress(vectors: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, label, code, error, label_error, codebooks_sha256 of the kept rows of ``vectors`` (vec_id, label, embedding)."""
    books = trained_books(vectors, parts, entries, rounds)
    rows = cut(encoded(vectors, books))
    return with_label_error(rows).withColumn("codebooks_sha256", F.lit(books_digest(books)))
