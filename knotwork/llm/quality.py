"""Quality by the votes of nearest labelled neighbours in a latent-semantic space (operator 1).

A text is a bag of hashed terms: its words, and the shape of each word (case, length, last byte, whether it repeats one of
the two words before). Frequencies enter by their square root times the inverse document frequency. A randomised singular
value decomposition of a bounded sample of labelled texts gives the latent space. The sample's vectors are broadcast, and
every text is compared with all of them, in blocks of exact cosine products; the nearest vote with their similarity."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm import text as tx
from knotwork.llm.labels import labelled_sample
from knotwork.llm.language import held_out

#: Expected labelled neighbours of each class.
NEIGHBOURS = {0: 1500, 1: 1500}
WORDS, SHAPES = 1024, 1024
TERMS = WORDS + SHAPES
RANK = 48
#: Neighbours that vote, and the power of the cosine that weighs a vote.
VOTERS, SHARPNESS = 25, 8
THRESHOLD = 0.3
#: Texts whose terms are counted at once.
ROWS = 256

_UPPER = np.zeros(256, bool)
_UPPER[65:91] = True


def terms(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Counts of hashed terms, a row for each text."""
    h, start, end, first = tx.words(data, offsets)
    n = len(offsets) - 1
    doc = np.repeat(np.arange(n), np.diff(first))
    back = [np.zeros(len(h), bool), np.zeros(len(h), bool)]
    for k in (1, 2):
        back[k - 1][k:] = (h[k:] == h[:-k]) & (doc[k:] == doc[:-k])
    upper = np.concatenate([[0], np.cumsum(_UPPER[data], dtype=np.int32)])
    if len(h):
        length = end - start
        capitals = upper[end] - upper[start]
        case = np.where(capitals == 0, 0, np.where(capitals * 2 > length, 2, 1))
        tail = data[end - 1].astype(np.int64)
        tail[((tail >= 97) & (tail <= 122)) | _UPPER[tail] | (tail >= 128)] = 97
        shape = (((tail * 3 + case) * 8 + np.minimum(length, 16) // 2) * 2 + back[0]) * 2 + back[1]
        shape = WORDS + (tx.mix(shape.astype(np.uint64)) % np.uint64(SHAPES)).astype(np.int64)
        word = (h % np.uint64(WORDS)).astype(np.int64)
        codes = np.concatenate([doc * TERMS + word, doc * TERMS + shape])
    else:
        codes = np.zeros(0, np.int64)
    return np.bincount(codes, minlength=n * TERMS).reshape(n, TERMS)


def weighted(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    """Square roots of the frequencies of words and of shapes, each apart, times the inverse document frequency."""
    x = counts.astype(np.float32)
    for part in (slice(0, WORDS), slice(WORDS, TERMS)):
        x[:, part] /= np.maximum(1, x[:, part].sum(axis=1, keepdims=True))
    return np.sqrt(x) * idf


def units(x: np.ndarray) -> np.ndarray:
    return x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def latent_space(x: np.ndarray, rank: int = RANK, seed: int = 7) -> np.ndarray:
    """The first right singular vectors of ``x`` as columns, by a randomised range finder with two power steps."""
    rank = min(rank, *x.shape)
    y = x @ np.random.default_rng(seed).standard_normal((x.shape[1], rank + 10)).astype(np.float32)
    for _ in range(2):
        y = x @ (x.T @ np.linalg.qr(y)[0])
    q = np.linalg.qr(y)[0]
    return np.linalg.svd(q.T @ x, full_matrices=False)[2][:rank].T.astype(np.float32)


def _pieces(column: pa.Array):
    for a, b, data, offsets in tx.groups(column):
        for i in range(a, b, ROWS):
            j = min(b, i + ROWS)
            lo, hi = offsets[i - a], offsets[j - a]
            yield i, j, terms(data[lo:hi], offsets[i - a : j - a + 1] - lo)


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0):
    """(idf, latent space, unit vectors of the neighbours, their labels, share of label 1), or None without both classes."""
    sample = labelled_sample(docs, labels, "quality", NEIGHBOURS, folds, fold)

    def count(batches):
        for batch in batches:
            for i, j, c in _pieces(batch.column("text")):
                yield pa.record_batch({"doc_id": batch.column("doc_id").slice(i, j - i), "y": batch.column("y").slice(i, j - i), "c": pa.array([r.tobytes() for r in c.astype(np.int32)], pa.binary())})

    got = sample.mapInArrow(count, f"doc_id {sample.schema['doc_id'].dataType.simpleString()}, y int, c binary").toArrow().sort_by("doc_id")
    y = got["y"].to_numpy().astype(np.float32)
    if not 0 < y.sum() < len(y):
        return None
    counts = np.stack([np.frombuffer(x, np.int32) for x in got["c"].to_pylist()])
    idf = np.log((1 + len(y)) / (1 + (counts > 0).sum(axis=0))).astype(np.float32) + 0.1
    x = weighted(counts, idf)
    space = latent_space(x)
    return idf, space, units(x @ space), y, float(y.mean())


def votes(vectors: np.ndarray, neighbours: np.ndarray, y: np.ndarray, prior: float) -> np.ndarray:
    """The share of the nearest neighbours' similarity that label 1 has. A text without terms has the prior."""
    cosine = vectors @ neighbours.T
    k = min(VOTERS, cosine.shape[1])
    near = np.argpartition(-cosine, k - 1, axis=1)[:, :k]
    w = np.maximum(np.take_along_axis(cosine, near, axis=1), 0).astype(np.float64) ** SHARPNESS
    return np.clip(((w * y[near]).sum(axis=1) + 1e-6 * prior) / (w.sum(axis=1) + 1e-6), 0, 1)


def score_quality(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``, repeated rows included.

    A null text is empty; an empty text has the sample's share of label 1. A very long text is read whole; what is held of
    it are the counts of ``TERMS`` terms. Of neighbours that are equally near any may vote. Without labels of both classes
    every score is 0.5. Columns of other names are not read. An empty table gives an empty table. Only the sample is
    shuffled."""
    model = fit(tx.in_small_batches(docs), labels, folds, fold)
    if model is None:
        score = F.lit(0.5)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(model)

        def run(column: pa.Array) -> pa.Array:
            idf, space, neighbours, y, prior = shared.value
            out = np.zeros(len(column))
            for i, j, c in _pieces(column):
                out[i:j] = votes(units(weighted(c, idf) @ space), neighbours, y, prior)
            return pa.array(out)

        score = F.arrow_udf(run, "double")("text")
    out = docs.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
