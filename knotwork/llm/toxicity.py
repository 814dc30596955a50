"""Toxicity by a factorization machine over hashed terms (operator 6).

A text is the set of its words, without final punctuation, and of their first four to eight bytes, which stand for stems, hashed to ``2**BITS`` numbers. The machine adds to
the weights of the terms present the inner products of the factors of every two of them, which tells an insult beside the
mention of a group from either alone. The pairs cost no more than the terms: ``sum_f (sum_i v_if)**2 - sum_i v_if**2``.

It is trained on a bounded sample of labelled texts by steps along adaptive gradients. A term has a weight and factors if
its presence in the sample tells something of the label (chi squared of at least ``CHI``), or if it is one of two words
whose presence together tells more of it than either does alone (by at least ``PAIR``), as in labels that only the pair
explains. Other terms would get weights by chance. Every whole text is then scored in sparse batches."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm import text as tx
from knotwork.llm.labels import labelled_sample
from knotwork.llm.language import held_out

#: Expected training texts of each class.
SAMPLE = {0: 4000, 1: 2000}
BITS = 20
CHI = 16.0
#: How much more two words must tell together, and of how many words, the most frequent of the sample in at least ``LEAST`` texts, all pairs are tried.
PAIR, PAIRED, LEAST = 60.0, 2048, 20
FACTORS = 4
EPOCHS, BATCH, RATE, DECAY = 30, 64, 0.2, 2e-4
PREFIXES = (4, 5, 6, 7, 8)
THRESHOLD = 0.5


def present(data: np.ndarray, offsets: np.ndarray, kept: np.ndarray | None = None, prefixes: tuple[int, ...] = PREFIXES) -> tuple[np.ndarray, np.ndarray]:
    """(text, term) numbers of the distinct terms of each text, by text. ``kept`` maps hashes to terms; those mapped to -1 are left out."""
    h, _, _, first = tx.words(data, offsets, prefixes=prefixes, core=True)
    h = np.atleast_2d(h)
    doc = np.tile(np.repeat(np.arange(len(offsets) - 1), np.diff(first)), len(h))
    term = (h.ravel() >> np.uint64(64 - BITS)).astype(np.int64)
    if kept is not None:
        term = kept[term]
        doc, term = doc[term >= 0], term[term >= 0]
    code = np.unique((doc << BITS) | term)
    return code >> BITS, code & ((1 << BITS) - 1)


class Machine:
    """bias, weights and factors over the kept terms; ``kept`` has the term of each hash or -1."""

    def __init__(self, kept: np.ndarray, n: int, prior: float, seed: int = 11):
        self.kept = kept
        self.bias = float(np.log(prior / (1 - prior)))
        self.w = np.zeros(n, np.float32)
        self.v = np.random.default_rng(seed).normal(0, 0.02, (n, FACTORS)).astype(np.float32)

    def margins(self, doc: np.ndarray, term: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The sums before the logistic function, and each text's sum of factors."""
        v = self.v[term]
        sums = np.stack([np.bincount(doc, v[:, f], n) for f in range(FACTORS)], axis=1)
        return self.bias + np.bincount(doc, self.w[term], n) + 0.5 * ((sums**2).sum(axis=1) - np.bincount(doc, (v**2).sum(axis=1), n)), sums

    def scores(self, doc: np.ndarray, term: np.ndarray, n: int) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(self.margins(doc, term, n)[0], -30, 30)))

    def train(self, first: np.ndarray, term: np.ndarray, y: np.ndarray, seed: int = 13) -> None:
        """Adaptive gradient steps; text i has the terms ``term[first[i]:first[i + 1]]``."""
        rng = np.random.default_rng(seed)
        gw, gv, gb = np.full(len(self.w), 1e-3), np.full(self.v.shape, 1e-3), 1e-3
        for _ in range(EPOCHS):
            order = rng.permutation(len(y))
            for i in range(0, len(order), BATCH):
                rows = order[i : i + BATCH]
                size = first[rows + 1] - first[rows]
                doc = np.repeat(np.arange(len(rows)), size)
                at = np.arange(size.sum()) + np.repeat(first[rows] - np.cumsum(size) + size, size)
                t = term[at]
                z, sums = self.margins(doc, t, len(rows))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[rows]) / len(rows)
                used, where = np.unique(t, return_inverse=True)
                e = error[doc]
                dw = np.bincount(where, e) + DECAY * self.w[used]
                v = self.v[used]
                pull = e[:, None] * (sums[doc] - self.v[t])
                dv = np.stack([np.bincount(where, pull[:, f]) for f in range(FACTORS)], axis=1) + DECAY * v
                gw[used] += dw**2
                gv[used] += dv**2
                self.w[used] -= (RATE * dw / np.sqrt(gw[used])).astype(np.float32)
                self.v[used] -= (0.1 * RATE * dv / np.sqrt(gv[used])).astype(np.float32)
                gb += error.sum() ** 2
                self.bias -= RATE * error.sum() / np.sqrt(gb)


def chi_squared(label: np.ndarray, term: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The statistic of presence against label for each hashed term, from (label, term) pairs and the labels of all texts; half a text is added to each cell."""
    return _statistic(np.bincount(term, minlength=1 << BITS) + 1.0, np.bincount(term, label, 1 << BITS) + 0.5, y)


def _statistic(n: np.ndarray, a: np.ndarray, y: np.ndarray) -> np.ndarray:
    p, m = (y.sum() + 1) / (len(y) + 2), len(y) + 2.0
    return (a - n * p) ** 2 / (n * p * (1 - p)) * m / np.maximum(m - n, 1)


def telling_pairs(doc: np.ndarray, word: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The words, of (text, word) pairs, that with another word tell more of the label than either alone."""
    df = np.bincount(word, minlength=1 << BITS)
    words = np.argsort(-df, kind="stable")[:PAIRED]
    words = words[df[words] >= LEAST]
    column = np.full(1 << BITS, -1)
    column[words] = np.arange(len(words))
    own = column[word] >= 0
    x = np.zeros((len(y), len(words)), np.float32)
    x[doc[own], column[word[own]]] = 1
    alone = _statistic(x.sum(axis=0) + 1.0, y @ x + 0.5, y)
    found = np.zeros(len(words), bool)
    for i in range(0, len(words), 256):  # a block of pairs at a time
        part = x[:, i : i + 256]
        n, a = part.T @ x, (part * y[:, None].astype(np.float32)).T @ x
        more = _statistic(n + 1.0, a + 0.5, y) - np.maximum(alone[i : i + 256, None], alone) >= PAIR
        more &= np.arange(i, i + part.shape[1])[:, None] != np.arange(len(words))
        found |= more.any(axis=0)
        found[i : i + 256] |= more.any(axis=1)
    return words[found]


def _lists(column: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(offsets, values) of a column of lists."""
    lists = column.combine_chunks()
    lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
    return lists.offsets.to_numpy().astype(np.int64), lists.values.to_numpy()


def fit(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> Machine | None:
    """The machine of a sample, or None without both classes."""
    sample = labelled_sample(docs, labels, "toxic", SAMPLE, folds, fold)

    def read(batches):
        for batch in batches:
            for a, b, data, offsets in tx.groups(batch.column("text")):
                both = {}
                for name, prefixes in (("terms", PREFIXES), ("words", ())):
                    doc, term = present(data, offsets, prefixes=prefixes)
                    both[name] = pa.ListArray.from_arrays(pa.array(np.searchsorted(doc, np.arange(b - a + 1)), pa.int32()), pa.array(term, pa.int32()))
                yield pa.record_batch({"y": batch.column("y").slice(a, b - a), "order": batch.column("order").slice(a, b - a), **both})

    keyed = sample.select("text", "y", F.xxhash64("doc_id").alias("order"))
    got = keyed.mapInArrow(read, "y int, order long, terms array<int>, words array<int>").toArrow().sort_by("order")
    y = got["y"].to_numpy().astype(float)
    if not 0 < y.sum() < len(y):
        return None
    first, term = _lists(got["terms"])
    frequent = chi_squared(np.repeat(y, np.diff(first)), term, y) >= CHI
    at, word = _lists(got["words"])
    frequent[telling_pairs(np.repeat(np.arange(len(y)), np.diff(at)), word, y)] = True
    kept = np.full(1 << BITS, -1, np.int32)
    kept[frequent] = np.arange(frequent.sum())
    there = kept[term] >= 0
    machine = Machine(kept, int(frequent.sum()), float(y.mean()))
    machine.train(np.concatenate([[0], np.cumsum(there)])[first], kept[term][there], y)
    return machine


def score_toxicity(docs: DataFrame, labels: DataFrame, folds: int = 5, fold: int = 0) -> DataFrame:
    """doc_id, held_out, score, predicted for each row of ``docs``, repeated rows included.

    A null text is empty and scores as one without terms. A very long text is read whole, as the set of its terms. Equal
    texts have equal scores. Without labels of both classes every score is 0. Columns of other names are not read. An empty
    table gives an empty table. Only the sample is shuffled."""
    machine = fit(tx.in_small_batches(docs), labels, folds, fold)
    if machine is None:
        score = F.lit(0.0)
    else:
        shared = docs.sparkSession.sparkContext.broadcast(machine)

        def run(column: pa.Array) -> pa.Array:
            out = np.zeros(len(column))
            for a, b, data, offsets in tx.groups(column):
                out[a:b] = shared.value.scores(*present(data, offsets, shared.value.kept), b - a)
            return pa.array(out)

        score = F.arrow_udf(run, "double")("text")
    out = docs.select("doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), score.alias("score"))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))
