"""A hashed maximum-entropy language model (operator 4).

Tokens are lower-cased words and an end for each text. A token has a class: a frequent word one of the groups of words by
frequency, the end its own, and any other word the class of its shape (length and last byte). The model is factored,
``P(class | history) * P(word | class, history)``, and two more classes repeat the last word and the one before it; what
they have of a word is added to what its own class has, so that the probabilities of all words and the end sum to 1. Both
factors are log-linear in hashed features of the last word (n-gram), the one before it (skip) and both. A word of a shape
has the add-one share of its corpus count in the shape, in which all words never seen are one.

How many words are told apart, as outcomes and in histories, and so the classes and the statistics, grows with the
training tokens (``Sizes``). Training covers every token of the training texts through its sufficient statistics, the
counts of histories with what follows, which Spark sums. The weights move in rounds: each broadcasts them, tasks sum the
gradient and its diagonal curvature over their histories, and the driver adds those of all tasks, hashed to ``2**BITS``
rows, and makes the step.

Scoring is by batches, of which only the histories that occur get a row of probabilities; a worker keeps some rows for the
next batch. It needs the corpus count of each word of each text. The most frequent words, at most ``HEAD`` of them, go to
every task; the words beyond meet their counts in a shuffled join, so that the vocabulary may grow as it likes. A token is
known by a 64-bit hash whose lowest bits hold its shape."""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from knotwork.llm import text as tx
from knotwork.llm.language import held_out
from knotwork.plans.lineage import cut

#: Most words whose counts are broadcast.
HEAD = 1 << 18
SHAPES = 16
#: Bytes of text scored at once.
PIECE = 1 << 19
#: Rows of the hashed features.
BITS = 13
ROUNDS, DECAY = 8, 4.0
#: Statistics that a task takes in a round, histories it computes at once, and rows of probabilities that a worker keeps.
STATISTICS, STEP, KEPT = 1_000_000, 4096, 60_000
#: Histories that the word before the last tells apart for words of a group; others are one.
COARSE = 64
#: The end's hash; its lowest bits are not a word's.
END_TOKEN = np.int64(-SHAPES)


@dataclass(frozen=True)
class Sizes:
    """Groups of as many words, and the histories: 0 begins a text, then come the shapes, then frequent words."""

    groups: int
    histories: int

    @classmethod
    def of(cls, tokens: int) -> "Sizes":
        """The words told apart grow with the square root of the tokens, up to what is broadcast."""
        k = min((HEAD.bit_length() - 1) // 2, max(3, int(math.log2(max(2, tokens)) / 4)))
        return cls(1 << k, 1 << (k + 2))

    @property
    def members(self) -> int:
        return self.groups

    @property
    def words(self) -> int:
        return self.groups * self.members

    @property
    def end(self) -> int:
        return self.groups + SHAPES

    @property
    def repeated(self) -> int:
        return self.end + 1

    @property
    def skipped(self) -> int:
        return self.end + 2

    @property
    def classes(self) -> int:
        return self.end + 3

    @property
    def pairs(self) -> int:
        return self.histories * self.histories

    def word_context(self, two: np.ndarray, one: np.ndarray) -> np.ndarray:
        """The history that words of a group are told by."""
        return np.where(two < min(COARSE, self.histories), two, COARSE) * self.histories + one


def tokens(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(64-bit words whose lowest four bits are the shape, the index of each text's first)."""
    h, start, end, first = tx.words(data, offsets)
    if not len(h):
        return h.view(np.int64), first
    last = data[end - 1]
    tail = np.select([last == 46, last == 44, tx.LETTER[last]], [1, 2, 0], 3)
    shape = np.minimum((end - start - 1) // 3, 3) * 4 + tail
    return ((h & ~np.uint64(SHAPES - 1)) | shape.astype(np.uint64)).view(np.int64), first


def _count(batches):
    kept, size, ends = [], 0, 0

    def fold(parts):
        values, inverse = np.unique(np.concatenate([p[0] for p in parts]), return_inverse=True)
        return values, np.bincount(inverse, np.concatenate([p[1] for p in parts]), len(values)).astype(np.int64)

    for batch in batches:
        for a, b, data, offsets in tx.groups(batch.column("text")):
            h, _ = tokens(data, offsets)
            values, n = np.unique(h, return_counts=True)
            kept.append((values, n))
            size += len(values)
            ends += b - a
            if size > 4_000_000:
                kept = [fold(kept)]
                size = len(kept[0][0])
                if size > 2_000_000:
                    yield from _batches(*kept[0])
                    kept, size = [], 0
    if ends:
        kept.append((np.array([END_TOKEN]), np.array([ends])))
        yield from _batches(*fold(kept))


def _batches(values: np.ndarray, n: np.ndarray, step: int = 200_000):
    for i in range(0, len(values), step):
        yield pa.record_batch({"h": pa.array(values[i : i + step]), "n": pa.array(n[i : i + step].astype(np.int64))})


def token_counts(docs: DataFrame) -> DataFrame:
    """(h, n): how often the texts hold each token, ends included."""
    return docs.select("text").mapInArrow(_count, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


class Vocabulary:
    """Groups and histories of the most frequent words."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, sizes: Sizes):
        self.sizes = sizes
        words = head != END_TOKEN
        best = np.lexsort((head[words], -counts[words]))[: sizes.words]
        self.words = head[words][best]
        order = np.argsort(self.words)
        self.keys, self.rank = self.words[order], order

    def ranks(self, h: np.ndarray) -> np.ndarray:
        """The rank of each token among the frequent words, or -1."""
        if not len(self.keys):
            return np.full(len(h), -1)
        at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
        return np.where(self.keys[at] == h, self.rank[at], -1)

    def read(self, h: np.ndarray, first: np.ndarray):
        """(own class, rank, last history, history before it, equals the last word, equals the one before) of each token, and the two histories of each text's end."""
        n, sizes = len(h), self.sizes
        rank = self.ranks(h)
        shape = (h & (SHAPES - 1)).astype(np.int64)
        history = np.where((rank >= 0) & (rank < sizes.histories - SHAPES - 1), rank + SHAPES + 1, shape + 1)
        padded = np.zeros(n + 2, np.int64)
        padded[2:] = history
        place = np.arange(n) - np.repeat(first[:-1], np.diff(first))
        one = np.where(place >= 1, padded[1 : n + 1], 0)
        two = np.where(place >= 2, padded[:n], 0)
        kind = np.where(rank >= 0, rank // sizes.members, sizes.groups + shape)
        last, before = np.zeros(n, bool), np.zeros(n, bool)
        last[1:] = (h[1:] == h[:-1]) & (place[1:] >= 1)
        before[2:] = (h[2:] == h[:-2]) & (place[2:] >= 2)
        size = np.diff(first)
        end_one = np.where(size >= 1, padded[first[1:] + 1], 0)
        end_two = np.where(size >= 2, padded[first[1:]], 0)
        return kind, rank, one, two, last, before, end_one, end_two


def statistics(docs: DataFrame, vocabulary: Vocabulary) -> DataFrame:
    """(t, context, outcome, n): how often each class follows each two histories (t 0), and each member of a group its histories with the group (t 1)."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)
    sizes = vocabulary.sizes
    wide = max(sizes.classes, sizes.members)

    def fold(kept):
        code, inverse = np.unique(np.concatenate([c for c, _ in kept]), return_inverse=True)
        return code, np.bincount(inverse, np.concatenate([n for _, n in kept]), len(code)).astype(np.int64)

    def read(batches):
        kept, size = [], 0
        for batch in batches:
            for _, _, data, offsets in tx.groups(batch.column("text")):
                h, first = tokens(data, offsets)
                kind, rank, one, two, last, before, end_one, end_two = shared.value.read(h, first)
                outcome = np.where(last, sizes.repeated, np.where(before, sizes.skipped, kind))
                own = outcome < sizes.groups
                context = sizes.word_context(two[own], one[own]) * sizes.groups + kind[own]
                code = [(two * sizes.histories + one) * wide + outcome, (end_two * sizes.histories + end_one) * wide + sizes.end, sizes.pairs * wide + context * wide + rank[own] % sizes.members]
                code, n = np.unique(np.concatenate(code), return_counts=True)
                kept.append((code, n))
                size += len(code)
                if size > 3_000_000:
                    kept = [fold(kept)]
                    size = len(kept[0][0])
                    if size > 1_500_000:
                        yield from _batches(*kept[0])
                        kept, size = [], 0
        if kept:
            yield from _batches(*fold(kept))

    summed = docs.select("text").mapInArrow(read, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))
    context = F.floor(F.col("h") / wide)
    word = context >= sizes.pairs
    return summed.select(word.cast("int").alias("t"), F.when(word, context - sizes.pairs).otherwise(context).alias("context"), (F.col("h") % wide).alias("outcome"), "n")


def _row(template: int, value: np.ndarray) -> np.ndarray:
    """The row of weights of a feature."""
    return (tx.mix(value.astype(np.uint64) + np.uint64(template << 56)) >> np.uint64(64 - BITS)).astype(np.int64)


class Weights:
    """Log-linear weights; features of the classes and of the words in groups have rows of two tables."""

    def __init__(self, sizes: Sizes, class_counts: np.ndarray, word_counts: np.ndarray):
        self.sizes = sizes
        self.bias = np.log(class_counts + 0.5), np.log(word_counts + 0.5).reshape(sizes.groups, sizes.members)
        self.tables = np.zeros((1 << BITS, sizes.classes), np.float32), np.zeros((1 << BITS, sizes.members), np.float32)

    def rows(self, t: int, context: np.ndarray) -> list[np.ndarray]:
        """The rows of the n-gram, the skip and the joint feature of contexts."""
        group, history = (context % self.sizes.groups, context // self.sizes.groups) if t else (0 * context, context)
        one, two = history % self.sizes.histories, history // self.sizes.histories
        return [_row(4 * t + k, x * self.sizes.groups + group) for k, x in enumerate((one, two, history), 1)]

    def logs(self, t: int, context: np.ndarray) -> np.ndarray:
        """Log probabilities of the classes after contexts (t 0), or of the members of contexts' groups (t 1)."""
        z = sum(self.tables[t][r].astype(float) for r in self.rows(t, context))
        if t:
            z += self.bias[1][context % self.sizes.groups]
        else:
            z += self.bias[0]
            # nothing can be repeated before there is a word
            z[context % self.sizes.histories == 0, self.sizes.repeated] = -np.inf
            z[context // self.sizes.histories == 0, self.sizes.skipped] = -np.inf
        z -= z.max(axis=1, keepdims=True)
        return z - np.log(np.exp(z).sum(axis=1, keepdims=True))

    def gradient(self, t: int, context: np.ndarray, outcome: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(rows, sums of the gradient and of its curvature side by side) over statistics sorted by context."""
        width = self.tables[t].shape[1]
        sums = np.zeros((1 << BITS, 2 * width), np.float32)
        starts = np.flatnonzero(np.diff(context, prepend=-1))
        for i in range(0, len(starts), STEP):
            lo, hi = starts[i], starts[i + STEP] if i + STEP < len(starts) else len(context)
            own, inverse = np.unique(context[lo:hi], return_inverse=True)
            p = np.exp(self.logs(t, own))
            both = np.zeros((len(own), 2 * width))
            np.add.at(both, (inverse, outcome[lo:hi]), n[lo:hi])
            total = both[:, :width].sum(axis=1, keepdims=True)
            both[:, :width] -= total * p
            both[:, width:] = total * p * (1 - p)
            for rows in self.rows(t, own):
                order = np.argsort(rows, kind="stable")
                first = np.flatnonzero(np.diff(rows[order], prepend=-1))
                sums[rows[order][first]] += np.add.reduceat(both[order], first, axis=0)
        used = np.flatnonzero(np.any(sums, axis=1))
        return used, sums[used]


def summed(parts: DataFrame) -> DataFrame:
    """t, row, g of ``parts`` (t, row, part, g): one row for each t and row, the sum of its float32 arrays in the order of ``part``.

    Rows are dealt by (t, row) and pass through in order, so a task holds one sum at a time, and the sum is the same however
    the parts came."""

    def add(batches):
        at, total = None, None
        for batch in batches:
            keys = list(zip(batch.column("t").to_pylist(), batch.column("row").to_pylist()))
            done = []
            for key, g in zip(keys, batch.column("g")):
                x = np.frombuffer(g.as_buffer(), np.float32)
                if key == at:
                    total = total + x
                    continue
                if at is not None:
                    done.append((*at, total.tobytes()))
                at, total = key, x.copy()
            yield _records(done)
        if at is not None:
            yield _records([(*at, total.tobytes())])

    dealt = parts.repartition("t", "row").sortWithinPartitions("t", "row", "part")
    return dealt.select("t", "row", "g").mapInArrow(add, "t long, row long, g binary")


def _records(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    t, row, g = zip(*rows) if rows else ((), (), ())
    return pa.record_batch({"t": pa.array(t, pa.int64()), "row": pa.array(row, pa.int64()), "g": pa.array(g, pa.binary())})


def train(stats: DataFrame, sizes: Sizes, rounds: int = ROUNDS) -> Weights:
    """The weights after ``rounds`` steps over statistics, which are dealt by context."""
    spark = stats.sparkSession
    stats = cut(stats)
    totals = stats.groupBy("t", F.when(F.col("t") == 1, F.col("context") % sizes.groups * sizes.members + F.col("outcome")).otherwise(F.col("outcome")).alias("k")).agg(F.sum("n").alias("n"), F.count("*").alias("rows")).toArrow()  # classes and words
    t, k, n = (totals[c].to_numpy() for c in ("t", "k", "n"))
    start = np.zeros(sizes.classes), np.zeros(sizes.words)
    for table in (0, 1):
        start[table][k[t == table]] = n[t == table]
    weights = Weights(sizes, *start)
    stats = cut(stats.repartition(max(2, -(-int(totals["rows"].to_numpy().sum()) // STATISTICS)), "t", "context").sortWithinPartitions("t", "context"))
    for _ in range(rounds):
        shared = spark.sparkContext.broadcast(weights)

        def gradient(batches, shared=shared):
            columns = [[batch.column(c).to_numpy() for c in ("t", "context", "outcome", "n")] for batch in batches]
            if columns:
                t, context, outcome, n = map(np.concatenate, zip(*columns))
                for table in (0, 1):
                    own = t == table
                    rows, sums = shared.value.gradient(table, context[own], outcome[own], n[own])
                    part = np.full(len(rows), TaskContext.get().partitionId())
                    yield pa.record_batch({"t": pa.array(np.full(len(rows), table)), "row": pa.array(rows), "part": pa.array(part), "g": pa.array([x.tobytes() for x in sums], pa.binary())})

        got = summed(tx.in_small_batches(stats).mapInArrow(gradient, "t long, row long, part long, g binary")).toArrow().sort_by([("t", "ascending"), ("row", "ascending")])  # 2**BITS rows of each table at most, whatever the tasks
        for t, table in enumerate(weights.tables):
            own = got.filter(pc.equal(got["t"], t))
            if own.num_rows:
                width = table.shape[1]
                sums = np.zeros((1 << BITS, 2 * width), np.float32)
                rows = own["row"].to_numpy()
                for i in range(0, len(rows), STEP):
                    np.add.at(sums, rows[i : i + STEP], np.stack([np.frombuffer(x, np.float32) for x in own["g"].slice(i, STEP).to_pylist()]))
                slope, curve = sums[:, :width] - DECAY * table, sums[:, width:] + DECAY
                # the three features of a history share the step
                table += np.clip(slope / curve, -2, 2) / 3
        shared.unpersist()
    return weights


class Rows:
    """Log10 probabilities by context, computed where they are asked for; up to ``KEPT`` are kept."""

    def __init__(self, weights: Weights, t: int):
        self.weights, self.t = weights, t
        self.keys, self.rows = np.zeros(0, np.int64), np.zeros((0, weights.tables[t].shape[1]), np.float32)

    def at(self, context: np.ndarray) -> np.ndarray:
        """The index in ``rows`` of each context's row, as they are now."""
        asked, inverse = np.unique(context, return_inverse=True)
        new = asked[~np.isin(asked, self.keys, assume_unique=True)]
        if len(new):
            if len(self.keys) + len(new) > KEPT:
                self.keys, self.rows, new = self.keys[:0], self.rows[:0], asked
            made = [(self.weights.logs(self.t, new[i : i + STEP]) / np.log(10)).astype(np.float32) for i in range(0, len(new), STEP)]
            keys = np.concatenate([self.keys, new])
            order = np.argsort(keys)
            self.keys, self.rows = keys[order], np.concatenate([self.rows, *made])[order]
        return np.searchsorted(self.keys, asked)[inverse]


class Scorer:
    def __init__(self, vocabulary: Vocabulary, weights: Weights, head: np.ndarray, counts: np.ndarray, shape_logs: np.ndarray):
        self.vocabulary = vocabulary
        self.classes, self.members = Rows(weights, 0), Rows(weights, 1)
        self.head, self.logs = head, np.log10(counts + 1.0)
        self.shape_logs = shape_logs
        self.end = np.log10(counts[head == END_TOKEN] + 1.0).sum()
        self.known_end = int((head == END_TOKEN).any())

    def score(self, data: np.ndarray, offsets: np.ndarray):
        """By text: tokens, known, sum of log10(c + 1) and model score as far as frequent words tell; and of the others, whose count c is not here, (text, token, times, times as a shape's word only) and, for those that may also repeat, (text, token, probability to repeat, probability of the shape over its words)."""
        h, first = tokens(data, offsets)
        n, sizes = len(offsets) - 1, self.vocabulary.sizes
        kind, rank, one, two, last, before, end_one, end_two = self.vocabulary.read(h, first)
        doc = np.repeat(np.arange(n), np.diff(first))
        at = np.minimum(np.searchsorted(self.head, h), max(0, len(self.head) - 1))
        found = self.head[at] == h if len(self.head) else np.zeros(len(h), bool)
        log = np.where(found, self.logs[at], 0) if len(self.head) else np.zeros(len(h))
        row = self.classes.at(np.concatenate([two * sizes.histories + one, end_two * sizes.histories + end_one]))
        model = self.classes.rows[row[: len(h)], kind].astype(float)
        again = np.where(last, 10.0 ** self.classes.rows[row[: len(h)], sizes.repeated], 0) + np.where(before, 10.0 ** self.classes.rows[row[: len(h)], sizes.skipped], 0)
        end = self.classes.rows[row[len(h) :], sizes.end]
        own = kind < sizes.groups
        context = sizes.word_context(two[own], one[own]) * sizes.groups + kind[own]
        for i in range(0, len(context), KEPT):  # no more contexts at once than rows are kept
            j = np.flatnonzero(own)[i : i + KEPT]
            row = self.members.at(context[i : i + KEPT])
            model[j] += self.members.rows[row, rank[j] % sizes.members]
        shaped = ~own
        model[shaped] += log[shaped] - self.shape_logs[kind[shaped] - sizes.groups]
        repeats = again > 0
        told = repeats & (own | found)
        model[told] = np.log10(10.0 ** model[told] + again[told])
        apart = repeats & ~told
        rest = doc[apart], h[apart], again[apart], 10.0 ** model[apart]
        model[apart] = 0
        size = np.diff(first) + 1
        base = np.bincount(doc, log, n) + self.end
        score = np.bincount(doc, model, n) + end
        rare = np.flatnonzero(~found)
        order = np.lexsort((h[rare], doc[rare]))
        d, t, s = doc[rare][order], h[rare][order], (shaped & ~apart)[rare][order]
        new = np.flatnonzero((np.diff(d, prepend=-1) != 0) | (np.diff(t, prepend=0) != 0)) if len(d) else np.zeros(0, np.int64)
        if len(d) and (not len(new) or new[0] != 0):
            new = np.concatenate([[0], new])
        times = np.diff(np.append(new, len(d)))
        as_shape = np.add.reduceat(s.astype(np.int64), new) if len(new) else np.zeros(0, np.int64)
        return size, np.bincount(doc, found, n).astype(np.int64) + self.known_end, base, score, (d[new], t[new], times, as_shape), rest


def score_texts(docs: DataFrame, folds: int = 7, fold: int = 2) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score for each row of ``docs``, repeated rows included.

    A null text is empty: its end is its only token. A null doc_id is held out. A very long text is scored whole. Equal texts
    have equal scores; of words of equal count those of the least hash are told apart first. Other columns are not read. An
    empty table gives an empty table; without training texts every base score is 0."""
    spark = docs.sparkSession
    learn = tx.in_small_batches(docs).where(~held_out(F.col("doc_id"), folds, fold))
    counts = cut(token_counts(learn))
    shape = F.col("h").bitwiseAND(SHAPES - 1)
    level = F.floor(F.log2("n") * 8)
    levels = counts.groupBy(level.alias("level"), F.when(F.col("h") != int(END_TOKEN), shape).alias("shape")).agg(F.count("*").alias("types"), F.sum("n").alias("n")).collect()  # by powers of two and shape
    total, types = sum(r["n"] for r in levels), sum(r["types"] for r in levels)
    by_level: dict[int, int] = {}
    for r in levels:
        by_level[r["level"]] = by_level.get(r["level"], 0) + r["types"]
    room, least = HEAD, None
    for k in sorted(by_level, reverse=True):
        if by_level[k] > room:
            break
        room, least = room - by_level[k], k
    frequent = F.lit(False) if least is None else level >= least
    got = counts.where(frequent | (F.col("h") == int(END_TOKEN))).toArrow().sort_by("h")  # at most HEAD + 1
    head, n = got["h"].to_numpy(), got["n"].to_numpy()
    sizes = Sizes.of(total)
    vocabulary = Vocabulary(head, n, sizes)
    weights = train(statistics(learn, vocabulary), sizes)
    shape_n, shape_types = np.zeros(SHAPES), np.zeros(SHAPES)
    for r in levels:
        if r["shape"] is not None:
            shape_n[r["shape"]] += r["n"]
            shape_types[r["shape"]] += r["types"]
    own = np.isin(head, vocabulary.words)
    np.subtract.at(shape_n, head[own] & (SHAPES - 1), n[own])
    np.subtract.at(shape_types, head[own] & (SHAPES - 1), 1)
    shape_logs = np.log10(shape_n + shape_types + 1)
    shared = spark.sparkContext.broadcast((vocabulary, weights, head, n, shape_logs))

    def read(batches):
        scorer = Scorer(*shared.value)
        for batch in batches:
            ids, rid = batch.column("doc_id"), batch.column("rid")
            for a, b, data, offsets in tx.groups(batch.column("text"), PIECE):
                size, known, base, score, (d, t, times, as_shape), (rd, rt, again, share) = scorer.score(data, offsets)
                rids, m = rid.slice(a, b - a), b - a
                # a text's own row has a hash of its number for a token, so that these rows spread like the others
                kinds = {
                    "own": (rids, tx.mix(rids.to_numpy().astype(np.uint64)).view(np.int64) | SHAPES - 1, {"own": np.ones(m, bool), "doc_id": ids.slice(a, m), "size": size, "known": known, "base": base, "model": score}),
                    "rare": (rids.take(pa.array(d)), t, {"times": times.astype(np.int64), "shaped": as_shape}),
                    "again": (rids.take(pa.array(rd)), rt, {"again": again, "share": share}),
                }
                for r, token, more in kinds.values():
                    if len(r):
                        values = {"rid": r, "h": pa.array(token), "own": np.zeros(len(r), bool), **more}
                        yield pa.record_batch([pa.nulls(len(r), f.type) if f.name not in values else pa.array(values[f.name]) if isinstance(values[f.name], np.ndarray) else values[f.name] for f in arrow], schema=arrow)

    id_type = docs.schema["doc_id"].dataType
    fields = f"rid long, h long, own boolean, doc_id {id_type.simpleString()}, size long, known long, base double, model double, times long, shaped long, again double, share double"
    arrow = to_arrow_schema(StructType.fromDDL(fields))
    rows = docs.select("doc_id", "text", F.monotonically_increasing_id().alias("rid")).mapInArrow(read, fields)
    tail = counts.where(~frequent & (F.col("h") != int(END_TOKEN)))
    met = rows.join(tail, "h", "left")
    log = F.when(~F.col("own"), F.log10(F.coalesce("n", F.lit(0)) + 1))
    summed = met.groupBy("rid").agg(
        F.max("doc_id").alias("doc_id"), F.max("size").alias("n_tokens"), F.max("known").alias("known"), F.max("base").alias("base"), F.max("model").alias("model"),
        F.coalesce(F.sum(F.when(F.col("n") > 0, F.col("times"))), F.lit(0)).alias("rare_known"), F.coalesce(F.sum(F.col("times") * log), F.lit(0.0)).alias("rare_log"), F.coalesce(F.sum(F.col("shaped") * log), F.lit(0.0)).alias("rare_model"),
        F.coalesce(F.sum(F.log10(F.col("again") + F.col("share") * (F.coalesce("n", F.lit(0)) + 1))), F.lit(0.0)).alias("rare_again"),
    )
    return summed.select(
        "doc_id", held_out(F.col("doc_id"), folds, fold).alias("held_out"), "n_tokens", (F.col("known") + F.col("rare_known")).alias("n_known"), F.lit(total).cast("long").alias("train_tokens"),
        (F.col("base") + F.col("rare_log") - F.col("n_tokens") * F.lit(float(np.log10(total + types + 1)))).alias("base_score"), (F.col("model") + F.col("rare_model") + F.col("rare_again")).alias("score"),
    )
