"""Benchmark passages found in documents by latent semantic retrieval (operator 7).

Benchmark items are cut into passages of at most ``PASSAGE`` words. Their TF-IDF matrix over hashed words, with document
frequencies of the whole corpus, has its leading right singular vectors computed by a randomised decomposition whose
products are sums over Spark tasks. A document is read in overlapping windows; a window's cosine with a passage is the
product of their latent vectors over the norms of the whole vectors, so that words outside the benchmark count against it.
Windows near a passage are then compared word by word: the longest common subsequence must cover most of the item's
passage, and its answer, the last words, must be there too. That finds passages with changed, lost or added words.

A cosine depends on a window's other words, so places that share enough pairs of adjacent words with a passage are compared
in the same way, whatever stands around them and however frequent the words are. A passage of which so much is there that
it counts shares that many pairs, with any words changed or lost.

The benchmark is the small side: it is read whole by each task, in blocks of ``ITEMS`` passages, behind a check of its size."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm import text as tx
from knotwork.plans.lineage import cut

BITS = 18
PASSAGE = 48
#: Words from window to window. Windows have 2 and 4 times as many, so that one of them holds any passage.
STEP, WIDTHS = 16, (2, 4)
RANK = 256
#: Share of a passage's own latent product that a window must reach.
COSINE = 0.4
#: Words in a larger share of documents do not count in the retrieval, or as ``FLOOR`` where the benchmark has them.
COMMON, FLOOR = 0.1, 0.1
#: The most that frequent words may give to a product with any passage, for them to be left out of windows' vectors.
LEAN = 0.25
#: Bytes of text searched at once.
PIECE = 1 << 19
#: Words of a longer text searched at once, and those around them that a passage may reach into. Both are whole steps.
WORDS, MARGIN = 1 << 16, 160
#: First bits of the benchmark's pairs that are looked up before the pairs; entries of an array while pairs are counted.
FIRST_BITS, SPREAD = 20, 1 << 22
#: Share of a passage, and of its last words, that must come in order.
COVER, ANSWER_COVER, ANSWER = 0.7, 0.5, 6
#: Passages shorter than this are matched only word for word.
SHORT = 8
ITEMS = 1024
#: Passages of a benchmark that may be broadcast; a larger benchmark is taken in as many rounds over the documents.
ROUND = 4_000


def _terms(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(64 - BITS)).astype(np.int64)


def document_frequencies(docs: DataFrame) -> tuple[np.ndarray, int]:
    """(documents with each hashed word, documents), over all texts. A task passes on one number for each word it has."""

    def count(batches):
        total, n = np.zeros(1 << BITS, np.int64), 0
        for batch in batches:
            for _, _, data, offsets in tx.groups(batch.column("text")):
                h, _, _, first = tx.words(data, offsets, core=True)
                doc = np.repeat(np.arange(len(offsets) - 1), np.diff(first))
                code = (doc << BITS) | _terms(h)
                code = np.sort(code.astype(np.uint32) if len(offsets) <= 1 << (32 - BITS) else code)
                code = code[np.diff(code, prepend=code[:1] + 1) != 0]
                total += np.bincount(code & ((1 << BITS) - 1), minlength=1 << BITS)
                n += len(offsets) - 1
        at = np.flatnonzero(total)
        yield pa.record_batch({"term": pa.array(np.append(at, -1)), "n": pa.array(np.append(total[at], n))})

    got = docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()  # at most 2**BITS rows
    term, n = got["term"].to_numpy(), got["n"].to_numpy()
    df = np.zeros(1 << BITS, np.int64)
    df[term[term >= 0]] = n[term >= 0]
    return df, int(n[term < 0].sum())


def passages(benchmark: DataFrame) -> DataFrame:
    """item_id, part, words (array of 64-bit hashes): whole items of at most ``PASSAGE`` words, longer ones in equal parts.

    The parts of an item that are numbered after these reach from the middle of each to the middle of the next."""

    def cut_up(batches):
        for batch in batches:
            at, part, lists = [], [], []
            for a, b, data, offsets in tx.groups(batch.column("text")):
                h, _, _, first = tx.words(data, offsets, core=True)
                for i in range(b - a):
                    w = h[first[i] : first[i + 1]].view(np.int64)
                    m = max(1, -(-len(w) // PASSAGE))
                    between = [w[len(w) * (2 * k + 1) // (2 * m) : len(w) * (2 * k + 3) // (2 * m)] for k in range(m - 1)]
                    for k, x in enumerate([*np.array_split(w, m), *between]):
                        if len(x):
                            at.append(a + i)
                            part.append(k)
                            lists.append(x)
            yield pa.record_batch({"item_id": batch.column("item_id").take(pa.array(at, pa.int64())), "part": pa.array(part, pa.int32()), "words": pa.array(lists, pa.list_(pa.int64()))})

    return benchmark.select("item_id", "text").mapInArrow(cut_up, f"item_id {benchmark.schema['item_id'].dataType.simpleString()}, part int, words array<long>")


def _rows(lists: list[np.ndarray], idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, term, unit TF-IDF value) of passages."""
    row = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
    term = _terms(np.concatenate([np.zeros(0, np.int64), *lists]).view(np.uint64))
    code, tf = np.unique((row << BITS) | term, return_counts=True)
    row, term = code >> BITS, code & ((1 << BITS) - 1)
    x = (1 + np.log(tf)) * idf[term]
    return row, term, x / np.sqrt(np.maximum(np.bincount(row, x * x, max(1, len(lists))), 1e-12))[row]


def latent_space(parts: DataFrame, idf: np.ndarray, terms: np.ndarray, rank: int = RANK, steps: int = 2, seed: int = 3) -> np.ndarray:
    """Right singular vectors of the passages' TF-IDF matrix, a row for each of ``terms``: a randomised range finder.

    Each step multiplies the matrix and its transpose in the tasks that hold the passages; the driver adds the products, of
    ``terms`` by ``rank``, and makes them orthogonal."""
    rank = min(rank, len(terms))
    spark = parts.sparkSession
    where = np.full(1 << BITS, -1)
    where[terms] = np.arange(len(terms))
    basis = np.random.default_rng(seed).standard_normal((len(terms), rank)).astype(np.float32)
    for _ in range(steps + 1):
        shared = spark.sparkContext.broadcast((idf, where, np.linalg.qr(basis)[0].astype(np.float32)))

        def product(batches, shared=shared):
            idf, where, q = shared.value
            total = np.zeros(q.shape, np.float32)
            for batch in batches:
                lists = [np.array(x, np.int64) for x in batch.column("words").to_pylist()]
                row, term, x = _rows(lists, idf)
                at = where[term]
                y = np.zeros((len(lists), q.shape[1]))
                np.add.at(y, row, x[:, None] * q[at])
                np.add.at(total, at, (x[:, None] * y[row]).astype(np.float32))
            used = np.flatnonzero(np.any(total, axis=1))
            yield pa.record_batch({"term": pa.array(used), "row": pa.array([r.tobytes() for r in total[used]], pa.binary())})

        got = parts.select("words").mapInArrow(product, "term long, row binary").toArrow()
        basis = np.zeros((len(terms), rank))
        if got.num_rows:
            np.add.at(basis, got["term"].to_numpy(), np.stack([np.frombuffer(x, np.float32) for x in got["row"].to_pylist()]))
    return np.linalg.qr(basis)[0].astype(np.float32)


def common_subsequence(a: np.ndarray, b: np.ndarray) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    n, m = len(a), len(b)
    table = np.zeros((n + 1, m + 1), np.int32)
    for i in range(n - 1, -1, -1):
        diagonal = np.where(b == a[i], table[i + 1, 1:] + 1, table[i + 1, :-1])
        table[i, :-1] = np.maximum.accumulate(np.maximum(diagonal, table[i + 1, :-1])[::-1])[::-1]
    out, i, j = [], 0, 0
    while i < n and j < m and table[i, j]:
        if a[i] == b[j]:
            out.append(i)
            i, j = i + 1, j + 1
        elif table[i + 1, j] >= table[i, j + 1]:
            i += 1
        else:
            j += 1
    return out


def covered(item: np.ndarray, found: list[int]) -> bool:
    """Whether a common subsequence covers enough of a passage and of its answer."""
    n = len(item)
    if n < SHORT:
        return len(found) == n
    answer = min(ANSWER, n // 2)
    return len(found) >= COVER * n and sum(1 for i in found if i >= n - answer) >= ANSWER_COVER * answer


def pairs_needed(n: int) -> int:
    """Pairs of adjacent words asked of a place for a passage of ``n`` words.

    Where ``kept`` words are left they lie in at most n - kept + 1 runs, so changed and lost words leave 2 * kept - n - 1
    pairs. Half of these are asked, as added words part further ones. Of a short passage the first pair is looked up."""
    if n < SHORT:
        return 1
    kept = int(np.ceil(COVER * n))
    return max(1, (2 * kept - n) // 2)


def _pairs(h: np.ndarray) -> np.ndarray:
    return h[:-1] * np.uint64(0x9E3779B97F4A7C15) + h[1:]


def _spread(begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(each number from a beginning to before its end, index of the range) of many ranges."""
    count = end - begin
    return np.repeat(begin - np.cumsum(count) + count, count) + np.arange(count.sum()), np.repeat(np.arange(len(count)), count)


class Searcher:
    def __init__(self, items: list[tuple[int, int, np.ndarray]], idf: np.ndarray, terms: np.ndarray, space: np.ndarray):
        self.items, self.idf = items, idf
        self.where = np.full(1 << BITS, -1)
        self.where[terms] = np.arange(len(terms))
        self.where[idf == 0] = -1
        self.space = space * idf[terms][:, None]
        row, term, x = _rows([w for _, _, w in items], idf)
        self.square = idf**2
        latent = np.zeros((len(items), space.shape[1]), np.float32)
        np.add.at(latent, row, (x[:, None] * space[np.searchsorted(terms, term)]).astype(np.float32))
        # against COSINE times its own product, so that what the space leaves of a passage is asked of a window
        self.latent = latent / np.maximum((latent**2).sum(axis=1, keepdims=True), 1e-6)
        self.most = max(1e-6, float(np.linalg.norm(self.latent, axis=1).max(initial=0)))
        # how much of a passage's product words of the least weight can give, for a window that has no others
        self.frequent = np.zeros(1 << BITS, bool)
        self.frequent[terms[idf[terms] <= FLOOR]] = True
        # (without passages that rest on them they are left out of windows' vectors, which then need less by as much)
        self.most_frequent = float(np.linalg.norm(space[self.frequent[terms]] @ self.latent.T, axis=0).max(initial=0))
        self.lean = self.most_frequent <= LEAN
        self.length = np.array([len(w) for _, _, w in items], np.int64)
        self.words_needed = np.where(self.length < SHORT, self.length, COVER * self.length)
        self.pairs_needed = np.array([pairs_needed(n) for n in self.length], np.int64)
        single = [w.view(np.uint64) if len(w) == 1 else w[:0].view(np.uint64) for _, _, w in items]
        pairs = [_pairs(w.view(np.uint64)[: 2 if len(w) < SHORT else None]) for _, _, w in items]
        self.vocabulary = np.unique(np.concatenate([w for _, _, w in items]).view(np.uint64))
        self.coded = np.full((len(items), self.length.max()), -2, np.int32)
        for i, (_, _, w) in enumerate(items):
            self.coded[i, : len(w)] = self._codes(w.view(np.uint64))
        # a row for each place compared at once, a column for each word; the last two stand for other words and for none
        self.seen = np.zeros((max(16, min(512, (1 << 22) // len(self.vocabulary))), len(self.vocabulary) + 2), bool)
        self.present = np.zeros(len(self.vocabulary) + 2, bool)
        self.single, self.pairs = self._postings(single), self._postings(pairs)
        self.width = 2 * int(self.length.max()) + 1

    @staticmethod
    def _postings(lists: list[np.ndarray]) -> tuple[np.ndarray, ...]:
        """(keys in order, whether a key has these first ``FIRST_BITS``, first row of each key and one past the last, item of each row, first posting of each row and one past the last, place in the item of each posting): a row for each key and item."""
        key = np.concatenate([np.zeros(0, np.uint64), *lists])
        item = np.repeat(np.arange(len(lists)), [len(x) for x in lists])
        place = np.concatenate([np.zeros(0, np.int64), *(np.arange(len(x)) for x in lists)])
        order = np.argsort(key, kind="stable")
        keys, number = np.unique(key[order], return_inverse=True)
        begins = np.zeros(1 << FIRST_BITS, bool)
        begins[keys >> np.uint64(64 - FIRST_BITS)] = True
        code, posting = np.unique(number * len(lists) + item[order], return_index=True)
        return keys, begins, np.searchsorted(code, np.arange(len(keys) + 1) * len(lists)), code % len(lists), np.append(posting, len(key)), place[order]

    @staticmethod
    def _looked_up(postings: tuple, key: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(index in ``key``, number of the key) of those that some item has."""
        keys, begins = postings[:2]
        if not len(keys) or not len(key):
            return (np.zeros(0, np.int64),) * 2
        where = np.flatnonzero(begins[key >> np.uint64(64 - FIRST_BITS)])
        at = np.minimum(np.searchsorted(keys, key[where]), len(keys) - 1)
        there = keys[at] == key[where]
        return where[there], at[there]

    def sharing(self, h: np.ndarray, first: np.ndarray, codes: Callable[[], np.ndarray] | None = None) -> Iterator[tuple[int, int, int]]:
        """(text, word at which the passage would begin, item) where enough pairs of adjacent words are shared.

        Of a pair that is repeated, in the text or in a passage, no more can belong to a common subsequence than either has.
        So the pairs of a stretch of text are counted once each, with their numbers, and only the passages that these suffice
        for are looked for in the stretch and the next."""
        at, key = self._looked_up(self.single, h)
        doc = np.searchsorted(first, at, "right") - 1
        once = np.unique(doc * (len(self.single[0]) + 1) + key, return_index=True)[1]  # the first in each text will do
        row, owner = _spread(self.single[2][key[once]], self.single[2][key[once] + 1])
        yield from zip(doc[once][owner].tolist(), at[once][owner].tolist(), self.single[3][row].tolist())
        where, key = self._looked_up(self.pairs, _pairs(h))
        codes = codes or cache(lambda: self._codes(h))
        for at, item, place in self._in_stretches(where, key):
            need = self.pairs_needed[item]
            last = np.arange(len(at)) + need - 1
            there = last < len(at)
            last[~there] = 0
            there &= (item[last] == item) & (at[last] - at <= 2 * self.length[item])
            at, item, place = at[there], item[there], place[there]
            if not len(at):
                continue
            doc = np.searchsorted(first, at, "right") - 1
            begin = at - place
            once = np.unique((item * len(first) + doc) * (len(h) + PASSAGE) + begin + PASSAGE, return_index=True)[1]
            doc, at, item = doc[once], begin[once], item[once]
            keep = self._shared_words(codes(), first, doc, at, item) >= self.words_needed[item]
            yield from zip(doc[keep].tolist(), at[keep].tolist(), item[keep].tolist())

    def _in_stretches(self, where: np.ndarray, key: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """(word, item, place in the item), by item and word, of the pairs at ``where`` in stretches of which two in a row share as many pairs with the item as it needs.

        A batch has about ``SPREAD`` entries at most; batches overlap by a stretch."""
        keys, _, rows, items, posting, places = self.pairs
        if not len(where):
            return
        block = where // self.width
        code, times = np.unique(block * len(keys) + key, return_counts=True)
        of, number = code // len(keys), code % len(keys)
        size = rows[number + 1] - rows[number]
        total, b = np.cumsum(size), int(block[0])
        row_code = np.repeat(np.arange(len(keys)), np.diff(rows)) * len(self.items) + items
        while True:
            i = int(np.searchsorted(of, b))
            j = int(np.searchsorted(total, (total[i] - size[i] if i < len(of) else 0) + SPREAD, "right"))
            to = max(b + 1, min(int(of[min(j, len(of)) - 1]), b + SPREAD // len(self.items)))  # the last stretch of the batch
            j = int(np.searchsorted(of, to, "right"))
            row, owner = _spread(rows[number[i:j]], rows[number[i:j] + 1])
            shared = np.minimum(times[i:j][owner], np.diff(posting)[row])
            shared = np.bincount(items[row] * (to - b + 1) + of[i:j][owner] - b, shared, len(self.items) * (to - b + 1)).reshape(len(self.items), -1)
            enough = shared[:, :-1] + shared[:, 1:] >= self.pairs_needed[:, None]
            alive = np.zeros(shared.shape, bool)
            alive[:, :-1] |= enough
            alive[:, 1:] |= enough
            item, stretch = np.nonzero(alive & (shared > 0))
            stretch += b
            lo, hi = np.searchsorted(block, stretch), np.searchsorted(block, stretch, "right")
            ends = np.cumsum(hi - lo)
            k = 0
            while k < len(item):
                upto = max(k + 2, int(np.searchsorted(ends, ends[k] + SPREAD // 16, "right")))
                hit, owner = _spread(lo[k:upto], hi[k:upto])
                want = key[hit] * len(self.items) + item[k:upto][owner]
                row = np.minimum(np.searchsorted(row_code, want), len(row_code) - 1)
                there = row_code[row] == want
                hit, row = hit[there], row[there]
                at, owner = _spread(posting[row], posting[row + 1])
                yield where[hit][owner], items[row][owner], places[at]
                k = upto if upto >= len(item) else upto - 1
            if to >= int(block[-1]):
                return
            b = to

    def _shared_words(self, code: np.ndarray, first: np.ndarray, doc: np.ndarray, at: np.ndarray, item: np.ndarray) -> np.ndarray:
        """How many places of each passage have their word in the text around ``at``, given its words' codes: no fewer than in order."""
        out, rows = np.zeros(len(at), np.int64), len(self.seen)
        for i in range(0, len(at), rows):
            k, begin, n = item[i : i + rows], at[i : i + rows, None], self.length[item[i : i + rows]][:, None]
            near = begin - n + np.arange(3 * n.max())
            there = (near < begin + 2 * n) & (near >= first[doc[i : i + rows], None]) & (near < first[doc[i : i + rows] + 1, None])
            row, window = np.arange(len(k))[:, None], np.where(there, code[np.where(there, near, 0)], -1)
            self.seen[row, window] = True
            self.seen[:, -2:] = False
            out[i : i + rows] = self.seen[row, self.coded[k][:, : n.max()]].sum(axis=1)
            self.seen[row, window] = False
        return out

    def _codes(self, h: np.ndarray) -> np.ndarray:
        """Numbers of the benchmark's words, -1 for others."""
        at = np.minimum(np.searchsorted(self.vocabulary, h), len(self.vocabulary) - 1)
        return np.where(self.vocabulary[at] == h, at, -1).astype(np.int32)

    def _with_words(self, window: np.ndarray, items: np.ndarray, barren: set) -> list[int]:
        """Those of ``items`` of whose passages enough places have their word in a window of codes; ``barren`` collects what had none."""
        seen = hash(window.tobytes()), hash(items.tobytes())  # a text that repeats itself has the same window again
        if seen in barren:
            return []
        self.present[window] = True
        self.present[-2:] = False
        there = self.present[self.coded[items]].sum(axis=1)
        self.present[window] = False
        items = items[there >= self.words_needed[items]].tolist()
        if not items:
            barren.add(seen)
        return items

    def near(self, h: np.ndarray, first: np.ndarray, codes: Callable[[], np.ndarray] | None = None) -> Iterator[tuple[int, int, int]]:
        """(text, first word of the window, item) of windows near an item's passage, with enough of its words in and around them."""
        codes, barren, reach = codes or cache(lambda: self._codes(h)), set(), int(self.length.max())
        count = np.diff(first)
        steps = -(-count // STEP)
        base = np.concatenate([[0], np.cumsum(steps)])
        if not base[-1]:
            return
        term = _terms(h)
        doc = np.repeat(np.arange(len(count)), count)
        step = base[doc] + (np.arange(len(h)) - first[doc]) // STEP
        square = self.square[term]
        at = self.where[term]
        inside = at >= 0
        frequent = self.frequent[term]
        rare = inside & ~frequent
        norm, most, least = np.bincount(step, square, base[-1]), np.bincount(step[rare], square[rare], base[-1]), np.bincount(step[frequent], square[frequent], base[-1])
        owner = np.repeat(np.arange(len(count)), steps)
        # a window's product with a passage is no more than its rare words' length times the passage's, and its frequent
        # words' length times what of the passage these can give: only where that is enough are vectors made
        widths, width, needed = [], 1, np.zeros(base[-1] + WIDTHS[-1], bool)
        while width < WIDTHS[-1]:
            norm, most, least = (self._doubled(x, owner, width) for x in (norm, most, least))
            width *= 2
            if width in WIDTHS:
                rows = np.flatnonzero((np.sqrt(most) * self.most + np.sqrt(least) * self.most_frequent >= COSINE * np.sqrt(norm)) & (norm > 0))
                needs = COSINE * np.sqrt(norm[rows]) - (np.sqrt(least[rows]) * self.most_frequent if self.lean else 0)
                widths.append((width, rows, needs.astype(np.float32)))
                for k in range(width):
                    needed[rows + k] = True
        used = np.flatnonzero((rare if self.lean else inside) & needed[step])
        if not len(used):
            return
        starts = np.flatnonzero(np.diff(step[used], prepend=-1))
        made = step[used[starts]]
        place = np.full(base[-1], len(made))
        place[made] = np.arange(len(made))
        sums = np.zeros((len(made) + 1, self.space.shape[1]), np.float32)
        sums[:-1] = np.add.reduceat(self.space[at[used]], starts, axis=0)
        for width, rows, needs in widths:
            last = base[owner[rows] + 1] - 1
            vectors = np.zeros((len(rows), self.space.shape[1]), np.float32)
            for k in range(width):
                there = rows + k <= last
                vectors[there] += sums[place[rows[there] + k]]
            for i in range(0, len(self.items), ITEMS):
                r, k = np.nonzero(vectors @ self.latent[i : i + ITEMS].T >= needs[:, None])
                bounds = np.flatnonzero(np.diff(r, prepend=-1, append=len(rows)))
                for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
                    x = rows[r[a]]
                    doc, items = int(owner[x]), k[a:b] + i
                    at = int(first[doc] + (x - base[doc]) * STEP)
                    for y in self._with_words(codes()[max(first[doc], at - reach) : min(first[doc + 1], at + WIDTHS[-1] * STEP + reach)], items, barren):
                        yield doc, at, y

    @staticmethod
    def _doubled(values: np.ndarray, owner: np.ndarray, width: int) -> np.ndarray:
        """Sums over windows twice as wide, within texts."""
        out = values.copy()
        if len(values) > width:
            out[:-width] += np.where(owner[width:] == owner[:-width], values[width:], 0)
        return out

    def links(self, h: np.ndarray, first: np.ndarray) -> dict[tuple[int, int], tuple[int, int]]:
        """(text, item) to (item's passage part, words in common) where a passage is covered.

        A text of over ``WORDS`` words, which comes alone, is searched in pieces with ``MARGIN`` words more on either side."""
        out: dict[tuple[int, int], tuple[int, int]] = {}
        if len(first) > 2 or len(h) <= WORDS:
            self._add_links(out, h, first, 0, len(h))
            return out
        for lo in range(0, len(h), WORDS):
            at, to = max(0, lo - MARGIN), min(len(h), lo + WORDS + MARGIN)
            # what begins before the first word, or in the last piece, belongs to these
            self._add_links(out, h[at:to], np.array([0, to - at]), lo - at if lo else -MARGIN, min(lo + WORDS, len(h)) - at)
        return out

    def _add_links(self, out: dict[tuple[int, int], tuple[int, int]], h: np.ndarray, first: np.ndarray, lo: int, hi: int) -> None:
        """Adds the links of windows and passages that begin from word ``lo`` to before ``hi``."""
        tried, failed = set(), set()
        signed = h.view(np.int64)

        def compared(k: int, words: np.ndarray, window: np.ndarray) -> int:
            seen = k, hash(window.tobytes())  # a text that repeats itself has the same window again
            if seen in failed:
                return 0
            common = self._compared(words, window)
            if not common:
                failed.add(seen)
            return common

        codes = cache(lambda: self._codes(h))
        for doc, at, k in self.near(h, first, codes):
            item, part, words = self.items[k]
            if not lo <= at < hi or (doc, item) in out or (doc, k, at // STEP) in tried:
                continue
            tried.add((doc, k, at // STEP))
            common = compared(k, words, signed[max(first[doc], at - len(words)) : min(first[doc + 1], at + WIDTHS[-1] * STEP + len(words))])
            if common:
                out[doc, item] = part, common
        tried = set()
        for doc, at, k in self.sharing(h, first, codes):
            item, part, words = self.items[k]
            n = len(words)
            if not lo <= at < hi and len(first) == 2 or (doc, item) in out or (doc, k, at) in tried:
                continue
            tried.add((doc, k, at))
            if at >= first[doc] and at + n <= first[doc + 1] and (signed[at : at + n] == words).all():
                out[doc, item] = part, n
            elif n >= SHORT:
                common = compared(k, words, signed[max(first[doc], at - n) : min(first[doc + 1], at + 2 * n)])
                if common:
                    out[doc, item] = part, common

    @staticmethod
    def _compared(words: np.ndarray, window: np.ndarray) -> int:
        """Words of a passage in a window, 0 where it is not covered."""
        own, times = np.unique(words, return_counts=True)
        around = np.sort(window)
        if np.minimum(times, np.searchsorted(around, own, "right") - np.searchsorted(around, own)).sum() < COVER * len(words):  # no fewer than in order
            return 0
        if len(words) < SHORT:
            found = list(range(len(words))) if any((window[i : i + len(words)] == words).all() for i in np.flatnonzero(window[: len(window) - len(words) + 1] == words[0])) else []
        else:
            found = common_subsequence(words, window)
        return len(found) if covered(words, found) else 0


def rounds(docs: DataFrame, benchmark: DataFrame) -> Iterator[tuple]:
    """(broadcast arguments of ``Searcher``, whether it is the last round) for each round of at most about ``ROUND`` passages, made when asked for; none without passages."""
    parts = passages(benchmark)
    tx.in_small_batches(docs)
    n = parts.count()
    if not n:
        return
    df, total = document_frequencies(docs)
    idf = np.where(df > COMMON * total, 0, np.log((total + 1) / (df + 0.5))).clip(0).astype(np.float32)
    many = -(-n // ROUND)
    for k in range(many):
        own = parts.where(F.pmod(F.xxhash64("item_id", "part", "words"), F.lit(many)) == k) if many > 1 else parts
        got = own.toArrow().sort_by([("item_id", "ascending"), ("part", "ascending")])  # about ROUND
        items = list(zip(got["item_id"].to_pylist(), got["part"].to_pylist(), (np.array(x, np.int64) for x in got["words"].to_pylist())))
        if items:
            terms = np.unique(_terms(np.concatenate([w for _, _, w in items]).view(np.uint64)))
            weights = idf.copy()
            weights[terms] = np.maximum(weights[terms], FLOOR)
            yield docs.sparkSession.sparkContext.broadcast((items, weights, terms, latent_space(own, weights, terms), got.schema.field("item_id").type)), k == many - 1


_latest: list = []


def _searcher(value: tuple) -> Searcher:
    """The searcher of a broadcast value, made once in each Python worker."""
    if not _latest or _latest[0] is not value:
        _latest[:] = [value, Searcher(*value[:4])]
    return _latest[1]


def _links_of(shared, column: pa.Array) -> Iterator[tuple[int, int, int, int, int]]:
    """(row, item_id, part, common words, passage words) of the texts of a column."""
    searcher = _searcher(shared.value)
    length = {(item, part): len(w) for item, part, w in searcher.items}
    for a, _, data, offsets in tx.groups(column, PIECE):
        h, _, _, first = tx.words(data, offsets, core=True)
        for (doc, item), (part, common) in searcher.links(h, first).items():
            yield a + doc, item, part, common, length[item, part]


def _found(shared):
    def search(batches):
        for batch in batches:
            rows = list(_links_of(shared, batch.column("text")))
            at = pa.array([x[0] for x in rows], pa.int64())
            kinds = ("item_id", None), ("part", pa.int32()), ("common_words", pa.int64()), ("passage_words", pa.int64())
            yield pa.record_batch({"doc_id": batch.column("doc_id").take(at), **{name: pa.array([x[k] for x in rows], kind or shared.value[4]) for k, (name, kind) in enumerate(kinds, 1)}})

    return search


def _dirty(shared):
    def search(column: pa.Array) -> pa.Array:
        out = np.zeros(len(column), bool)
        out[[r[0] for r in _links_of(shared, column)]] = True
        return pa.array(out)

    return F.arrow_udf(search, "boolean")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, part, common_words, passage_words: a row for each document and item of which it has a passage.

    Null and wordless texts have no passage, on either side; a null doc_id is reported as null. Items of equal text are
    reported each; of an item's passages that a document has the first found. Rows of ``docs`` that repeat repeat their
    links. A very long text is searched whole. Other columns are not read. Without documents or items the result is empty.
    No text is shuffled; the items' words are broadcast in rounds of ``ROUND`` passages, one at a time."""
    item = benchmark.schema["item_id"].dataType.simpleString()
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, item_id {item}, part int, common_words long, passage_words long"
    found = []
    for shared, last in rounds(docs, benchmark):
        now = docs.select("doc_id", "text").mapInArrow(_found(shared), schema)
        if not last:  # the round is done before the next one's items are sent
            now = cut(now)
            shared.unpersist()
        found.append(now)
    return reduce(DataFrame.unionByName, found) if found else docs.sparkSession.createDataFrame([], schema)


def clean_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no passage of the benchmark, with all their columns; null and empty texts stay.

    Repeated rows stay or go together. A benchmark of several rounds writes the rows that each leaves to the shared folder."""
    clean = docs
    for shared, last in rounds(docs, benchmark):
        clean = clean.where(~_dirty(shared)("text"))
        if not last:
            clean = cut(clean)
            shared.unpersist()
    return clean
