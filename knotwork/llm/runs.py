"""Periodic runs of words (operator 12): suffix array, longest previous factors, LZ blocks, Main's extensions, copying.

A run is a stretch of words with smallest period q, of at least ``max(least, 2 * q)`` words, that neither neighbour extends
keeping the period. Texts are searched many at a time: their words become numbers that no two texts share, so the suffixes of
a text lie together in one suffix array.

1. Prefix doubling: classes of equal stretches of 1, 2, 4, … words, in order, until no two stretches are equal. The last
   classes order the suffixes; all of them answer, by halving, how far two places agree to the right or to the left.
2. The longest previous factor of a place is the longer agreement with the nearest earlier place before and after it in the
   suffix array. Both are found by jumps over places already passed, for all places at once.
3. Blocks: at each place the longest previous factor, or one word.
4. A run that is not inside a block touches the border b of two blocks a..b..c, with a period below c - a: it is found by how
   far the words at b and b - q, or b + q and b, agree to both sides. Twice as many pairs as words are tried in all, fewer for
   the least length.
5. A run inside a block is a run of the earlier place that the block repeats; such runs lie in buckets by their start and are
   copied from left to right.

A text in which no ``least // 2`` words occur twice has no run and is not searched further: a run's first period repeats that
many words at least.

Null texts have no words. Repeated rows have equal results. A very long text is a batch of its own; memory is about 60 bytes
a word, and four for each doubling of the longest repeat. Words are told apart by 64-bit hashes within a text. Columns of any
name may stand beside doc_id and text. An empty table stays empty."""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from knotwork.llm import text as tx

#: Words of the shortest run.
LEAST = 12
#: Words that are searched at once, and pairs of a border and a period.
WORDS, PAIRS = 1 << 18, 1 << 19
#: Rounds of jumps before a pass with a stack.
JUMPS = 1024


def classes(codes: np.ndarray) -> list[np.ndarray]:
    """For k = 0, 1, …: the class of the ``2 ** k`` numbers from each place on, in their order, until all differ.

    A stretch that reaches over the end equals no other. Only places whose class is shared are sorted again."""
    n = len(codes)
    rank = np.unique(codes, return_inverse=True)[1].astype(np.int64)
    counts = np.bincount(rank, minlength=n)
    begin = np.concatenate([[0], np.cumsum(counts)[:-1]])  # a class is numbered by the places before it, so that it can be parted in place
    rank, shared = begin[rank], np.flatnonzero(counts[rank] > 1)
    out, width = [rank.astype(np.int32)], 1
    while len(shared):
        after = shared + width
        second = np.where(after < n, rank[np.minimum(after, n - 1)], -1 - shared) + n  # one over the end comes first, and alone
        key = rank[shared] * (2 * n + 1) + second
        order = np.argsort(key, kind="stable")
        key, at = key[order], shared[order]
        first = rank[at]
        new_class, new_group = np.ones(len(at), bool), np.ones(len(at), bool)
        new_class[1:] = key[1:] != key[:-1]
        new_group[1:] = first[1:] != first[:-1]
        place = np.arange(len(at))
        group = np.maximum.accumulate(np.where(new_group, place, 0))
        own = np.maximum.accumulate(np.where(new_class, place, 0))
        rank[at] = first + own - group
        out.append(rank.astype(np.int32))
        ends = np.flatnonzero(np.append(new_class[1:], True))
        size = np.diff(np.append(-1, ends))
        shared = np.sort(at[np.repeat(size, size) > 1])
        width *= 2
    return out


def agree_right(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many numbers from places i and j on are equal; 0 where one is past the end."""
    n, total = len(levels[0]), np.zeros(len(i), np.int64)
    i, j = i.copy(), j.copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (i < n) & (j < n)
        same = inside & (levels[k][np.minimum(i, n - 1)] == levels[k][np.minimum(j, n - 1)])
        step = same.astype(np.int64) << k
        total += step
        i += step
        j += step
    return total


def agree_left(levels: list[np.ndarray], i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """How many numbers before places i and j, these not included, are equal."""
    total = np.zeros(len(i), np.int64)
    i, j = i.copy(), j.copy()
    for k in range(len(levels) - 1, -1, -1):
        a, b = i - (1 << k), j - (1 << k)
        same = (a >= 0) & (b >= 0) & (levels[k][np.maximum(a, 0)] == levels[k][np.maximum(b, 0)])
        step = same.astype(np.int64) << k
        total += step
        i -= step
        j -= step
    return total


def previous_factors(levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """(length, place) of the longest earlier occurrence of what begins at each place; length 0 has place -1."""
    n = len(levels[0])
    suffixes = np.empty(n, np.int64)
    suffixes[levels[-1]] = np.arange(n)
    common = np.zeros(n + 1, np.int64)  # common[r]: agreement of the suffixes r - 1 and r
    if n > 1:
        common[1:n] = agree_right(levels, suffixes[:-1], suffixes[1:])
    length, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    for direction in (-1, 1):
        jump = np.arange(n) + direction
        least = common[:n].copy() if direction < 0 else common[1:].copy()
        todo = np.flatnonzero(least > 0)
        todo = todo[suffixes[jump[todo]] > suffixes[todo]]
        rounds = 0
        while len(todo):  # all between a place and its jump are later in the text; jumps over jumps keep that
            if rounds == JUMPS:
                _pass(suffixes.tolist(), common.tolist(), direction, jump, least)
                break
            rounds += 1
            over = jump[todo]
            least[todo] = np.minimum(least[todo], least[over])
            jump[todo] = jump[over]
            todo = todo[least[todo] > 0]
            todo = todo[suffixes[jump[todo]] > suffixes[todo]]
        found = np.flatnonzero(least > 0)
        at = suffixes[found]
        better = least[found] > length[at]
        length[at[better]], source[at[better]] = least[found][better], suffixes[jump[found[better]]]
    return length, source


def _pass(suffixes: list[int], common: list[int], direction: int, jump: np.ndarray, least: np.ndarray) -> None:
    """Sets ``jump`` and ``least`` of all places in one pass with a stack, where jumps take too many rounds."""
    n, stack = len(suffixes), []
    for r in range(n) if direction < 0 else range(n - 1, -1, -1):
        m = common[r] if direction < 0 else common[r + 1]
        while stack and suffixes[stack[-1][0]] > suffixes[r]:
            m = min(m, stack.pop()[1])
        jump[r], least[r] = (stack[-1][0], m) if stack else (r, 0)
        stack.append((r, m))


def _blocks(length: list[int], begin: int, end: int) -> list[int]:
    """Where the blocks of a text begin, and its end."""
    out, at = [], begin
    while at < end:
        out.append(at)
        at += length[at] or 1
    return [*out, end]


def _at_borders(levels: list[np.ndarray], a: np.ndarray, b: np.ndarray, c: np.ndarray, least: int) -> np.ndarray:
    """(start, end, period) of runs that touch the borders b between blocks a..b and b..c."""
    found, width = [np.zeros((0, 3), np.int64)], c - a - 1
    keep = np.flatnonzero(2 * width + 1 >= least)  # a run here is shorter than c - a + q
    a, b, width = a[keep], b[keep], width[keep]
    ends = np.cumsum(width)
    at = 0
    while at < len(width):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PAIRS, "right")))
        w = width[at:to]
        border, q = np.repeat(b[at:to], w), np.arange(int(w.sum())) - np.repeat(np.cumsum(w) - w, w) + 1
        q = q.astype(np.int64)
        for i in (border, border + q):
            ok = np.flatnonzero((i - q >= 0) & (i <= len(levels[0])))
            x, p = i[ok], q[ok]
            right = agree_right(levels, x, x - p)
            left = agree_left(levels, x, x - p)
            good = (right + left >= p) & (right + left + p >= least)
            found.append(np.stack([x - p - left, x + right, p], 1)[good])
        at = to
    return np.concatenate(found)


def find_runs(codes: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> Iterator[list[tuple[int, int, int]]]:
    """For each text ``codes[offsets[t]:offsets[t + 1]]``, which share no number: its runs (start, length, period) by start and period."""
    n = len(codes)
    if not n:
        yield from ([] for _ in offsets[1:])
        return
    levels = classes(codes)
    length, source = previous_factors(levels)
    lengths, sources, blocks = length.tolist(), source.tolist(), []
    for begin, end in zip(offsets[:-1].tolist(), offsets[1:].tolist()):
        blocks.append(_blocks(lengths, begin, end))
    a, b, c = ([x for bs in blocks for x in side(bs)] for side in (lambda bs: bs[:-1], lambda bs: bs[1:], lambda bs: [*bs[2:], bs[-1]][: len(bs) - 1]))
    near = _at_borders(levels, *(np.array(x, np.int64) for x in (a, b, c)), least)
    near = near[np.lexsort((near[:, 2], near[:, 1], near[:, 0]))]
    if len(near):
        near = near[np.append(True, (near[1:, :2] != near[:-1, :2]).any(axis=1))]  # of one stretch the smallest period
    cuts = np.searchsorted(near[:, 0], offsets)
    for t, bs in enumerate(blocks):
        runs = {(s, e): q for s, e, q in near[cuts[t] : cuts[t + 1]].tolist()}
        _copy_inner(runs, bs, lengths, sources, least)
        begin = int(offsets[t])
        yield sorted((s - begin, e - s, q) for (s, e), q in runs.items())


def _copy_inner(runs: dict[tuple[int, int], int], blocks: list[int], lengths: list[int], sources: list[int], least: int) -> None:
    """Adds the runs inside blocks, from those of the places that the blocks repeat."""
    buckets: dict[int, list[tuple[int, int]]] = {}
    for (s, e), q in runs.items():
        buckets.setdefault(s, []).append((e, q))
    starts = sorted(buckets)
    for b, c in zip(blocks, blocks[1:]):
        if c - b < least + 2 or lengths[b] < least + 2 or not starts:
            continue
        back = b - sources[b]
        k = bisect_left(starts, b - back + 1)
        while k < len(starts) and starts[k] < c - back - least:
            s = starts[k]
            for e, q in list(buckets[s]):
                if e < c - back and (s + back, e + back) not in runs:
                    runs[s + back, e + back] = q
                    if s + back not in buckets:
                        buckets[s + back] = []
                        starts.insert(bisect_left(starts, s + back), s + back)
                    buckets[s + back].append((e + back, q))
            k += 1


def may_repeat(hashes: np.ndarray, offsets: np.ndarray, least: int = LEAST) -> np.ndarray:
    """For each text whether ``least // 2`` words of it may occur twice: equal ones have equal hashes."""
    width, n = least // 2, len(offsets) - 1
    of = np.repeat(np.arange(n), np.diff(offsets))
    if len(hashes) < width:
        return np.zeros(n, bool)
    m = len(hashes) - width + 1
    total = tx.mix(of[:m].astype(np.uint64) + np.uint64(1 << 32))
    for k in range(width):
        total = (total ^ hashes[k : k + m]) * np.uint64(0x9E3779B97F4A7C15)
        total ^= total >> np.uint64(29)
    whole = np.flatnonzero(of[:m] == of[width - 1 :])
    total, of = total[whole], of[whole]
    ordered = np.sort(total)
    twice = np.unique(ordered[1:][ordered[1:] == ordered[:-1]])
    out = np.zeros(n, bool)
    if len(twice):
        at = np.minimum(np.searchsorted(twice, total), len(twice) - 1)
        out[of[twice[at] == total]] = True
    return out


def _numbered(hashes: np.ndarray, offsets: np.ndarray, texts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(numbers, offsets) of the words of the texts chosen; no two texts share a number."""
    sizes = np.diff(offsets)[texts]
    ends = np.concatenate([[0], np.cumsum(sizes)])
    words = np.repeat(offsets[texts] - ends[:-1], sizes) + np.arange(ends[-1])
    of = np.repeat(np.arange(len(texts)), sizes)
    order = np.lexsort((hashes[words], of))
    h, t = hashes[words][order], of[order]
    new = np.append(True, (h[1:] != h[:-1]) | (t[1:] != t[:-1])) if len(order) else np.zeros(0, bool)
    codes = np.empty(len(order), np.int64)
    codes[order] = np.cumsum(new) - 1
    return codes, ends


def _searched(hashes: np.ndarray, offsets: np.ndarray, least: int) -> dict[int, list[tuple[int, int, int]]]:
    """Text to its runs, for texts that have some."""
    out, texts = {}, np.flatnonzero(may_repeat(hashes, offsets, least))
    ends = np.cumsum(np.diff(offsets)[texts])
    at = 0
    while at < len(texts):
        to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORDS, "right")))
        for t, runs in zip(texts[at:to].tolist(), find_runs(*_numbered(hashes, offsets, texts[at:to]), least)):
            if runs:
                out[t] = runs
        at = to
    return out


def dropped(runs: list[tuple[int, int, int]], n: int) -> np.ndarray:
    """Whether each of n words lies in a run after that run's first period."""
    change = np.zeros(n + 1, np.int64)
    for s, length, q in runs:
        change[s + q] += 1
        change[s + length] -= 1
    return np.cumsum(change[:n]) > 0


_RUNS = pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))


def _batch_runs(column: pa.Array, modified: list[int | None], least: int) -> Iterator[tuple[int, list[tuple[int, int, int]], bytes]]:
    """(words, runs, collapsed text) of each text. ``modified``: None, or what makes a text periodic."""
    for a, b, data, offsets in tx.groups(column):
        hashes, starts, ends, first = tx.words(data, offsets, lower=False)
        raw = data.tobytes()
        for t in range(a, b):
            if modified[t] is not None:
                lo, hi = int(first[t - a]), int(first[t - a + 1])
                hashes[lo:hi] = hashes[lo:hi][_periodic(hi - lo, modified[t])]
        found = _searched(hashes, first, least)
        for t in range(a, b):
            lo, hi = int(first[t - a]), int(first[t - a + 1])
            words = raw[offsets[t - a] : offsets[t - a + 1]].split()
            if modified[t] is not None:
                words = [words[i] for i in _periodic(hi - lo, modified[t]).tolist()]
            runs = found.get(t - a, [])
            if runs:
                gone = dropped(runs, hi - lo).tolist()
                kept = b" ".join([w for w, x in zip(words, gone) if not x])
            else:
                kept = b" ".join(words)
            yield hi - lo, runs, kept


def _periodic(n: int, g: int) -> np.ndarray:
    """Places 0 to n - 1, from ``g % n`` on repeated with a period that g gives."""
    at = np.arange(n)
    if n:
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        at[a:] = a + (at[a:] - a) % p
    return at


def text_runs(docs: DataFrame, least: int = LEAST, seed: str | None = None) -> DataFrame:
    """doc_id, n_words, runs, collapsed: a row for each row of ``docs``.

    ``runs`` has (start, length, period) by start and period, words counted from 0; ``collapsed`` is the text, as UTF-8, of the words
    that lie in no run after its first period, joined by single spaces. With ``seed``, an SQL expression, texts whose value
    is a multiple of ten are made periodic first, as planted cases."""
    rows = tx.in_small_batches(docs).select("doc_id", "text", (F.expr(seed) if seed else F.lit(None)).cast("long").alias("seed"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seeds = batch.column("seed").to_pylist()
            modified = [None if h is None or h % 10 else h // 10 for h in seeds]
            n, runs, kept = [], [], []
            for count, found, collapsed in _batch_runs(batch.column("text"), modified, least):
                n.append(count)
                runs.append([{"start": s, "length": x, "period": q} for s, x, q in found])
                kept.append(collapsed)
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "n_words": pa.array(n, pa.int64()), "runs": pa.array(runs, _RUNS), "collapsed": pa.array(kept, pa.binary())})

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed binary")


def run_digests(found: DataFrame) -> DataFrame:
    """doc_id, n_words, n_runs, start, length, period, exponent_milli, runs_sha256, collapsed_sha256 of ``text_runs``: the longest run, of equals the first, then that of the smallest period."""
    longest = F.array_max(F.transform("runs", lambda r: F.struct(r["length"].alias("length"), (-r["start"]).alias("start"), (-r["period"]).alias("period"))))
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    out = found.select("doc_id", "n_words", F.size("runs").cast("long").alias("n_runs"), longest.alias("r"), F.sha2(F.array_join(F.transform("runs", line), ""), 256).alias("runs_sha256"), F.sha2("collapsed", 256).alias("collapsed_sha256"))
    return out.selectExpr("doc_id", "n_words", "n_runs", "-r.start AS start", "r.length AS length", "-r.period AS period", "1000 * r.length div -r.period AS exponent_milli", "runs_sha256", "collapsed_sha256")
