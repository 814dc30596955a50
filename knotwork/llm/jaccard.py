"""Documents joined by the Jaccard similarity of their word n-grams (operator 5).

Documents of equal n-gram sets are one set from the start. Two sets x, y of a similarity of at least t differ in at most
``(1 - t) / (1 + t) * (|x| + |y|)`` n-grams. Cut the hash range into more segments than that and they agree on some whole
ones, so links lie within blocks: components of sets that share a segment of their class of size or the next. There are a
few segments to spare: a set with no more tiny segments than these agrees with any similar one on another, and makes no
keys of tiny ones. So neither empty segments nor single frequent n-grams make blocks of unrelated sets.

Within a block, T-occurrence search finds the links: an inverted list for each n-gram, and for each set the search of
those sets that occur in at least T of its lists, T being the overlap that any similar set has. As in DivideSkip, L of the
longest lists are set aside; the others are merged in a heap that skips ahead to members of at least T - L of them, and
these are probed for in the long lists by binary search until they reach the overlap that their size asks, or cannot.

Before that a block is held against one of its sets: those that link with it are one component and need no search among
themselves. The sets of blocks too large for a task are first put in blocks anew, by prefixes of their rarest n-grams. A
block that is still too large is held against ``PIVOTS`` sets in the same way; those that link with the pivot of
the most links are dealt in parts, the others too, and each part of the others meets each part in a task; no set is left
out. A large group of near copies costs as many comparisons as it has members.

What is returned are the components. Links are not counted: sets already in one component are not compared."""

from __future__ import annotations

import heapq
import math
import uuid
from bisect import bisect_left, bisect_right
from functools import lru_cache
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from knotwork.llm import text as tx
from knotwork.plans.components import components
from knotwork.plans.lineage import cut, freed, shared_dir

N, THRESHOLD = 3, 90
#: N-grams that a task holds of a block. A larger block is dealt in parts of half as many.
HELD = 200_000
PIVOTS = 4
#: Slices of the n-grams of large blocks that are dealt one after the other.
SLICES = 4
#: The ratio of sizes within a class, as a power of that of similar sets.
WIDE = 2.4
#: Weighs a probe of a long list against a merge of it, as DivideSkip does to choose how many are long.
PROBE = 0.0085

_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], np.uint64)


def gram_sets(data: np.ndarray, offsets: np.ndarray, n: int = N):
    """The sorted distinct n-gram hashes of each text: words lower-cased, of fewer than n words the whole sequence, without words none."""
    h, _, _, first = tx.words(data, offsets)
    size = max(0, len(h) - n + 1)
    gram = np.zeros(size, np.uint64)
    for k in range(n):
        gram += h[k : k + size] * _ODD[k % 5] + np.uint64(k)
    gram = tx.mix(gram).view(np.int64)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= n:
            yield np.unique(gram[a : b - n + 1])
        else:
            short = h[a:b] * _ODD[: b - a] + np.uint64(77 + b - a)
            yield tx.mix(short.sum(keepdims=True)).view(np.int64) if b > a else np.zeros(0, np.int64)


def _identity(g: np.ndarray) -> tuple[int, int]:
    m = g.view(np.uint64)
    return (int(tx.mix(m * _ODD[1]).sum().view(np.int64)), int(tx.mix(m ^ _ODD[2]).sum().view(np.int64))) if len(g) else (0, 0)


def _identities(n: int):
    def read(batches):
        for batch in batches:
            found = [(len(g), *_identity(g)) for _, _, data, offsets in tx.groups(batch.column("text")) for g in gram_sets(data, offsets, n)]
            size, a, b = (pa.array([x[k] for x in found], pa.int64()) for k in range(3))
            yield pa.record_batch({"doc_id": batch.column("doc_id"), "tk": batch.column("tk"), "size": size, "a": a, "b": b})

    return read


def size_classes(threshold: int, most: int) -> list[int]:
    """Least sizes of the classes; similar sets are in one class or in two that follow each other.

    Classes wider than the sizes of similar sets need more segments, but fewer of their sets have keys of the next class."""
    bounds = [1]
    while bounds[-1] <= most:
        bounds.append(max(bounds[-1] + 1, -(-bounds[-1] * 100 // threshold), int(bounds[-1] * (100 / threshold) ** WIDE)))
    return bounds


@lru_cache(maxsize=64)
def _chosen(k: int, together: int) -> np.ndarray:
    return np.array(list(combinations(range(k), together)))


def segment_keys(g: np.ndarray, bounds: list[int], threshold: int = THRESHOLD) -> np.ndarray:
    """The keys of a sorted set: its segments, or two or three of them together, under its own class and, if sets of that may be similar, the next. Similar sets share one.

    With d differences at most and d + 1 + s segments, similar sets agree on s + 1. If one of them has at most s tiny
    segments, one of these is not tiny, and both have its key; if both have more, both have keys of tiny ones too."""
    m = g.view(np.uint64)
    m = m[np.argsort(m, kind="stable")]
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(tx.mix(m ^ _ODD[3]))])
    own = bisect_right(bounds, len(g)) - 1
    out = []
    for c in (own, own + 1) if len(g) * 100 >= threshold * bounds[own + 1] else (own,):
        # the larger of two sets in this class and the one before has at most this many n-grams
        largest = bounds[c + 1] - 1
        differ = (100 - threshold) * 2 * largest // (100 + threshold)
        # where single segments would hold few n-grams, keys are of two or three of them
        together = 3 if differ <= 5 else 2 if differ <= (100 - threshold) * 9 // 20 else 1
        spare = 0 if not differ else together - 1 if together > 1 else 3 + max(0, 90 - threshold) // 5 + differ * (100 - threshold) ** 2 // 4000
        k = differ + 1 + spare
        cuts = np.concatenate([[0], np.searchsorted(m, np.arange(1, k, dtype=np.uint64) * np.uint64((1 << 64) // k)), [len(m)]]) if k > 1 else np.array([0, len(m)])
        size = np.diff(cuts)
        part = sums[cuts[1:]] - sums[cuts[:-1]] + size.astype(np.uint64)
        keys = tx.mix(part + tx.mix(np.array([c], np.uint64)) + np.arange(k, dtype=np.uint64) * _ODD[0])
        if differ and together > 1:
            keys = tx.mix(keys[_chosen(k, together)] * _ODD[:together]).sum(axis=1)
        elif differ:
            tiny = size < (2 if len(m) >= 6 * k else 1)
            if tiny.sum() <= spare:
                keys = keys[~tiny]
        out.append(keys)
    return np.concatenate(out).view(np.int64)


#: Keys that a task holds before it passes them on.
KEYS = 1_000_000


def _shares(n: int, threshold: int):
    """Rows (key, a, head): a set a under a key, and two sets that a task found under one key. A task passes on one set for each key, of up to ``KEYS`` at a time."""

    def told(keys: np.ndarray, owners: np.ndarray, step: int = 100_000):
        order = np.lexsort((owners, keys))
        keys, owners = keys[order], owners[order]
        new = np.ones(len(keys), bool)
        new[1:] = keys[1:] != keys[:-1]
        head = owners[np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))]
        pairs = np.unique(np.stack([owners, head], axis=1)[owners != head], axis=0)
        keys, owners = keys[new], owners[new]
        for i in range(0, len(keys), step):
            k = keys[i : i + step]
            yield pa.record_batch({"key": pa.array(k), "a": pa.array(owners[i : i + step]), "head": pa.nulls(len(k), pa.int64())})
        for i in range(0, len(pairs), step):
            a, head = (np.ascontiguousarray(x) for x in pairs[i : i + step].T)
            # keys of their own, spread like the others
            yield pa.record_batch({"key": pa.array(tx.mix(a.view(np.uint64)).view(np.int64)), "a": pa.array(a), "head": pa.array(head)})

    def read(batches):
        keys, owners, size, bounds = [], [], 0, [1]
        for batch in batches:
            for _, _, data, offsets in tx.groups(batch.column("text")):
                for g in gram_sets(data, offsets, n):
                    if len(g):
                        if len(g) * 8 >= bounds[-1]:
                            bounds = size_classes(threshold, len(g) * 16)
                        k = segment_keys(g, bounds, threshold)
                        keys.append(k)
                        owners.append(np.full(len(k), _identity(g)[0]))
                        size += len(k)
                if size > KEYS:
                    yield from told(np.concatenate(keys), np.concatenate(owners))
                    keys, owners, size = [], [], 0
        if size:
            yield from told(np.concatenate(keys), np.concatenate(owners))

    return read


class Block:
    """T-occurrence search over the sets of a block. With ``cross`` only sets of different parts are searched for."""

    def __init__(self, sets: list[np.ndarray], parts: list[int], cross: bool, threshold: int = THRESHOLD):
        self.parts, self.cross, self.threshold = parts, cross, threshold
        self.root = list(range(len(sets)))
        # the inverted lists: members[first[t]:first[t + 1]] has the sets with n-gram t, in ascending order
        self.size = np.array([len(x) for x in sets])
        values, self.gram = np.unique(np.concatenate(sets), return_inverse=True)
        self.starts = np.concatenate([[0], np.cumsum(self.size)])
        owner = np.repeat(np.arange(len(sets)), self.size)
        self.members = owner[np.argsort(self.gram, kind="stable")].tolist()
        self.length = np.bincount(self.gram, minlength=len(values))
        self.first = np.concatenate([[0], np.cumsum(self.length)])

    def find(self, i: int) -> int:
        while self.root[i] != i:
            self.root[i] = self.root[self.root[i]]
            i = self.root[i]
        return i

    def union(self, i: int, j: int) -> None:
        i, j = sorted((self.find(i), self.find(j)))
        self.root[j] = i

    @staticmethod
    def occurrences(members: list[int], spans: list[tuple[int, int]], need: int):
        """(member, lists that have it) of members of at least ``need`` of the sorted lists ``members[lo:hi]``, by a heap of their heads that skips ahead."""
        heads = [(members[lo], lo, hi) for lo, hi in spans if lo < hi]
        heapq.heapify(heads)
        while len(heads) >= need:
            member, popped = heads[0][0], []
            while heads and heads[0][0] == member:
                popped.append(heapq.heappop(heads))
            ahead = member + 1
            if len(popped) >= need:
                yield member, len(popped)
            else:  # no member before the head that follows need - 1 popped lists can be in need of them
                while heads and len(popped) < need - 1:
                    popped.append(heapq.heappop(heads))
                if not heads:
                    break
                ahead = max(ahead, heads[0][0])
            for _, lo, hi in popped:
                lo = bisect_left(members, ahead, lo, hi)
                if lo < hi:
                    heapq.heappush(heads, (members[lo], lo, hi))

    @classmethod
    def merged(cls, lists: list[list[int]], need: int) -> list[int]:
        """The members of at least ``need`` of sorted lists."""
        ends = np.cumsum([0, *map(len, lists)]).tolist()
        return [m for m, _ in cls.occurrences([y for x in lists for y in x], list(zip(ends, ends[1:])), need)]

    def star(self) -> np.ndarray:
        """Which sets link with the one that has most of the block's frequent n-grams; they become one component."""
        often = np.add.reduceat(self.length[self.gram], self.starts[:-1]) / self.size
        pivot = int(often.argmax())
        there = np.zeros(len(self.length), bool)
        there[self.gram[self.starts[pivot] : self.starts[pivot + 1]]] = True
        both = np.add.reduceat(there[self.gram].astype(np.int64), self.starts[:-1])
        linked = both * 100 >= self.threshold * (self.size + self.size[pivot] - both)
        for i in np.flatnonzero(linked).tolist():
            self.union(pivot, i)
        return linked

    def searches(self) -> list[int]:
        """The sets to search for: all links are between one of them and another set."""
        if self.cross:
            counts = {p: self.parts.count(p) for p in set(self.parts)}
            fewest = min(counts, key=lambda p: (counts[p], p))
            return [i for i, p in enumerate(self.parts) if p == fewest]
        return np.flatnonzero(~self.star()).tolist()

    def link(self) -> list[int]:
        """The least set in the component of each set."""
        t, members, sizes = self.threshold, self.members, self.size.tolist()
        for x in self.searches():
            gram = self.gram[self.starts[x] : self.starts[x + 1]]
            n, times = len(gram), self.length[gram]
            least = -(-n * t // 100)  # no similar set, of whatever size, has fewer n-grams of x
            gram = gram[times > 1]
            if len(gram) < least:
                continue
            gram = gram[np.argsort(self.length[gram], kind="stable")]
            long = min(least - 1, int(least / (PROBE * math.log2(int(times.max())) + 1)))
            spans = list(zip(self.first[gram].tolist(), self.first[gram + 1].tolist()))
            short, probed = spans[: len(spans) - long], spans[len(spans) - long :]
            for y, found in self.occurrences(members, short, least - long):
                m = sizes[y]
                if m * 100 < t * n or n * 100 < t * m or self.cross and self.parts[x] == self.parts[y] or self.find(x) == self.find(y):
                    continue
                need = -(-t * (n + m) // (100 + t))
                for left, (lo, hi) in zip(range(long, 0, -1), probed):
                    if found >= need or found + left < need:
                        break
                    at = bisect_left(members, y, lo, hi)
                    found += at < hi and members[at] == y
                if found >= need:
                    self.union(x, y)
        return [self.find(i) for i in range(len(sizes))]


def _search(threshold: int):
    def run(key, table):
        table = table.combine_chunks()
        size = table["size"].to_numpy()
        order = np.lexsort((table["b"].to_numpy(), table["a"].to_numpy(), size))
        a, b, part = (table[c].to_numpy()[order].tolist() for c in ("a", "b", "part"))
        raw = table["grams"]
        sets = [np.frombuffer(raw[int(i)].as_buffer(), np.int64) for i in order]
        cross = key[1].as_py() == "L" or key[2].as_py() != key[3].as_py()
        roots = Block(sets, part, cross, threshold).link() if not cross or len(set(part)) > 1 else list(range(len(sets)))
        # rows repeated in full bring a set twice; its copies are one component
        linked = [i for i, r in enumerate(roots) if r != i]
        pick = lambda x, ids: pa.array([x[i] for i in ids], pa.int64())
        heads = [roots[i] for i in linked]
        return pa.table({"a": pick(a, linked), "b": pick(b, linked), "ra": pick(a, heads), "rb": pick(b, heads)})

    return run


def _grams_of(n: int):
    """The n-grams of texts in place of the texts; of rows repeated in full, which meet in a task, the first."""

    def read(batches):
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            ids = list(zip(batch.column("a").to_pylist(), batch.column("b").to_pylist()))
            kept = []
            for i, x in enumerate(ids):
                if x not in seen:
                    seen.add(x)
                    kept.append(i)
            batch = batch.take(pa.array(kept, pa.int64()))
            sets = [g.tobytes() for _, _, data, offsets in tx.groups(batch.column("text")) for g in gram_sets(data, offsets, n)]
            yield pa.record_batch({**{c: batch.column(c) for c in batch.schema.names if c != "text"}, "grams": pa.array(sets, pa.binary())})

    return read


def _near_pivots(threshold: int):
    """Appends, as bits, with which of the row's pivots a set links."""

    def read(batches):
        for batch in batches:
            bits = []
            for own, pivots in zip(batch.column("grams"), batch.column("pivots")):
                g = np.frombuffer(own.as_buffer(), np.int64)
                found = 0
                for k, p in enumerate(pivots):
                    other = np.frombuffer(p["grams"].as_buffer(), np.int64)
                    at = np.minimum(np.searchsorted(other, g), len(other) - 1)
                    both = int((other[at] == g).sum())
                    found |= (both * 100 >= threshold * (len(g) + len(other) - both)) << k
                bits.append(found)
            kept = [c for c in batch.schema.names if c != "pivots"]
            yield pa.record_batch({**{c: batch.column(c) for c in kept}, "bits": pa.array(bits, pa.int32())})

    return read


def _exploded(part: int):
    """(gram, a): a row for each n-gram of a set whose hash falls in a part of the range."""

    def read(batches):
        for batch in batches:
            a = batch.column("a").to_numpy()
            for i in range(0, len(a), 256):
                grams = [np.frombuffer(x.as_buffer(), np.int64) for x in batch.column("grams").slice(i, 256)]
                grams = [g[g % SLICES == part] for g in grams]
                times = [len(g) for g in grams]
                yield pa.record_batch({"gram": pa.array(np.concatenate(grams)), "a": pa.array(np.repeat(a[i : i + 256], times))})

    return read


def _prefix_blocks(large: DataFrame, threshold: int) -> DataFrame:
    """The sets of large blocks in the blocks of their rarest n-grams.

    Of n-grams ordered by the sets that have them, similar sets share one among the first ``size - least overlap + 1`` of
    each. N-grams of one set only come first and are shared with none, so sets with enough n-grams of their own, such as
    texts that have a passage in common, are in no block. The n-grams are dealt a slice of their hashes at a time, and only
    those of several sets are kept, so the shuffle's files never hold all of them."""
    folder = f"{shared_dir(large.sparkSession)}/grams-{uuid.uuid4().hex}"
    for k in range(SLICES):
        each = large.select("a", "grams").mapInArrow(_exploded(k), "gram long, a long")
        freed(lambda df=each: df.withColumn("df", F.count("*").over(Window.partitionBy("gram"))).where("df > 1").write.parquet(f"{folder}/{k}"), large.sparkSession)
    shared = large.sparkSession.read.schema("gram long, a long, df long").parquet(*(f"{folder}/{k}" for k in range(SLICES)))
    own = Window.partitionBy("a")
    ranked = shared.select("gram", "a", F.row_number().over(own.orderBy("df", "gram")).alias("rank"), F.count("*").over(own).alias("shared"))
    first = F.col("size") - F.ceil(F.col("size") * threshold / 100) + 1 - (F.col("size") - F.col("shared"))
    prefix = ranked.join(large.select("a", "size"), "a").where(F.col("rank") <= first).select("gram", "a")
    stars = prefix.withColumn("head", F.min("a").over(Window.partitionBy("gram"))).where("head <> a").select(F.col("a").alias("u"), F.col("head").alias("v")).distinct()
    blocks = components(stars).withColumnRenamed("node", "a").withColumnRenamed("root", "block")
    # blocks are weighed on slim rows, so that n-grams are dealt once
    members = large.select("a", "b", "size").join(blocks, "a")
    weights = members.groupBy("block").agg(F.sum("size").alias("weight"))
    members = members.join(weights, "block").select("block", "a", "b", "size", _parts())
    return members.join(large.select("a", "b", "grams"), ["a", "b"]).select("block", "a", "b", "size", "parts", "grams")


def _parts() -> Column:
    return F.when(F.col("weight") > HELD, F.ceil(F.col("weight") / (HELD // 2))).otherwise(1).cast("int").alias("parts")


def _large_blocks(grams: DataFrame, threshold: int) -> tuple[DataFrame, DataFrame]:
    """(links with pivots, rows of the tasks in which the other pairs meet) of blocks of several parts."""
    which = [F.min_by(F.struct("a", "b"), F.xxhash64(F.lit(k), "a", "b")).alias(f"p{k}") for k in range(PIVOTS)]
    chosen = grams.groupBy("block").agg(*which).select("block", F.posexplode(F.array(*(f"p{k}" for k in range(PIVOTS)))).alias("k", "p")).select("block", "k", "p.a", "p.b")
    # the rows of a block are dealt by (block, salt), and what is told of the block is there for each salt
    salt = F.pmod("b", "parts").cast("int").alias("salt")
    salts = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("salt")
    pivots = chosen.join(grams.select("block", "a", "b", "parts", "grams"), ["block", "a", "b"]).dropDuplicates(["block", "k"])
    pivots = cut(pivots.groupBy("block").agg(F.max("parts").alias("parts"), F.array_sort(F.collect_list(F.struct("k", "a", "b", "grams"))).alias("pivots")))  # PIVOTS for each block
    near = grams.select("*", salt).join(pivots.select("block", salts, "pivots"), ["block", "salt"])
    tested = cut(near.mapInArrow(_near_pivots(threshold), "block long, salt int, a long, b long, size long, parts int, grams binary, bits int"))
    linked = lambda k: F.col("bits").bitwiseAND(1 << k) > 0
    counts = F.array(*(f"n{k}" for k in range(PIVOTS)))
    sums = tested.groupBy("block").agg(F.max("parts").alias("parts"), *(F.count_if(linked(k)).alias(f"n{k}") for k in range(PIVOTS)), *(F.sum(F.when(~linked(k), F.col("size"))).alias(f"s{k}") for k in range(PIVOTS)))
    best = sums.withColumn("k", (F.array_position(counts, F.array_max(counts)) - 1).cast("int")).withColumn("left", F.element_at(F.array(*(f"s{k}" for k in range(PIVOTS))), F.col("k") + 1))
    best = best.select("block", "k", "parts", F.coalesce(F.ceil(F.col("left") / (HELD // 2)), F.lit(0)).cast("int").alias("rests"))
    pivot = F.element_at("pivots", F.col("k") + 1)
    best = best.join(pivots.select("block", "pivots"), "block").select("block", salts, "k", "rests", pivot["a"].alias("ra"), pivot["b"].alias("rb"))
    told = tested.join(best, ["block", "salt"]).withColumn("linked", F.expr("shiftright(bits, k) & 1 = 1"))
    star = told.where("linked AND NOT (a = ra AND b = rb)").select("a", "b", "ra", "rb")
    part = F.pmod("b", F.when(F.col("linked"), F.col("parts")).otherwise(F.col("rests"))).cast("int")
    all_of = lambda n: F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    with_rest = F.transform(all_of(F.col("rests")), lambda r: F.struct(F.lit("L").alias("kind"), F.col("own").alias("i"), r.alias("j"), F.lit(0).alias("part")))
    as_rest = F.transform(all_of(F.col("parts")), lambda p: F.struct(F.lit("L").alias("kind"), p.alias("i"), F.col("own").alias("j"), F.lit(1).alias("part")))
    among = F.transform(all_of(F.col("rests")), lambda r: F.struct(F.lit("R").alias("kind"), F.least("own", r).alias("i"), F.greatest("own", r).alias("j"), F.col("own").alias("part")))
    tasks = F.when(F.col("linked"), with_rest).otherwise(F.concat(as_rest, among))
    met = told.withColumn("own", part).select("block", "a", "b", "size", "grams", F.explode(tasks).alias("t")).select("block", "t.i", "t.j", "t.kind", "a", "b", "size", "t.part", "grams")
    return star, met


def _text_key() -> Column:
    return F.xxhash64("text")


def _known_id(docs: DataFrame) -> Column:
    """doc_id with a value of its own for null, so that joins find it."""
    if isinstance(docs.schema["doc_id"].dataType, IntegralType):
        return F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)))
    return F.coalesce(F.concat(F.lit("="), F.col("doc_id").cast("string")), F.lit(""))


def set_components(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """(rows, classes): doc_id, tk, size, a, b of each row, where tk is a hash of the text and (a, b) the identity of its set;
    and a, b, root_a, root_b, first_id of each set that is not empty, where first_id is its least doc_id."""
    read = tx.in_small_batches(docs).select("doc_id", _text_key().alias("tk"), "text").mapInArrow(_identities(n), f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, tk long, size long, a long, b long")
    rows = cut(read)
    own = F.struct("tk", _known_id(docs).alias("did"))
    sets = rows.where("size > 0").groupBy("a", "b").agg(F.max("size").alias("size"), F.min("doc_id").alias("first_id"), F.min(own).alias("own"))
    shares = docs.select("text").mapInArrow(_shares(n, threshold), "key long, a long, head long")
    met = Window.partitionBy("key").orderBy(F.desc_nulls_first("head"), "a").rowsBetween(Window.unboundedPreceding, 0)
    shares = shares.withColumn("head", F.coalesce("head", F.first("a").over(met))).where("head <> a").select(F.col("a").alias("u"), F.col("head").alias("v")).distinct()
    blocks = components(shares)
    members = sets.select("a", "b", "size", "own").join(blocks.withColumnRenamed("node", "a").withColumnRenamed("root", "block"), "a")
    weights = members.groupBy("block").agg(F.sum("size").alias("weight"))
    members = members.join(weights, "block").select("block", "a", "b", "size", "own.tk", "own.did", _parts())
    texts = docs.select(_text_key().alias("tk"), _known_id(docs).alias("did"), "text").join(members, ["tk", "did"])
    grams = cut(texts.select("block", "a", "b", "size", "parts", "text").mapInArrow(_grams_of(n), "block long, a long, b long, size long, parts int, grams binary"))
    if not grams.where("parts > 1").isEmpty():
        grams = grams.where("parts = 1").unionByName(cut(_prefix_blocks(grams.where("parts > 1"), threshold)))
    small = grams.where("parts = 1").select("block", F.lit(0).alias("i"), F.lit(0).alias("j"), F.lit("S").alias("kind"), "a", "b", "size", F.lit(0).alias("part"), "grams")
    search = lambda met: met.groupBy("block", "kind", "i", "j").applyInArrow(_search(threshold), "a long, b long, ra long, rb long")
    large = grams.where("parts > 1")
    if large.isEmpty():
        found = search(small)
    else:
        star, met = _large_blocks(large, threshold)
        found = search(small.unionByName(met)).unionByName(star)
    links = components(found.select(F.struct("a", "b").alias("u"), F.struct(F.col("ra").alias("a"), F.col("rb").alias("b")).alias("v")))
    links = links.select("node.a", "node.b", F.col("root.a").alias("root_a"), F.col("root.b").alias("root_b"))
    classes = sets.select("a", "b", "first_id").join(links, ["a", "b"], "left").select("a", "b", F.coalesce("root_a", "a").alias("root_a"), F.coalesce("root_b", "b").alias("root_b"), "first_id")
    return rows.select("doc_id", "tk", "size", "a", "b"), classes


def join_components(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """doc_id, n_shingles, component_id for each row of ``docs``, repeated rows included.

    A null or wordless text has an empty set and is linked with nothing, so its component is its own doc_id. A null doc_id
    counts for no component's least doc_id; where no other is there the component is null. A very long text is compared
    whole, as the set of its n-grams. Equal texts, and texts of equal sets, are always of one component. Other columns are not
    read. An empty table gives an empty table."""
    rows, classes = set_components(docs, n, threshold)
    least = classes.groupBy("root_a", "root_b").agg(F.min("first_id").alias("component_id"))
    of_set = classes.join(least, ["root_a", "root_b"]).select("a", "b", "component_id")
    out = rows.join(of_set, ["a", "b"], "left")
    return out.select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("size") > 0, F.col("component_id")).otherwise(F.col("doc_id")).alias("component_id"))


def distinct_documents(docs: DataFrame, n: int = N, threshold: int = THRESHOLD) -> DataFrame:
    """The rows of ``docs`` of which one of each component stays, the one of the least doc_id (then text hash); nulls come last. Wordless texts all stay, but for rows repeated in full."""
    rows, classes = set_components(docs, n, threshold)
    key = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "tk")
    first = rows.where("size > 0").groupBy("a", "b").agg(F.min(key).alias("first")).join(classes, ["a", "b"]).groupBy("root_a", "root_b").agg(F.min("first").alias("first"))
    kept = first.select("first.tk", "first.doc_id").unionByName(rows.where("size = 0").select("tk", "doc_id").distinct())
    did = _known_id(docs).alias("did")
    whole = docs.select(_text_key().alias("tk"), did, F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"))
    return whole.join(kept.select("tk", did), ["tk", "did"], "left_semi").dropDuplicates(["tk", "did"]).select("row.*")
