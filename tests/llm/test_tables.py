"""Joins, mixes, shards, media and tokens against brute force and round trips."""

import hashlib
import random
import struct
import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
import sentencepiece

from knotwork.llm import decontamination, jaccard, media, mixing, sharding, tokens
from tests.llm.conftest import DOCS, prose

MODEL = public_tokenizers.path("piece_bpe_32k.model")


def shingles(text, n=3):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").split()
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def components_of(sets, t=90):
    root = list(range(len(sets)))

    def find(x):
        return x if root[x] == x else find(root[x])

    for i in range(len(sets)):
        for j in range(i):
            k = len(sets[i] & sets[j])
            if k and 100 * k >= t * (len(sets[i]) + len(sets[j]) - k):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(sets))]


def near_copies(rng, n=240):
    """Texts of which many differ by a few words, in groups of all sizes, with a long common passage."""
    passage = prose(rng, "en", 60)
    out = []
    for g in range(12):
        base = prose(rng, rng.choice(["en", "de"]), rng.choice([2, 5, 11, 40, 150])) + (" " + passage if g % 3 == 0 else "")
        for _ in range(n // 12):
            words = base.split()
            for _ in range(rng.choice([0, 0, 1, 1, 2, 5])):
                words[rng.randrange(len(words))] = f"w{rng.randrange(10**6)}"
            out.append(" ".join(words))
    return out


@pytest.mark.parametrize("n,threshold", [(3, 90), (5, 80)])
@pytest.mark.parametrize("held", [None, 300])
def test_similar_documents_against_all_pairs(spark, held, n, threshold, monkeypatch):
    if held:  # blocks dealt in parts
        monkeypatch.setattr(jaccard, "HELD", held)
    texts = near_copies(random.Random(8)) + [None, "", " ", "one", "ONE", "two words", "two  WORDS"]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).repartition(5)
    sets = [shingles(t, n) for t in texts]
    root = components_of(sets, threshold)
    want = {i: (len(s), root[i] if s else i) for i, s in enumerate(sets)}
    assert len(set(root)) < len(texts) - 50
    got = {r["doc_id"]: (r["n_shingles"], r["component_id"]) for r in jaccard.join_components(df, n, threshold).collect()}
    assert got == want
    kept = sorted(r["doc_id"] for r in jaccard.distinct_documents(df, n, threshold).collect())
    assert kept == sorted({v[1] for v in want.values()})


def test_similar_sets_share_a_segment():
    rng = np.random.default_rng(5)
    bounds = jaccard.size_classes(90, 2000)
    wide = jaccard.size_classes(80, 2000)
    for n in [*range(1, 40), 99, 100, 101, 450]:
        g = np.unique(rng.integers(-(1 << 62), 1 << 62, n))
        for drop in range(0, n // 5 + 1, max(1, n // 15)):
            other = np.unique(np.concatenate([rng.permutation(g)[drop:], rng.integers(-(1 << 62), 1 << 62, max(0, (5 * (n - drop) - 4 * n) // 4))]))
            assert np.intersect1d(jaccard.segment_keys(g, wide, 80), jaccard.segment_keys(other, wide, 80)).size, (n, drop)
        for drop in range(n // 9 + 2):
            for add in range(n // 9 + 2):
                if 100 * (n - drop) < 90 * (n + add) or drop >= n:
                    continue
                other = np.unique(np.concatenate([rng.permutation(g)[drop:], rng.integers(-(1 << 62), 1 << 62, add)]))
                assert np.intersect1d(jaccard.segment_keys(g, bounds), jaccard.segment_keys(other, bounds)).size, (n, drop, add)


@pytest.mark.parametrize("threshold,n,most", [(90, 8, 3), (90, 30, 3), (90, 100, 3), (90, 1000, 3), (80, 15, 200), (80, 30, 600), (80, 100, 200), (80, 1000, 20)])
def test_unrelated_sets_share_no_segment(threshold, n, most):
    rng, many = np.random.default_rng(19), min(20_000, 1_000_000 // n)
    bounds = jaccard.size_classes(threshold, 4 * n)
    keys = np.concatenate([jaccard.segment_keys(np.sort(rng.integers(-(1 << 63), (1 << 63) - 1, n)), bounds, threshold) for _ in range(many)])
    assert np.unique(keys, return_counts=True)[1].max() <= most


def test_links_of_a_block_against_all_pairs():
    rng = np.random.default_rng(20)
    for cross in (False, True):
        for _ in range(40):
            bases = [np.unique(rng.integers(0, 5000, rng.integers(5, 120))) for _ in range(4)]
            sets = []
            for _ in range(40):
                g = bases[rng.integers(4)]
                sets.append(np.unique(np.concatenate([rng.permutation(g)[rng.integers(0, len(g) // 8 + 1) :], rng.integers(0, 5000, rng.integers(0, len(g) // 10 + 1))])))
            parts = rng.integers(0, 2, len(sets)).tolist()
            got = jaccard.Block(sets, parts, cross, 80).link()
            root = list(range(len(sets)))
            for i in range(len(sets)):
                for j in range(i):
                    both = len(np.intersect1d(sets[i], sets[j]))
                    if 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both) and (not cross or parts[i] != parts[j]):
                        a, b = sorted((root[i], root[j]))
                        root = [a if x == b else x for x in root]
            assert got == root


def test_ids_that_are_strings(spark):
    texts = near_copies(random.Random(21), 60)
    df = spark.createDataFrame([(f"d{i:03}" if i else None, t) for i, t in enumerate(texts)], "doc_id string, text string")
    root = components_of([shingles(t) for t in texts])
    name = lambda k: min((f"d{i:03}" for i, x in enumerate(root) if x == k and i), default=None)
    assert {(r["doc_id"], r["component_id"]) for r in jaccard.join_components(df).collect()} == {(f"d{i:03}" if i else None, name(k)) for i, k in enumerate(root)}


def test_heap_merge():
    rng = random.Random(6)
    for _ in range(300):
        lists = [sorted(rng.sample(range(30), rng.randrange(0, 12))) for _ in range(rng.randrange(1, 7))]
        c = Counter(x for l in lists for x in l)
        for need in range(1, len(lists) + 1):
            assert jaccard.Block.merged(lists, need) == sorted(x for x, n in c.items() if n >= need)


def waterfall(sizes, total, weights):
    target, open_ = {}, set(sizes)
    while True:
        level = (total - sum(target.values())) / sum(weights[s] for s in open_) if open_ else 0
        over = {s for s in open_ if level * weights[s] > 2 * sizes[s]}
        if not over:
            return target | {s: level * weights[s] for s in open_}
        target |= {s: Fraction(2 * sizes[s]) for s in over}
        open_ -= over


def test_mix(docs):
    rows = docs.collect()
    size = lambda t: len((t or "").split())
    sizes = Counter()
    for r in rows:
        sizes[r["source"]] += size(r["text"])
    names = sorted((s for s in sizes if s is not None)) + [None]
    want = waterfall(sizes, Fraction(3, 2) * sum(sizes.values()), {s: (5, 2, 1)[i % 3] for i, s in enumerate(names)})
    source = {str((r["doc_id"], size(r["text"]))): r["source"] for r in rows}
    got = mixing.mix(docs).collect()
    taken = Counter()
    for r in got:
        s = source[str((r["doc_id"], r["size"]))]
        assert abs(r["target"] - float(want[s])) < 1e-6 and r["source_size"] == sizes[s] and 0 <= r["taken"] <= 2 * r["size"]
        assert r["taken"] == sum(t["words"] for t in r["takes"]) and all(0 <= t["position"] < 1 for t in r["takes"])
        taken[s] += r["taken"]
    assert all(abs(taken[s] - float(want[s])) <= 0.5 for s in sizes)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))
    order = [r["position"] for r in mixing.training_order(mixing.mix(docs)).collect()]
    assert order == sorted(order) and len(order) == sum(len(r["takes"]) for r in got)


def test_a_source_whose_target_rounds_to_nothing(spark):
    rows = [(k, "word" if s in "ADGI" else None, "en", s, 1) for k, s in enumerate("ABCDEFGHI")]
    got = {r["doc_id"]: r for r in mixing.mix(spark.createDataFrame(rows, DOCS)).collect()}
    small = [r for r in got.values() if 0 < r["target"] < 0.5]
    assert small and all(r["taken"] == 0 and r["takes"] == [] for r in small) and sum(r["taken"] for r in got.values()) > 0
    assert mixing.mixed_documents(spark.createDataFrame(rows, DOCS)).count() > 0


def test_positions_invert_the_schedule(spark):
    from pyspark.sql import functions as F

    rows = [(k / 10, a) for k in range(11) for a in (-1.0, -0.5, 0.0, 0.7, 1.0) if not (a == 1.0 and k == 0)]
    for r in spark.createDataFrame(rows, "u double, a double").select("u", "a", mixing._position(F.col("u"), F.col("a")).alias("t")).collect():
        assert abs((1 - r["a"]) * r["t"] + r["a"] * r["t"] ** 2 - r["u"]) < 1e-9


def test_best_fit_against_a_plain_search():
    rng = random.Random(1)
    for _ in range(200):
        sizes, capacity = [rng.randint(1, 30) for _ in range(rng.randint(0, 60))], rng.randint(20, 40)
        room, want = [], [0] * len(sizes)
        for i in sorted(range(len(sizes)), key=lambda i: (-sizes[i], i)):
            fits = [(r, b) for b, r in enumerate(room) if r >= sizes[i]]
            want[i] = min(fits)[1] if fits else len(room)
            if not fits:
                room.append(capacity)
            room[want[i]] -= sizes[i]
        assert sharding.best_fit_decreasing(sizes, capacity) == want


def test_the_tree_stays_balanced():
    tree, rng = sharding.CapacityTree(), random.Random(2)
    keys = [(rng.randrange(10**6), i) for i in range(2000)]
    for k in keys:
        tree.add(k)
    for k in keys[:1000]:
        tree.remove(k)
    assert tree.root.height <= 15 and tree.tightest(0) == min(keys[1000:]) and tree.tightest(10**7) is None


@pytest.mark.parametrize("shards", [1, 4, 16])
def test_shards(docs, shards):
    rows = sharding.pack(docs, shards).collect()
    texts = {(r["doc_id"], len((r["text"] or "").encode()) + 1): (r["text"] or "") for r in docs.collect()}
    load, slots, group = Counter(), defaultdict(list), {}
    for r in rows:
        t = texts[r["doc_id"], r["size"]]
        assert r["text_crc32"] == zlib.crc32(t.encode()) and r["law"] == "bytes" and r["grown_shard"] is None and 0 <= r["shard"] < shards
        assert group.setdefault(t, r["shard"]) == r["shard"]
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    largest = max(Counter({t: sum(r["size"] for r in rows if texts[r["doc_id"], r["size"]] == t) for t in {""} | {max(texts.values(), key=len)}}).values())
    assert max(load.values()) <= max(largest, sum(load.values()) / shards * 1.1 + 200)


@pytest.mark.parametrize("share", [3, 10])
def test_a_large_group_leaves_no_shard_empty(spark, share):
    rng = random.Random(15)
    texts = [f"{i} " + "x" * rng.randrange(100, 200) for i in range(2000)]
    many = sum(map(len, texts)) // (share - 1) // 100
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts + ["y" * 99] * many)], DOCS)
    load = Counter()
    for r in sharding.pack(df).collect():
        load[r["shard"]] += r["size"]
    loads = sorted(load[s] for s in range(16))
    assert loads[-1] == 100 * many and loads[0] > 0 and loads[-2] <= 1.02 * sum(loads[:-1]) / 15


def test_items_above_the_mean_stand_alone():
    rng = random.Random(16)
    assert len(set(sharding.pack_into([10] * 17, 16))) == 16
    assert sorted(Counter(sharding.pack_into([50, 30, *[1] * 60], 5)).values()) == [1, 1, 20, 20, 20]
    for _ in range(200):
        sizes, shards = [rng.choice([1, 2, 3, 50, 200]) for _ in range(rng.randrange(40))], rng.randrange(1, 9)
        placed = sharding.pack_into(sizes, shards)
        assert len(placed) == len(sizes) and len(set(placed)) == min(shards, len(sizes)) and all(0 <= s < shards for s in placed)


def test_shards_of_a_capacity(docs):
    rows = sharding.pack(docs, None, 20_000).collect()
    load = Counter()
    for r in rows:
        load[r["shard"]] += r["size"]
    assert sum(n > 20_000 for n in load.values()) <= 1 and len(load) <= 3 + sum(load.values()) // 20_000


def test_cells_of_a_capacity(spark, monkeypatch):
    monkeypatch.setattr(sharding, "CELL", 8)
    rng = random.Random(17)
    texts = ["y" * 30_000] * 3 + [str(i) + "x" * rng.randrange(2000) for i in range(1500)]
    df = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in enumerate(texts)], DOCS).repartition(4)
    rows = sharding.pack(df, None, 40_000).collect()
    load, group, slots = Counter(), {}, defaultdict(list)
    for r in rows:
        load[r["shard"]] += r["size"]
        slots[r["shard"]].append(r["slot"])
        assert group.setdefault(texts[r["doc_id"]], r["shard"]) == r["shard"]
    wanted = -(-sum(load.values()) // 40_000)
    assert sorted(load) == list(range(len(load))) and len(load) <= wanted + -(-wanted // 8) + 2
    assert sorted(load.values())[-1] == 3 * 30_001 and sorted(load.values())[-2] <= 40_000
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


def test_slots_follow_the_order_of_the_files(spark, tmp_path):
    df = spark.range(500).selectExpr("id AS doc_id", "concat('text ', hash(id)) AS text", "hash(id) AS position")
    df.orderBy("position").drop("position").write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    want = {r["doc_id"]: r["position"] for r in df.collect()}
    slots = defaultdict(dict)
    for r in sharding.pack(docs, 4, order=sharding.stored_order(docs)).collect():
        slots[r["shard"]][r["slot"]] = want[r["doc_id"]]
    assert all([s[k] for k in range(len(s))] == sorted(s.values()) for s in slots.values()) and sum(map(len, slots.values())) == 500
    assert sharding.stored_order(df) is None


def png(rows, kinds, width):
    """An image whose rows have the given filters, written from their definition."""
    lines, prior = b"", [0] * width
    for row, kind in zip(rows, kinds):
        out = []
        for i, x in enumerate(row):
            a, b, c = row[i - 1] if i else 0, prior[i], prior[i - 1] if i else 0
            p = a + b - c
            paeth = min((abs(p - a), 0, a), (abs(p - b), 1, b), (abs(p - c), 2, c))[2]
            out.append((x - [0, a, b, (a + b) // 2, paeth][kind]) % 256)
        lines += bytes([kind, *out])
        prior = row
    head = struct.pack(">IIBBBBB", width, len(rows), 8, 0, 0, 0, 0)
    return media.SIGNATURE + media._chunk(b"IHDR", head) + media._chunk(b"tEXt", b"x") + media._chunk(b"IDAT", zlib.compress(lines)) + media._chunk(b"IEND", b"")


def test_all_filters_are_undone():
    rng = random.Random(3)
    for _ in range(20):
        w, h = rng.randint(1, 9), rng.randint(1, 12)
        rows = [[rng.randrange(256) for _ in range(w)] for _ in range(h)]
        assert media.decode(png(rows, [rng.randrange(5) for _ in range(h)], w)).tolist() == rows


def test_broken_images_are_refused():
    good = media.encode(media.padded(b"x" * 500))
    for bad in (b"", good[:-5], good[:40] + bytes([good[40] ^ 1]) + good[41:], good[:-12]):
        with pytest.raises((ValueError, struct.error)):
            media.decode(bad)


def test_media_round_trip(docs):
    texts = {r["doc_id"]: r["text"] for r in docs.where("doc_id IS NOT NULL").collect()}
    images = {r["doc_id"]: r["media"] for r in media.media_table(docs).collect()}
    feature = {}
    for r in media.media_features(docs).where("doc_id IS NOT NULL").collect():
        raw = (texts[r["doc_id"]] or "").encode()
        payload = raw + bytes(max(64, -(-len(raw) // 64) * 64) - len(raw))
        assert media.decode(bytes(images[r["doc_id"]])).tobytes() == payload
        assert (r["n_bytes"], r["payload_bytes"], r["payload_sha256"]) == (len(raw), len(payload), hashlib.sha256(payload).hexdigest())
        assert (r["tail_crc32"], r["media_bytes"], r["media_sha256"]) == (zlib.crc32(payload[-64:]), len(images[r["doc_id"]]), hashlib.sha256(images[r["doc_id"]]).hexdigest())
        assert feature.setdefault(raw, r["feature"]) == r["feature"] and len(r["feature"]) == 16
    assert len(set(feature.values())) > len(feature) * 0.8


def test_low_frequencies_survive_small_changes():
    rng = np.random.default_rng(7)
    smooth = media._LOW.T @ rng.normal(size=(8, 8)) @ media._LOW
    image = np.kron(smooth / np.abs(smooth).max() * 120 + 128, np.ones((4, 2))).astype(np.uint8)
    noisy = np.clip(image.astype(int) + rng.integers(-4, 5, image.shape), 0, 255).astype(np.uint8)
    far = lambda a, b: bin(int(a, 16) ^ int(b, 16)).count("1")
    h = media.low_frequency_hash(image)
    assert far(h, media.low_frequency_hash(noisy)) <= 6 < far(h, media.low_frequency_hash(rng.integers(0, 256, image.shape).astype(np.uint8)))


def test_token_counts_and_prefixes(spark, docs):
    library = sentencepiece.SentencePieceProcessor(model_file=MODEL)
    texts = {r["doc_id"]: r["text"] or "" for r in docs.where("doc_id IS NOT NULL").collect()}
    for r in tokens.count_tokens(docs, MODEL).where("doc_id IS NOT NULL").collect():
        t = texts[r["doc_id"]]
        assert (r["n_tokens"], r["n_bytes"]) == (len(library.encode(t)), len(t.encode())) and r["over_limit"] == (r["n_tokens"] > 4096)
    counter, rng = tokens.PrefixCounter(MODEL), random.Random(2)
    for _ in range(3000):
        s = "".join(rng.choice(["a", "the", " ", "  ", "\n", "▁", "é", "🙂", "<s>", "lo", "\t", "."]) for _ in range(rng.randint(0, 12)))
        table = counter.table(s)
        assert counter.total(s) == len(library.encode(s)) == (table[-1] if table else 0)
        k, budget = rng.randint(0, len(s)), rng.randint(0, 8)
        assert counter.at(s, table, k) == len(library.encode(s[:k]))
        assert len(library.encode(s[: counter.fit(s, table, budget)])) <= budget


def test_stored_prefix_tables(spark):
    from pyspark.sql import functions as F

    library, rng = sentencepiece.SentencePieceProcessor(model_file=MODEL), random.Random(4)
    odd = ["".join(rng.choice(["tion", "re", "ing", "A", "é", "漢", "字", "🙂", "7", "-", " ", "  ", "\n", "<s>", "▁"]) for _ in range(rng.randrange(1, 40))) for _ in range(150)]
    texts = ["one two  three", "", None, "x" * 300, "漢字かな" * 40, prose(rng, "de", 80), " lead and trail  ", *odd]
    stored = spark.createDataFrame([(t,) for t in texts], "text string").withColumn("prefix", tokens.prefix_counts(F.col("text"), MODEL))
    got = stored.select("text", "prefix", tokens.truncation(F.col("prefix"), 9).alias("fit"), tokens.tokens_at(F.col("prefix"), 5).alias("five")).collect()
    for r in got:
        text = r["text"] or ""
        want = [len(library.encode(text[:k])) for k in range(len(text) + 1)]
        assert r["prefix"] == want[1:]
        assert r["fit"] == max(k for k, n in enumerate(want) if n <= 9) and r["five"] == want[min(5, len(text))]


def test_prefix_counts_need_no_library():
    counter, rng = tokens.PrefixCounter(MODEL), random.Random(5)
    library = counter.library
    for _ in range(2000):
        unit = "▁" + "".join(rng.choice(["tion", "re", "ing", "the", "A", "é", "漢", "🙂", "7", "-", "q", "\n"]) for _ in range(rng.randrange(1, 9)))
        assert counter.counts(unit) == [1, *(len(library.encode(unit[1:k])) for k in range(2, len(unit) + 1))]


def test_benchmark_passages(spark):
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(5))
    common = [word() for _ in range(40)]
    text = lambda n: " ".join(rng.choice(common) if rng.random() < 0.5 else word() for _ in range(n))
    items = [text(rng.choice([12, 30, 45, 70])) for _ in range(30)] + ["tiny item", "", None]
    rows, want = [], set()
    for i in range(200):
        body = text(rng.choice([20, 150, 900])).split()
        if i % 4 == 0:
            k = rng.randrange(30)
            passage = items[k].split()
            if i % 8 == 0:  # a paraphrase: a fifth of the words changed, and some added
                passage = [word() if rng.random() < 0.15 else w for w in passage]
                passage.insert(rng.randrange(len(passage)), word())
            at = rng.randrange(len(body))
            body[at:at] = passage
            want.add((i, k))
        rows.append((i, " ".join(body).capitalize(), "en", "s", 1))
    rows += [(500, None, "en", "s", 1), (501, f"{word()} tiny item {word()}", "en", "s", 1), (502, f"tiny {word()} item", "en", "s", 1)]
    want.add((501, 30))
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect()}
    exact = {(d, k) for d, k in want if d % 8}
    assert exact <= got and len(got & want) >= 0.9 * len(want) and not got - want
    clean = {r["doc_id"] for r in decontamination.clean_documents(docs, bench).collect()}
    assert clean == {r[0] for r in rows} - {d for d, _ in got}


def test_verbatim_passages_whatever_surrounds_them(spark):
    rng = random.Random(13)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(8))
    rare = lambda n: " ".join(word() for _ in range(n))
    everyday = [word() for _ in range(15)]
    hot, five, long = rare(30), rare(5), rare(96)
    plain = " ".join(rng.choice(everyday) for _ in range(20))
    bodies, want = [], set()
    for i in range(120):
        passages = [(0, hot)] * (i % 3 == 0) + [(1, five)] * (i % 40 == 1) + [(2, plain)] * (i % 40 == 5)
        passages += [(3, " ".join(long.split()[26:70]))] * (i % 40 == 7)  # over the seam of the item's two parts
        passages += [(4, everyday[0] + "zz")] * (i == 11)
        bodies.append((i, " ".join([rare(60), *(t + " " + rare(60) for _, t in passages), " ".join(f"{w} {word()}" for w in everyday)])))
        want |= {(i, k) for k, _ in passages}
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in bodies], DOCS).repartition(3)
    bench = spark.createDataFrame(list(enumerate([hot, five, plain, long, everyday[0] + "zz"])), "item_id long, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect()} == want
    assert {r["doc_id"] for r in decontamination.clean_documents(docs, bench).collect()} == set(range(120)) - {d for d, _ in want}


@pytest.mark.parametrize("shared", [(1, 1), (5, 5), (12, 2), (40, 21)])
def test_however_widely_a_passage_leaked(spark, shared):
    rng, (n, leaked) = random.Random(18), shared
    passage = prose(rng, "en", 25)
    rows = [(str(i), prose(rng, "de", 50) + (" " + passage if i < leaked else ""), "en", "s", 1) for i in range(n)]
    docs = spark.createDataFrame(rows, DOCS.replace("doc_id long", "doc_id string"))
    bench = spark.createDataFrame([("q1", passage), ("q2", prose(rng, "fr", 25))], "item_id string, text string")
    assert {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, bench).collect()} == {(str(i), "q1") for i in range(leaked)}


def hashes(text):
    import pyarrow as pa

    from knotwork.llm import text as tx

    (_, _, data, offsets), = tx.groups(pa.array([text or ""]))
    return tx.words(data, offsets, core=True)[0].view(np.int64)


def test_the_whole_query_against_all_windows(spark):
    from pathlib import Path

    folder = Path("/root/testdata/sf0.001")
    if not folder.is_dir():
        pytest.skip("no test tables here")
    from knotwork.llm.queries import op7_decontamination

    docs = {r["doc_id"]: hashes(r["text"]) for r in spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text").collect()}
    parts = [(r["item_id"], np.array(r["words"], np.int64)) for r in decontamination.passages(spark.read.parquet(f"{folder}/benchmark.parquet")).collect()]
    want, verbatim = set(), set()
    for doc, words in docs.items():
        for item, passage in parts:
            n = len(passage)
            there = np.concatenate([[0], np.cumsum(np.isin(words, passage))])
            for at in range(0, max(1, len(words) - n), max(1, n // 2)):
                to = min(len(words), at + 3 * n)
                if there[to] - there[at] < decontamination.COVER * min(n, 16):  # too few words for any subsequence
                    continue
                window = words[at:to]
                if any((window[i : i + n] == passage).all() for i in np.flatnonzero(window[: len(window) - n + 1] == passage[0])):
                    verbatim.add((doc, item))
                if n >= decontamination.SHORT and decontamination.covered(passage, decontamination.common_subsequence(passage, window)):
                    want.add((doc, item))
    got = {(r["doc_id"], r["item_id"]) for r in op7_decontamination(spark, str(folder)).collect()}
    assert verbatim and verbatim <= got <= want | verbatim and len(got) >= 0.9 * len(want | verbatim)


def test_changed_and_lost_words_leave_enough_pairs():
    rng = np.random.default_rng(14)
    none = np.zeros(0, np.int64)
    for n in [*range(1, 60)]:
        words = rng.integers(1, 1 << 62, n)
        searcher = decontamination.Searcher([(7, 0, words)], np.ones(1 << decontamination.BITS, np.float32), np.unique(decontamination._terms(words.view(np.uint64))), np.zeros((len(np.unique(decontamination._terms(words.view(np.uint64)))), 1), np.float32))
        for _ in range(20):
            left = words.copy()
            if n >= decontamination.SHORT:  # as many words out as the cover allows, outside the answer
                out = rng.permutation(n - decontamination.ANSWER)[: n - int(np.ceil(decontamination.COVER * n))] if n >= 12 else none
                left[out] = rng.integers(1, 1 << 62, len(out))
                left = np.delete(left, out[: rng.integers(0, len(out) + 1)])
            text = np.concatenate([rng.integers(1, 1 << 62, 70), left, rng.integers(1, 1 << 62, 70)])
            assert (0, 7) in searcher.links(text.view(np.uint64), np.array([0, len(text)])), n


def searcher_of(items, rank=1):
    terms = np.unique(decontamination._terms(np.concatenate([w for _, _, w in items]).view(np.uint64)))
    return decontamination.Searcher(items, np.ones(1 << decontamination.BITS, np.float32), terms, np.zeros((len(terms), rank), np.float32))


def test_pairs_of_few_words_are_counted_with_their_repeats():
    rng = np.random.default_rng(15)
    few = rng.integers(1, 1 << 62, 5)
    for n in range(8, 49):
        words, other = few[rng.integers(0, 5, n)], few[rng.integers(0, 5, n)]
        searcher = searcher_of([(7, 0, words), (8, 0, other)])
        for _ in range(5):
            out = rng.permutation(n - decontamination.ANSWER)[: n - int(np.ceil(decontamination.COVER * n))] if n >= 12 else np.zeros(0, np.int64)
            left = words.copy()
            left[out] = rng.integers(1, 1 << 62, len(out))
            left = np.delete(left, out[: rng.integers(0, len(out) + 1)])
            text = np.concatenate([few[rng.integers(0, 5, rng.integers(0, 300))], left, few[rng.integers(0, 5, rng.integers(0, 300))]])
            assert (0, 7) in searcher.links(text.view(np.uint64), np.array([0, len(text)])), n


def test_small_batches_and_pieces_change_nothing(monkeypatch):
    rng = np.random.default_rng(16)
    words = rng.integers(1, 1 << 62, 300)
    share = 1 / np.arange(1, 301)
    items = [(i, 0, rng.choice(words, int(n), p=share / share.sum())) for i, n in enumerate(rng.integers(1, 49, 60))]
    text = rng.choice(words, 4_000, p=share / share.sum())
    for i in range(30):
        at = rng.integers(0, len(text) - 60)
        text[at : at + len(items[i][2])] = items[i][2]
    text[:len(items[31][2])], text[len(text) - len(items[32][2]) :] = items[31][2], items[32][2]
    h, first = text.view(np.uint64), np.array([0, len(text)])
    want = set(searcher_of(items).links(h, first))
    assert {(0, 31), (0, 32)} <= want and len(want) > 25
    monkeypatch.setattr(decontamination, "SPREAD", 256)
    assert set(searcher_of(items).links(h, first)) == want
    monkeypatch.setattr(decontamination, "WORDS", 160)
    assert set(searcher_of(items).links(h, first)) == want
    halves = np.array([0, 1_000, 1_000, 2_500, len(text)])
    got = searcher_of(items).links(h, halves)
    assert {(d, i) for d, i in got} == {(d, i) for d in range(4) for _, i in searcher_of(items).links(h[halves[d] : halves[d + 1]], np.array([0, halves[d + 1] - halves[d]]))}


def test_repeats_of_frequent_words_are_passed_over():
    rng = np.random.default_rng(17)
    words, share = rng.integers(1, 1 << 62, 20_000), 1 / np.arange(1, 20_001)
    items = [(i, 0, rng.choice(words, 48, p=share / share.sum())) for i in range(2_000)]
    searcher = searcher_of(items)
    tried = []
    searcher._shared_words = lambda code, first, doc, at, item: tried.append(len(at)) or np.zeros(len(at), np.int64)
    for text in (np.repeat(words[:1], 100_000), np.tile(words[:3], 30_000)):
        assert not searcher.links(text.view(np.uint64), np.array([0, len(text)]))
    # the few passages with half the pairs they need are tried, as two stretches are counted apart; all with the pair were, before
    having = sum(1 for _, _, w in items if (decontamination._pairs(w.view(np.uint64)) == decontamination._pairs(words[[0, 0]].view(np.uint64))).any())
    assert having > 400 and sum(tried) < 190_000  # places of both texts, for each of which one passage


def test_rounds_of_a_large_benchmark(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "ROUND", 4)
    rng = random.Random(10)
    items = [(i, prose(rng, "en", 30)) for i in range(12)]
    docs = spark.createDataFrame([(i, prose(rng, "de", 50) + " " + t, "en", "s", 1) for i, t in items], DOCS)
    got = {(r["doc_id"], r["item_id"]) for r in decontamination.contaminated(docs, spark.createDataFrame(items, "item_id long, text string")).collect()}
    assert {(i, i) for i in range(12)} <= got


def test_longest_common_subsequence():
    rng = np.random.default_rng(11)
    for _ in range(100):
        a, b = rng.integers(0, 6, rng.integers(0, 12)), rng.integers(0, 6, rng.integers(0, 15))
        table = np.zeros((len(a) + 1, len(b) + 1), int)
        for i in range(len(a)):
            for j in range(len(b)):
                table[i + 1, j + 1] = table[i, j] + 1 if a[i] == b[j] else max(table[i, j + 1], table[i + 1, j])
        found = decontamination.common_subsequence(a, b)
        assert len(found) == table[-1, -1] and found == sorted(set(found))


def test_latent_space_of_passages(spark):
    rng = random.Random(12)
    parts = decontamination.passages(spark.createDataFrame([(i, prose(rng, "en", 40)) for i in range(25)], "item_id long, text string"))
    lists = [np.array(r["words"]) for r in parts.orderBy("item_id", "part").collect()]
    idf = np.ones(1 << decontamination.BITS, np.float32)
    terms = np.unique(decontamination._terms(np.concatenate(lists).view(np.uint64)))
    space = decontamination.latent_space(parts, idf, terms, rank=8, steps=6)
    row, term, x = decontamination._rows(lists, idf)
    m = np.zeros((len(lists), len(terms)))
    m[row, np.searchsorted(terms, term)] = x
    best = np.linalg.svd(m)[1][:8]
    assert np.allclose(space.T @ space, np.eye(8), atol=1e-4) and np.linalg.norm(m @ space) > 0.98 * np.linalg.norm(best)
