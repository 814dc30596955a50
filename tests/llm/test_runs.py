"""Periodic runs against a search of every period."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest

from knotwork.llm import queries, runs

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(w, least):
    """(start, length, period): every stretch in which words q apart agree, with its smallest period."""
    found, n = {}, len(w)
    for q in range(1, n // 2 + 1):
        i = q
        while i < n:
            if w[i] != w[i - q]:
                i += 1
                continue
            j = i
            while j < n and w[j] == w[j - q]:
                j += 1
            if j - i >= q and j - i + q >= least:
                found.setdefault((i - q, j), q)
            i = j
    return sorted((s, e - s, q) for (s, e), q in found.items())


def periodic(w, h):
    n, g = len(w), h // 10
    if h % 10 or not n:
        return w
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]


def sequences():
    rng = random.Random(3)
    out = [[0] * 50, [0, 1] * 30, [], [0], [0, 0], list(range(40))]
    a, b = [0], [0, 1]
    for _ in range(9):
        a, b = b, b + a
    out.append(b)  # a Fibonacci word
    thue = [0]
    for _ in range(7):
        thue += [1 - x for x in thue]
    out.append(thue)
    for k in range(300):
        size, letters = rng.randrange(1, 90), rng.choice([1, 2, 2, 3, 5, 30])
        w = [rng.randrange(letters) for _ in range(size)]
        if k % 2:
            i, p = rng.randrange(size), rng.randrange(1, 12)
            w = w[:i] + (w[i : i + p] * rng.randrange(1, 9)) + w[i:]
        if k % 5 == 0:
            w = w * rng.randrange(1, 5) + w[: rng.randrange(len(w))]
        out.append(w)
    return out


@pytest.mark.parametrize("least", [2, 5, 12])
def test_runs_of_many_texts_at_once(least):
    texts = sequences()
    offsets = np.cumsum([0, *map(len, texts)])
    codes = np.concatenate([np.array(w, np.int64) + 1000 * t for t, w in enumerate(texts)])
    for w, found in zip(texts, runs.find_runs(codes, offsets, least), strict=True):
        assert found == brute(w, least), w


def test_previous_factors_with_and_without_jumps(monkeypatch):
    rng = np.random.default_rng(1)
    for letters in (1, 2, 4):
        w = rng.integers(0, letters, 120)
        got = []
        for most in (1024, 0):
            monkeypatch.setattr(runs, "JUMPS", most)
            got.append(runs.previous_factors(runs.classes(w)))
        length, source = got[0]
        assert (length == got[1][0]).all()
        for i in range(len(w)):
            best = max((next((k for k in range(len(w) - i) if w[i + k] != w[j + k]), len(w) - i) for j in range(i)), default=0)
            assert length[i] == best
            for s in (source[i], got[1][1][i]):
                assert best == 0 or (s < i and (w[s : s + best] == w[i : i + best]).all())


def test_texts_without_a_repeat_are_left_out():
    rng = np.random.default_rng(2)
    h = rng.integers(1, 1 << 63, 400, dtype=np.uint64)
    h[306:312] = h[300:306]
    assert runs.may_repeat(h, np.array([0, 200, 200, 305, 400])).tolist() == [False, False, False, False]
    assert runs.may_repeat(h, np.array([0, 200, 300, 400])).tolist() == [False, False, True]


def expected(doc_id, text, seeded=True):
    w = WORD.findall(text or "")
    if seeded and doc_id is not None:
        w = periodic(w, zlib.crc32(str(doc_id).encode()))
    found = brute(w, 12)
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    best = min(found, key=lambda r: (-r[1], r[0], r[2]), default=None)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    digests = (sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(" ".join(x for i, x in enumerate(w) if i not in gone)))
    return (doc_id, len(w), len(found), *(best or (None, None, None)), 1000 * best[1] // best[2] if best else None, *digests)


COLUMNS = ["doc_id", "n_words", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"]


def test_the_whole_query_against_brute_force(spark, tmp_path):
    rng = random.Random(7)
    words = "the of and über x a​ to in is 12, que".split(" ")
    rows = [(i, rng.choice([" ", "\n", "\t ", "\x0b"]).join(rng.choice(words) if i % 3 else f"{rng.choice(words)}{rng.randrange(90)}" for _ in range(rng.randrange(150)))) for i in range(120)]
    rows += [(200, "spam egg " * 900), (201, ("a b c " * 5 + "d ") * 40), (202, None), (203, ""), (None, "x " * 30), (None, None), (5, rows[5][1])]
    spark.createDataFrame(rows, "doc_id long, text string").repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.op12_runs(spark, str(tmp_path)).select(COLUMNS).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1], r[7])
    assert sorted(map(tuple, got), key=key) == sorted((expected(*r) for r in rows), key=key)
    assert sum(r["n_runs"] > 0 for r in got) >= 10


def test_the_operator_itself(spark):
    docs = spark.createDataFrame([("k", "go " * 20 + "on"), ("m", "no runs here")], "doc_id string, text string")
    got = {r["doc_id"]: r for r in runs.text_runs(docs).collect()}
    assert [tuple(x) for x in got["k"]["runs"]] == [(0, 20, 1)] and bytes(got["k"]["collapsed"]) == b"go on"
    assert got["m"]["runs"] == [] and bytes(got["m"]["collapsed"]) == b"no runs here"
