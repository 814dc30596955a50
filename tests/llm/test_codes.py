"""Vector codes against plain integers."""

import hashlib
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from knotwork.llm import codes

SCHEMA = "vec_id long, embedding array<float>, label int"


def plain(rows, parts=4, entries=256, rounds=4):
    """vec_id, label, code, error, label_error, digest, by Python integers."""
    kept = [(i, v, k) for i, v, k in rows if v is not None and all(x is not None and math.isfinite(x) for x in v)]
    kept = [(i, [math.floor(1024 * x) for x in v], k) for i, v, k in kept]
    if not kept:
        return []
    ordered = sorted(kept, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    length = len(ordered[0][1])
    fits = [r for r in kept if len(r[1]) == length]
    w = length // parts
    cut = lambda v, p: v[p * w : (p + 1) * w]
    books = [[list(cut(r[1], p)) for r in ordered if len(r[1]) == length][:entries] for p in range(parts)]
    dist = lambda a, b: sum((x - y) ** 2 for x, y in zip(a, b))
    near = lambda v, p: min((dist(cut(v, p), c), e) for e, c in enumerate(books[p]))
    for _ in range(rounds):
        of = [[near(v, p)[1] for p in range(parts)] for _, v, _ in fits]
        for p in range(parts):
            for e in range(len(books[p])):
                own = [cut(v, p) for (_, v, _), es in zip(fits, of) if es[p] == e]
                if own:
                    books[p][e] = [sum(x) // len(own) for x in zip(*own)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    out = []
    for i, v, k in kept:
        if len(v) != length:
            out.append((i, k, None, None))
            continue
        got = [near(v, p) for p in range(parts)]
        out.append((i, k, "".join(f"{e:02x}" for _, e in got), sum(d for d, _ in got)))
    total = {k: [e for _, j, _, e in out if j == k and e is not None] for k in {r[1] for r in out}}
    return [(*r, sum(total[r[1]]) if total[r[1]] else None, digest) for r in out]


def check(spark, rows, **kwargs):
    got = codes.compress(spark.createDataFrame(rows, SCHEMA).repartition(3), **kwargs)
    assert got.columns == ["vec_id", "label", "code", "error", "label_error", "codebooks_sha256"]
    key = lambda r: tuple((x is None, x if x is not None else 0) for x in r)
    assert sorted(map(tuple, got.collect()), key=key) == sorted(plain(rows, **kwargs), key=key)


def vectors(rng, n, length=16, size=1.0):
    return [(i, [np.float32(rng.gauss(0, size)).item() for _ in range(length)], rng.choice([None, 1, 2, 3])) for i in range(n)]


def test_against_integers(spark):
    rng = random.Random(4)
    rows = vectors(rng, 330)
    rows += [(1000 + i, rows[i % 7][1], 9) for i in range(60)]  # copies: entries tie
    rows += [(2000, None, 1), (2001, [None, *[0.5] * 15], 1), (2002, [math.nan, *[0.5] * 15], 2), (2003, [math.inf, *[0.5] * 15], 2), (None, [0.25] * 16, None), (5, rows[5][1], 3), (5, [0.0] * 16, 3), (2004, [0.1] * 12, 4), (2005, [], 4), (2006, [-0.0] * 16, 77)]
    rng.shuffle(rows)
    check(spark, rows)
    check(spark, rows, entries=5, rounds=2)


def test_few_and_no_vectors(spark):
    check(spark, [(3, [0.5, -0.5, 0.0001, -0.0001], 1), (3, [0.5, -0.5, 0.0001, -0.0001], None)])
    for rows in ([], [(1, None, 1)], [(1, [math.nan] * 4, 1)]):
        got = codes.compress(spark.createDataFrame(rows, SCHEMA))
        assert got.count() == 0 and got.columns[2] == "code"


def test_screening_is_exact_where_float32_is_not():
    rng = np.random.default_rng(6)
    for size in (3, 1 << 12, 1 << 24, 1 << 28):
        book = rng.integers(-size, size, (64, 8))
        book[1::2] = book[::2] + rng.integers(-1, 2, (32, 8))  # neighbours that float32 cannot tell apart
        book[10] = book[3]
        x = np.concatenate([book + rng.integers(-1, 2, book.shape), (book[::2] + book[1::2]) // 2, rng.integers(-size, size, (200, 8))])
        want = [min((sum((int(a) - int(b)) ** 2 for a, b in zip(v, c)), e) for e, c in enumerate(book)) for v in x]
        index, distance = codes.nearest(x, book)
        assert list(zip(distance.tolist(), index.tolist())) == want


def test_components_beyond_64_bits_and_lengths_that_cannot_be_cut(spark):
    with pytest.raises(Exception, match="do not fit 64 bits"):
        codes.compress(spark.createDataFrame([(1, [1e12, 0.0, 0.0, 0.0], 1)], SCHEMA))
    with pytest.raises(ValueError, match="cannot be cut"):
        codes.compress(spark.createDataFrame([(1, [1.0] * 6, 1)], SCHEMA))


def test_labels_that_are_too_many_to_be_sent(spark):
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else i % 7, f"{i:02x}", i) for i in range(200)], "vec_id long, label int, code string, error long")
    a, b = (sorted(map(str, codes.with_label_error(rows, most=m).collect())) for m in (1000, 2))
    assert a == b and len(a) == 200


def test_columns_of_clashing_names(spark):
    rows = vectors(random.Random(8), 40)
    plain_ = spark.createDataFrame(rows, SCHEMA)
    clash = plain_.select("*", *(F.lit("x").alias(c) for c in ("code", "error", "cell", "total", "label_error", "__label", "__own")))
    assert sorted(map(str, codes.compress(clash).collect())) == sorted(map(str, codes.compress(plain_).collect()))


def test_ids_and_labels_of_any_type(spark):
    rows = [(f"v{i:03d}", [float(i), 1.0, 2.0, float(i % 3)], f"l{i % 2}") for i in range(30)]
    got = codes.compress(spark.createDataFrame(rows, "vec_id string, embedding array<double>, label string")).collect()
    assert len(got) == 30 and {r["error"] for r in got} == {0}
