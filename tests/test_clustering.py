"""Clusters against a linkage and a density tree of whole distance matrices."""

from collections import defaultdict

import numpy as np
import pytest

from knotwork.operators import clustering, density

SCHEMA = "entity_type string, name string, embedding array<double>"


def blobs(seed, n, groups, dims=6, spread=0.12):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(groups, dims))
    return centres[rng.integers(0, groups, n)] + rng.normal(size=(n, dims)) * spread * rng.uniform(0.3, 3, (n, 1))


def table(spark, types):
    rows = [(t, f"{t}{i:05d}", None if v is None else [float(x) for x in v]) for t, vs in types.items() for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


def groups(df):
    out = defaultdict(set)
    for r in df.collect():
        out[r["cluster_id"]].add(r["name"])
    assert all(k == f"{min(v).rstrip('0123456789')}_cluster_{min(v)}" for k, v in out.items())
    return sorted(map(sorted, out.values()))


def distances(vectors):
    unit = np.array(vectors, float)
    unit = unit / np.linalg.norm(unit, axis=1, keepdims=True)
    return 1 - unit @ unit.T


def naive_average(vectors, threshold):
    d, parts = distances(vectors), [[i] for i in range(len(vectors))]
    while len(parts) > 1:
        mean, i, j = min((d[np.ix_(a, b)].mean(), i, j) for i, a in enumerate(parts) for j, b in enumerate(parts) if i < j)
        if mean > threshold:
            break
        parts[i] += parts.pop(j)
    return parts


def naive_density(vectors, least, samples):
    """Top down over whole matrices: split at the longest edge of the tree of what is left."""
    d = distances(vectors)
    if samples > 1:
        core = np.sort(d + np.diag([np.inf] * len(d)), axis=1)[:, min(samples, len(d) - 1) - 1]
        d = np.maximum(d, np.maximum(core[:, None], core[None]))
    d = np.maximum(d, density.NEAR)
    clusters = []  # (points at the beginning, stability, children)

    def parts(points, at):
        """Components of points by edges under ``at``."""
        left, out = set(points), []
        while left:
            todo = [left.pop()]
            found = set(todo)
            while todo:
                x = todo.pop()
                more = {y for y in left if d[x, y] < at}
                left -= more
                found |= more
                todo += more
            out.append(sorted(found))
        return out

    def longest(points):
        inside, out = {points[0]}, 0.0
        while len(inside) < len(points):
            w, y = min((d[x, y], y) for x in inside for y in points if y not in inside)
            out = max(out, w)
            inside.add(y)
        return out

    def walk(points, birth):
        me, stability, now = len(clusters), 0.0, points
        clusters.append(None)
        children = []
        while len(now) > 1:
            at = longest(now)
            split = parts(now, at)
            big = [p for p in split if len(p) >= least]
            stability += sum(len(p) for p in split if len(p) < least or len(big) > 1) * (1 / at - birth)
            if len(big) != 1:
                children = [walk(p, 1 / at) for p in big]
                break
            now = big[0]
        clusters[me] = (points, stability, children)
        return me

    walk(list(range(len(d))), 0.0)

    def best(c):
        points, stability, children = clusters[c]
        inside = [best(x) for x in children]
        total = sum(s for s, _ in inside)
        return (total, [p for _, ps in inside for p in ps]) if c == 0 or total > stability else (stability, [points])

    return best(0)[1]


@pytest.mark.parametrize("most", [4000, 15])
def test_average_linkage_in_tasks_and_in_rounds(spark, monkeypatch, most):
    monkeypatch.setattr(clustering, "MOST", most)
    monkeypatch.setattr(clustering, "PART", 25)
    types = {"a": blobs(1, 60, 2), "b": blobs(2, 20, 20), "c": blobs(3, 1, 1), "d": np.concatenate([blobs(4, 20, 2), [[1.0, 0, 0, 0, 0, 0]] * 9])}
    df = table(spark, {**types, "e": [None, None, [1.0] * 6]})
    got = groups(clustering.cluster_entities(df, 0.75))
    want = []
    for t, vs in types.items():
        if len(vs) > 1:
            want += [sorted(f"{t}{i:05d}" for i in p) for p in naive_average(vs, 0.25)]
    assert got == sorted(want)


def test_over_four_thousand_similar_entities(spark):
    rng = np.random.default_rng(7)
    near = np.array([[1.0, 0, 0, 0]] * 4100) + rng.normal(size=(4100, 4)) * 0.05
    far = np.array([[0, 0, 0, 1.0]] * 3)
    got = groups(clustering.cluster_entities(table(spark, {"s": np.concatenate([near, far]), "t": [[1.0, 0], [0.99, 0.1], [0, 1.0]]}), 0.75))
    assert [len(g) for g in got if g[0][0] == "s"] == [4100, 3]
    assert [g for g in got if g[0][0] == "t"] == [["t00000", "t00001"], ["t00002"]]


@pytest.mark.parametrize("edges", [1_000_000, 60])
@pytest.mark.parametrize(("least", "samples"), [(2, 1), (4, 3)])
def test_density_clusters(spark, monkeypatch, edges, least, samples):
    monkeypatch.setattr(clustering, "EDGES", edges)
    monkeypatch.setattr(clustering, "PART", 25)
    types = {"a": blobs(5, 90, 4), "b": blobs(6, 30, 5, spread=0.4), "c": blobs(7, 2, 1), "d": blobs(8, 60, 1)}
    got = groups(clustering.density_clusters(table(spark, {**types, "e": [None, [1.0] * 6]}), least, samples))
    want = [sorted(f"{t}{i:05d}" for i in p) for t, vs in types.items() for p in naive_density(vs, least, samples)]
    assert got == sorted(want)


def test_density_of_copies(spark):
    vs = [[1.0, 0.0]] * 6 + [[0.0, 1.0]] * 5
    assert groups(clustering.density_clusters(table(spark, {"a": vs}))) == [[f"a{i:05d}" for i in range(6)], [f"a{i:05d}" for i in range(6, 11)]]


def test_nothing_to_cluster(spark):
    for rows in ([], [("a", "x", [1.0, 0.0])], [("a", "x", None), ("a", "y", None)]):
        df = spark.createDataFrame(rows, SCHEMA)
        assert clustering.cluster_entities(df).count() == 0 and clustering.density_clusters(df).count() == 0


def test_spanning_edges_of_two_sides():
    rng = np.random.default_rng(9)
    for n, m in ((1, 1), (5, 3), (30, 40), (0, 4)):
        d = rng.random((n, m))
        a, b, w = density.spanning_edges(d, False)
        assert len(w) == (n + m - 1 if n and m else 0) and (d[a, b] == w).all()
        if len(w):
            root = list(range(n + m))
            find = lambda x: x if root[x] == x else find(root[x])
            total = 0.0
            for k in np.argsort(d, axis=None):
                x, y = find(k // m), find(n + k % m)
                if x != y:
                    root[x] = y
                    total += d.flat[k]
            assert np.isclose(total, w.sum())
