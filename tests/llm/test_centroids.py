"""Integer k-means against a plain version in Python integers, and edge rows."""

import hashlib
import math
import random

import numpy as np
import pytest

from attrition.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, distance string, q string"


def plain(rows, k, rounds, dims):
    kept = []
    for vec_id, v, *_ in rows:
        if v is None or len(v) != dims or any(x is None or not math.isfinite(x) for x in v):
            continue
        kept.append((vec_id, [max(-2 ** 62, min(2 ** 62, math.floor(256 * x))) for x in v]))
    order = sorted(kept, key=lambda r: (r[0] is None, hashlib.sha256(
        f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))
    cs = [q for _, q in order[:k]]

    def assign():
        return [min((sum((a - b) ** 2 for a, b in zip(q, c)), j) for j, c in enumerate(cs)) for _, q in kept]

    for _ in range(rounds):
        best = assign()
        cs = [[sum(col) // len(mine) for col in zip(*mine)] if (mine := [
            q for (_, q), (_, b) in zip(kept, best) if b == j]) else c for j, c in enumerate(cs)]
    best = assign()
    top = 2 ** 63 - 1
    per = {j: sum(min(d, top) for d, b in best if b == j) for j in range(len(cs))}
    return sorted([(i, b, min(d, top), min(per[b], top), min(sum(per.values()), top),
                    hashlib.sha256(",".join(map(str, cs[b])).encode()).hexdigest())
                   for (i, _), (d, b) in zip(kept, best)], key=str)


def got(df, **kw):
    out = centroids.cluster(df, **kw)
    assert out.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    return sorted((tuple(r) for r in out.collect()), key=str)


def made(n=160, dims=6):
    r = random.Random(8)
    rows = [(i, [r.gauss(i % 5, 0.4) for _ in range(dims)], "x", "y") for i in range(n)]
    rows += [(1000 + i, [0.5] * dims, "x", "y") for i in range(60)]  # one very common vector
    rows += [rows[3], rows[3], (None, [1.0] * dims, "x", "y"), (None, [2.0] * dims, None, None)]
    rows += [(2000, None, "x", "y"), (2001, [1.0] * (dims - 1), "x", "y"), (2002, [None] + [1.0] * (dims - 1), "x", "y"),
             (2003, [float("nan")] * dims, "x", "y"), (2004, [float("-inf")] * dims, "x", "y"), (2005, [], "x", "y")]
    return rows


@pytest.mark.parametrize("share", [0.2, 0.95])
def test_equals_plain_version(spark, share):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(4)
    assert got(df, k=9, rounds=3, dimensions=6, share=share) == plain(rows, 9, 3, 6)


def test_few_vectors_ties_huge_values_and_empty(spark):
    rows = [(i, [float(i % 2), 0.0], "a", "b") for i in range(6)]  # ties between equal centroids
    assert got(spark.createDataFrame(rows, SCHEMA), k=40, dimensions=2) == plain(rows, 40, 5, 2)
    rows += [(50, [1e30, -1e30], "a", "b"), (51, [9e5, 3.0], "a", "b"), (52, [-7e5, 1e-300], "a", "b")]
    assert got(spark.createDataFrame(rows, SCHEMA), k=3, rounds=2, dimensions=2) == plain(rows, 3, 2, 2)
    assert got(spark.createDataFrame([], SCHEMA)) == []
    assert got(spark.createDataFrame([(1, None, "a", "b")], SCHEMA)) == []


def test_bound_never_exceeds_the_distance():
    r = np.random.default_rng(1)
    q = r.integers(-400, 400, (300, 16)) * np.linspace(3, 0.1, 16).astype(int).clip(1)
    c = q[:20].astype(object)
    _, axes = np.linalg.eigh(np.cov(q.T))
    for leading in (1, 5, 15):
        z, cz = (centroids.rotated(x, q.mean(axis=0), axes[:, ::-1][:, :leading]) for x in (q, c))
        low = ((z[:, None] - cz[None]) ** 2).sum(axis=2)
        true = ((q[:, None] - c[None].astype(int)) ** 2).sum(axis=2)
        assert (low <= true * (1 + 1e-9) + 1e-6).all()
        best, d, pairs = centroids.nearest(q, z, c, cz)
        assert (best == true.argmin(axis=1)).all() and (d == true.min(axis=1)).all()
        assert leading < 15 or pairs < true.size / 4  # the filter does filter
