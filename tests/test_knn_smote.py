"""Exact k-NN against brute force (also with many cells and tiny chunks),
and SMOTE's balance and geometry."""

import numpy as np
import pytest
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from attrition.operators.knn import knn
from attrition.operators.resample import smote_base_of, smote_vectors
from conftest import SF001


def _brute(pdf, k):
    out = {}
    for g, grp in pdf.groupby("label"):
        ids = grp["vec_id"].values
        x = np.vstack(grp["embedding"].values).astype(np.float64)
        d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
        for a in range(len(ids)):
            order = sorted((d[a, b], ids[b]) for b in range(len(ids)) if b != a)[:k]
            out[ids[a]] = [i for _, i in order]
    return out


@pytest.mark.parametrize("pivots,chunk", [(None, 2048), (6, 8), (3, 5)])
def test_knn_matches_brute_force(spark, pivots, chunk):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet")
    want = _brute(emb.toPandas(), 5)
    got = {}
    for r in knn(emb, "vec_id", "embedding", k=5, group_col="label", n_pivots=pivots,
                 chunk_size=chunk).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append(r.neighbor_id)
    assert got == want


def test_knn_boxes_leave_most_blocks_out(spark):
    """On indicator columns a block sees a small share of the others, and misses none it needs."""
    from attrition.operators import knn as K
    gen = np.random.default_rng(3)
    x = np.hstack([gen.integers(0, 2, (8000, 12)) * 3.0, gen.normal(0, 0.3, (8000, 3))])
    tree, counts = K._tree(x[:1000], 128)
    cell = K._cell_of(x, tree)
    assert len(counts) == 128 and sum(counts) == 1000 and np.bincount(cell, minlength=128).min() > 10
    members = [np.flatnonzero(cell == c) for c in range(128)]
    h = np.arange(8000)
    seen = 0
    for c in range(0, 128, 16):
        q = members[c]
        bounds = K._own_bounds(x[q], h[q], 3)
        true = np.sort(((x[q][:, None] - x[None]) ** 2).sum(axis=2), axis=1)[:, 1:4]
        assert (bounds >= true[:, 2]).all()
        for m in members:
            gap = K._outside(x[q], x[m].min(axis=0), x[m].max(axis=0))
            seen += bool((gap <= bounds).any())
            near = ((x[q][:, None] - x[m][None]) ** 2).sum(axis=2).min(axis=1)
            assert (gap <= near + 1e-9).all()
    assert seen < 0.5 * 8 * 128
    assert (K._unpacked(K._packed(x[:700])) == x[:700]).all()


def test_knn_of_equal_points_repeated_ids_and_missing_values(spark):
    rows = [(i, [0.0, 1.0]) for i in range(40)] + [(100 + i, [5.0 + i, float(i % 3)]) for i in range(30)]
    rows += [(7, [0.0, 1.5]), (200, [float("nan"), 0.0]), (201, [float("inf"), 0.0]), (202, [None, 0.0])]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = {}
    for r in knn(df, "vec_id", "embedding", k=4, chunk_size=6, n_pivots=5).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append((round(r.distance, 9), r.neighbor_id))
    fine = [(i, np.array(v)) for i, v in rows if i < 200]
    want = {}
    for i, v in fine:
        near = sorted((round(float(np.sqrt(((v - w) ** 2).sum())), 9), j) for j, w in fine if j != i)[:4]
        want.setdefault(i, []).extend(near)
    assert got == {i: sorted(v)[:4] for i, v in want.items()}


@pytest.fixture(scope="module")
def prepared(spark):
    from attrition.plans.models import prepare
    from attrition.plans import catalog
    return prepare(catalog.raw(spark, SF001), resample="none")


def test_smote_balances_and_interpolates(spark, prepared):
    train = prepared.train
    res = smote_vectors(train, k=5).cache()
    counts = {r.churn: r["count"] for r in res.groupBy("churn").count().collect()}
    assert counts[0] == counts[1]
    syn = res.where("is_synthetic").select("customer_id", vector_to_array("features").alias("v")).toPandas()
    mino = train.where("churn = 1").select("customer_id", vector_to_array("features").alias("v")).toPandas()
    vec = {r.customer_id: np.array(r.v) for r in mino.itertuples()}
    ids = list(vec)
    x = np.vstack([vec[i] for i in ids])
    for r in syn.sample(n=min(40, len(syn)), random_state=0).itertuples():
        base = vec[smote_base_of(r.customer_id)]
        d = np.sqrt(((x - base) ** 2).sum(1))
        nn = [ids[j] for j in np.argsort(d)[1:6]]
        s = np.array(r.v)
        ok = False
        for n in nn:  # s = base + t (nb - base), 0 <= t <= 1
            seg = vec[n] - base
            t = float(seg @ (s - base) / (seg @ seg))
            if -1e-9 <= t <= 1 + 1e-9 and np.allclose(base + t * seg, s, atol=1e-9):
                ok = True
        assert ok
