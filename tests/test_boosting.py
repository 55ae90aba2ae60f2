"""Second-order boosting: against a plain fit, over slices and in one task,
leaf-wise order, exact attribution."""

import itertools
import math
from dataclasses import replace

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from attrition.functions import trees as T
from attrition.plans import boosting as B

SPEC = T.BoostSpec(rounds=6, step=0.3, max_depth=4, l1=0.2, l2=0.7, min_gain=0.05, min_child_weight=0.5,
                   min_rows=2, subsample=1.0, colsample=1.0, pos_weight=2.0)


def data(n=300, seed=0, features=5):
    r = np.random.default_rng(seed)
    x = r.normal(size=(n, features))
    x[:, 1] = r.integers(0, 2, n)
    x[:, 2] = r.integers(0, 6, n)
    y = (x[:, 0] + x[:, 1] * x[:, 2] / 3 + r.normal(size=n) * 0.5 > 0.7).astype(float)
    return x, y


def frame(spark, x, y, fold=None):
    rows = [(f"c{i}", float(y[i]), Vectors.dense(x[i]), int(-1 if fold is None else fold[i])) for i in range(len(y))]
    return spark.createDataFrame(rows, ["customer_id", "label", "features", "fold"])


def plain_tree(x, g, h, spec, cuts):
    """Best-first growth by looping over every (feature, cut) of every node."""
    def score(rows):
        gs, hs = g[rows].sum(), h[rows].sum()
        return max(abs(gs) - spec.l1, 0) ** 2 / (hs + spec.l2) if hs + spec.l2 > 0 else 0.0

    def split(rows, depth):
        best = None
        if depth < spec.max_depth:
            for f, edges in enumerate(cuts):
                for c in edges:
                    a, b = rows[x[rows, f] <= c], rows[~(x[rows, f] <= c)]
                    if min(len(a), len(b)) < max(spec.min_rows, 1) or \
                            min(h[a].sum(), h[b].sum()) < spec.min_child_weight:
                        continue
                    gain = score(a) + score(b) - score(rows)
                    if gain > max(spec.min_gain, T.LEAST_GAIN) and (best is None or gain > best[0] + 1e-12):
                        best = (gain, f, c, a, b)
        return best

    root = {"rows": np.arange(len(x)), "depth": 0}
    root["split"] = split(root["rows"], 0)
    leaves, order = [root], []
    while len(leaves) < (spec.max_leaves or 10 ** 9) and any(n["split"] for n in leaves):
        node = max((n for n in leaves if n["split"]), key=lambda n: n["split"][0])
        leaves = [n for n in leaves if n is not node]
        gain, f, c, a, b = node["split"]
        order.append((gain, f, c))
        for rows in (a, b):
            child = {"rows": rows, "depth": node["depth"] + 1}
            child["split"] = split(rows, child["depth"])
            leaves.append(child)
    out = np.zeros(len(x))
    for n in leaves:
        gs, hs = g[n["rows"]].sum(), h[n["rows"]].sum()
        out[n["rows"]] = -math.copysign(max(abs(gs) - spec.l1, 0), gs) / (hs + spec.l2) * spec.step
    return out, order, len(leaves)


def plain_fit(x, y, spec, cuts):
    w = np.where(y == 1, spec.pos_weight, 1.0)
    margin, shapes = np.zeros(len(y)), []
    for _ in range(spec.rounds):
        g, h = T.gradients(margin, y, w)
        step, order, leaves = plain_tree(x, g * T.UNIT, h * T.UNIT, spec, cuts)
        margin = margin + step
        shapes.append((order, leaves))
    return margin, shapes


def cuts_of(layout):
    return [list(layout.cuts[a:b - 1]) for a, b in zip(layout.starts, layout.starts[1:])]


@pytest.mark.parametrize("spec", [SPEC, replace(SPEC, max_leaves=6, max_depth=7), replace(SPEC, l1=0.0, l2=0.0)])
def test_equals_a_plain_fit(spark, spec):
    x, y = data()
    table = B.bin_table(frame(spark, x, y, np.zeros(len(y))).repartition(3), fold=F.col("fold"), max_bins=16)
    (model,), scores = B.fit_boosted(table, [B.BoostJob(spec, 0, 0)])
    want, shapes = plain_fit(x, y, spec, cuts_of(table.layout))
    assert np.allclose(model.margins(x), want, atol=1e-9)
    got = {r["id"]: r["margin"] for r in scores.collect()}
    assert np.allclose([got[f"c{i}"] for i in range(len(y))], want, atol=1e-9)
    for t, (order, leaves) in enumerate(shapes):
        at = slice(model.roots[t], model.roots[t + 1])
        assert (model.feature[at] < 0).sum() == leaves <= (spec.max_leaves or 10 ** 9)
        gains = sorted(model.gain[at][model.feature[at] >= 0], reverse=True)
        assert np.allclose(gains, sorted((g for g, *_ in order), reverse=True))


def test_best_first_keeps_the_largest_gains(spark):
    """63 leaves of a depth of 7: the queue's order, not the level's, decides."""
    x, y = data(2000, 3)
    spec = T.BoostSpec(rounds=1, max_depth=7, max_leaves=20, l2=0.0, subsample=1.0, colsample=1.0)
    table = B.bin_table(frame(spark, x, y), max_bins=32)
    (model,), _ = B.fit_boosted(table, [B.BoostJob(spec)])
    _, shapes = plain_fit(x, y, replace(spec, pos_weight=1.0), cuts_of(table.layout))
    order, leaves = shapes[0]
    assert leaves == 20 == (model.feature < 0).sum()
    depths = {len(path) for _, path in model.paths()}
    assert len(depths) > 1  # not a full level
    assert {(int(f), float(t)) for f, t in zip(model.feature, model.threshold) if f >= 0} == {(f, c) for _, f, c in order}


def test_slices_folds_and_partitions_give_the_same_trees(spark):
    x, y = data(400, 5)
    x[::17, 0] = np.nan
    fold = np.arange(len(y)) % 3
    df = frame(spark, x, y, fold)
    sets = sum((F.when(F.col("fold") != s, 1 << s).otherwise(0) for s in range(3)), F.lit(0)).cast("long")
    lean = T.BoostSpec(rounds=3, max_depth=3, subsample=0.7, colsample=0.6, pos_weight=None, from_prior=True)
    jobs = [B.BoostJob(replace(s, seed=7), f, f) for s in (lean, replace(lean, rounds=2, max_leaves=5, max_depth=5))
            for f in range(3)]
    results = []
    for parts, slice_rows in ((1, 10_000), (5, 10_000), (4, 50)):
        table = B.bin_table(df.repartition(parts), 3, sets, F.col("fold"), 16)
        models, scores = B.fit_boosted(table, jobs, slice_rows)
        results.append(([m.to_bytes() for m in models],
                        sorted((r["job"], r["id"], r["margin"]) for r in scores.collect())))
    assert results[0] == results[1] == results[2]
    rows = results[0][1]
    assert len(rows) == 2 * len(y)  # each row once per kind of model, by the fold that leaves it out
    assert all(int(i[1:]) % 3 == jobs[j].fold for j, i, _ in rows)
    margin = {(j, i): m for j, i, m in rows}
    models = B.fit_boosted(table, jobs, 10_000)[0]
    for j, job in enumerate(jobs):
        own = np.flatnonzero(fold == job.fold)
        assert np.allclose(models[j].margins(x[own]), [margin[j, f"c{i}"] for i in own])


def test_one_class_empty_and_unlabelled(spark):
    x, y = data(40, 1)
    (model,), _ = B.fit_boosted(B.bin_table(frame(spark, x, np.ones(40))), [B.BoostJob(T.BoostSpec(rounds=3))])
    assert (model.probabilities(x) > 0.5).all()
    df = frame(spark, x, y)
    table = B.bin_table(df.withColumn("label", F.lit(None).cast("double")))
    (model,), _ = B.fit_boosted(table, [B.BoostJob(T.BoostSpec(rounds=2))])
    assert (model.margins(x) == 0).all()
    (model,), scores = B.fit_boosted(B.bin_table(df.limit(0)), [B.BoostJob(T.BoostSpec(rounds=2), 0, 0)])
    assert scores.count() == 0 and model.expected() == 0


def expectation(model, tree, node, x, known):
    f = model.feature[node]
    if f < 0:
        return model.value[node]
    kids = model.left[node], model.left[node] + 1
    if f in known:
        return expectation(model, tree, kids[0] if x[f] <= model.threshold[node] else kids[1], x, known)
    return sum(model.cover[k] / model.cover[node] * expectation(model, tree, k, x, known) for k in kids)


def test_attribution_equals_subset_enumeration(spark):
    x, y = data(200, 9)
    x[3, 0] = x[7, 2] = np.nan
    spec = T.BoostSpec(rounds=4, step=0.4, max_depth=6, subsample=0.8, colsample=1.0, l2=0.1)
    df = frame(spark, x, y)
    (model,), _ = B.fit_boosted(B.bin_table(df, max_bins=16), [B.BoostJob(spec)])
    n = x.shape[1]
    got = model.attributions(x[:12])
    for row, phi in zip(x[:12], got):
        worth = {s: sum(expectation(model, t, r, row, s) for t, r in enumerate(model.roots[:-1]))
                 for k in range(n + 1) for s in map(frozenset, itertools.combinations(range(n), k))}
        for i in range(n):
            others = [j for j in range(n) if j != i]
            want = sum(math.factorial(k) * math.factorial(n - k - 1) / math.factorial(n)
                       * (worth[frozenset(s) | {i}] - worth[frozenset(s)])
                       for k in range(n) for s in itertools.combinations(others, k))
            assert phi[i] == pytest.approx(want, abs=1e-9)
    assert np.allclose(model.attributions(x).sum(axis=1), model.margins(x) - model.expected())
    scored = B.BoostedScoreModel("m", model).attributions(df.repartition(2)).collect()
    by_id = {r["customer_id"]: r["attributions"] for r in scored}
    assert np.allclose([by_id[f"c{i}"] for i in range(len(y))], model.attributions(x))
    back = T.TreeEnsemble.from_bytes(model.to_bytes())
    assert (back.margins(x) == model.margins(x)).all() and model.importances().sum() == pytest.approx(1)


def test_indicator_columns_are_summed_like_the_others():
    """Sums by matrix products, and rows moved on level by level, against plain counts and walks."""
    gen = np.random.default_rng(8)
    layout = T.Layout.of([[0.5], [], [0.1, 0.4, 0.7], [0.0], [0.2, 0.9]])
    x = np.column_stack([gen.integers(0, 2, 70_000), np.zeros(70_000), gen.random(70_000),
                         gen.integers(0, 2, 70_000), gen.random(70_000)]).astype(float)
    code = layout.binned(x)
    slot = gen.integers(-1, 6, 70_000)
    slot[slot == 3] = -1
    g, h = np.rint(gen.normal(0, 1 << 20, 70_000)), np.rint(gen.random(70_000) * (1 << 18))
    plain = T.histograms(code, slot, g, h, 6, layout.width)
    assert (T.histograms(code, slot, g, h, 6, layout.width, layout) == plain).all()
    assert (T.histograms(code, np.full(70_000, -1), g, h, 6, layout.width, layout) == 0).all()
    feature = layout.feature_of()
    bins, left = np.array([0, layout.starts[2] + 1, -1, -1, -1], np.int32), np.array([1, 3, -1, -1, -1], np.int32)
    node = np.zeros(len(code), np.int64)
    for _ in range(3):
        node = T.stepped(code, node, bins, left, feature)
    assert (node == T.walk(code, bins, left, feature)).all()


def test_packed_columns_give_the_same_sums():
    gen = np.random.default_rng(4)
    n = 5_000
    layout = T.Layout.of([[0.5]] * 11 + [[], [0.1, 0.4, 0.7], list(np.linspace(0.02, 0.98, 63))])
    x = np.column_stack([gen.integers(0, 2, (n, 11)), np.zeros(n), gen.random((n, 2))]).astype(float)
    x[::7, 3] = x[::9, 13] = np.nan
    code = layout.binned(x)
    slot = gen.integers(-1, 6, n)
    slot[slot == 3] = -1
    g, h = np.rint(gen.normal(0, 1 << 20, n)), np.rint(gen.random(n) * (1 << 18))
    packed = T.PackedCode(code, layout)
    assert len(packed.columns) + len(packed.bytes) == 4  # of 14 features
    assert (packed.histograms(slot, g, h, 6) == T.histograms(code, slot, g, h, 6, layout.width)).all()
    assert (packed.histograms(np.full(n, -1), g, h, 2) == 0).all()


def block_of(x, y, layout, seed=0):
    n = len(y)
    return B.Block(layout.binned(x), y.astype(np.uint8), np.ones(n, np.int64), np.full(n, -1, np.int32),
                   np.random.default_rng(seed).integers(0, 2 ** 63, n).astype(np.uint64), [f"c{i}" for i in range(n)])


@pytest.mark.parametrize("spec", [SPEC, replace(SPEC, max_leaves=5, max_depth=6, subsample=0.7)])
def test_rows_keep_their_place_in_a_task(spec, monkeypatch):
    """No tree is walked again from its root, and rows under a split that lost its place end in the leaf there."""
    x, y = data(800, 6)
    layout = T.Layout.of([list(np.quantile(x[:, 0], np.linspace(0.1, 0.9, 9))), [0.0], [0, 1, 2, 3, 4], [-1.0, 0.0, 1.0], []])
    with monkeypatch.context() as m:
        m.setattr(T, "walk", None)
        model, margin = B.fit_alone(block_of(x, y, layout), B.BoostJob(spec), [(int((y == 0).sum()), int(y.sum()))], layout)
    assert len(model.value) > spec.rounds
    assert np.allclose(margin, model.margins(x), atol=1e-12)


def test_attribution_work_is_bounded_per_leaf(monkeypatch):
    """However many rows there are, a leaf of d features is worked out for 2^d patterns at most."""
    x, y = data(3000, 2)
    x[::17, 0] = np.nan
    layout = T.Layout.of([list(np.quantile(x[1::17, j], np.linspace(0.1, 0.9, 9))) if j != 1 else [0.0] for j in range(5)])
    model, _ = B.fit_alone(block_of(x, y, layout), B.BoostJob(SPEC), [(int((y == 0).sum()), int(y.sum()))], layout)
    seen, plain = [], T._leaf_values
    monkeypatch.setattr(T, "_leaf_values", lambda ones, *a: seen.append(ones.shape) or plain(ones, *a))
    many = model.attributions(x)
    assert seen and all(m <= 1 << d for d, m in seen)
    few = np.vstack([model.attributions(x[i:i + 1]) for i in range(60)])  # row by row
    assert np.array_equal(many[:60], few)
    assert np.allclose(many.sum(axis=1), model.margins(x) - model.expected())


def test_row_and_hessian_are_summed_as_one_number():
    """Whatever the weights: with room for both, without it, and over several chunks."""
    gen = np.random.default_rng(2)
    n = 150_000
    layout = T.Layout.of([[0.5]] * 3 + [[], [0.1, 0.4, 0.7], [0.3, 0.6], list(np.linspace(0.02, 0.98, 63))])
    x = np.column_stack([gen.integers(0, 2, (n, 3)), np.zeros(n), gen.random((n, 3))]).astype(float)
    code = layout.binned(x)
    slot = gen.integers(-1, 4, n)
    packed = T.PackedCode(code, layout)
    for weight in (0.0, 1.0, 300.0, 2.0 ** 14):
        g, h = T.gradients(gen.normal(size=n), x[:, 0], np.full(n, weight))
        want = T.histograms(code, slot, g, h, 4, layout.width)
        assert (packed.histograms(slot, g, h, 4) == want).all()


def test_packed_rows_move_as_unpacked_ones():
    gen = np.random.default_rng(3)
    layout = T.Layout.of([[0.5], [0.1, 0.4, 0.7], list(np.linspace(0.003, 0.997, 300))])
    code = layout.binned(gen.random((70_000, 3)))
    packed = T.PackedCode(code, layout)
    assert packed.local.dtype == np.uint16  # a feature of more than 256 bins
    bins = np.array([layout.starts[2] + 280, layout.starts[1], 0, -1, -1, -1, -1], np.int32)
    left = np.array([1, 3, 5, -1, -1, -1, -1], np.int32)
    at, node = np.zeros(len(code), np.intp), np.zeros(len(code), np.int64)
    for _ in range(3):
        packed.step(at, bins, left)
        node = T.stepped(code, node, bins, left, layout.feature_of())
        assert (at == node).all()
    assert len(set(at)) == 4


def test_a_task_holds_few_bytes_a_row():
    """So that the training set of 900,000 customers fits a task: no ids but the held-out rows', no copy per feature."""
    import tracemalloc
    gen = np.random.default_rng(6)
    n, features = 60_000, 50
    layout = T.Layout.of([list(np.linspace(0.02, 0.98, 63))] * 5 + [[0.5]] * 45)
    block = B.Block(layout.binned(gen.random((n, features))), gen.integers(0, 2, n).astype(np.uint8), np.ones(n, np.int64),
                    np.where(np.arange(n) % 10 == 0, 0, -1).astype(np.int32),
                    gen.integers(0, 2 ** 63, n).astype(np.uint64), [f"c{i:07d}" for i in range(n)])
    job = B.BoostJob(replace(SPEC, rounds=2), 0, 0)
    dealt = list(B._dealt([block.written(0).drop_columns(["job"])], {0: job}, layout, [0]))
    assert sum(len(r["ids"][0]) for r in dealt) == n // 10
    assert sum(r.nbytes for r in dealt) < n * (features + 15)
    tracemalloc.start()
    counts = [(int((block.y == 0).sum()), int(block.y.sum()))]
    (done,) = list(B._alone(iter(dealt), [job], counts, layout))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 260 * n and B.SLICE_ROWS * 260 < 300 << 20
    model, margin = B.fit_alone(block, job, counts, layout)
    assert done["model"][0].as_py() == model.to_bytes()
    assert done["margins"][0].as_py() == margin[::10].tolist() and done["ids"][0].as_py() == block.ids[::10]
