"""Forests: the same trees however training sets are cut, against a plain fit."""

import numpy as np
import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from attrition.functions import forests as R
from attrition.plans import boosting, forests
from attrition.plans.boosting import BoostJob, bin_table
from attrition.functions.trees import BoostSpec


def frame(spark, n=1500, partitions=5):
    rng = np.random.default_rng(3)
    x = np.column_stack([rng.normal(size=n), rng.integers(0, 2, n), rng.integers(0, 9, n), rng.random(n)])
    y = (x[:, 0] + x[:, 1] * x[:, 2] / 4 + rng.normal(size=n) > 1).astype(float)
    rows = [(f"c{i}", float(y[i]), [float(v) for v in x[i]]) for i in range(n)]
    return spark.createDataFrame(rows, "customer_id string, label double, x array<double>") \
        .select("customer_id", "label", array_to_vector("x").alias("features")).repartition(partitions)


def plain(code, y, times, heap, tree, spec, layout, weight, out):
    """One node after another, every cut tried."""
    n = np.array([times[y == v].sum() for v in (0, 1)], float)
    gini = lambda m: 2 * (m * weight).prod() / max((m * weight).sum(), 1e-300)
    best = (1e-9 * (n * weight).sum(), -1)
    if heap.bit_length() - 1 < spec.max_depth:
        for f in R.feature_draws(np.array([heap]), spec, tree, layout.n_features)[0]:
            for b in range(layout.starts[f], layout.starts[f + 1]):
                left = np.array([times[(y == v) & (code[:, f] <= b)].sum() for v in (0, 1)], float)
                if min(left.sum(), (n - left).sum()) < max(spec.min_rows, 1):
                    continue
                if (gain := gini(n) - gini(left) - gini(n - left)) > best[0]:
                    best = (gain, b, f)
    out[heap] = (best[1], (n * weight)[1] / max((n * weight).sum(), 1e-300))
    if best[1] >= 0:
        right = code[:, best[2]] > best[1]
        plain(code[~right], y[~right], times[~right], 2 * heap, tree, spec, layout, weight, out)
        plain(code[right], y[right], times[right], 2 * heap + 1, tree, spec, layout, weight, out)
        (lb, lv), (rb, rv) = out[2 * heap], out[2 * heap + 1]
        if lb < 0 and rb < 0 and (lv > 0.5) == (rv > 0.5):  # sibling leaves of the same class
            out[heap] = (-1, out[heap][1])
            del out[2 * heap], out[2 * heap + 1]


@pytest.mark.parametrize("balanced", [False, True])
def test_equals_a_plain_fit(spark, balanced):
    table = bin_table(frame(spark), max_bins=16)
    job = forests.ForestJob(R.ForestSpec(trees=3, max_depth=6, min_rows=5, features="0.5"), balanced=balanced)
    forest = forests.fit_forest(table, job)
    block = boosting.Block.joined([boosting.Block.read(*r) for r in table.blocks.collect()])
    for t in range(3):
        out = {}
        times = R.row_draws(block.rid, job.spec, t)
        plain(block.code, block.y, times, 1, t, job.spec, table.layout, forests.class_weights(job, table.counts), out)
        a, b = forest.roots[t:t + 2]
        assert [out[h][0] for h in sorted(out)] == forest.bin[a:b].tolist()
        leaf = forest.bin[a:b] < 0
        assert np.allclose(np.array([out[h][1] for h in sorted(out)])[leaf], forest.value[a:b][leaf])


def test_subtrees_folds_and_partitions_give_the_same_trees(spark, monkeypatch):
    monkeypatch.setattr(forests, "EXCHANGED", 20_000)  # several batches of trees
    monkeypatch.setattr(forests, "MET", 10_000)
    spec, models = R.ForestSpec(trees=6, max_depth=8, min_rows=3), []
    for partitions, slice_rows in ((1, 10_000), (7, 10_000), (4, 300), (6, 40)):
        table = bin_table(frame(spark, partitions=partitions), max_bins=32)
        models.append(forests.fit_forest(table, forests.ForestJob(spec), slice_rows))
    for m in models[1:]:
        for name in ("bin", "roots", "left"):
            assert (getattr(m, name) == getattr(models[0], name)).all(), name
        leaf = m.bin < 0
        assert (m.value[leaf] == models[0].value[leaf]).all()
        assert np.allclose(m.importances(), models[0].importances())
    assert models[0].getNumTrees == 6 and models[0].importances().sum() == pytest.approx(1)


@pytest.mark.parametrize("slice_rows", [10_000, 200])
def test_held_out_rows_are_scored_once_by_the_other_folds(spark, slice_rows):
    df = frame(spark, 600).withColumn("fold", (F.crc32("customer_id") % 3).cast("int"))
    sets = F.lit(7).cast("long").bitwiseXOR(F.expr("shiftleft(1L, fold)"))
    table = bin_table(df.withColumn("sets", sets), 3, F.col("sets"), F.col("fold"))
    jobs = [forests.ForestJob(R.ForestSpec(trees=4, max_depth=5), f, f) for f in range(3)]
    got = {r.id: (r.job, r.score) for r in forests.held_out_scores(table, jobs, slice_rows).collect()}
    assert len(got) == 600
    for f in range(3):
        alone = bin_table(df, 1).layout
        assert alone == table.layout  # edges are of all rows
        forest = forests.fit_forest(table, jobs[f], slice_rows)
        own = forests.ForestScoreModel("rf", forest).score(df.where(F.col("fold") == f)).collect()
        assert {r.customer_id: (f, pytest.approx(r.score)) for r in own} == \
            {k: v for k, v in got.items() if v[0] == f}


def test_one_class_empty_and_missing_values(spark):
    spec = R.ForestSpec(trees=3, max_depth=4)
    df = frame(spark, 50)
    one = forests.fit_forest(bin_table(df.withColumn("label", F.lit(1.0))), forests.ForestJob(spec, balanced=True))
    assert one.probabilities(np.array([[0.0, 1.0, 2.0, np.nan]])).tolist() == [1.0]
    assert one.importances().sum() == 0
    none = forests.fit_forest(bin_table(df.limit(0)), forests.ForestJob(spec))
    assert none.getNumTrees == 0


def test_bytes_round_trip(spark):
    forest = forests.fit_forest(bin_table(frame(spark, 300)), forests.ForestJob(R.ForestSpec(trees=3, max_depth=4)))
    x = np.random.default_rng(1).normal(size=(20, 4))
    assert (R.Forest.from_bytes(forest.to_bytes()).probabilities(x) == forest.probabilities(x)).all()


def test_a_boosted_set_within_a_slice_is_fitted_in_tasks_whatever_the_table(spark, monkeypatch):
    """Cross-fitting puts every fold's rows into one table; each fold's own rows count."""
    df = frame(spark, 400).withColumn("fold", (F.crc32("customer_id") % 4).cast("int"))
    table = bin_table(df.withColumn("sets", F.expr("shiftleft(1L, fold)")), 4, F.col("sets"), F.col("fold"))

    def over_slices(*_):
        raise AssertionError("a Spark job per level")

    monkeypatch.setattr(boosting, "_fit_over_slices", over_slices)
    jobs = [BoostJob(BoostSpec(rounds=2, max_depth=3), f, (f + 1) % 4) for f in range(4)]
    models, scores = boosting.fit_boosted(table, jobs, slice_rows=200)
    assert len(models) == 4 and scores.count() == 400


def _grown_alone(code, y, times, rows, spec, layout, copies):
    """What the plain growth needs: a copy of the drawn rows, and its peak memory."""
    import tracemalloc
    both = R.classed(code, y, layout)
    tracemalloc.start()
    out = R.grow_rows(both, rows, times, 1, 0, spec, layout, np.ones(2)) if not copies else \
        R.grow(code[rows], y[rows], times, 1, 0, spec, layout, np.ones(2))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return out, peak


@pytest.mark.parametrize("bins", [64, 200])
def test_a_tree_keeps_places_instead_of_rows(bins, monkeypatch):
    """Drawn rows are copied once, however deep the tree is, and their order gives the counts."""
    from attrition.functions.trees import Layout
    gen = np.random.default_rng(5)
    n, many = 60_000, 40
    monkeypatch.setattr(R, "_CELLS", 4_096)
    layout = Layout.of([list(np.linspace(0.01, 0.99, bins - 1))] * 3 + [[0.5]] * (many - 3))
    x = gen.random((n, many))
    code = R.local_codes(layout.binned(x), layout)
    y = (x[:, 0] + x[:, 4] + gen.random(n) > 1.5).astype(np.uint8)
    spec = R.ForestSpec(trees=1, max_depth=9, min_rows=4)
    times = R.row_draws(np.arange(n, dtype=np.uint64), spec, 0)
    rows = np.flatnonzero(times)
    both = R.classed(code, y, layout)
    got, peak = _grown_alone(code, y, times[rows], rows, spec, layout, False)
    same, _ = _grown_alone(code, y, times[rows], rows, spec, layout, True)
    assert len(got["heap"]) > 100 and all((got[k] == same[k]).all() for k in got)
    assert peak < (many * both.itemsize + 140) * len(rows)
    slot = np.sort(gen.integers(0, 50, len(rows)))
    feats = R.feature_draws(np.arange(1, 51), spec, 0, many)
    hist = R._counted(both.reshape(-1), rows * many, times[rows].astype(float), np.bincount(slot, minlength=50), feats,
                      np.diff(layout.starts))
    assert (hist == R.counts(code[rows], y[rows].astype(np.int64), times[rows], slot, feats, np.diff(layout.starts))).all()
