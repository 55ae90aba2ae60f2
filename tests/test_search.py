"""The adaptive search: sampler against random draws, interrupted and resumed
searches, folds before resampling, exact folds."""

import math
import random
from dataclasses import replace

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.operators.split import exact_folds
from attrition.params import Params, TuneParams
from attrition.plans import boosting, catalog, tune
from attrition.plans.ensemble import cross_fit, fold_trains
from attrition.plans.jobs import params_for
from conftest import SF0001

SPACE = {"a": (0.0, 1.0, "float"), "b": (1e-3, 1e3, "log"), "c": (1, 20, "int")}


def target(p):
    return -(p["a"] - 0.3) ** 2 - (math.log10(p["b"]) - 1.2) ** 2 / 9 - ((p["c"] - 14) / 20) ** 2


def best_of(ask, n=45, batch=5):
    history = []
    while len(history) < n:
        history += [(p, target(p)) for p in ask(history, batch)]
    return max(v for _, v in history)


def test_sampler_beats_random_draws():
    adaptive = [best_of(tune.ParzenSampler(SPACE, seed).ask) for seed in range(12)]
    uniform = [best_of(tune.ParzenSampler(SPACE, seed, startup=10 ** 9).ask) for seed in range(12)]
    assert np.median(adaptive) > np.median(uniform) and np.mean(adaptive) > np.mean(uniform)
    assert adaptive == [best_of(tune.ParzenSampler(SPACE, seed).ask) for seed in range(12)]  # seeded


def test_sampler_stays_in_its_ranges():
    s = tune.ParzenSampler(tune.search_space(params_for("none")), 3, startup=4)
    rng, history = random.Random(1), []
    for _ in range(20):
        history += [(p, rng.random()) for p in s.ask(history, 3)]
    assert len(history) == 60
    for p, _ in history:
        for name, (low, high, kind) in s.space.items():
            assert low <= p[name] <= high and (kind != "int" or p[name] == int(p[name]))
            assert s.value(name, s.place(name, p[name])) == pytest.approx(p[name])
    assert set(tune.search_space(Params())) == set(s.space) - {"pos_weight"}  # one correction of the classes


def small():
    return replace(Params(), tune=TuneParams(n_trials=5, folds=2, rounds_range=(2, 6), batch=2, startup=2))


def test_interrupted_search_goes_on(spark, tmp_path, monkeypatch):
    td, p = catalog.training(spark, SF0001), small()
    whole = [tuple(r) for r in tune.search(td.train, p).orderBy("trial").collect()]
    fits, plain = [], boosting.fit_boosted

    def dying(table, jobs, *args):
        fits.append(len(jobs))
        if len(fits) == 2:
            raise RuntimeError("lost")
        return plain(table, jobs, *args)

    store = tune.TrialStore(spark, str(tmp_path / "trials"))
    monkeypatch.setattr(boosting, "fit_boosted", dying)
    with pytest.raises(RuntimeError):
        tune.search(td.train, p, store)
    assert store.table().count() == 2  # the first batch is committed
    # a batch whose writer died before its marker counts as not written
    store.spark.createDataFrame([(9, {"l1": 1.0}, 0.5, 0.1)], tune.TRIALS).write.parquet(store._batch(1))
    marker = tmp_path / "trials" / "batch-00001" / "_SUCCESS"
    marker.unlink()
    assert store.table().count() == 2
    again = tune.search(td.train, p, store)
    assert fits == [4, 4, 4, 2]  # two trials of two folds; lost; the lost batch, the last trial
    assert [tuple(r) for r in again.orderBy("trial").collect()] == whole
    assert [tuple(r) for r in tune.search(td.train, p, store).orderBy("trial").collect()] == whole
    assert fits == [4, 4, 4, 2]
    assert [r["best_so_far"] for r in tune.best_so_far(store.table()).orderBy("trial").collect()] == \
        list(np.maximum.accumulate([r[2] for r in whole]))


def test_folds_are_cut_before_resampling(spark):
    td = catalog.training(spark, SF0001)
    data = fold_trains(td.train, 3, Params())
    assert data.folded.count() == td.train.count()
    for f, rows in data.trains.items():
        held = {r[0] for r in data.folded.where(F.col("fold") == f).select("customer_id").collect()}
        bases = {r[0].split("#s")[0] for r in rows.select("customer_id").collect()}
        assert not held & bases
        n = {r[0]: r[1] for r in rows.groupBy("churn").count().collect()}
        assert n[0] == n[1] == data.table.counts[f][0] == data.table.counts[f][1]
    oof = cross_fit(td.train, ["logistic_regression", "gbt_b"], replace(
        Params(), boost_b=replace(Params().boost_b, max_iter=3)), 3)
    assert oof.groupBy("customer_id", "model").count().where("count = 1").count() == 2 * td.train.count()
    assert oof.join(data.folded.select("customer_id", F.col("fold").alias("f")), "customer_id") \
        .where("fold != f").count() == 0


def test_exact_folds(spark):
    rows = [(f"c{i}", int(i % 7 == 0)) for i in range(211)] + [("c5", 0), (None, 1), (None, None)]
    df = spark.createDataFrame(rows, "customer_id string, churn int").repartition(5)
    out = exact_folds(df, 4)
    assert out.columns == ["customer_id", "churn", "fold"] and out.count() == len(rows)
    for r in out.groupBy("churn").pivot("fold", [0, 1, 2, 3]).count().na.fill(0, ["0", "1", "2", "3"]).collect():
        sizes = [r["0"], r["1"], r["2"], r["3"]]
        assert max(sizes) - min(sizes) <= 1
    assert exact_folds(df.limit(0), 4).count() == 0
