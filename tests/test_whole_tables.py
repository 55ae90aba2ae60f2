"""Registered queries read whole tables."""

import numpy as np
from pyspark.sql import functions as F

from attrition.params import Params
from attrition.plans import catalog
from attrition.plans.models import BASE_MODELS
from conftest import SF0001


def test_score_batch_model_scores_every_customer(spark):
    got = catalog.QUERIES["score_batch_model"](spark, SF0001)
    ids = {r[0] for r in catalog.raw(spark, SF0001).select("customer_id").collect()}
    assert sorted(r[0] for r in got.select("customer_id").collect()) == sorted(ids)


def test_null_profile_sees_every_column(spark, monkeypatch):
    plain = catalog.cust
    first = plain(spark, SF0001).agg(F.min("customer_id")).first()[0]
    monkeypatch.setattr(catalog, "cust", lambda *a: plain(*a).withColumn(
        "tech_support", F.when(F.col("customer_id") != first, F.col("tech_support"))).withColumn(
        "p", F.when(F.col("customer_id") != first, F.col("p"))))
    got = {r[0]: r[1] for r in catalog.QUERIES["null_profile"](spark, SF0001).collect()}
    assert got["tech_support"] == got["churn_probability"] == 1 and got["risk_segment"] >= 1


def test_multi_fit_queries_end_at_production_size(spark):
    """Fits every model that the registered queries fit, at Params()."""
    p = Params()
    td = catalog.training(spark, SF0001)
    scores = catalog.QUERIES["stacking_scores"](spark, SF0001)
    per = scores.groupBy("customer_id", "model").count()
    assert per.count() == 3 * td.train.count() and per.where("count != 1").count() == 0
    cv = {r["model"]: r for r in catalog.QUERIES["cv_scores"](spark, SF0001).collect()}
    assert set(cv) == set(BASE_MODELS)
    stack, _ = catalog.stacking(spark, SF0001)
    gbt_a, gbt_b = (next(b.model for b in stack.bases if b.name == n) for n in ("gbt_a", "gbt_b"))
    assert len(gbt_a.roots) - 1 == p.boost_a.max_iter == 300 and len(gbt_b.roots) - 1 == p.boost_b.max_iter
    leaves = np.add.reduceat(gbt_b.feature < 0, gbt_b.roots[:-1])
    assert leaves.max() <= p.boost_b.max_leaves
    forest = next(b.model for b in stack.bases if b.name == "random_forest")
    assert forest.getNumTrees == p.forest.num_trees == 300
    assert catalog.QUERIES["stacking_model"](spark, SF0001).count() == td.test.count()
    trials = catalog.QUERIES["tuning_trials"](spark, SF0001).collect()
    assert len(trials) == p.tune.n_trials == 30
    assert max(t["params"]["rounds"] for t in trials) > 300 and all("l2" in t["params"] for t in trials)
    running = [r["best_so_far"] for r in catalog.QUERIES["best_so_far"](spark, SF0001).orderBy("trial").collect()]
    assert running[-1] == max(t["auc_mean"] for t in trials) and running == sorted(running)
