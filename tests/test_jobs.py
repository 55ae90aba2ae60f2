"""End-to-end jobs with small models: pipeline, persistence of every model
kind, batch scoring from the saved registry."""

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from attrition.params import check_profile
from attrition.operators.clean import clean_data
from attrition.plans.jobs import evaluate_saved, main, run_pipeline, score_job
from attrition.sources.customers import customers_from_tables, read_customers, write_table
from attrition.sources.registry import load_all
from conftest import SF0001


def small():
    """The jobs' logic on 150 rows; tests/test_whole_tables.py fits the production sizes."""
    p = check_profile()
    return replace(p, tune=replace(p.tune, n_trials=2), cv_folds=3, stacking_folds=3)


@pytest.fixture(scope="module")
def pipeline(spark, tmp_path_factory):
    out = str(tmp_path_factory.mktemp("pipeline"))
    p = small()
    tables = run_pipeline(spark, SF0001, out, p, tune=True, parallelism=4)
    return out, tables


def test_pipeline_tables(pipeline):
    out, tables = pipeline
    comp = tables["model_comparison"].collect()
    names = {r.model for r in comp}
    assert {"random_forest", "logistic_regression", "gbt_a", "gbt_b", "soft_voting",
            "stacking_ensemble", "tuned_gbt"} <= names
    aucs = [r.auc_roc for r in comp]
    assert aucs == sorted(aucs, reverse=True)
    seg = tables["segment_summary"].collect()
    assert [r.risk_segment for r in seg] == ["Low Risk", "Medium Risk", "High Risk"]
    assert tables["retention_impact"].count() == 1
    assert tables["feature_importance"].count() == 20
    best = comp[0].model
    assert {r.model for r in tables["best_confusion_matrix"].collect()} == {best}
    assert tables["best_confusion_matrix"].agg(F.sum("count")).first()[0] == \
        tables["segment_summary"].agg(F.sum("count")).first()[0]
    trees = [r.model for r in comp if r.model in ("random_forest", "gbt_a", "gbt_b", "tuned_gbt")]
    assert {r.model for r in tables["feature_importance"].collect()} == {trees[0]}
    boosted = [t for t in trees if t != "random_forest"]
    assert {r.model for r in tables["tree_attribution"].collect()} == {boosted[0]}
    assert tables["cv_scores"].count() == 4 and tables["best_so_far"].count() == 2


def test_saved_models_score_like_fitted(spark, pipeline):
    out, tables = pipeline
    saved = load_all(spark, f"{out}/models")
    again = evaluate_saved(clean_data(read_customers(spark, f"{out}/raw")), f"{out}/models", small())
    before = {r.model: r.auc_roc for r in tables["model_comparison"].collect()}
    assert set(saved) == set(before)
    assert {r.model: r.auc_roc for r in again["model_comparison"].collect()} == pytest.approx(before)


def test_train_and_evaluate_on_an_own_csv(spark, tmp_path):
    src, out = str(tmp_path / "customers"), str(tmp_path / "out")
    write_table(customers_from_tables(spark, SF0001), src, "csv")
    p = replace(small(), tune=replace(small().tune, n_trials=1))
    main(["train", "--input", src, "--out", out, "--exact"], p)
    main(["evaluate", "--input", src, "--models", f"{out}/models", "--out", f"{out}/eval", "--exact"], p)
    tables = {n: spark.read.parquet(f"{p_}/tables/{n}") for p_, n in (
        (out, "cv_scores"), (out, "tuning_trials"), (f"{out}/eval", "model_comparison"),
        (f"{out}/eval", "tree_attribution"), (f"{out}/eval", "elapsed_sec"))}
    assert tables["cv_scores"].count() == 4 and tables["tuning_trials"].count() == 1
    assert tables["model_comparison"].count() == 7 and tables["elapsed_sec"].first()[0] > 0
    raw = read_customers(spark, src, "csv")
    per = {r["churn"]: r["n"] for r in raw.groupBy("churn").agg(F.count("*").alias("n")).collect()}
    tested = spark.read.parquet(f"{out}/eval/tables/best_confusion_matrix").agg(F.sum("count")).first()[0]
    assert tested == sum(int(n * 0.2 + 0.5) for n in per.values())  # exact shares


def test_score_job(spark, pipeline, tmp_path):
    out, _ = pipeline
    src = str(tmp_path / "batch")
    write_table(customers_from_tables(spark, SF0001).drop("churn"), src)
    counts = score_job(spark, src, str(tmp_path / "scored"), f"{out}/models")
    back = spark.read.parquet(str(tmp_path / "scored"))
    assert back.count() == 150
    assert sum(r["count"] for r in counts.collect()) == back.where("risk_segment is not null").count()
    assert back.where((F.col("churn_probability") < 0) | (F.col("churn_probability") > 1)).count() == 0


def test_pipeline_skip_data_and_train(spark, pipeline):
    out, _ = pipeline
    tables = run_pipeline(spark, SF0001, out, check_profile(), skip_data=True, skip_train=True)
    assert [r.risk_segment for r in tables["segment_summary"].collect()] == ["Low Risk", "Medium Risk", "High Risk"]
    assert tables["hist_tenure"].count() == 60
    assert spark.read.parquet(f"{out}/processed").count() == 150
