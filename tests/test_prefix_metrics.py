"""Two-level cumulative sums and ranking metrics against direct computation."""

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from attrition.functions.prefix import prefix_sums_desc
from attrition.operators import metrics
from attrition.plans import catalog
from conftest import SF001


def test_prefix_sums_match_pandas(spark):
    c = catalog.cust(spark, SF001)
    per = c.groupBy("contract", F.col("monthly_charges").alias("s")).agg(F.sum("churn").alias("v"))
    got = prefix_sums_desc(per, "s", ["v"], ["contract"], partitions=7).toPandas()
    pdf = per.toPandas().sort_values(["contract", "s"], ascending=[True, False])
    pdf["want"] = pdf.groupby("contract")["v"].cumsum()
    m = got.merge(pdf, on=["contract", "s", "v"])
    assert len(m) == len(pdf)
    assert (m["v_cum"] == m["want"]).all()


def test_prefix_sums_over_many_ranges(spark):
    """Continuous values over several ranges and batches, skewed groups, nulls, totals."""
    rows = [("hot" if i % 3 else ("a", None)[i % 2], (i * 7919 % 5003) / 7.0, i % 5, i / 3.0) for i in range(5003)]
    df = spark.createDataFrame([*rows, ("hot", None, 1, None)], "g string, s double, n int, x double").repartition(6)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "97")
    try:
        out = prefix_sums_desc(df, "s", ["n", "x"], ["g"], total_suffix="_all", partitions=9)
        pdf = out.toPandas()
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert dict(out.dtypes)["n_cum"] == "bigint" and len(pdf) == 5004
    for g, part in pdf.groupby("g", dropna=False):
        part = part.sort_values("s", ascending=False, na_position="last")
        assert (part["n_cum"] == part["n"].cumsum()).all() and (part["n_all"] == part["n"].sum()).all()
        assert np.allclose(part["x_cum"], part["x"].fillna(0).cumsum()) and np.allclose(part["x_all"], part["x"].sum())
    assert prefix_sums_desc(df.limit(0), "s", ["n"], ["g"]).count() == 0
    assert prefix_sums_desc(df, "s", ["n"], partitions=4).agg(F.max("n_cum")).first()[0] == pdf["n"].sum()


def _auc_pairs(y, s):
    pos, neg = s[y == 1], s[y == 0]
    gt = (pos[:, None] > neg[None, :]).sum()
    eq = (pos[:, None] == neg[None, :]).sum()
    return (gt + 0.5 * eq) / (len(pos) * len(neg))


def _ap_steps(y, s):
    order = np.argsort(-s, kind="mergesort")
    y, s = y[order], s[order]
    thresholds = np.unique(s)[::-1]
    P = y.sum()
    ap, prev_r = 0.0, 0.0
    for t in thresholds:
        sel = s >= t
        tp = y[sel].sum()
        prec = tp / sel.sum()
        rec = tp / P
        ap += (rec - prev_r) * prec
        prev_r = rec
    return ap


@pytest.mark.parametrize("score", ["round(p, 2)", "monthly_charges / 120", "1 - tenure / 72.0"])
def test_auc_ap_against_direct(spark, score):
    df = catalog.cust(spark, SF001).select("churn", F.expr(score).alias("score"))
    pdf = df.toPandas()
    y, s = pdf["churn"].to_numpy(), pdf["score"].to_numpy()
    r = metrics.auc_avg_precision(df).first()
    assert r.auc_roc == pytest.approx(_auc_pairs(y, s), abs=1e-12)
    assert r.avg_precision == pytest.approx(_ap_steps(y, s), abs=1e-12)


def test_grouped_metrics_equal_single(spark):
    long = catalog.rule_models(spark, SF001)
    grouped = {r.model: r for r in metrics.metrics_table(long, group_cols=["model"]).collect()}
    for name in ("rule", "tenure", "charges"):
        single = metrics.metrics_table(long.where(F.col("model") == name)).first()
        for k in ("accuracy", "auc_roc", "f1", "avg_precision"):
            assert grouped[name][k] == pytest.approx(single[k], abs=1e-12)


def test_mllib_evaluator_agrees_without_ties(spark):
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    df = catalog.cust(spark, SF001).select(
        F.col("churn").cast("double").alias("label"), "churn",
        (F.col("monthly_charges") / 120 + F.col("tenure") * 1e-6).alias("score"))
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label", numBins=0)
    ours = metrics.auc_avg_precision(df).first().auc_roc
    assert ours == pytest.approx(ev.evaluate(df), abs=1e-9)


def test_roc_and_pr_curve_shape(spark):
    s = catalog.scored(spark, SF001)
    roc = metrics.roc_curve(s).toPandas().sort_values(["fpr", "tpr"])
    assert roc.iloc[0][["fpr", "tpr"]].tolist() == [0.0, 0.0]
    assert roc.iloc[-1][["fpr", "tpr"]].tolist() == [1.0, 1.0]
    pr = metrics.pr_curve(s).toPandas()
    end = pr[pr["threshold"].isna()]
    assert end[["precision", "recall"]].values.tolist() == [[1.0, 0.0]]
    _ = pd
