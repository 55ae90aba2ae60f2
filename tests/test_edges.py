"""Edge rows: boundaries, nulls, missing columns, unseen values, empty input."""

import pytest
from pyspark.sql import functions as F

from attrition.functions.binning import cut
from attrition.operators import metrics, segments
from attrition.operators.clean import clean_data
from attrition.operators.encode import align_columns, fit_encoder, onehot
from attrition.operators.features import engineer_features, fit_features
from attrition.operators.scale import fit_scaler
from attrition.params import FeatureParams
from attrition.schema import RAW_SCHEMA, TENURE_EDGES, TENURE_LABELS


def _row(**kw):
    base = dict(customer_id="C1", gender="Male", senior_citizen=0, partner="Yes", dependents="No", tenure=10,
                contract="One year", internet_service="DSL", online_security="No", tech_support="No",
                online_backup="Yes", device_protection="No", streaming_tv="Yes", streaming_movies="No",
                phone_service="Yes", multiple_lines="No", paperless_billing="Yes",
                payment_method="Electronic check", monthly_charges=50.0, total_charges=500.0, churn=0)
    base.update(kw)
    return tuple(base[f.name] for f in RAW_SCHEMA.fields)


def test_tenure_bucket_edges(spark):
    df = spark.createDataFrame([(t,) for t in (0, 1, 6, 7, 12, 24, 48, 72, 73, -1)], "tenure int")
    got = dict(df.select("tenure", cut("tenure", TENURE_EDGES, TENURE_LABELS, True).alias("b")).collect())
    assert got == {0: "0-6m", 1: "0-6m", 6: "0-6m", 7: "6-12m", 12: "6-12m", 24: "12-24m",
                   48: "24-48m", 72: "48+m", 73: None, -1: None}
    got_open = dict(df.select("tenure", cut("tenure", TENURE_EDGES, TENURE_LABELS, False).alias("b")).collect())
    assert got_open[0] is None and got_open[1] == "0-6m"


def test_risk_segment_edges(spark):
    df = spark.createDataFrame([(p,) for p in (0.0, 1e-9, 0.3, 0.30001, 0.6, 0.61, 1.0, 1.01)], "p double")
    got = dict(df.select("p", segments.risk_segment("p").alias("s")).collect())
    assert got == {0.0: None, 1e-9: "Low Risk", 0.3: "Low Risk", 0.30001: "Medium Risk", 0.6: "Medium Risk",
                   0.61: "High Risk", 1.0: "High Risk", 1.01: None}


def test_feature_flags_nulls_and_case(spark):
    rows = [_row(customer_id="A", payment_method=None, tenure=0, total_charges=80.0),
            _row(customer_id="B", payment_method="AUTOMATIC transfer"),
            _row(customer_id="C", tech_support="No internet service", online_security="No internet service")]
    df = engineer_features(spark.createDataFrame(rows, RAW_SCHEMA))
    got = {r.customer_id: r for r in df.collect()}
    assert got["A"].auto_payment == 0 and got["A"].avg_monthly_revenue == 80.0
    assert got["A"].tenure_bucket == "0-6m"
    assert got["B"].auto_payment == 1
    assert got["C"].no_support_services == 0 and got["A"].no_support_services == 1


def test_missing_service_columns(spark):
    df = spark.createDataFrame([_row()], RAW_SCHEMA).drop("tech_support")
    r = engineer_features(df).first()
    assert r.no_support_services == 1  # missing tech_support counts as 'No'
    none = spark.createDataFrame([_row()], RAW_SCHEMA).drop(
        "online_security", "online_backup", "device_protection", "tech_support", "streaming_tv", "streaming_movies")
    r = engineer_features(none).first()
    assert r.num_services == 0 and r.charge_per_service == 50.0


def test_approximate_cutoff_is_an_option(spark):
    rows = [_row(customer_id=str(i), monthly_charges=20.0 + i) for i in range(40)]
    df = spark.createDataFrame(rows, RAW_SCHEMA)
    exact = fit_features(df).cutoff
    near = fit_features(df, FeatureParams(approx_cutoff=True)).cutoff
    assert abs(exact - near) <= 1.0


def test_levels_come_from_the_data(spark):
    rows = [_row(customer_id=str(i), payment_method=p) for i, p in enumerate(["Barter", "Cash", None, "Cash"])]
    enc = fit_encoder(engineer_features(spark.createDataFrame(rows, RAW_SCHEMA)))
    assert enc.levels["payment_method"] == ["Barter", "Cash"]
    assert enc.levels["tenure_bucket"] == TENURE_LABELS


def test_unknown_and_unseen_categories(spark):
    train = engineer_features(spark.createDataFrame([_row(customer_id=str(i)) for i in range(3)], RAW_SCHEMA))
    enc = fit_encoder(train, declared=True)
    new = engineer_features(spark.createDataFrame(
        [_row(customer_id="N", contract="Weekly", internet_service="Satellite")], RAW_SCHEMA))
    out = align_columns(enc.transform(new), enc.feature_names).first().asDict()
    assert out["contract"] is None
    assert all(out[f"internet_service_{v}"] == 0 for v in ("DSL", "Fiber optic", "No"))
    assert len(enc.feature_names) == 50


def test_onehot_null_is_all_zero(spark):
    df = spark.createDataFrame([("a",), (None,)], "c string")
    rows = onehot(df, {"c": ["a", "b"]}).collect()
    assert [tuple(r) for r in rows] == [(1, 0), (0, 0)]


def test_clean_data(spark):
    rows = [("C1", " 5 ", "12.5", "x"), ("C1", "5", "12.5", "x"), ("C2", "3", " ", "y")]
    df = spark.createDataFrame(rows, "customer_id string, tenure string, monthly_charges string, gender string")
    df = df.withColumn("total_charges", F.when(F.col("customer_id") == "C1", F.lit("62.5")).otherwise(F.lit("n/a")))
    out = {r.customer_id: r for r in clean_data(df).collect()}
    assert len(out) == 2
    assert out["C1"].tenure == 5 and out["C1"].total_charges == 62.5
    assert out["C2"].monthly_charges is None and out["C2"].total_charges is None


def test_constant_feature_scales_to_zero(spark):
    df = spark.createDataFrame([(1.0, 2.0), (1.0, 4.0)], "a double, b double")
    m = fit_scaler(df, ["a", "b"])
    assert m.scales[0] == 1.0
    rows = m.transform(df).collect()
    assert [r.a for r in rows] == [0.0, 0.0] and sorted(r.b for r in rows) == [-1.0, 1.0]


def test_metrics_single_class_and_empty(spark):
    one = spark.createDataFrame([(1, 0.2), (1, 0.9)], "churn int, score double")
    r = metrics.metrics_table(one).first()
    assert r.auc_roc == 0.0 and r.f1 == pytest.approx(2 / 3)
    empty = spark.createDataFrame([], "churn int, score double")
    cm = {(r.actual, r.predicted): r["count"] for r in metrics.confusion_matrix(empty).collect()}
    assert cm == {(0, 0): 0, (0, 1): 0, (1, 0): 0, (1, 1): 0}
    ri = segments.retention_impact(empty).first()
    assert (ri.total_churners, ri.coverage, ri.reduction) == (0, 0.0, 0.0)
    summ = segments.segment_summary(empty).collect()
    assert [r.risk_segment for r in summ] == ["Low Risk", "Medium Risk", "High Risk"]
    assert all(r["count"] == 0 and r.actual_churn_rate is None for r in summ)


def test_tied_scores_auc(spark):
    df = spark.createDataFrame([(0, 0.5), (1, 0.5), (0, 0.1), (1, 0.9)], "churn int, score double")
    assert metrics.auc_avg_precision(df).first().auc_roc == pytest.approx(0.875)


def test_average_precision_step_sum(spark):
    df = spark.createDataFrame([(0, 0.1), (0, 0.4), (1, 0.35), (1, 0.8)], "churn int, score double")
    assert metrics.auc_avg_precision(df).first().avg_precision == pytest.approx(0.8333333333)


def test_segment_counts_keep_empty_segments(spark):
    df = spark.createDataFrame([(0.9,), (0.95,), (0.1,), (0.0,)], "p double")
    scored = segments.score_table(df, "p", id_col=None)
    got = [tuple(r) for r in segments.segment_counts(scored).collect()]
    assert got == [("High Risk", 2), ("Low Risk", 1), ("Medium Risk", 0)]
    with_null = [tuple(r) for r in segments.segment_counts(scored, dropna=False).collect()]
    assert with_null == [("High Risk", 2), ("Low Risk", 1), (None, 1), ("Medium Risk", 0)]


def test_correlation_matrix_with_nulls_and_constants(spark):
    import numpy as np
    import pandas as pd

    from attrition.operators.eda import correlation_matrix
    r = np.random.default_rng(2)
    pdf = pd.DataFrame(r.normal(size=(300, 5)), columns=list("abcde"))
    pdf["b"] = pdf["a"] * 2 + 1e6
    pdf["c"] = 3.0
    pdf.loc[::3, "d"] = np.nan
    df = spark.createDataFrame(pdf.astype(object).where(pdf.notna(), None).values.tolist(),
                               ", ".join(f"{c} double" for c in "abcde")).repartition(4)
    want = pdf.corr()
    got = {(x["col_a"], x["col_b"]): x["corr"] for x in correlation_matrix(df, list("abcde")).collect()}
    assert len(got) == 10 and {p for p, v in got.items() if v is None} == {p for p in got if "c" in p}
    assert all(abs(v - want.loc[p]) < 1e-9 for p, v in got.items() if v is not None)
    assert correlation_matrix(df.limit(0), list("ab")).collect() in ([], [("b", "a", None)])
