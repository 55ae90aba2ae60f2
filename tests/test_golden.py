"""Known figures of the fixture (FIXTURES.md, computed independently with DuckDB)."""

import pytest
from pyspark.sql import functions as F

from attrition.operators import metrics, segments
from attrition.operators.features import fit_features
from attrition.plans import catalog
from conftest import SF001


@pytest.fixture(scope="module")
def cust(spark):
    return catalog.cust(spark, SF001).cache()


def test_rows_and_churn(cust):
    r = cust.agg(F.count("*").alias("n"), F.sum("churn").alias("s")).first()
    assert (r.n, r.s) == (1500, 582)


def test_p75_cutoff(cust):
    assert fit_features(cust).cutoff == pytest.approx(77.56)


def test_auc_and_ap_of_rule_score(cust):
    s = cust.withColumn("score", F.round("p", 4))
    r = metrics.auc_avg_precision(s).first()
    assert r.auc_roc == pytest.approx(0.716520, abs=1e-6)
    assert r.avg_precision == pytest.approx(0.609158, abs=1e-6)


def test_rate_by_contract(cust):
    from attrition.operators.eda import rate_by
    got = {r.contract: (r["count"], round(r.churn_rate, 6)) for r in rate_by(cust, "contract").collect()}
    assert got == {"Month-to-month": (840, 0.501190), "One year": (342, 0.242690), "Two year": (318, 0.245283)}


def test_segments(cust):
    s = cust.withColumn("score", F.round("p", 4))
    got = {r.risk_segment: (r["count"], round(r.actual_churn_rate, 6))
           for r in segments.segment_summary(s).collect()}
    assert got == {"Low Risk": (445, 0.193258), "Medium Risk": (830, 0.431325), "High Risk": (199, 0.693467)}
    nulls = s.where(segments.risk_segment("score").isNull()).count()
    assert nulls == 26


def test_tenure_buckets(spark):
    f = catalog.featured(spark, SF001)
    got = {r.tenure_bucket: r["count"] for r in f.groupBy("tenure_bucket").count().collect()}
    assert got == {"0-6m": 48, "6-12m": 158, "12-24m": 371, "24-48m": 622, "48+m": 301}
