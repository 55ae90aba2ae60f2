"""Physical-plan properties that matter at scale."""

import re

import pytest

from attrition.plans.catalog import QUERIES
from conftest import SF0001


def _formatted(df) -> str:
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))


def _windows(text: str):
    """(input, argument groups) of every Window node."""
    out = []
    for m in re.finditer(r"\(\d+\) Window\nInput \[\d+\]: \[(.*?)\]\nArguments: (.*?)\n", text):
        groups = re.findall(r"\[([^\[\]]*(?:\[[^\[\]]*\][^\[\]]*)*)\]", m.group(2))
        out.append((m.group(1), groups))
    return out


@pytest.mark.parametrize("name", ["engineer_features", "segment_summary", "encode_features"])
def test_scan_reads_only_the_key(spark, name):
    text = _formatted(QUERIES[name](spark, SF0001))
    schemas = set(re.findall(r"ReadSchema: (struct<[^>]*>)", text))
    assert schemas == {"struct<c_custkey:bigint>"}


@pytest.mark.parametrize("name", ["metric_auc", "roc_curve", "pr_curve", "model_comparison"])
def test_cumulative_sums_need_no_window(spark, name):
    text = _formatted(QUERIES[name](spark, SF0001))
    assert not _windows(text) and "MapInArrow" in text


def test_ranges_of_continuous_scores_are_even(spark, monkeypatch):
    """Scores without ties are dealt evenly over the range exchange's partitions."""
    from attrition.functions import prefix
    from pyspark.sql import functions as F
    kept = []
    monkeypatch.setattr(prefix, "checkpointed", lambda df: kept.append(df.checkpoint()) or kept[-1])
    df = spark.range(40_000).select(F.rand(3).alias("s"), F.lit(1).alias("n"))
    prefix.prefix_sums_desc(df, "s", ["n"], partitions=16)
    sizes = [r["count"] for r in kept[0].groupBy(prefix.PART).count().collect()]
    assert len(sizes) == 16 and max(sizes) < 2 * 40_000 / 16


def test_exact_split_ranks_only_boundary_buckets(spark):
    wins = _windows(_formatted(QUERIES["stratified_split_exact"](spark, SF0001)))
    ranks = [g for _i, g in wins if "row_number" in g[0]]
    assert ranks and all("churn" in g[1] and "__b" in g[1] for g in ranks)


def test_knn_partial_top_k_before_shuffle(spark):
    text = _formatted(QUERIES["knn_minority"](spark, SF0001))
    assert "WindowGroupLimit" in text
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_dedupe_is_partial_aggregate(spark):
    text = _formatted(QUERIES["clean_customers"](spark, SF0001))
    assert "partial_min" in text


# Queries whose helper tables (per-score counts, hash-bucket counts, class
# ranges, class totals) are read several times: the source table is scanned
# at most this often in the final plan, not once per reader.
@pytest.mark.parametrize("name,max_scans", [
    ("metric_auc", 0), ("roc_curve", 0), ("pr_curve", 0), ("metric_avg_precision", 0),
    ("metrics_row", 1), ("model_comparison", 1),
    ("stratified_split_exact", 2), ("hist_tenure", 1), ("hist_monthly_charges", 1),
    ("churn_share", 1), ("class_distribution", 1), ("class_weights", 1),
])
def test_source_scanned_once(spark, name, max_scans):
    text = _formatted(QUERIES[name](spark, SF0001))
    assert len(re.findall(r"\(\d+\) Scan parquet", text)) <= max_scans
