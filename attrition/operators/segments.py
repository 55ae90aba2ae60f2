"""Risk segments, hard decisions and the retention-impact estimate.

Segment summaries list every segment, also empty ones, in Low < Medium <
High order. That is done with one conditional aggregate turned into rows by
``stack`` — no join with a dimension table and one tiny final exchange.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.binning import cut
from ..params import SegmentParams
from ..schema import RISK_LABELS


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def risk_segment(prob: Column | str, params: SegmentParams = SegmentParams()) -> Column:
    """Low / Medium / High on (0, m], (m, h], (h, 1]; 0 or outside gives null."""
    edges = [0.0, params.medium_threshold, params.high_threshold, 1.0]
    return cut(prob, edges, RISK_LABELS, include_lowest=False)


def hard_decision(prob: Column | str, threshold: float = 0.5) -> Column:
    """1 or 0; null where the probability is null or NaN (NaN >= x holds in Spark)."""
    return F.when(~F.isnan(_c(prob).cast("double")), (_c(prob) >= F.lit(threshold)).cast("int"))


def score_table(df: DataFrame, prob_col: str = "score", params: SegmentParams = SegmentParams(),
                id_col: str | None = "customer_id") -> DataFrame:
    """Prediction output: id, probability (4 digits), decision, segment.

    Decision and segment use the unrounded probability.
    """
    cols = [F.col(id_col)] if id_col and id_col in df.columns else []
    p = F.col(prob_col)
    return df.select(*cols,
                     F.round(p, 4).alias("churn_probability"),
                     hard_decision(p, params.decision_threshold).alias("churn_prediction"),
                     risk_segment(p, params).alias("risk_segment"))


def segment_detail(df: DataFrame, prob_col: str = "score", label: str = "churn",
                   params: SegmentParams = SegmentParams(),
                   id_col: str | None = "customer_id") -> DataFrame:
    ids = [F.col(id_col)] if id_col and id_col in df.columns else []
    return df.select(*ids, F.col(prob_col).alias("churn_probability"),
                     F.col(label).alias("actual_churn"),
                     risk_segment(F.col(prob_col), params).alias("risk_segment"))


def segment_summary(df: DataFrame, prob_col: str = "score", label: str = "churn",
                    params: SegmentParams = SegmentParams()) -> DataFrame:
    """risk_segment, count, actual_churn_rate, avg_prob for all three segments
    (rate and mean null when a segment is empty); null segment left out."""
    seg = risk_segment(F.col(prob_col), params)
    aggs = []
    for i, lab in enumerate(RISK_LABELS):
        hit = seg == lab
        aggs += [F.count_if(hit).alias(f"n{i}"),
                 F.avg(F.when(hit, F.col(label).cast("double"))).alias(f"r{i}"),
                 F.avg(F.when(hit, F.col(prob_col).cast("double"))).alias(f"p{i}")]
    wide = df.agg(*aggs)
    parts = ", ".join(f"'{lab}', {i + 1}, n{i}, r{i}, p{i}" for i, lab in enumerate(RISK_LABELS))
    return wide.selectExpr(
        f"stack({len(RISK_LABELS)}, {parts}) as "
        "(risk_segment, segment_rank, count, actual_churn_rate, avg_prob)")


def segment_counts(scored: DataFrame, segment_col: str = "risk_segment",
                   dropna: bool = True) -> DataFrame:
    """Rows per segment of a scored batch, largest first (ties in segment
    order). Like a count over a categorical column, every segment appears,
    also with count 0; the null segment is added only when ``dropna=False``.

    One conditional aggregate (map-side partial counts, one tiny exchange)
    and ``stack`` into rows: no shuffle on the two- or three-valued key.
    """
    seg = F.col(segment_col)
    aggs = [F.count_if(seg == lab).alias(f"n{i}") for i, lab in enumerate(RISK_LABELS)]
    parts = [f"'{lab}', {i + 1}, n{i}" for i, lab in enumerate(RISK_LABELS)]
    if not dropna:
        aggs.append(F.count_if(seg.isNull()).alias("n_null"))
        parts.append(f"cast(null as string), {len(RISK_LABELS) + 1}, n_null")
    rows = scored.agg(*aggs).selectExpr(
        f"stack({len(parts)}, {', '.join(parts)}) as (risk_segment, __rank, count)")
    return (rows.orderBy(F.col("count").desc(), F.col("__rank")).drop("__rank")
            .withColumnRenamed("risk_segment", segment_col))


def retention_impact(df: DataFrame, prob_col: str = "score", label: str = "churn",
                     params: SegmentParams = SegmentParams()) -> DataFrame:
    """Churners, those caught in High Risk, coverage, saved and churn reduction."""
    high = risk_segment(F.col(prob_col), params) == RISK_LABELS[-1]
    y = F.col(label).cast("long")
    base = df.agg(F.coalesce(F.sum(y), F.lit(0)).cast("bigint").alias("total_churners"),
                  F.coalesce(F.sum(F.when(high, y).otherwise(F.lit(0))), F.lit(0))
                  .cast("bigint").alias("churners_caught"))
    saved = F.floor(F.col("churners_caught") * F.lit(params.retention_success_rate)).cast("bigint")
    cov = F.when(F.col("total_churners") > 0,
                 F.col("churners_caught") / F.col("total_churners")).otherwise(F.lit(0.0))
    out = base.select("total_churners", "churners_caught", cov.alias("coverage"), saved.alias("saved"))
    red = F.when(F.col("total_churners") > 0,
                 F.col("saved") / F.col("total_churners")).otherwise(F.lit(0.0))
    return out.withColumn("reduction", red)
