"""Scoring of customers with fitted state (batch; the same code on streams).

``score_customers``: preparation (clean -> features with the fitted cutoff
-> encode with the fitted levels -> align to the training columns -> scale)
-> model -> probability (4 digits), decision (>= threshold) and risk segment.
It is a chain of row-wise transforms, so there is no shuffle and the
function accepts a streaming DataFrame as well.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from ..operators.segments import retention_impact, score_table, segment_summary
from ..params import SegmentParams
from ..schema import ID_COL, TARGET


def prepare_new_data(df: DataFrame, prep) -> DataFrame:
    """Model input for new rows (customer_id, [churn, label,] features)."""
    return prep.transform(df, clean=True)


def score_customers(df: DataFrame, model, prep, params: SegmentParams = SegmentParams()) -> DataFrame:
    ready = prepare_new_data(df, prep)
    scored = model.score(ready, "__p")
    return score_table(scored, "__p", params, ID_COL)


def evaluate_segments(test: DataFrame, model, params: SegmentParams = SegmentParams()) -> dict[str, DataFrame]:
    """Segment summary and retention impact of a model on the prepared test side."""
    scored = model.score(test, "score")
    return {"segment_summary": segment_summary(scored, "score", TARGET, params),
            "retention_impact": retention_impact(scored, "score", TARGET, params)}
