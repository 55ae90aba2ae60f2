"""Binary-classification metrics as Spark aggregates.

Input is a long table of (label 0/1, score) rows, optionally with group
columns (e.g. ``model``) so many models are evaluated in one pass. Decisions
use an explicit threshold (``score >= threshold``) everywhere.

* accuracy, F1 of class 1, confusion counts: one conditional aggregate;
* AUC (exact, ties count half) and step-wise average precision: aggregate
  per distinct score, then cumulative sums over a range exchange
  (:mod:`..functions.prefix`);
* ROC / PR curves: the same cumulative table, one row per distinct score.

Every output is a DataFrame; nothing is collected.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.prefix import prefix_sums_desc


def _div(a: Column, b: Column) -> Column:
    return F.coalesce(F.try_divide(a.cast("double"), b.cast("double")), F.lit(0.0))


def confusion_counts(df: DataFrame, label: str = "churn", score: str = "score",
                     threshold: float = 0.5, group_cols: list[str] | None = None,
                     prediction: str | None = None) -> DataFrame:
    """tp, fp, tn, fn per group (a one-row frame without groups)."""
    y = F.col(label)
    pred = F.col(prediction) if prediction else (F.col(score) >= F.lit(threshold)).cast("int")
    aggs = [
        F.count_if((y == 1) & (pred == 1)).alias("tp"),
        F.count_if((y == 0) & (pred == 1)).alias("fp"),
        F.count_if((y == 0) & (pred == 0)).alias("tn"),
        F.count_if((y == 1) & (pred == 0)).alias("fn"),
    ]
    groups = group_cols or []
    return df.groupBy(*groups).agg(*aggs) if groups else df.agg(*aggs)


def accuracy(df: DataFrame, label: str = "churn", score: str = "score",
             threshold: float = 0.5) -> DataFrame:
    pred = (F.col(score) >= F.lit(threshold)).cast("int")
    return df.agg(F.avg((F.col(label) == pred).cast("double")).alias("accuracy"))


def f1_expr() -> Column:
    return _div(F.lit(2) * F.col("tp"), F.lit(2) * F.col("tp") + F.col("fp") + F.col("fn"))


def f1(df: DataFrame, label: str = "churn", score: str = "score", threshold: float = 0.5) -> DataFrame:
    return confusion_counts(df, label, score, threshold).select(f1_expr().alias("f1"))


def score_counts(df: DataFrame, label: str = "churn", score: str = "score",
                 group_cols: list[str] | None = None) -> DataFrame:
    """One row per (group, distinct score): positives, negatives, cumulative
    positives/negatives at or above the score, and group totals P, N."""
    groups = list(group_cols or [])
    per = df.groupBy(*groups, F.col(score).alias("threshold")).agg(
        F.sum(F.col(label).cast("long")).alias("tp"),
        F.sum((1 - F.col(label)).cast("long")).alias("fp"))
    # One exchange by score, checkpointed in order: the scored input is scanned
    # once however many metrics and curves read the table.
    return prefix_sums_desc(per, "threshold", ["tp", "fp"], groups, total_suffix="_all") \
        .withColumnsRenamed({"tp_all": "P", "fp_all": "N"})


def auc_avg_precision(df: DataFrame, label: str = "churn", score: str = "score",
                      group_cols: list[str] | None = None) -> DataFrame:
    """Exact ROC AUC (ties half) and step-wise average precision per group."""
    groups = list(group_cols or [])
    sc = score_counts(df, label, score, groups)
    auc_term = F.col("fp") * ((F.col("tp_cum") - F.col("tp")) + F.col("tp") / F.lit(2.0))
    ap_term = F.col("tp") * _div(F.col("tp_cum"), F.col("tp_cum") + F.col("fp_cum"))
    aggs = [
        _div(F.sum(auc_term), F.first("P") * F.first("N")).alias("auc_roc"),
        _div(F.sum(ap_term), F.first("P")).alias("avg_precision"),
    ]
    return sc.groupBy(*groups).agg(*aggs) if groups else sc.agg(*aggs)


def roc_curve(df: DataFrame, label: str = "churn", score: str = "score",
              group_cols: list[str] | None = None) -> DataFrame:
    """(threshold, fpr, tpr) for every distinct score plus the (0, 0) start at +inf."""
    groups = list(group_cols or [])
    sc = score_counts(df, label, score, groups)
    pts = sc.select(*groups, F.col("threshold").cast("double").alias("threshold"),
                    _div(F.col("fp_cum"), F.col("N")).alias("fpr"),
                    _div(F.col("tp_cum"), F.col("P")).alias("tpr"))
    start = sc.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    start = start.select(*groups, F.lit(float("inf")).alias("threshold"),
                         F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return pts.unionByName(start)


def pr_curve(df: DataFrame, label: str = "churn", score: str = "score",
             group_cols: list[str] | None = None) -> DataFrame:
    """(threshold, precision, recall) per distinct score plus the closing
    point precision 1, recall 0 (threshold null)."""
    groups = list(group_cols or [])
    sc = score_counts(df, label, score, groups)
    pts = sc.select(*groups, F.col("threshold").cast("double").alias("threshold"),
                    _div(F.col("tp_cum"), F.col("tp_cum") + F.col("fp_cum")).alias("precision"),
                    F.when(F.col("P") == 0, F.lit(1.0))
                    .otherwise(_div(F.col("tp_cum"), F.col("P"))).alias("recall"))
    end = sc.groupBy(*groups).agg(F.count(F.lit(1)).alias("__n"))
    end = end.select(*groups, F.lit(None).cast("double").alias("threshold"),
                     F.lit(1.0).alias("precision"), F.lit(0.0).alias("recall"))
    return pts.unionByName(end)


def confusion_matrix(df: DataFrame, label: str = "churn", score: str = "score",
                     threshold: float = 0.5) -> DataFrame:
    """All four cells (actual, predicted, count), also when a cell is empty."""
    cc = confusion_counts(df, label, score, threshold)
    return cc.selectExpr(
        "stack(4, 0, 0, tn, 0, 1, fp, 1, 0, fn, 1, 1, tp) as (actual, predicted, count)")


def classification_report(df: DataFrame, label: str = "churn", score: str = "score",
                          threshold: float = 0.5) -> DataFrame:
    """Per class precision/recall/f1/support, accuracy, macro and weighted average."""
    cc = confusion_counts(df, label, score, threshold)
    tp, fp, tn, fn = (F.col(c) for c in ("tp", "fp", "tn", "fn"))
    s1, s0 = tp + fn, tn + fp
    n = s0 + s1
    p1, r1 = _div(tp, tp + fp), _div(tp, s1)
    p0, r0 = _div(tn, tn + fn), _div(tn, s0)
    f1_1 = _div(F.lit(2) * tp, F.lit(2) * tp + fp + fn)
    f1_0 = _div(F.lit(2) * tn, F.lit(2) * tn + fn + fp)
    wide = cc.select(
        p0.alias("p0"), r0.alias("r0"), f1_0.alias("f0"), s0.alias("s0"),
        p1.alias("p1"), r1.alias("r1"), f1_1.alias("f1"), s1.alias("s1"),
        _div(tp + tn, n).alias("acc"), n.alias("n"),
        ((p0 + p1) / 2).alias("mp"), ((r0 + r1) / 2).alias("mr"), ((f1_0 + f1_1) / 2).alias("mf"),
        _div(p0 * s0 + p1 * s1, n).alias("wp"), _div(r0 * s0 + r1 * s1, n).alias("wr"),
        _div(f1_0 * s0 + f1_1 * s1, n).alias("wf"))
    return wide.selectExpr(
        "stack(5, '0', p0, r0, f0, s0, '1', p1, r1, f1, s1, "
        "'accuracy', cast(null as double), cast(null as double), acc, n, "
        "'macro avg', mp, mr, mf, n, 'weighted avg', wp, wr, wf, n) "
        "as (class, precision, recall, f1_score, support)")


def metrics_table(df: DataFrame, label: str = "churn", score: str = "score",
                  threshold: float = 0.5, group_cols: list[str] | None = None) -> DataFrame:
    """accuracy, auc_roc, f1, avg_precision per group (one row per model)."""
    groups = list(group_cols or [])
    pred = (F.col(score) >= F.lit(threshold)).cast("int")
    simple_aggs = [
        F.avg((F.col(label) == pred).cast("double")).alias("accuracy"),
        F.count_if((F.col(label) == 1) & (pred == 1)).alias("tp"),
        F.count_if((F.col(label) == 0) & (pred == 1)).alias("fp"),
        F.count_if((F.col(label) == 1) & (pred == 0)).alias("fn"),
    ]
    simple = df.groupBy(*groups).agg(*simple_aggs) if groups else df.agg(*simple_aggs)
    simple = simple.select(*groups, "accuracy", f1_expr().alias("f1"))
    ranks = auc_avg_precision(df, label, score, groups)
    if groups:
        return simple.join(ranks, on=groups, how="inner")
    r = ranks.first()  # one row of two numbers
    return simple.select("accuracy", "f1", F.lit(r["auc_roc"]).alias("auc_roc"),
                         F.lit(r["avg_precision"]).alias("avg_precision"))


def model_comparison(long_df: DataFrame, label: str = "churn", score: str = "score",
                     model_col: str = "model", threshold: float = 0.5) -> DataFrame:
    """Metrics per model, best first (AUC descending, then name)."""
    return (metrics_table(long_df, label, score, threshold, [model_col])
            .select(model_col, "accuracy", "auc_roc", "f1", "avg_precision")
            .orderBy(F.col("auc_roc").desc(), F.col(model_col)))


def model_comparison_long(wide: DataFrame, model_col: str = "model") -> DataFrame:
    """(model, metric, value) rows of a model comparison."""
    return wide.unpivot([model_col], ["accuracy", "auc_roc", "f1", "avg_precision"],
                        "metric", "value")
