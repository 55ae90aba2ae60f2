"""Data profile: shape, nulls per column, class balance (one pass each)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def shape(df: DataFrame) -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_cols", F.lit(len(df.columns)))


def null_profile(df: DataFrame) -> DataFrame:
    """(column, null_count) for columns with at least one null."""
    wide = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    long = wide.unpivot([], df.columns, "column", "null_count")
    return long.where(F.col("null_count") > 0)


def class_distribution(df: DataFrame, label: str = "churn") -> DataFrame:
    """count and rate per class in one pass (total summed over the class rows)."""
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("rate", F.col("count") / F.sum("count").over(Window.partitionBy())))


def imbalance_ratio(df: DataFrame, label: str = "churn") -> DataFrame:
    """n0 / n1 and the positive rate in one aggregate."""
    y = F.col(label)
    return df.agg(F.count_if(y == 0).alias("n_negative"),
                  F.count_if(y == 1).alias("n_positive"),
                  F.avg(y.cast("double")).alias("positive_rate")).withColumn(
        "imbalance_ratio", F.try_divide(F.col("n_negative").cast("double"), F.col("n_positive")))
