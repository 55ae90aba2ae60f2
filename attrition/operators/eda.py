"""Exploratory tables (the data behind the original charts).

* churn share per class,
* equal-width histograms per class with each class's own range,
* churn rate per category, sorted,
* pairwise Pearson correlations (strict lower triangle).

Each is one or two aggregate passes with partial aggregation; the only
joins are against per-class range rows, one per class.
"""

from __future__ import annotations

from functools import partial
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.binning import equal_width_bin
from ..session import checkpointed, ship_package


def churn_share(df: DataFrame, label: str = "churn") -> DataFrame:
    """count and share per class (one pass; the total is summed over the
    per-class rows, not over the input)."""
    return (df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
            .withColumn("share", F.col("count") / F.sum("count").over(Window.partitionBy())))


def histogram(df: DataFrame, value: str, n_bins: int, class_col: str = "churn",
              fill_empty: bool = True) -> DataFrame:
    """Per class: bin index, bin edges and row count; bins span the class's
    own [min, max], the last bin closed. Empty bins are listed with 0."""
    rng = df.where(F.col(value).isNotNull()).groupBy(class_col).agg(
        F.min(F.col(value).cast("double")).alias("lo"),
        F.max(F.col(value).cast("double")).alias("hi"))
    # Read twice (binning and the bin grid): checkpointed so neither re-derives
    # it from the input. One row per class; the optimizer picks the join.
    rng = checkpointed(rng)
    binned = (df.where(F.col(value).isNotNull()).join(rng, on=class_col)
              .withColumn("bin", equal_width_bin(value, F.col("lo"), F.col("hi"), n_bins)))
    counts = binned.groupBy(class_col, "bin").agg(F.count(F.lit(1)).alias("count"))
    if not fill_empty:
        grid = counts.join(rng, on=class_col)
    else:
        grid = (rng.withColumn("bin", F.explode(F.sequence(F.lit(0), F.lit(n_bins - 1))))
                .join(counts, on=[class_col, "bin"], how="left")
                .withColumn("count", F.coalesce(F.col("count"), F.lit(0).cast("bigint"))))
    width = (F.col("hi") - F.col("lo")) / F.lit(n_bins)
    return grid.select(class_col, "bin",
                       (F.col("lo") + F.col("bin") * width).alias("bin_lo"),
                       (F.col("lo") + (F.col("bin") + 1) * width).alias("bin_hi"),
                       "count")


def rate_by(df: DataFrame, key: str, label: str = "churn", ascending: bool = False) -> DataFrame:
    """Mean of the label per category (null category dropped), sorted by rate."""
    out = (df.where(F.col(key).isNotNull()).groupBy(key)
           .agg(F.avg(F.col(label).cast("double")).alias("churn_rate"),
                F.count(F.lit(1)).alias("count")))
    order = F.col("churn_rate").asc() if ascending else F.col("churn_rate").desc()
    return out.orderBy(order, F.col(key))


def correlation_pairs(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation for every pair (row column after column column in
    the given order), one aggregate pass; (col_a, col_b, corr)."""
    pairs = [(b, a) for a, b in combinations(columns, 2)]
    wide = df.agg(*[F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"c{i}")
                    for i, (a, b) in enumerate(pairs)])
    parts = ", ".join(f"'{a}', '{b}', c{i}" for i, (a, b) in enumerate(pairs))
    return wide.selectExpr(f"stack({len(pairs)}, {parts}) as (col_a, col_b, corr)")


def correlation_matrix(df: DataFrame, columns: list[str]) -> DataFrame:
    """Pearson correlation of every pair of numeric columns, (col_a, col_b, corr),
    row column after column column in the given order.

    A blocked Gram matrix in place of an aggregate per pair: each task adds up matrix
    products of its rows (values less the column's mean, squares, presence) and sends a
    row per pair once. A pair counts the rows where both are present; without variance
    its correlation is null.
    """
    ship_package(df.sparkSession)
    x = df.select(*[F.col(f"`{c}`").cast("double").alias(f"c{i}") for i, c in enumerate(columns)])
    means = x.agg(*[F.coalesce(F.avg(c), F.lit(0.0)).alias(c) for c in x.columns]).first()
    cells = x.mapInArrow(partial(_gram, means=[means[c] for c in x.columns]),
                         "i int, j int, n double, a double, b double, aa double, bb double, ab double") \
        .groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "a", "b", "aa", "bb", "ab")])
    va = F.col("n") * F.col("aa") - F.col("a") * F.col("a")
    vb = F.col("n") * F.col("bb") - F.col("b") * F.col("b")
    corr = F.when((va > 1e-9) & (vb > 1e-9),
                  (F.col("n") * F.col("ab") - F.col("a") * F.col("b")) / F.sqrt(va) / F.sqrt(vb))
    names = F.array(*[F.lit(c) for c in columns])
    return cells.select(F.get(names, F.col("i")).alias("col_a"), F.get(names, F.col("j")).alias("col_b"),
                        corr.alias("corr"))


def _gram(batches, means):
    total = 0.0
    for b in batches:
        raw = np.column_stack([c.to_numpy(zero_copy_only=False) for c in b.columns])
        here = ~np.isnan(raw)
        x, m = np.where(here, raw - means, 0.0), here.astype(float)
        total = total + np.stack([m.T @ m, x.T @ m, m.T @ x, (x * x).T @ m, m.T @ (x * x), x.T @ x])
    if isinstance(total, np.ndarray):
        i, j = np.tril_indices(total.shape[1], -1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(i, pa.int32()), pa.array(j, pa.int32()), *[pa.array(t[i, j]) for t in total]],
            ["i", "j", "n", "a", "b", "aa", "bb", "ab"])
