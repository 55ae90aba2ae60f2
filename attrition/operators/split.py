"""Train/test split and fold ids from hashes of the row id.

``hash_split`` (default): a row is in the test side when its hash uniform
is below ``test_size``. It is a projection: no shuffle, no global state,
stable under re-partitioning and executor loss; per-class shares are
``test_size`` up to sampling noise, which is the same for every class, so
the split is stratified in expectation.

``exact_split``: exactly ``round(n_c * test_size)`` test rows per class
(rows with the smallest hashes, ties by id). A single window per class
would put half the data in one task, so it ranks in two levels: counts per
(class, hash bucket of 2^20) -> cumulative counts on that bounded table ->
rows below the boundary bucket are test, above are train, and only the
boundary bucket's rows are ranked.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.random import hash_bits, uniform
from ..schema import ID_COL, TARGET
from ..session import checkpointed

BUCKET_SHIFT = 12  # 32-bit hash >> 12 = 2^20 buckets per class


def hash_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
               id_col: str = ID_COL) -> DataFrame:
    """Adds ``is_test`` (boolean)."""
    return df.withColumn("is_test", uniform(id_col, "split", seed) < F.lit(float(test_size)))


def mark_smallest(df: DataFrame, hash_col: str, want: DataFrame | Callable[[DataFrame], DataFrame],
                  group_col: str, id_col: str = ID_COL, out: str = "is_test") -> DataFrame:
    """Flag exactly ``want.__want`` rows per group: those with the smallest
    (hash, id). ``hash_col`` holds a 32-bit unsigned hash; ``want`` has one
    row per group (group_col, __want), or is a function of the bucket-count
    table (group_col, __b, __n) that returns it."""
    keyed = df.withColumn("__b", F.shiftright(F.col(hash_col), BUCKET_SHIFT))
    # At most groups x 2^20 rows whatever the input size; checkpointed so the
    # wanted counts and the boundary read it instead of the input.
    counts = checkpointed(keyed.groupBy(group_col, "__b").agg(F.count(F.lit(1)).alias("__n")))
    if callable(want):
        want = want(counts)
    w = Window.partitionBy(group_col).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    cum = counts.withColumn("__before", F.coalesce(F.sum("__n").over(w), F.lit(0)))
    cum = cum.join(F.broadcast(want), on=group_col)
    # The boundary bucket per group: it holds the last wanted row.
    boundary = cum.where((F.col("__before") < F.col("__want"))
                         & (F.col("__before") + F.col("__n") >= F.col("__want"))).select(
        group_col, F.col("__b").alias("__bb"), (F.col("__want") - F.col("__before")).alias("__need"))
    marked = keyed.join(F.broadcast(boundary), on=group_col, how="left")
    in_boundary = F.col("__b") == F.col("__bb")
    wr = Window.partitionBy(group_col, "__b").orderBy(hash_col, id_col)
    ranked = marked.where(in_boundary).withColumn("__rk", F.row_number().over(wr)).withColumn(
        out, F.col("__rk") <= F.col("__need")).drop("__rk")
    rest = marked.where(~in_boundary | F.col("__bb").isNull()).withColumn(
        out, F.coalesce(F.col("__b") < F.col("__bb"), F.lit(False)))
    return ranked.unionByName(rest).drop("__b", "__bb", "__need")


def exact_split(df: DataFrame, test_size: float = 0.2, seed: int = 42,
                label: str = TARGET, id_col: str = ID_COL) -> DataFrame:
    """Adds ``is_test`` with exactly round(n_class * test_size) test rows per class."""
    keyed = df.withColumn("__h", hash_bits(id_col, "split", seed))

    def want(counts: DataFrame) -> DataFrame:
        return counts.groupBy(label).agg(
            F.round(F.sum("__n") * F.lit(float(test_size))).cast("bigint").alias("__want"))

    return mark_smallest(keyed, "__h", want, label, id_col).drop("__h")


def fold_ids(df: DataFrame, k: int = 5, seed: int = 42, id_col: str = ID_COL,
             name: str = "fold") -> DataFrame:
    """Fold 0..k-1 from the hash of the id (balanced per class in expectation)."""
    return df.withColumn(name, F.least(F.floor(uniform(id_col, "fold", seed) * F.lit(k)),
                                       F.lit(k - 1)).cast("int"))


def exact_folds(df: DataFrame, k: int = 5, seed: int = 42, label: str = TARGET, id_col: str = ID_COL,
                name: str = "fold", stream: str = "fold") -> DataFrame:
    """Exactly stratified folds: per class, rows in the order of (hash, id) are
    dealt in turn, so fold sizes differ by one row per class at most.

    A row's rank is the count of the hash buckets before its own (at most
    classes x 2^20 rows) plus its place inside the bucket. Equal ids tie and
    take neighbouring folds; null ids come first."""
    keyed = df.withColumn("__h", F.coalesce(hash_bits(id_col, stream, seed), F.lit(0))) \
        .withColumn("__b", F.shiftright(F.col("__h"), BUCKET_SHIFT))
    counts = checkpointed(keyed.groupBy(label, "__b").agg(F.count(F.lit(1)).alias("__n")))
    w = Window.partitionBy(label).orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)
    before = counts.select(F.col(label).alias("__label"), F.col("__b").alias("__bucket"),
                           F.coalesce(F.sum("__n").over(w), F.lit(0)).alias("__before"))
    place = F.row_number().over(Window.partitionBy(label, "__b").orderBy("__h", id_col))
    ranked = keyed.withColumn("__at", place).join(
        before, F.col(label).eqNullSafe(F.col("__label")) & (F.col("__b") == F.col("__bucket")))
    return ranked.withColumn(name, ((F.col("__before") + F.col("__at") - 1) % k).cast("int")) \
        .select(*[c for c in df.columns if c != name], name)


def split_report(split_df: DataFrame, label: str = TARGET) -> DataFrame:
    """Rows and churn rate per side."""
    side = F.when(F.col("is_test"), F.lit("test")).otherwise(F.lit("train"))
    return split_df.groupBy(side.alias("split")).agg(
        F.count(F.lit(1)).alias("rows"), F.avg(F.col(label).cast("double")).alias("churn_rate"))
