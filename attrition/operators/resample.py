"""Class-imbalance handling: class weights, SMOTE over-sampling, k-NN.

Class weights are n / (2 * n_class) from one grouped count; the weight
column is attached with a literal map (two entries), no join.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..schema import ID_COL, TARGET


def class_weight_table(df: DataFrame, label: str = TARGET) -> DataFrame:
    """(label, count, weight) with weight = n / (n_classes * n_class)."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("count"))
    over_classes = Window.partitionBy()  # over the per-class rows only
    total = F.sum("count").over(over_classes)
    n_classes = F.count(F.lit(1)).over(over_classes)
    return counts.withColumn("weight", total / (n_classes * F.col("count")))


def with_class_weights(df: DataFrame, label: str = TARGET, out: str = "weight",
                       pos_weight: float | None = None) -> DataFrame:
    """Attach a weight column: balanced (default) or 1 / ``pos_weight`` for 0 / 1."""
    if pos_weight is not None:
        return df.withColumn(out, F.when(F.col(label) == 1, F.lit(float(pos_weight)))
                             .otherwise(F.lit(1.0)))
    rows = class_weight_table(df, label).collect()  # one row per class
    expr = None
    for r in rows:
        cond = F.col(label) == r[label]
        expr = F.when(cond, F.lit(float(r["weight"]))) if expr is None else expr.when(cond, F.lit(float(r["weight"])))
    return df.withColumn(out, expr.otherwise(F.lit(1.0)) if expr is not None else F.lit(1.0))


def smote_vectors(train: DataFrame, k: int = 5, seed: int = 42, label: str = TARGET,
                  id_col: str = ID_COL, features: str = "features",
                  chunk_size: int = 2048) -> DataFrame:
    """SMOTE on a vector column: the minority class is raised to the majority
    size with points x + u * (neighbour - x), u ~ U(0, 1), neighbour one of the
    k nearest minority points (exact k-NN, :mod:`.knn`).

    Base rows are used evenly: every minority row seeds ``q`` synthetic rows
    and exactly ``r`` rows (smallest hashes) one more, so the class sizes end
    up exactly equal. Neighbour pick and gap are hashes of (id, copy, seed),
    independent of partitioning. Adds ``is_synthetic``; synthetic ids are
    ``<id>#s<copy>``.
    """
    from pyspark.ml.functions import array_to_vector, vector_to_array

    from ..functions.random import hash_bits, uniform
    from .knn import knn
    from .split import mark_smallest

    base = train.withColumn("is_synthetic", F.lit(False))
    counts = {r[label]: r["n"] for r in train.groupBy(label).agg(F.count(F.lit(1)).alias("n")).collect()}
    if len(counts) != 2:
        return base
    minority = min(counts, key=lambda c: (counts[c], c))
    majority = max(counts, key=lambda c: (counts[c], -c))
    n_min, n_maj = counts[minority], counts[majority]
    n_syn = n_maj - n_min
    if n_syn <= 0 or n_min < 2:
        return base
    k_eff = min(k, n_min - 1)
    q, r = divmod(n_syn, n_min)

    mino = train.where(F.col(label) == F.lit(minority))
    nn = knn(mino, id_col, features, k=k_eff, chunk_size=chunk_size, seed=seed, with_vectors=True)
    nbrs = nn.groupBy(id_col).agg(  # exactly k_eff rows per id
        F.array_sort(F.collect_list(F.struct("rank", "neighbor_vec"))).alias("__nbrs"))
    keyed = mino.withColumn("__h", hash_bits(id_col, "smote_extra", seed))
    def want(counts):
        return counts.groupBy(label).agg(F.lit(r).cast("bigint").alias("__want"))

    marked = mark_smallest(keyed, "__h", want, label, id_col, out="__extra").drop("__h")
    seeds = (marked.join(nbrs, on=id_col, how="inner")
             .withColumn("__copies", F.lit(q) + F.col("__extra").cast("int"))
             .where(F.col("__copies") > 0)
             .withColumn("__j", F.explode(F.sequence(F.lit(0), F.col("__copies") - 1))))
    copy_key = F.concat(F.col(id_col), F.lit("#s"), F.col("__j").cast("string"))
    pick = F.least(F.floor(uniform(copy_key, "smote_nn", seed) * F.lit(k_eff)),
                   F.lit(k_eff - 1)).cast("int")
    gap = uniform(copy_key, "smote_gap", seed)
    synth = (seeds.withColumn("__x", vector_to_array(F.col(features), "float64"))
             .withColumn("__nb", F.element_at(F.col("__nbrs"), pick + 1).getField("neighbor_vec"))
             .withColumn("__gap", gap)
             .withColumn(features, array_to_vector(F.zip_with(
                 "__x", "__nb", lambda a, b: a + F.col("__gap") * (b - a))))
             .withColumn(id_col, copy_key)
             .withColumn("is_synthetic", F.lit(True)))
    synth = synth.select(*base.columns)
    return base.unionByName(synth)


def smote_base_of(synthetic_id: str) -> str:
    return synthetic_id.split("#s", 1)[0]
