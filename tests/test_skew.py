"""Hot keys: one key holding a third of the rows."""

import numpy as np
from pyspark.sql import functions as F

from attrition.operators.clean import clean_data
from attrition.operators.knn import knn
from attrition.plans import catalog
from conftest import SF001


def test_clean_with_hot_duplicate_id(spark):
    raw = catalog.raw(spark, SF001)
    n = raw.count()
    hot = raw.where(F.col("customer_id") == "CUST0000001")
    copies = hot.withColumn("_r", F.explode(F.sequence(F.lit(1), F.lit(n // 2)))).drop("_r")
    dup = raw.unionByName(copies)
    out = clean_data(dup)
    assert out.count() == n
    assert out.where(F.col("customer_id") == "CUST0000001").count() == 1


def _brute(ids, x, k):
    d = np.sqrt(((x[:, None, :] - x[None, :, :]) ** 2).sum(-1))
    res = {}
    for a in range(len(ids)):
        order = sorted((d[a, b], ids[b]) for b in range(len(ids)) if b != a)[:k]
        res[ids[a]] = [i for _, i in order]
    return res


def test_knn_hot_cell_of_identical_points(spark):
    emb = spark.read.parquet(f"{SF001}/embeddings.parquet").where("label < 3")
    first = emb.orderBy("vec_id").first().embedding
    hot = emb.withColumn("embedding", F.when(F.col("vec_id") % 3 == 0, F.array(*[F.lit(v) for v in first]))
                         .otherwise(F.col("embedding")))
    pdf = hot.toPandas()
    want = _brute(pdf["vec_id"].values, np.vstack(pdf["embedding"].values).astype(np.float64), 5)
    got = {}
    for r in knn(hot, "vec_id", "embedding", k=5, n_pivots=4, chunk_size=16).orderBy("vec_id", "rank").collect():
        got.setdefault(r.vec_id, []).append(r.neighbor_id)
    assert got == want
