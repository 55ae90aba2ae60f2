"""Results do not depend on the number of partitions."""

from pyspark.sql import functions as F

from attrition.operators.split import exact_split, fold_ids, hash_split
from attrition.sources.customers import generate_customers
from conftest import SF001


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_generator_partition_invariant(spark):
    keys = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey")
    a = generate_customers(keys.repartition(1), keep_propensity=True)
    b = generate_customers(keys.repartition(13), keep_propensity=True)
    assert _rows(a) == _rows(b)


def test_splits_partition_invariant(spark):
    keys = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey")
    for n in (1, 13):
        df = generate_customers(keys.repartition(n))
        rows = _rows(fold_ids(hash_split(df)).select("customer_id", "is_test", "fold"))
        ex = _rows(exact_split(df).select("customer_id", "is_test"))
        if n == 1:
            first, first_ex = rows, ex
    assert rows == first and ex == first_ex


def test_exact_split_counts(spark):
    keys = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey")
    df = exact_split(generate_customers(keys))
    got = {(r.churn, r.is_test): r["count"] for r in df.groupBy("churn", "is_test").count().collect()}
    n1 = got[(1, True)] + got[(1, False)]
    n0 = got[(0, True)] + got[(0, False)]
    assert got[(1, True)] == round(n1 * 0.2)
    assert got[(0, True)] == round(n0 * 0.2)


def test_hash_split_share(spark):
    keys = spark.read.parquet(f"{SF001}/customer.parquet").select("c_custkey")
    share = hash_split(generate_customers(keys)).agg(F.avg(F.col("is_test").cast("double"))).first()[0]
    assert 0.17 < share < 0.23
