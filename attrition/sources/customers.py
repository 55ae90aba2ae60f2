"""Customer sources: synthetic generator, CSV/parquet reader and writer.

The generator derives one customer per key of any key table (the driver's
``customer`` table here, ``spark.range`` for a stand-alone run). It is a
single projection over the scan: no shuffle, no driver state, and every
draw is a hash of (key, column, seed), so the output does not depend on
partitioning and a lost task recomputes the same rows.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.random import gamma_2_5, normal, uniform
from ..schema import RAW_COLUMNS, RAW_SCHEMA


def _d(x: float) -> Column:
    return F.lit(float(x))


def _pick(u: Column, cuts: list[tuple[float, str]], last: str) -> Column:
    expr = None
    for threshold, value in cuts:
        cond = u < _d(threshold)
        expr = F.when(cond, F.lit(value)) if expr is None else expr.when(cond, F.lit(value))
    return expr.otherwise(F.lit(last))


# ---------------------------------------------------------------------------
# Marginal shares, add-on shares and charge model of the
# synthetic customer population.
# ---------------------------------------------------------------------------
ADDON_SHARES = {
    "online_security": 0.29,
    "tech_support": 0.29,
    "online_backup": 0.34,
    "device_protection": 0.34,
    "streaming_tv": 0.38,
    "streaming_movies": 0.39,
}
CHARGE_MODEL = {  # internet_service -> (mean, sd) of monthly charges
    "Fiber optic": (80, 20),
    "DSL": (55, 15),
    "No": (25, 8),
}

# ---------------------------------------------------------------------------
# Score card of the churn propensity (additive terms).
# ---------------------------------------------------------------------------
BASE_RATE = 0.05
CONTRACT_UPLIFT = {"Month-to-month": 0.28, "One year": 0.05}
SHORT_TENURE_6 = 0.20
SHORT_TENURE_12 = 0.10
LONG_TENURE_48 = -0.12
HIGH_CHARGE_80 = 0.12
NO_TECH_SUPPORT = 0.08
NO_ONLINE_SECURITY = 0.07
FIBER = 0.08
ELECTRONIC_CHECK = 0.08
SENIOR = 0.05
MAX_PROPENSITY = 0.95


def propensity(df_cols: dict[str, Column] | None = None) -> Column:
    """Rule score-card churn propensity in [0, 0.95] as a double column."""
    c = df_cols or {}

    def col(name: str) -> Column:
        return c.get(name, F.col(name))

    zero = _d(0)
    contract = (F.when(col("contract") == "Month-to-month", _d(CONTRACT_UPLIFT["Month-to-month"]))
                .when(col("contract") == "One year", _d(CONTRACT_UPLIFT["One year"]))
                .otherwise(zero))
    terms = [
        contract,
        F.when(col("tenure") <= 6, _d(SHORT_TENURE_6)).otherwise(zero),
        F.when(col("tenure") <= 12, _d(SHORT_TENURE_12)).otherwise(zero),
    ]
    total = reduce(lambda a, b: a + b, terms, _d(BASE_RATE))
    total = total - F.when(col("tenure") >= 48, _d(-LONG_TENURE_48)).otherwise(zero)
    for term in [
        F.when(col("monthly_charges") > 80, _d(HIGH_CHARGE_80)).otherwise(zero),
        F.when(col("tech_support") == "No", _d(NO_TECH_SUPPORT)).otherwise(zero),
        F.when(col("online_security") == "No", _d(NO_ONLINE_SECURITY)).otherwise(zero),
        F.when(col("internet_service") == "Fiber optic", _d(FIBER)).otherwise(zero),
        F.when(col("payment_method") == "Electronic check", _d(ELECTRONIC_CHECK)).otherwise(zero),
        col("senior_citizen") * _d(SENIOR),
    ]:
        total = total + term
    return F.least(_d(MAX_PROPENSITY), F.greatest(_d(0.0), total))


def generate_customers(keys: DataFrame, key_col: str = "c_custkey", seed: int = 42,
                       keep_propensity: bool = False) -> DataFrame:
    """21-column synthetic customers, one per key (plus ``p`` if asked)."""
    k = F.col(key_col)

    def u(stream: str) -> Column:
        return uniform(key_col, stream, seed)

    inet = _pick(u("inet"), [(0.34, "DSL"), (0.78, "Fiber optic")], "No")
    base = keys.select(
        F.concat(F.lit("CUST"), F.lpad(k.cast("string"), 7, "0")).alias("customer_id"),
        F.when(u("gender") < _d(0.5), F.lit("Male")).otherwise(F.lit("Female")).alias("gender"),
        F.when(u("senior") < _d(0.84), F.lit(0)).otherwise(F.lit(1)).alias("senior_citizen"),
        F.when(u("partner") < _d(0.48), F.lit("Yes")).otherwise(F.lit("No")).alias("partner"),
        F.when(u("dependents") < _d(0.3), F.lit("Yes")).otherwise(F.lit("No")).alias("dependents"),
        F.floor(F.least(_d(72.0), F.greatest(_d(1.0), F.lit(14) * gamma_2_5(key_col, "t", seed))))
        .cast("int").alias("tenure"),
        _pick(u("contract"), [(0.55, "Month-to-month"), (0.79, "One year")], "Two year").alias("contract"),
        inet.alias("internet_service"),
        *[u(name).alias(f"u_{name}") for name in ADDON_SHARES],
        F.when(u("phone") < _d(0.9), F.lit("Yes")).otherwise(F.lit("No")).alias("phone_service"),
        u("lines").alias("u_lines"),
        F.when(u("paperless") < _d(0.59), F.lit("Yes")).otherwise(F.lit("No")).alias("paperless_billing"),
        _pick(u("pay"), [(0.34, "Electronic check"), (0.57, "Mailed check"),
                         (0.79, "Bank transfer (automatic)")], "Credit card (automatic)")
        .alias("payment_method"),
        normal(key_col, "charge", seed).alias("z_charge"),
        u("total").alias("u_total"),
        u("churn").alias("u_churn"),
    )

    no_inet = F.col("internet_service") == "No"
    addons = {
        name: F.when(no_inet, F.lit("No internet service"))
        .when(F.col(f"u_{name}") < _d(share), F.lit("Yes")).otherwise(F.lit("No"))
        for name, share in ADDON_SHARES.items()
    }
    charge = None
    for service, (mean, sd) in CHARGE_MODEL.items():
        val = F.lit(mean) + F.lit(sd) * F.col("z_charge")
        if charge is None:
            charge = F.when(F.col("internet_service") == service, val)
        elif service == "No":
            charge = charge.otherwise(val)
        else:
            charge = charge.when(F.col("internet_service") == service, val)
    monthly = F.round(F.least(_d(120.0), F.greatest(_d(18.0), charge)), 2)

    step = base.select(
        "customer_id", "gender", "senior_citizen", "partner", "dependents", "tenure",
        "contract", "internet_service",
        *[addons[n].alias(n) for n in ["online_security", "tech_support", "online_backup",
                                       "device_protection", "streaming_tv", "streaming_movies"]],
        "phone_service",
        F.when(F.col("phone_service") == "No", F.lit("No phone service"))
        .when(F.col("u_lines") < _d(0.42), F.lit("Yes")).otherwise(F.lit("No")).alias("multiple_lines"),
        "paperless_billing", "payment_method",
        monthly.alias("monthly_charges"), "u_total", "u_churn",
    )
    step = step.withColumn(
        "total_charges",
        F.round(F.col("monthly_charges") * F.col("tenure") * (_d(0.9) + _d(0.2) * F.col("u_total")), 2))
    step = step.withColumn("p", propensity())
    step = step.withColumn("churn", F.when(F.col("u_churn") < F.col("p"), F.lit(1)).otherwise(F.lit(0)))
    cols = RAW_COLUMNS + (["p"] if keep_propensity else [])
    return step.select(*cols)


def customers_from_tables(spark: SparkSession, sf_dir: str, seed: int = 42,
                          keep_propensity: bool = False) -> DataFrame:
    """The fixture customer table derived from ``customer``'s keys."""
    keys = spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey")
    return generate_customers(spread(keys), "c_custkey", seed, keep_propensity)


def spread(keys: DataFrame) -> DataFrame:
    """Round-robin the key column over the cores when the scan yields fewer
    splits than cores (a small file is one split; each key costs ~27 hash
    draws). A large table already has enough splits and is left alone."""
    target = keys.sparkSession.sparkContext.defaultParallelism
    if keys.rdd.getNumPartitions() < target:
        return keys.repartition(target)
    return keys


def read_customers(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """Read a customer table with the declared schema (CSV never infers types)."""
    if fmt == "csv":
        return spark.read.schema(RAW_SCHEMA).option("header", True).csv(path)
    df = spark.read.format(fmt).load(path)
    present = set(df.columns)
    return df.select(*[F.col(f.name).cast(f.dataType) for f in RAW_SCHEMA.fields
                       if f.name in present])


def write_table(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Write a table (CSV with header, no index column; parquet by default)."""
    writer = df.write.mode(mode)
    if fmt == "csv":
        writer = writer.option("header", True)
    writer.format(fmt).save(path)
