"""Cleaning of raw customer rows (own design: the original body is absent).

1. cast every column to the declared raw type (``try_cast``: text such as
   ' ' in total_charges becomes null instead of failing the job),
2. trim text columns,
3. one row per customer_id (deterministic: the smallest row as a struct),
4. missing total_charges filled with monthly_charges * tenure.

De-duplication is a hash aggregate on the id with map-side partial
aggregation, so even an id that holds a third of the rows collapses to one
row per map task before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ID_COL, RAW_SCHEMA


def cast_raw(df: DataFrame) -> DataFrame:
    exprs = {}
    present = set(df.columns)  # one schema fetch, not one per field
    for f in RAW_SCHEMA.fields:
        if f.name not in present:
            continue
        c = F.col(f.name)
        if isinstance(f.dataType, T.StringType):
            exprs[f.name] = F.trim(c.cast("string"))
        else:
            exprs[f.name] = F.expr(f"try_cast(trim(cast(`{f.name}` as string)) as {f.dataType.simpleString()})")
    return df.withColumns(exprs)


def dedupe(df: DataFrame, key: str = ID_COL) -> DataFrame:
    others = [c for c in df.columns if c != key]
    if not others:
        return df.groupBy(key).agg()
    return (df.groupBy(key).agg(F.min(F.struct(*others)).alias("__r"))
            .select(key, *[F.col(f"__r.{c}").alias(c) for c in others])
            .select(*df.columns))


def fill_total_charges(df: DataFrame) -> DataFrame:
    if "total_charges" not in df.columns:
        return df
    fill = F.round(F.col("monthly_charges") * F.col("tenure"), 2)
    return df.withColumn("total_charges", F.coalesce(F.col("total_charges"), fill))


def clean_data(df: DataFrame, deduplicate: bool = True) -> DataFrame:
    out = cast_raw(df)
    if deduplicate and ID_COL in out.columns:
        out = dedupe(out)
    return fill_total_charges(out)
