"""Helpers shared by the corpus operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.session import shared_dir, ship_package

#: White space of the word and line contracts: space, tab, LF, VT, FF, CR.
SPACE = " \t\n\x0b\f\r"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

#: Rows a table may have to be broadcast; beyond it the join shuffles.
BROADCAST_ROWS = 1_000_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once into the shared folder and read it back: cuts the
    lineage with a table every executor can reread after a loss."""
    spark = df.sparkSession
    path = shared_dir(spark, f"llm-{name}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._stored_at = path
    return out


def forget(df: DataFrame) -> None:
    """Delete the files of a ``stored`` table that nothing reads any more."""
    sc = df.sparkSession.sparkContext
    path = sc._jvm.org.apache.hadoop.fs.Path(df._stored_at)
    path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def sized(df: DataFrame, rows: int | None = None) -> DataFrame:
    """``df`` with a broadcast hint if its counted rows are few, else as it is."""
    n = df.count() if rows is None else rows
    return F.broadcast(df) if n <= BROADCAST_ROWS else df


def text_of(name: str = "text") -> Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


def ascii_lower(c: Column) -> Column:
    """Lower-case A-Z only. ``lower`` is the fast form for ASCII strings."""
    return F.when(F.octet_length(c) == F.char_length(c), F.lower(c)).otherwise(
        F.translate(c, UPPER, UPPER.lower()))


def row_key(*cols: Column) -> list[Column]:
    """Two 64-bit hashes of the row's id and text. Equal rows share a key, so
    whatever is derived from id and text alone may be joined on it."""
    return [F.xxhash64(*cols), F.xxhash64(F.lit("second"), *cols)]


def with_replaced(df: DataFrame, cols: dict[str, Column], drop: tuple[str, ...] = ()) -> DataFrame:
    """Add output columns; an input column of the same name (in any case) is replaced."""
    new = {k.lower() for k in cols}
    keep = [F.col(f"`{c}`") for c in df.columns if c.lower() not in new and c not in drop]
    return df.select(*keep, *[v.alias(k) for k, v in cols.items()])


def python_ready(df: DataFrame) -> DataFrame:
    """Ship this package to the Python workers before an Arrow function runs."""
    ship_package(df.sparkSession)
    return df
