"""Order-based cumulative sums over the exchange, without a window.

"The sum over all rows ranked at or above this one" in three steps:

1. one range exchange by (group, value descending), sorted inside each partition
   and checkpointed with the partition's number; how many partitions there are
   follows from the data's size (AQE) and ``spark.sql.shuffle.partitions``;
2. totals per (partition, group): since partitions are ranges, these are about
   as many rows as there are partitions plus groups, and they are added up in order;
3. a pass over the sorted rows that carries a running sum on from each
   partition's offset.

No task holds more than a batch of rows, and no row is shuffled twice. Input should
already be aggregated to one row per distinct ordering value (per group); the
exchange keeps equal values together, so ties across rows would still be in
one partition. Null ordering values come last.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import checkpointed, ship_package

PART, KEY = "__part", "__key"


def prefix_sums_desc(df: DataFrame, order_col: str, value_cols: list[str],
                     group_cols: list[str] | None = None, suffix: str = "_cum",
                     total_suffix: str | None = None, partitions: int | None = None) -> DataFrame:
    """Add ``<v><suffix>`` = sum of ``v`` over rows with order value >= this row's
    (within the group), for each ``v`` in ``value_cols``, and ``<v><total_suffix>``,
    the group's total, if that is named.

    Rows must be unique per (group, order value). Integer columns are summed as
    longs, others as doubles; a null value adds nothing.
    """
    ship_package(df.sparkSession)
    groups = list(group_cols or [])
    key = F.xxhash64(*groups) if groups else F.lit(0).cast("long")
    order = [*[F.col(g) for g in groups], F.col(order_col).desc_nulls_last()]
    dealt = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    placed = checkpointed(dealt.sortWithinPartitions(*order).select(
        "*", F.spark_partition_id().alias(PART), key.alias(KEY)))
    whole = [isinstance(df.schema[v].dataType, T.IntegralType) for v in value_cols]
    kinds = ["long" if w else "double" for w in whole]
    sums = placed.groupBy(PART, KEY).agg(*[
        F.coalesce(F.sum(F.col(v).cast(k)), F.lit(0).cast(k)).alias(f"s{i}")
        for i, (v, k) in enumerate(zip(value_cols, kinds))]).collect()  # about partitions + groups rows
    offsets, running = {}, {}
    for part, k, *s in sorted(sums, key=lambda r: r[0]):
        offsets[part, k] = running.get(k, (0,) * len(s))
        running[k] = tuple(a + b for a, b in zip(offsets[part, k], s))
    added = [(f"{v}{suffix}", k) for v, k in zip(value_cols, kinds)]
    if total_suffix:
        added += [(f"{v}{total_suffix}", k) for v, k in zip(value_cols, kinds)]
    keep = [f.name for f in df.schema.fields]
    schema = T.StructType([*df.schema.fields, *[
        T.StructField(n, T.LongType() if k == "long" else T.DoubleType()) for n, k in added]])
    return placed.mapInArrow(partial(_running, keep=keep, values=value_cols, whole=whole, offsets=offsets,
                                     totals=running if total_suffix else None, names=schema.names), schema)


def _running(batches: Iterator[pa.RecordBatch], keep, values, whole, offsets, totals, names) -> Iterator[pa.RecordBatch]:
    at, carried = None, None  # the (partition, group) that the last batch ended in, and its sums so far
    for b in batches:
        n = b.num_rows
        if not n:
            continue
        part, key = b[PART].to_numpy(), b[KEY].to_numpy()
        new = np.concatenate([[True], (part[1:] != part[:-1]) | (key[1:] != key[:-1])])
        starts = np.flatnonzero(new)
        run = np.cumsum(new) - 1
        where = [(int(part[i]), int(key[i])) for i in starts]
        bases = [carried if w == at else offsets[w] for w in where]
        out = []
        for j, v in enumerate(values):
            kind = np.int64 if whole[j] else np.float64
            x = b[v].cast(pa.int64() if whole[j] else pa.float64()).fill_null(0).to_numpy(zero_copy_only=False)
            inside = np.cumsum(x, dtype=kind)
            before = (inside[starts] - x[starts])[run]
            out.append(inside - before + np.array([base[j] for base in bases], kind)[run])
        at, carried = where[-1], tuple(o[-1].item() for o in out)
        if totals is not None:
            out += [np.array([totals[k][j] for _, k in where], np.int64 if whole[j] else np.float64)[run]
                    for j in range(len(values))]
        yield pa.RecordBatch.from_arrays([*[b[c] for c in keep], *map(pa.array, out)], names)
