"""Document fingerprints by content-defined chunking.

A gear hash over the last 32 bytes picks boundaries, normalised: before the
average length a boundary needs more zero bits than after it, and lengths stay
within a minimum and a maximum. Since a boundary depends on nearby bytes only,
chunks realign after an insertion. A fingerprint lists the digests of the
chunks, each with the bytes it stands for (repeats added), sorted by digest.
The likeness of two fingerprints is the shared bytes over the smaller total
(containment of the smaller in the larger).

Null text is empty, with an empty fingerprint; two empty fingerprints are alike
(1), an empty and another are not (0). Texts of any length are chunked whole.
For neighbours, rows are ordered by id (null first), ties by text hash; the
row after the last is the first, and a single row is its own neighbour. Empty
tables give empty results. Input columns other than id and text are not used.
"""

from __future__ import annotations

import functools
from bisect import bisect_left

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

LEAST, MEAN, MOST = 8, 32, 128  # bytes of a chunk
STRICT, LOOSE = 7, 3  # zero bits asked for before and after the mean length
REACH = 32  # bytes that the gear hash sees


@functools.lru_cache(maxsize=1)
def _gear():
    import xxhash

    return np.array([xxhash.xxh32_intdigest(bytes([b]), seed=1) for b in range(256)], np.uint32)


def boundaries(data: bytes, start: int = 0) -> list[int]:
    """Ends of the chunks of ``data`` from the chunk that begins at ``start`` on."""
    begin = max(0, start - REACH)
    h = _gear()[np.frombuffer(data, np.uint8, offset=begin)] if len(data) > begin else np.zeros(0, np.uint32)
    for step in (1, 2, 4, 8, 16):  # sum of gear << age, by doubling
        if len(h) > step:
            nxt = h.copy()
            nxt[step:] += h[:-step] << np.uint32(step)
            h = nxt
    loose = np.flatnonzero(h >> np.uint32(32 - LOOSE) == 0)
    strict = (loose[h[loose] >> np.uint32(32 - STRICT) == 0] + (begin + 1)).tolist()
    loose = (loose + (begin + 1)).tolist()
    out, s, n = [], start, len(data)
    while s < n:
        i = bisect_left(strict, s + LEAST)
        if i < len(strict) and strict[i] < s + MEAN:
            s = strict[i]
        else:
            i = bisect_left(loose, s + MEAN)
            s = min(loose[i] if i < len(loose) else n, s + MOST, n)
        out.append(s)
    return out


def chunks(data: bytes, ends: list[int], start: int = 0) -> list[tuple[str, int]]:
    import xxhash

    out = []
    for e in ends:
        out.append((xxhash.xxh64_hexdigest(data[start:e])[:12], e - start))
        start = e
    return out


def weighed(parts: list[tuple[str, int]]) -> dict[str, int]:
    out: dict[str, int] = {}
    for d, n in parts:
        out[d] = out.get(d, 0) + n
    return out


def as_string(weights: dict[str, int]) -> str:
    return ",".join(f"{d}:{n}" for d, n in sorted(weights.items()))


def likeness(a: dict[str, int], b: dict[str, int]) -> float:
    if not a or not b:
        return float(not a and not b)
    if len(b) < len(a):
        a, b = b, a
    shared = sum(min(n, b[d]) for d, n in a.items() if d in b)
    return shared / min(sum(a.values()), sum(b.values()))


def fingerprint(text: str) -> str:
    data = text.encode("utf-8", "surrogatepass")
    return as_string(weighed(chunks(data, boundaries(data))))


def add_fingerprint(df: DataFrame, text_col: str = "text") -> DataFrame:
    """``df`` with a ``fingerprint`` column (an input column of that name is replaced)."""
    common.python_ready(df)
    made = F.pandas_udf(lambda texts: texts.map(fingerprint), "string")
    return common.with_replaced(df, {"fingerprint": made(common.text_of(f"`{text_col}`"))})


def in_order(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(target, last, doc_id, text): rows dealt into buckets of consecutive ids and
    sorted there, each bucket closed by a copy (last = 1) of the next one's first row."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     common.text_of(f"`{text_col}`").alias("text")).withColumn("h", F.xxhash64("text"))
    cuts = rows.agg(F.percentile_approx("doc_id", [k / n for k in range(1, n)] or [0.5], 100 * n)).first()[0]
    bounds = np.unique(np.array(cuts or [], np.int64))

    @F.pandas_udf("int")
    def bucket(ids, null):
        import pandas as pd

        return pd.Series(np.where(null, 0, np.searchsorted(bounds, ids.to_numpy(), side="left")), dtype="int32")

    filled = F.coalesce("doc_id", F.lit(0))
    rows = rows.withColumn("bucket", bucket(filled, F.col("doc_id").isNull()))
    # one row per bucket: at most as many as there are partitions
    heads = sorted(rows.groupBy("bucket").agg(F.min(F.struct("doc_id", "h")).alias("m")).collect())
    send = df.sparkSession.createDataFrame(
        [(b, m["doc_id"], m["h"], heads[i - 1][0]) for i, (b, m) in enumerate(heads)],
        "bucket int, hid long, hh long, before int")
    return (rows.join(F.broadcast(send), "bucket")
            .withColumn("to", F.explode(F.when(
                F.col("doc_id").eqNullSafe(F.col("hid")) & (F.col("h") == F.col("hh")),
                F.array(F.struct(F.col("bucket").alias("target"), F.lit(0).alias("last")),
                        F.struct(F.col("before").alias("target"), F.lit(1).alias("last"))))
                .otherwise(F.array(F.struct(F.col("bucket").alias("target"), F.lit(0).alias("last"))))))
            .select("to.target", "to.last", "doc_id", "h", "text")
            .repartition(n, "target").sortWithinPartitions("target", "last", F.asc_nulls_first("doc_id"), "h")
            .select("target", "last", "doc_id", "text"))


def edited_fingerprints(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Each text's fingerprint against that of its edited text (the last quarter
    of its code points replaced by the beginning of the next text) and the next text's."""
    common.python_ready(df)
    names = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint",
             "near_edited", "near_next"]

    def run(batches):
        import hashlib

        import pyarrow as pa

        def read(doc_id, text):
            data = text.encode("utf-8", "surrogatepass")
            ends = boundaries(data)
            parts = chunks(data, ends)
            return doc_id, text, data, ends, parts, weighed(parts)

        def compare(now, nxt):
            doc_id, text, data, ends, parts, own = now
            k = len(text) // 4
            kept = text[:len(text) - k].encode("utf-8", "surrogatepass")
            edited = kept + nxt[1][:k].encode("utf-8", "surrogatepass")
            # chunks that end before the edit are the same
            same = bisect_left(ends, len(kept))
            start = ends[same - 1] if same else 0
            other = weighed(parts[:same] + chunks(edited, boundaries(edited, start), start))
            return (doc_id, len(text), hashlib.sha256(edited).hexdigest(), as_string(own),
                    as_string(other), likeness(own, other), likeness(own, nxt[5]))

        def table(out):
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
            return pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], names)

        out, held, at = [], None, None
        for batch in batches:
            targets, lasts, ids = (batch.column(i).to_pylist() for i in range(3))
            for target, last, doc_id, text in zip(targets, lasts, ids, batch.column(3), strict=True):
                row = read(doc_id, text.as_py())
                if held is not None and at == target:
                    out.append(compare(held, row))
                held, at = (None if last else row), target
                if len(out) >= 512:
                    yield table(out)
                    out = []
        if out:
            yield table(out)

    return in_order(df, id_col, text_col).mapInArrow(
        run, "doc_id long, n_chars long, edited_sha256 string, fingerprint string, "
             "edited_fingerprint string, near_edited double, near_next double")
