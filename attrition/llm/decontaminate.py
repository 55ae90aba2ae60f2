"""Benchmark decontamination: MinHash containment search by item size, with SQL
expressions only, verified by exact shingle containment.

Items are dealt into size classes (powers of two of their shingle count). Each
class has its own MinHash scale: an item keeps the shingle hashes below
``sketch / least size of the class`` of the hash range, so that a short item
keeps all of them and a long one about ``sketch``. Unlike a fixed-length
signature this stays usable when the item is a tiny part of a long document:
the document's side of a class is its shingles below the same bound, found by
one hash join without a shuffle of shingles. A pair is a candidate if at least
one sketch hash is shared; an item with ``containment`` of its shingles in the
document is missed with probability below (1 - scale)^(containment * size),
about exp(-containment * sketch). Candidates are verified with the shingles themselves.

Words are runs of non-white-space, lower-cased. Items under ``width`` words
are one shingle of all their words and match documents by the like rule or as
a run of words inside them; items without words match nothing. Null text is
empty. Repeated items and rows each give their matches. Empty tables give no
matches. Columns other than id and text are not used.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

_HALF = 2.0 ** 63


def word_list(text: Column) -> Column:
    trimmed = F.btrim(F.lower(text), F.lit(common.SPACE))
    return F.when(trimmed == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, r"[\x20\x09-\x0D]+"))


def _shingles(df: DataFrame, width: int, keep: list[str]) -> DataFrame:
    """A row (keep, w0, w1, ...) per run of ``width`` words of the array ``w``:
    the array zipped with its own tails, which stays in generated code."""
    runs = F.arrays_zip(*[F.slice("w", k + 1, F.size("w")).alias(f"w{k}") for k in range(width)])
    return df.select(*keep, F.inline(runs).alias(*[f"w{k}" for k in range(width)])) \
        .filter(F.col(f"w{width - 1}").isNotNull())


def _hashed(width: int) -> Column:
    return F.xxhash64(*[f"w{k}" for k in range(width)]).alias("h")


def _joined(width: int) -> Column:
    return F.concat_ws(" ", *[f"w{k}" for k in range(width)]).alias("s")


def _below(h: Column, share: Column) -> Column:
    """Whether a signed 64-bit hash lies in the lowest ``share`` of its range."""
    return (share >= 1) | (h.cast("double") < share * (2.0 * _HALF) - _HALF)


def find_items(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
               text_col: str = "text", width: int = 5, containment: float = 0.75,
               sketch: int = 24) -> DataFrame:
    """Pairs (doc_id, item_id, n_shingles of the item, n_shared, containment)
    with at least ``containment`` of the item's distinct shingles in the document."""
    return _matches(docs, items, id_col, item_col, text_col, width, containment, sketch).drop("k1", "k2")


def _matches(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", item_col: str = "item_id",
             text_col: str = "text", width: int = 5, containment: float = 0.75,
             sketch: int = 24) -> DataFrame:
    """The pairs of ``find_items`` with the key (k1, k2) of the document's row."""
    text = common.text_of(f"`{text_col}`")
    words = items.select(F.col(f"`{item_col}`").alias("item_id"), word_list(text).alias("w")) \
        .filter(F.size("w") > 0)
    # all widths that items have: the full width and those of shorter items
    widths = [r[0] for r in words.select(F.least(F.size("w"), F.lit(width)).alias("n")).distinct().collect()]
    found = [_find(docs, words.filter(F.least(F.size("w"), F.lit(width)) == n), id_col, text, n,
                   containment, sketch) for n in sorted(widths, reverse=True)]
    if not found:
        found = [_find(docs, words, id_col, text, width, containment, sketch)]
    out = found[0]
    for f in found[1:]:
        out = out.unionByName(f)
    return out


def _find(docs, items, id_col, text, width, containment, sketch) -> DataFrame:
    own = _shingles(items, width, ["item_id"]).select("item_id", _hashed(width)).distinct()
    sizes = own.groupBy("item_id").agg(F.count("*").alias("n"))
    share = F.lit(float(sketch)) / F.pow(F.lit(2.0), F.floor(F.log2(F.col("n").cast("double"))))
    sketches = own.join(sizes, "item_id").filter(_below(F.col("h"), share)).select("h", "item_id")
    keys = common.sized(sketches.select("h").distinct())
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), text)
    src = docs.select(F.col(f"`{id_col}`").alias("doc_id"), text.alias("text"),
                      k1.alias("k1"), k2.alias("k2"))
    words = src.withColumn("w", word_list(F.col("text")))
    hits = (_shingles(words, width, ["k1", "k2"]).select("k1", "k2", _hashed(width))
            .join(keys, "h", "left_semi"))
    # written: candidates are read for the documents and for the pairs
    candidates = common.stored(hits.join(sketches, "h").select("k1", "k2", "item_id").distinct(),
                               "leak-candidates")
    suspects = common.sized(candidates.select("k1", "k2").distinct())
    # numbered before the shingles: repeated rows are counted apart
    read = words.join(suspects, ["k1", "k2"], "left_semi") \
        .withColumn("row", F.monotonically_increasing_id())
    strings = _shingles(read, width, ["doc_id", "k1", "k2", "row"]) \
        .select("doc_id", "k1", "k2", "row", _joined(width))
    wanted = _shingles(items, width, ["item_id"]).select("item_id", _joined(width)).distinct()
    exact = wanted.join(wanted.groupBy("item_id").agg(F.count("*").alias("n_shingles")), "item_id")
    need = F.ceil(F.lit(containment) * F.col("n_shingles") - 1e-9)
    return (strings.join(exact, "s").join(candidates, ["k1", "k2", "item_id"], "left_semi")
            .groupBy("row", "doc_id", "k1", "k2", "item_id", "n_shingles")
            .agg(F.count_distinct("s").alias("n_shared"))
            .filter(F.col("n_shared") >= need)
            .select("doc_id", "k1", "k2", "item_id", "n_shingles", "n_shared",
                    (F.col("n_shared") / F.col("n_shingles")).alias("containment")))


def decontaminate(docs: DataFrame, items: DataFrame, id_col: str = "doc_id",
                  text_col: str = "text", **options) -> DataFrame:
    """``docs`` without the rows whose own text holds an item."""
    found = _matches(docs, items, id_col=id_col, text_col=text_col, **options)
    hit = found.select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")).distinct()
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), common.text_of(f"`{text_col}`"))
    return (docs.withColumns({"__k1": k1, "__k2": k2}).join(hit, ["__k1", "__k2"], "left_anti")
            .select(*[F.col(f"`{c}`") for c in docs.columns]))


#: DuckDB SQL of the pairs: the same containment without the search. Shorter
#: items than five words are not among the given tables' items.
ORACLE = r"""
WITH dw AS (SELECT doc_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
iw AS (SELECT item_id AS id, list_filter(regexp_split_to_array(lower(coalesce(text, '')),
        '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM benchmark),
ds AS (SELECT DISTINCT id, array_to_string(w[i:i+4], ' ') AS s FROM
        (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM dw WHERE len(w) >= 5)),
bs AS (SELECT DISTINCT id, array_to_string(w[i:i+4], ' ') AS s FROM
        (SELECT id, w, unnest(range(1, len(w) - 3)) AS i FROM iw WHERE len(w) >= 5)),
n AS (SELECT id, count(*) AS n FROM bs GROUP BY id)
SELECT ds.id AS doc_id, bs.id AS item_id, any_value(n.n)::BIGINT AS n_shingles,
       count(*)::BIGINT AS n_shared, count(*) / any_value(n.n) AS containment
FROM ds JOIN bs ON ds.s = bs.s JOIN n ON n.id = bs.id
GROUP BY ds.id, bs.id HAVING count(*) >= ceil(0.75 * any_value(n.n) - 1e-9)
"""


def miss_bound(size: int, containment: float = 0.75, sketch: int = 24) -> float:
    """Upper bound of the chance that the search misses an item of ``size`` shingles."""
    scale = min(1.0, sketch / 2.0 ** math.floor(math.log2(size)))
    return (1 - scale) ** math.ceil(containment * size)
