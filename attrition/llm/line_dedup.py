"""Removal of lines that many documents share, with SQL expressions only.

Lines (split at LF) are normalised to keys: white space stripped at both ends,
A-Z lower-cased. Keys are hashed to 128 bits, the documents of each hash are
counted (a document once; partly aggregated before each shuffle), and the lines of
hashes found in at least ``min_docs`` documents are dropped everywhere. Texts
are never shuffled by line: only (row key, position) of dropped lines is, and
the kept lines are put together by position within their row.

Null or empty text is one empty line. Keys shorter than ``min_chars`` code
points are never dropped. Rows equal in id and text count as one document. Null ids are allowed: rows meet by a hash of id and text, and equal rows
get equal results. An empty table gives an empty result. Input columns named
like an output column are replaced.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm import common


def line_key(line: Column) -> Column:
    return common.ascii_lower(F.btrim(line, F.lit(common.SPACE)))


def _hash(key: str = "key") -> list[Column]:
    return [F.xxhash64(key).alias("h1"), F.xxhash64(F.lit("line"), F.col(key)).alias("h2")]


def frequent_lines(lines: DataFrame, min_docs: int) -> DataFrame:
    """Hashes found in at least ``min_docs`` documents of (k1, k2, pos, h1, h2)."""
    return (lines.groupBy("h1", "h2").agg(F.count_distinct("k1", "k2").alias("n"))
            .filter(F.col("n") >= min_docs).select("h1", "h2"))


def dedup_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                min_docs: int = 10, min_chars: int = 1) -> DataFrame:
    """``df`` with ``text`` reduced to the kept lines joined by LF (null if no
    line is kept), n_lines (before) and n_dropped."""
    text = common.text_of(f"`{text_col}`")
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), text)
    # each line is normalised once; counting and dropping read this narrow table
    lines = common.stored(
        df.select(k1.alias("k1"), k2.alias("k2"), F.posexplode(F.split(text, "\n", -1)).alias("pos", "line"))
        .select("k1", "k2", "pos", line_key(F.col("line")).alias("key"))
        .filter(F.char_length("key") >= min_chars)
        .select("k1", "k2", "pos", *_hash()), "line-hashes")
    frequent = common.sized(common.stored(frequent_lines(lines, min_docs), "frequent-lines"))
    dropped = (lines.join(frequent, ["h1", "h2"], "left_semi")
               .groupBy("k1", "k2").agg(F.collect_set("pos").alias("__drop"))
               .withColumnsRenamed({"k1": "__k1", "k2": "__k2"}))
    joined = df.withColumns({"__k1": k1, "__k2": k2}).join(dropped, ["__k1", "__k2"], "left")
    lines = F.split(text, "\n", -1)
    kept = F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__drop"))
    # the one-element array binds both lists once a row, not once a line
    chosen = F.transform(F.array(F.struct(lines.alias("l"), kept.alias("p"))),
                         lambda s: F.transform(s["p"], lambda i: F.get(s["l"], i)))[0]
    none = F.col("__drop").isNull()
    return common.with_replaced(joined, {
        text_col: F.when(none, F.col(f"`{text_col}`"))
        .when(F.size("__drop") < F.size(lines), F.array_join(chosen, "\n")),
        "n_lines": F.size(lines).cast("long"),
        "n_dropped": F.coalesce(F.size("__drop"), F.lit(0)).cast("long"),
    }, drop=("__k1", "__k2", "__drop"))


#: DuckDB SQL of the query's digest columns.
ORACLE = r"""
WITH d AS (  -- r: the row; doc: rows equal in id and text are one document
  SELECT row_number() OVER () AS r, dense_rank() OVER (ORDER BY doc_id, coalesce(text, '')) AS doc, doc_id,
         string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
l AS (SELECT r, doc, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos FROM d),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
        'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
f AS (SELECT key FROM k WHERE length(key) >= 1 GROUP BY key HAVING count(DISTINCT doc) >= 10)
SELECT any_value(k.doc_id) AS doc_id, count(*)::BIGINT AS n_lines, count(f.key)::BIGINT AS n_dropped,
       sha256(coalesce(string_agg(k.line, chr(10) ORDER BY k.pos) FILTER (f.key IS NULL), '')) AS kept_sha256
FROM k LEFT JOIN f ON k.key = f.key GROUP BY k.r
"""
