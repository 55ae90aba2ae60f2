"""The corpus pipeline: documents in, packed training sequences out.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read again as the next stage's docs. All stages but the last
return the columns of documents. Empty tables pass through every stage; null
texts are kept (as a text without words) and columns that documents doesn't
have are passed on. A document that loses all its lines stays, with an empty text.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from attrition.llm import common, decontaminate, line_dedup, ngram_join, packing, toxicity

VOCABULARY = "word_bpe_49k.json"


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier, fitted on the labelled rows, doesn't reject."""
    model = toxicity.train_on_labels(docs, common.table(spark, sf_dir, "labels"))
    scored = toxicity.score_documents(docs.select("*", F.struct("*").alias("__row")), model)
    return scored.filter("predicted = 0").select("__row.*")


def drop_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that at least ten of them share."""
    out = line_dedup.dedup_lines(docs.select(F.struct("*").alias("__row"), "doc_id", "text"))
    text = F.when(F.col("__row.text").isNotNull(), common.text_of())
    fields = {"text": text}
    if "n_chars" in docs.columns:
        fields["n_chars"] = F.when(F.col("n_dropped") > 0, F.char_length(text).cast("long")) \
            .otherwise(F.col("__row.n_chars"))
    return out.select(*[fields.get(c, F.col(f"__row.`{c}`")).alias(c) for c in docs.columns])


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates (five-word shingles, 0.75)."""
    return ngram_join.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, common.table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of at most 2048 tokens."""
    return packing.pack(docs, public_tokenizers.path(VOCABULARY))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_lines),
    ("n-gram Jaccard join", drop_near_duplicates),
    ("benchmark decontamination", drop_contaminated),
    ("packing", pack_sequences),
]

#: The classifier and the packing have no SQL form; tests hold the stages
#: against brute-force versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each stage's result is written and read again."""
    docs = common.table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = common.stored(stage(spark, docs, sf_dir), "stage-" + name.replace(" ", "-"))
    return docs
