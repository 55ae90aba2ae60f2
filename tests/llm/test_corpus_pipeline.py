"""The pipeline's stages on a small table of planted cases."""

import random

import pytest
from pyspark.sql import functions as F

import corpus_pipeline


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    r = random.Random(8)
    def prose(k=80):
        return " ".join("".join(r.choices("aeinorst", k=r.randint(2, 9))) for _ in range(k)) + "."
    base = [prose() for _ in range(60)]
    item = prose(30)
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, t + " grumbkin. wuzzle grumbkins.") for i, t in enumerate(prose() for _ in range(25))]
    rows += [(200, base[0] + " extra"), (201, prose() + " " + item + " " + prose()), (202, None), (203, "")]
    rows += [(300 + i, "the shared line\n" + prose()) for i in range(12)]
    d = str(tmp_path_factory.mktemp("tables"))
    docs = spark.createDataFrame([(i, t, "en", "src", None if t is None else len(t)) for i, t in rows],
                                 "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(d + "/documents.parquet")
    spark.createDataFrame([(i, 1, int(100 <= i < 200)) for i, _ in rows if i < 200],
                          "doc_id long, quality int, toxic int").write.parquet(d + "/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(d + "/benchmark.parquet")
    return d


def test_stages(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet")
    cols, left = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = corpus_pipeline.common.stored(stage(spark, docs, folder), "test")
        assert docs.columns == cols
        left[name] = {x[0] for x in docs.select("doc_id").collect()}
    assert not left["toxicity"] & set(range(100, 125)) and set(range(60)) <= left["toxicity"]
    assert left["line dedup"] == left["toxicity"]
    assert docs.filter(F.col("text").contains("the shared line")).count() == 0
    assert 200 not in left["n-gram Jaccard join"] and 0 in left["n-gram Jaccard join"]
    assert 201 not in docs.select("doc_id").toPandas().doc_id.tolist()
    assert set(range(60)) | {202, 203} | set(range(300, 312)) <= left["benchmark decontamination"]
    packed = corpus_pipeline.STAGES[-1][1](spark, docs, folder)
    assert {x[0] for x in packed.select("doc_id").collect()} == left["benchmark decontamination"]


def test_empty_and_wider_table(spark, folder):
    docs = spark.read.parquet(folder + "/documents.parquet").limit(0).withColumn("score", F.lit("extra"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.columns[-1] == "score"
    assert corpus_pipeline.STAGES[-1][1](spark, docs, folder).count() == 0
