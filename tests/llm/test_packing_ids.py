"""Ids of whole texts equal the library's; equal rows are spread."""

import random

import public_tokenizers
from pyspark.sql import functions as F

from attrition.llm import packing
from attrition.llm.words import tokenizer

VOCAB = public_tokenizers.path("word_bpe_49k.json")


def test_ids_equal_the_library():
    r = random.Random(7)
    pool = ["the", "it's", "Ünï", "東京", "\x01\x02", "áb", "<|endoftext|>", "x" * 400, "12.5", "ﬁ½", "İ", "'t",
            "naïve—", "​", "\x7f", "😀👍🏽", "don't!?", "\xa0", "<|", "ſecret", "\r\n", "\t"]
    texts = ["", " ", "\n"] + [r.choice(["", " "]).join(r.choices(pool, k=r.randrange(1, 30))) for _ in range(400)]
    texts += ["".join(chr(r.choice([r.randrange(1, 0x2FF), r.randrange(0x300, 0xD7FF)])) for _ in range(40))
              for _ in range(200)]
    enc, tok = packing.WordIds(VOCAB), tokenizer(VOCAB)
    for t in texts:
        ids, _ = enc.encode(t, 1)
        assert ids.tolist() == [*tok.encode(t, add_special_tokens=False).ids, 1], repr(t)


def test_equal_rows_are_spread(spark):
    df = spark.createDataFrame([(7, "one and the same text " * 40)] * 4000, "doc_id long, text string").repartition(4)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        out = packing.pack(df, VOCAB).withColumn("task", F.shiftright("sequence_id", 40)).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert len({r["task"] for r in out}) >= 4  # not one task
    n = out[0]["doc_tokens"]
    assert sum(r["length"] for r in out) == 4000 * n
