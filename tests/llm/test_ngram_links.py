"""Open lists of the n-gram join: links leave the tasks, not all pairs that may link."""

import numpy as np

from attrition.llm import common, ngram_join
from attrition.llm.components import extended
from pyspark.sql import functions as F


def test_crossing_links_are_fewer_than_the_rows_and_join_the_same(spark, monkeypatch):
    r = np.random.default_rng(3)
    base = [f"w{k}" for k in range(160)]
    texts = []
    for k in range(60):  # near copies of one text: most pairs are close, some link
        words = list(base)
        for at in r.integers(0, 160, r.integers(1, 5)):
            words[at] = f"x{k}_{at}"
        texts.append(" ".join(words))
    texts += [f"a{k} b{k} c{k} d{k} e{k} f{k}" for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(4)
    shingles = ngram_join._hasher(5)
    sets = [shingles(t) for t in texts]
    ids = [ngram_join._set_id(s) for s in sets]
    docs = common.python_ready(df)
    rows = spark.createDataFrame(list(zip(range(len(ids)), ids)), "id long, node long")
    live = spark.createDataFrame(
        [(lst, i, len(s), 0, None, None, i) for lst in (1, 2) for i, s in zip(ids, sets)],
        "list long, node long, n int, pos int, hot long, lc long, root long")
    bitmaps = spark.createDataFrame([(i, bytearray(ngram_join._parities(s))) for i, s in zip(ids, sets)],
                                    "node long, bits binary")

    def likeness(x, y):
        shared = len(np.intersect1d(x, y))
        return shared / (len(x) + len(y) - shared)

    edges = {(min(ids[i], ids[j]), max(ids[i], ids[j])) for i in range(len(ids)) for j in range(i)
             if likeness(sets[i], sets[j]) >= 0.75}
    assert len(edges) > 100

    def roots(pairs):
        frame = spark.createDataFrame(sorted(pairs), "a long, b long")
        none = spark.createDataFrame([], "node long, root long")
        return {x["node"]: x["root"] for x in extended(none, frame).collect()}

    for chunk, items in ((2048, 10**6), (2048, 3000), (30, 10**6)):
        monkeypatch.setattr(ngram_join, "CHUNK", chunk)
        monkeypatch.setattr(ngram_join, "ITEMS", items)
        links = ngram_join.crossing_links(live, bitmaps, docs, rows, 5, 0.75)
        got = [(x["a"], x["b"]) for x in links.collect()]
        assert set(got) <= edges and roots(set(got)) == roots(edges)
        tasks = live.groupBy("list").agg(F.count("*").alias("c")).count()
        if (chunk, items) == (2048, 10**6):
            assert len(got) < tasks * len(ids) < len(edges) * tasks


def test_near_duplicates_take_no_pairs_of_open_lists_out_of_tasks(spark, monkeypatch):
    """What is verified as pairs grows with the rows of a group of near copies, not their square."""
    base, made = [f"w{k}" for k in range(60)], []
    r = np.random.default_rng(9)
    for k in range(150):
        words = list(base)
        words[30 + int(r.integers(0, 4))], words[10 + int(r.integers(0, 4))] = f"x{k}", f"y{k}"
        made.append((k, " ".join(words)))
    df = spark.createDataFrame(made, "doc_id long, text string").repartition(3)
    counted, real = [], ngram_join.verified

    def verified(pairs, *rest):
        counted.append(pairs.count())
        return real(pairs, *rest)

    monkeypatch.setattr(ngram_join, "verified", verified)
    monkeypatch.setattr(ngram_join, "SHORT", 4)
    monkeypatch.setattr(ngram_join, "LEADERS", 1)
    ngram_join.near_duplicates(df).count()
    assert len(counted) == 2  # the counted pairs and the rays
