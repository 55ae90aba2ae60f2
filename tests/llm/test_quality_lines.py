"""Line field and base rules against plain versions; held-out quality; edge rows."""

import itertools
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from attrition.llm import quality_lines as q

SF = "/root/testdata/sf0.1"
SCHEMA = "doc_id long, text string, kept string, n_words string"
BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def plain_base(text):
    text = text or ""
    words = re.findall("[^ \t-\r]+", text)
    windows = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    hit = {j for i, w in enumerate(windows) if windows.count(w) > 1 for j in range(i, i + 8)}
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if re.search("[^ \t-\r]", x) and x in lines[:i])
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def path_score(s, y, w):
    turn = w[q.N_VALUES + 1:].reshape(2, 2)
    return w[q.N_VALUES] * y[0] + sum(a * b for a, b in zip(s, y)) + sum(turn[a, b] for a, b in zip(y, y[1:]))


def chains(rng, n_chains=7, longest=7):
    lengths = rng.integers(0, longest, n_chains)
    features = np.stack([rng.integers(0, n, lengths.sum()) for n in q.SIZES], 1).astype(np.uint8)
    return lengths, features


def texts():
    r = random.Random(2)
    loop = "a b c d e f g h i j "
    out = [None, "", " \n\t\n", "one", "x y\nx y\n \n \nx y\n X y", loop * 3, "same " * 30, loop + "\n" + loop,
           "\xa0nbsp\x85next \x1c sep # | <b> 東京 \U0001f600!", "w " * 50_000, "| " * 3000 + "\n" * 500]
    for _ in range(30):
        line = [r.choice("abc") * r.randrange(1, 4) for _ in range(r.randrange(60))]
        out.append("".join(w + r.choice([" ", "\n", "  ", " # "]) for w in line))
    return out


def test_base_equals_plain_version(spark):
    rows = [(i, t, "x", "y") for i, t in enumerate(texts()) if not t or len(t) < 5000]
    rows += [rows[6], (None, "null id " * 9, None, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = q.judge(df, np.zeros(q.N_WEIGHTS))
    assert sorted(out.columns) == sorted([*BASE, "doc_id", "text", "n_lines", "n_content_lines", "content_share",
                                          "base_failed", "kept"])
    got = out.collect()
    assert len(got) == len(rows)
    for r in got:
        want = plain_base(r["text"])
        assert tuple(r[c] for c in BASE) == want, r["text"]
        assert r["base_failed"] == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert r["kept"] == (not r["base_failed"])  # zero weights: every line is content
    assert q.judge(spark.createDataFrame([], SCHEMA), np.zeros(q.N_WEIGHTS)).count() == 0


def test_blocks_do_not_change_results(monkeypatch):
    w = np.random.default_rng(4).normal(size=q.N_WEIGHTS)
    whole = q.judged([t or "" for t in texts()], w)
    monkeypatch.setattr(q, "BLOCK", 50)
    assert q.judged([t or "" for t in texts()], w).equals(whole)
    assert list(whole["n_words"][[9, 10]]) == [50_000, 3000]


def test_viterbi_finds_the_best_path():
    rng = np.random.default_rng(0)
    for _ in range(20):
        lengths, features = chains(rng)
        w = rng.normal(size=q.N_WEIGHTS)
        s = q.emissions(features, w)
        got, at = q.viterbi(lengths, s, w), 0
        for n in lengths:
            if n:
                own = s[at:at + n]
                best = max(path_score(own, y, w) for y in itertools.product((0, 1), repeat=int(n)))
                assert path_score(own, got[at:at + n].astype(int), w) == pytest.approx(best)
            at += n
    assert not q.viterbi(np.array([3]), np.zeros(3), np.zeros(q.N_WEIGHTS)).any()  # ties: content


def test_likelihood_and_gradient_by_enumeration():
    rng = np.random.default_rng(1)
    lengths, features = chains(rng)
    labels = rng.integers(0, 2, len(features)).astype(float)
    w = rng.normal(size=q.N_WEIGHTS) * 0.5

    def loss(w):
        s, at, total = q.emissions(features, w), 0, 0.0
        for n in lengths:
            if n:
                own = [path_score(s[at:at + n], y, w) for y in itertools.product((0, 1), repeat=int(n))]
                total += np.logaddexp.reduce(own) - path_score(s[at:at + n], labels[at:at + n].astype(int), w)
            at += n
        return total

    got, grad = q.likelihood(lengths, features, labels, w)
    assert got == pytest.approx(loss(w))
    for i in range(0, q.N_WEIGHTS, 3):
        e = np.eye(q.N_WEIGHTS)[i] * 1e-5
        assert grad[i] == pytest.approx((loss(w + e) - loss(w - e)) / 2e-5, abs=1e-5)


def test_held_out_quality(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    w = q.train(docs.select("doc_id", "text"), labels.filter(~held))
    tested = q.judge(docs.join(labels, "doc_id").filter(held), w).filter("not base_failed")
    good, bad = (tested.filter(f"quality = {y}").agg(F.avg(F.col("kept").cast("int"))).first()[0] for y in (1, 0))
    assert good > 0.99 and bad < 0.02


def test_one_label_or_none_keeps_every_line(spark):
    docs = spark.createDataFrame([(1, "a b. " * 9, None, None), (None, None, None, None)], SCHEMA)
    labels = spark.createDataFrame([(1, 1), (None, 0), (2, None)], "doc_id long, quality int")
    assert not q.train(docs, labels).any()
    assert not q.train(docs, labels.limit(0)).any()
