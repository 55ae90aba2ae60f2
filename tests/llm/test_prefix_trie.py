"""The conversation prefix trie against a plain trie in Python, and edge rows."""

import hashlib
import random
import zlib

import pytest

from attrition.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, n_convs string, depth string"


def plain(rows):
    """Every prefix of every rebuilt conversation in a dict."""
    turns = {}
    for c, t, role, text, *_ in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))

    def tid(role, text):
        return hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]

    own = {c: [x[2:] for x in sorted(ts, key=lambda x: (x[:3], tid(*x[2:])))] for c, ts in turns.items()}
    members = {}
    for c, ts in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c > 0 else -1)
        seq = tuple(own.get(base, [])[:h] + ts[h:])
        for d in range(len(seq) + 1):
            members.setdefault(seq[:d], []).append((c, len(seq) == d))
    out = []
    for k, ms in members.items():
        below = [x for x in members if x[:len(k)] == k]
        kids = [x for x in below if len(x) == len(k) + 1]
        ends = ",".join(str(c) for c, e in sorted(ms) if e)
        out.append((min(ms)[0], len(k), min(members[k[:-1]])[0] if k else None, len(ms), len(kids),
                    sum(1 for x in below if not any(y[:-1] == x for y in members if y)),
                    sum((len(members[x]) - 1) * (len(x[-1][1]) if x else 0) for x in below),
                    hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def got(df, container):
    cols = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]
    return sorted((tuple(r) for r in prefix_trie.prefix_trie(df, container).select(*cols).collect()), key=str)


def made():
    r = random.Random(3)
    rows = []
    for c in [*range(-3, 40), *range(100, 130), 205, 207, 9999]:
        words = [f"w{r.randrange(2)}" for _ in range(r.randrange(7))]
        rows += [(c, t, r.choice(["user", "user", None]), w, "x", "y") for t, w in enumerate(words)]
    for c in range(500, 560):  # copies, beyond the window of a pass
        rows += [(c, t, "user", f"long turn {t}", "x", "y") for t in range(12)]
    rows += [(600, t, None, None, None, None) for t in (None, 0, 0, 1)]  # null turn, tied and empty turns
    rows += [(601, 0, "user", "aé\U0001f600"), (601, 1, "bot", "z " * 4000), (None, 0, "user", "no conversation")]
    return [(*x, None, None)[:6] for x in rows]


@pytest.mark.parametrize("container", [1, 4, 512])
def test_equals_plain_trie(spark, container):
    rows = made()
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert got(df, container) == plain(rows)


def test_turnless_members_and_empty_table(spark):
    # 201 has one turn, replaced by those of the absent 200: it is a member of the root alone.
    c = next(c for c in range(201, 300) if zlib.crc32(str(c).encode()) % 6 > 1)
    rows = [(c, 0, "user", "hi", None, None)]
    assert got(spark.createDataFrame(rows, SCHEMA), 4) == plain(rows)
    assert got(spark.createDataFrame(rows, SCHEMA), 4)[0][1:6] == (0, None, 1, 0, 1)
    assert got(spark.createDataFrame([], SCHEMA), 4) == []
    assert got(spark.createDataFrame([(None, 0, "a", "b", None, None)], SCHEMA), 4) == []


def test_ends_of_many_members_are_chunked(spark):
    n = 3 * prefix_trie.CHUNK + 7
    ids = [100 * i for i in range(n)]  # bases keep their own turns
    df = spark.createDataFrame([(c, 0, "user", "same", None, None) for c in ids], SCHEMA)
    rows = prefix_trie.prefix_trie(df).filter("depth = 1").collect()
    assert [(r["n_convs"], r["ends_sha256"]) for r in rows] == [
        (n, hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())]
