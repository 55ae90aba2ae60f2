"""Conversation prefix trie, built as burst tries.

Turns become ids (128 bits of SHA-256 over role and text), conversations
become sequences of turn ids, and equal sequences collapse into one weighted
row before anything is grouped. A *container* holds the suffixes below one
trie *head*. It starts at the root; a prefix with more than ``container``
distinct sequences bursts by its next turn id and becomes a head itself, a
window of turns per pass, windows doubling. The suffixes that stay under a
head are dealt into shards by their next turn id, sorted, and swept with a
stack into nodes. Shard totals are then added up along the paths of the heads.

A shard holds about ``container`` sequences, a head's children lie whole in one
shard, and joins of nodes with their head run on (head, shard): no key holds
more than a shard, however hot a first turn or a copied conversation is.

Defined cases: rows without conv_id belong to no conversation; a null role or
text is empty; turns of one conversation that tie (repeated rows included) are
ordered by role, then by turn id, and all count; a conversation left without
turns is a member of the root alone; an empty table has no node. Further
columns are ignored. A text is read once and only its id and length travel; one
conversation's ids (20 bytes a turn) must fit into a task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

#: Conversations of a block of 100 ids share the block's first turns; at most so many less one.
SHARED = 6
#: Distinct sequences a container may hold before it bursts.
CONTAINER = 512
#: Ids that are joined into one row before an end's hash is taken.
CHUNK = 512


def key_of(ids: Column) -> list[Column]:
    """Two 64-bit hashes that stand for a sequence of turn ids."""
    return [F.xxhash64(F.lit(11), ids), F.xxhash64(F.lit("second"), ids)]


def prefix(n: Column) -> Column:
    return F.slice("ids", F.lit(1), n)


def originals(conversations: DataFrame) -> DataFrame:
    """conv_id, ids array<binary>, lens array<int>: each conversation's turns in order."""
    role = F.coalesce(F.col("role").cast("string"), F.lit(""))
    text = common.text_of()
    tid = F.unhex(F.left(F.sha2(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text), 256),
                         F.lit(32)))
    turn = F.struct(F.col("turn").alias("t"), role.alias("r"), tid.alias("id"),
                    F.char_length(text).alias("n"))
    return conversations.filter("conv_id is not null") \
        .select(F.col("conv_id").cast("long").alias("conv_id"), turn.alias("turn")) \
        .groupBy("conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns")) \
        .select("conv_id", F.col("turns.id").alias("ids"), F.col("turns.n").alias("lens"))


def rebuilt(conversations: DataFrame) -> DataFrame:
    """Each conversation with its first turns taken from the first of its block of 100 ids."""
    own = common.stored(originals(conversations), "trie-turns")
    base = own.filter("conv_id % 100 = 0").select(
        F.col("conv_id").alias("base"), F.slice("ids", 1, SHARED - 1).alias("b_ids"),
        F.slice("lens", 1, SHARED - 1).alias("b_lens"))
    h = (F.crc32(F.col("conv_id").cast("string")) % SHARED).cast("int")

    def spliced(mine: str, theirs: str) -> Column:
        head = F.coalesce(F.slice(theirs, F.lit(1), h), F.slice(mine, 1, 0))
        rest = F.slice(mine, h + 1, F.greatest(F.size(mine) - h, F.lit(0)))
        return F.concat(head, rest)

    return own.withColumn("base", F.col("conv_id") - F.col("conv_id") % 100) \
        .join(base, "base", "left") \
        .select("conv_id", spliced("ids", "b_ids").alias("ids"), spliced("lens", "b_lens").alias("lens"))


def _chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Runs of one sequence's sorted conv_ids, joined by commas, CHUNK at most."""
    key, ids = None, []

    def row():
        return {"s1": key[0], "s2": key[1], "first": ids[0], "joined": ",".join(map(str, ids))}

    for b in batches:
        out = []
        for k, c in zip(zip(b["s1"].to_pylist(), b["s2"].to_pylist()), b["conv_id"].to_pylist()):
            if k != key or len(ids) == CHUNK:
                if ids:
                    out.append(row())
                key, ids = k, []
            ids.append(c)
        if out:
            yield pa.RecordBatch.from_pylist(out)
    if ids:
        yield pa.RecordBatch.from_pylist([row()])


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One hash per sequence, fed chunk by chunk in order."""
    key, sha = None, None
    for b in batches:
        out = []
        for k, joined in zip(zip(b["s1"].to_pylist(), b["s2"].to_pylist()), b["joined"].to_pylist()):
            if k == key:
                sha.update(b"," + joined.encode())
                continue
            if key is not None:
                out.append({"s1": key[0], "s2": key[1], "ends": sha.hexdigest()})
            key, sha = k, hashlib.sha256(joined.encode())
        if out:
            yield pa.RecordBatch.from_pylist(out)
    if key is not None:
        yield pa.RecordBatch.from_pylist([{"s1": key[0], "s2": key[1], "ends": sha.hexdigest()}])


def ends_of(members: DataFrame) -> DataFrame:
    """s1, s2, ends: SHA-256 of the conv_ids of each distinct sequence."""
    joined = members.select("s1", "s2", "conv_id").repartitionByRange("s1", "s2", "conv_id") \
        .sortWithinPartitions("s1", "s2", "conv_id") \
        .mapInArrow(_chunks, "s1 long, s2 long, first long, joined string")
    return joined.repartition("s1", "s2").sortWithinPartitions("s1", "s2", "first") \
        .mapInArrow(_digests, "s1 long, s2 long, ends string")


def sequences(conversations: DataFrame) -> DataFrame:
    """Distinct sequences: s1, s2, ids, lens, n (members), conv (smallest), ends."""
    members = common.stored(
        rebuilt(conversations).select("*", *[k.alias(a) for k, a in zip(key_of(F.col("ids")), ("s1", "s2"))]),
        "trie-members")
    same = members.groupBy("s1", "s2", "ids", "lens") \
        .agg(F.count("*").alias("n"), F.min("conv_id").alias("conv"))
    return common.stored(same.join(ends_of(members), ["s1", "s2"]), "trie-sequences")


def burst(seqs: DataFrame, container: int, window: int = 8) -> DataFrame | None:
    """Prefixes with more than ``container`` distinct sequences: k1, k2, depth, n_seqs, rep."""
    found, live, done = None, seqs.select("s1", "ids"), 0
    while True:
        depth = F.explode(F.sequence(F.lit(done + 1), F.least(F.size("ids"), F.lit(done + window))))
        counted = live.filter(F.size("ids") > done).select("s1", "ids", depth.alias("depth")) \
            .select("s1", "depth", *[k.alias(a) for k, a in zip(key_of(prefix(F.col("depth"))), ("k1", "k2"))]) \
            .groupBy("k1", "k2", "depth").agg(F.count("*").alias("n_seqs"), F.min("s1").alias("rep")) \
            .filter(F.col("n_seqs") > container)
        heads = common.stored(counted, "trie-heads")
        found = heads if found is None else found.unionByName(heads)
        done += window
        deepest = heads.filter(F.col("depth") == done).select("k1", "k2")
        n = deepest.count()
        if not n:
            return found
        keyed = live.filter(F.size("ids") > done).select(
            "*", *[k.alias(a) for k, a in zip(key_of(prefix(F.lit(done))), ("k1", "k2"))])
        live = keyed.join(common.sized(deepest, n), ["k1", "k2"], "left_semi").select("s1", "ids")
        window *= 2


def heads_of(seqs: DataFrame, bursts: DataFrame) -> DataFrame:
    """All heads with the path of keys from the root and the length of their last text.

    The root is a head whatever its size. ``rep`` names one sequence below the head.
    """
    def key_at(d):
        return F.struct(*[k.alias(a) for k, a in zip(key_of(prefix(d)), ("k1", "k2"))])

    path = F.transform(F.sequence(F.lit(0), F.col("depth")), key_at)
    found = bursts.join(seqs.select(F.col("s1").alias("rep"), "ids", "lens"), "rep") \
        .select("k1", "k2", "depth", "n_seqs", F.get("lens", F.col("depth") - 1).alias("len"), path.alias("path")) \
        .filter("path[depth].k1 = k1 and path[depth].k2 = k2").dropDuplicates(["k1", "k2", "depth"])
    none = F.array().cast("array<binary>")
    root = seqs.agg(F.count("*").alias("n_seqs")).filter("n_seqs > 0") \
        .select(*[k.alias(a) for k, a in zip(key_of(none), ("k1", "k2"))], F.lit(0).alias("depth"), "n_seqs",
                F.lit(0).alias("len"))
    root = root.withColumn("path", F.array(F.struct("k1", "k2")))
    return common.stored(root.unionByName(found), "trie-paths")


def sharded(seqs: DataFrame, heads: DataFrame, container: int) -> DataFrame:
    """Each sequence under its deepest head, dealt by its next turn id."""
    shape = heads.agg(F.max("depth").alias("d"), F.count("*").alias("n"),
                      F.max(F.when(F.col("depth") == 0, F.col("n_seqs"))).alias("all")).first()
    last, total = shape["d"] or 0, shape["all"] or 0
    below = heads.filter("depth > 0").select("k1", "k2", "depth", "n_seqs")
    depth = F.explode(F.sequence(F.lit(1), F.least(F.size("ids"), F.lit(last))))
    deep = seqs.filter((F.size("ids") > 0) & F.lit(last > 0)).select("s1", "s2", "ids", depth.alias("depth")) \
        .select("s1", "s2", "depth", *[k.alias(a) for k, a in zip(key_of(prefix(F.col("depth"))), ("k1", "k2"))]) \
        .join(common.sized(below, shape["n"]), ["k1", "k2", "depth"]) \
        .groupBy("s1", "s2").agg(F.max(F.struct("depth", "n_seqs")).alias("at"))
    at = F.coalesce(F.col("at.depth"), F.lit(0))
    shards = F.ceil(F.coalesce(F.col("at.n_seqs"), F.lit(total)) / container)
    return seqs.join(deep, ["s1", "s2"], "left").select(
        *[k.alias(a) for k, a in zip(key_of(prefix(at)), ("h1", "h2"))], at.alias("top"),
        F.pmod(F.xxhash64(F.get("ids", at)), shards).cast("int").alias("shard"),
        "ids", "lens", "n", "conv", "ends")


class _Node:
    __slots__ = ("at", "depth", "len", "n", "conv", "children", "leaves", "saved", "ends")

    def __init__(self, at, depth, length):
        self.at, self.depth, self.len = at, depth, length
        self.n = self.children = self.leaves = self.saved = 0
        self.conv = self.ends = None

    def absorb(self, child: "_Node") -> None:
        self.n += child.n
        self.conv = child.conv if self.conv is None else min(self.conv, child.conv)
        self.children += 1
        self.leaves += child.leaves
        self.saved += child.saved


def _sweep_shard(key, rows) -> list[dict]:
    """Nodes of one shard from its sorted suffixes; the head's own row holds the shard's totals."""
    h1, h2, shard, top = key
    made, parents = [_Node(0, top, 0)], [None]
    stack, before = [made[0]], []

    def close():
        node = stack.pop()
        node.leaves = node.leaves or 1
        node.saved += (node.n - 1) * node.len
        stack[-1].absorb(node)

    for ids, lens, n, conv, ends in rows:
        shared = top
        while shared < min(len(ids), len(before)) and ids[shared] == before[shared]:
            shared += 1
        while len(stack) - 1 > shared - top:
            close()
        for d in range(shared, len(ids)):
            node = _Node(len(made), d + 1, lens[d])
            made.append(node)
            parents.append(stack[-1].at)
            stack.append(node)
        end = stack[-1]
        end.n += n
        end.conv = conv if end.conv is None else min(end.conv, conv)
        end.ends = ends
        before = ids
    while len(stack) > 1:
        close()
    return [{"h1": h1, "h2": h2, "shard": shard, "is_head": x.at == 0, "depth": x.depth, "conv": x.conv,
             "parent": made[p].conv if p else None, "n_convs": x.n, "n_children": x.children,
             "n_leaves": x.leaves, "saved": x.saved, "ends": x.ends} for x, p in zip(made, parents)]


SWEPT = ("h1 long, h2 long, shard int, is_head boolean, depth int, conv long, parent long, n_convs long, "
         "n_children long, n_leaves long, saved long, ends string")
_SWEPT = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("shard", pa.int32()), ("is_head", pa.bool_()),
                    ("depth", pa.int32()), ("conv", pa.int64()), ("parent", pa.int64()),
                    ("n_convs", pa.int64()), ("n_children", pa.int64()), ("n_leaves", pa.int64()),
                    ("saved", pa.int64()), ("ends", pa.string())])


def _sweep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, rows = None, []
    for b in batches:
        cols = {c: b[c].to_pylist() for c in b.schema.names}
        out = []
        for k, row in zip(zip(cols["h1"], cols["h2"], cols["shard"], cols["top"]),
                          zip(cols["ids"], cols["lens"], cols["n"], cols["conv"], cols["ends"])):
            if k != key:
                if rows:
                    out += _sweep_shard(key, rows)
                key, rows = k, []
            rows.append(row)
        if out:
            yield pa.RecordBatch.from_pylist(out, _SWEPT)
    if rows:
        yield pa.RecordBatch.from_pylist(_sweep_shard(key, rows), _SWEPT)


def prefix_trie(conversations: DataFrame, container: int = CONTAINER) -> DataFrame:
    """One row per distinct prefix of the rebuilt conversations.

    conv_id (smallest member), depth, parent_conv_id, n_convs, n_children,
    n_leaves, saved_tokens, ends_sha256.
    """
    common.python_ready(conversations)
    seqs = sequences(conversations)
    heads = heads_of(seqs, burst(seqs, container))
    swept = common.stored(
        sharded(seqs, heads, container).repartition("h1", "h2", "shard")
        .sortWithinPartitions("h1", "h2", "shard", "ids").mapInArrow(_sweep, SWEPT), "trie-swept")

    # Totals of shards, added to every head on their path.
    path = heads.select("k1", "k2", "path")
    totals = swept.filter("is_head").select(
        F.col("h1").alias("k1"), F.col("h2").alias("k2"), "conv", "n_convs", "n_children", "n_leaves", "saved", "ends")
    is_own = (F.col("up.k1") == F.col("k1")) & (F.col("up.k2") == F.col("k2"))
    summed = totals.join(path, ["k1", "k2"]).withColumn("up", F.explode("path")) \
        .groupBy(F.col("up.k1").alias("k1"), F.col("up.k2").alias("k2")) \
        .agg(F.min("conv").alias("conv"), F.sum("n_convs").alias("n_convs"), F.sum("n_leaves").alias("n_leaves"),
             F.sum("saved").alias("below"), F.sum(F.when(is_own, F.col("n_children")).otherwise(0)).alias("own"),
             F.max(F.when(is_own, F.col("ends"))).alias("ends"))
    up = F.get("path", F.col("depth") - 1)
    burst_children = heads.filter("depth > 0").groupBy(up["k1"].alias("k1"), up["k2"].alias("k2")) \
        .agg(F.count("*").alias("burst"))
    head_nodes = common.stored(
        heads.join(summed, ["k1", "k2"]).join(burst_children, ["k1", "k2"], "left")
        .withColumn("n_children", F.col("own") + F.coalesce("burst", F.lit(0))), "trie-head-nodes")
    saved = head_nodes.select(F.explode("path").alias("up"),
                              ((F.col("n_convs") - 1) * F.col("len")).alias("v")) \
        .groupBy(F.col("up.k1").alias("k1"), F.col("up.k2").alias("k2")).agg(F.sum("v").alias("heads_saved"))
    convs = head_nodes.select(F.col("k1").alias("p1"), F.col("k2").alias("p2"), F.col("conv").alias("parent"))
    tops = head_nodes.join(saved, ["k1", "k2"]) \
        .withColumn("p1", F.when(F.col("depth") > 0, up["k1"])) \
        .withColumn("p2", F.when(F.col("depth") > 0, up["k2"])).join(convs, ["p1", "p2"], "left") \
        .select("conv", "depth", "parent", "n_convs", "n_children",
                F.greatest("n_leaves", F.lit(1)).alias("n_leaves"),
                (F.col("below") + F.col("heads_saved")).alias("saved"), "ends")

    # The first nodes below a head find its smallest member by (head, shard).
    at = swept.filter("is_head").select("h1", "h2", "shard").join(
        head_nodes.select(F.col("k1").alias("h1"), F.col("k2").alias("h2"), F.col("conv").alias("top_conv")),
        ["h1", "h2"])
    rest = swept.filter("not is_head").join(at, ["h1", "h2", "shard"]) \
        .withColumn("parent", F.coalesce("parent", "top_conv")).select(*tops.columns)
    nothing = hashlib.sha256(b"").hexdigest()
    return tops.unionByName(rest).select(
        F.col("conv").alias("conv_id"), F.col("depth").cast("long").alias("depth"),
        F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", "n_leaves",
        F.col("saved").alias("saved_tokens"), F.coalesce("ends", F.lit(nothing)).alias("ends_sha256"))


ORACLE = """
WITH t AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, tid) AS pos, tid, n
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, length(coalesce(text, '')) AS n,
               sha256(length(coalesce(role, '')) || ':' || coalesce(role, '') || coalesce(text, '')) AS tid
        FROM conversations WHERE conv_id IS NOT NULL)
), c AS (
  SELECT conv_id, list({'tid': tid, 'n': n} ORDER BY pos) AS turns FROM t GROUP BY conv_id
), crc AS (  -- CRC-32 of the decimal id, bit by bit over its characters
  WITH RECURSIVE step(conv_id, s, i, v) AS (
    SELECT conv_id, conv_id::varchar, 0, 4294967295::BIGINT FROM c
    UNION ALL
    SELECT conv_id, s, i + 1, list_reduce(
      list_concat([xor(v, ascii(substr(s, i + 1, 1))::BIGINT)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
      lambda a, b: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384::BIGINT) ELSE a >> 1 END)
    FROM step WHERE i < length(s)
  ) SELECT conv_id, (xor(v, 4294967295::BIGINT) % 6)::INTEGER AS h FROM step WHERE i = length(s)
), r AS (
  SELECT c.conv_id, list_concat(coalesce(b.turns, [])[:h], c.turns[h + 1:]) AS turns
  FROM c JOIN crc USING (conv_id) LEFT JOIN c b ON b.conv_id = c.conv_id - c.conv_id % 100
), p AS (
  SELECT conv_id, len(turns) AS size, d, turns[:d] AS k, CASE WHEN d > 0 THEN turns[d].n ELSE 0 END AS n
  FROM (SELECT conv_id, turns, unnest(range(0, len(turns) + 1)) AS d FROM r)
), nodes AS (
  SELECT k, d, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(n) AS n,
         sha256(coalesce(string_agg(conv_id::varchar, ',' ORDER BY conv_id) FILTER (size = d), '')) AS ends_sha256
  FROM p GROUP BY k, d
), kids AS (
  SELECT k[:d - 1] AS k, d - 1 AS d, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY ALL
), full_nodes AS (
  SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (k, d)
), up AS (
  SELECT k[:a] AS k, a AS d, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS n_leaves,
         sum((n_convs - 1) * n) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS a FROM full_nodes) GROUP BY ALL
)
SELECT x.conv_id, x.d::BIGINT AS depth, y.conv_id AS parent_conv_id, x.n_convs, x.n_children,
       n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, x.ends_sha256
FROM full_nodes x JOIN up USING (k, d) LEFT JOIN nodes y ON y.k = x.k[:x.d - 1] AND y.d = x.d - 1
"""
