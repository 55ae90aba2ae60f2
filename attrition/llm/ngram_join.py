"""Near duplicates by a grouped prefix join on word shingles (exact Jaccard).

1. Texts become sets of hashed shingles; rows with equal sets are one class.
2. A set's items are ordered by one global order (by hash, frequent shingles
   last) and two sets of Jaccard >= t must share an item of their prefixes of
   n - ceil(t n) + 1 items. Classes with the same prefix and size are one group,
   and only groups are posted under their prefix items.
3. Within a posting list, group pairs pass the size and the position filter.
   A short list gives all its pairs. A long one gives pairs with a few leaders
   only and is kept as open. Pairs are counted over the lists, and those whose
   count bounds the overlap below the similarity go.
4. Group pairs are expanded to their members. Each set has a bitmap of parities,
   one or two bits an item, and at least as many items differ between two sets as
   parities do; pairs that differ too much for the similarity go. The others are verified on the whole sets. Links make components.
5. An open list whose members have all met in one component holds no further
   news. In the others, every node is compared with one of the largest component,
   and what is still apart after that pairwise across components, in blocks inside
   the tasks, which only the pairs that may link leave: by size and position, by the frequent items (two sets whose prefixes hold all their
   other items share no more than either has), by the bitmaps, then on the whole sets. No link between
   components is lost; links inside a component change nothing. No list, bucket
   or partner count is capped.

The frequent shingles, which only choose the order, are those that reach
``frequent`` of the documents in some block of the scan; there are at most
2 * mean set size / ``frequent`` of them, however many documents there are. A
frequent item's posting list is salted, so that no task holds a hot one.

Words are runs of non-white-space with A-Z lower-cased. A text of fewer words
than ``width`` is one shingle of all; a text without words (null, empty, blank)
is empty, links with nothing and is its own class. A null id is no component
name: its rows take part, and a component of null ids only has null. Equal rows
share a class. An empty table gives an empty result. Columns other than id and
text are not used. Shingles and sets are told apart by 64-bit hashes.
"""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common
from attrition.llm.components import components, extended

#: Groups a posting list may have to give all its pairs at once.
SHORT = 48
#: Leaders that members of a longer list are compared with first.
LEADERS = 2
#: Shingles of a scan block in which frequent ones are looked for.
BLOCK = 2_000_000
SALTS = 64
#: Rows of an open list that are compared in one task, about.
CHUNK = 2048
#: Items of whole sets in a chunk of rows, about.
ITEMS = 1_000_000
#: Parities in a set's bitmap, at least.
LEAST_BITS = 256


class _WordHashes(dict):
    """Hashes of words, remembered; a missing one is made."""

    def __missing__(self, word: bytes) -> int:
        import xxhash

        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


@functools.lru_cache(maxsize=1)
def _hasher(width: int):
    import numpy as np
    import xxhash

    seen = _WordHashes()
    mult = [np.uint64(xxhash.xxh64_intdigest(bytes([k])) | 1) for k in range(width)]
    down, half = np.uint64(29), np.uint64(32)

    def shingles(text: str):
        """The sorted distinct shingle hashes of a text."""
        # of bytes, lower() is A-Z only and split() cuts at the contract's six characters
        words = text.encode("utf-8", "surrogatepass").lower().split()
        if not words:
            return np.zeros(0, np.uint64)
        if len(words) < width:
            return np.array([xxhash.xxh64_intdigest(b" ".join(words), seed=7)], np.uint64)
        if len(seen) > 200_000:
            seen.clear()
        h = np.fromiter(map(seen.__getitem__, words), np.uint64, len(words))
        n = len(words) - width + 1
        s = h[:n] * mult[0]
        for k in range(1, width):
            s ^= s >> down
            s += h[k:k + n]
            s *= mult[k]
        s ^= s >> half
        s *= mult[0]
        s ^= s >> down
        s.sort()
        keep = np.empty(n, bool)
        keep[0] = True
        np.not_equal(s[1:], s[:-1], out=keep[1:])
        return s[keep]

    return shingles


def _set_id(s) -> int:
    """Signed 64-bit id of a set of shingle hashes."""
    import xxhash

    v = xxhash.xxh64_intdigest(s.tobytes())
    return v - (1 << 64) if v >> 63 else v


def _parities(s) -> bytes:
    """Whether an odd number of the set's items falls on each of a power of two
    places, as many as items at least. Folding the halves together gives the bitmap
    of half the size."""
    import numpy as np

    size = max(LEAST_BITS, 1 << (len(s) - 1).bit_length())
    place = (s & np.uint64(size - 1)).astype(np.int64)
    return np.packbits((np.bincount(place, minlength=size) & 1).astype(bool)).tobytes()


def _folded(maps: list[bytes], size: int):
    """Bitmaps of one length as rows of 64-bit words, folded to ``size`` bytes."""
    import numpy as np

    out = np.frombuffer(b"".join(maps), np.uint8).reshape(len(maps), -1)
    while out.shape[1] > size:
        half = out.shape[1] // 2
        out = out[:, :half] ^ out[:, half:]
    return np.ascontiguousarray(out).view(np.uint64)


def _texts(batches):
    for batch in batches:
        for row_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            yield row_id, text.as_py()


def signatures(docs: DataFrame, width: int, frequent: float) -> DataFrame:
    """(id, node, n, k1, k2) of each row of (id, text, k1, k2), and (null, shingle,
    count, null, null) with n < 0 for the shingles frequent in a block of rows."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        shingles = _hasher(width)
        rows, block, held = [], [], 0

        def table(out):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["id", "node", "n", "k1", "k2"])

        def often():
            u, c = np.unique(np.concatenate(block), return_counts=True)
            ok = c >= max(4, frequent * len(block))
            none = [None] * int(ok.sum())
            return list(zip(none, u[ok].view(np.int64).tolist(), (-c[ok]).tolist(), none, none, strict=True))

        for batch in batches:
            keys = zip(*(batch.column(c).to_pylist() for c in ("k1", "k2")), strict=True)
            for (row_id, text), (k1, k2) in zip(_texts([batch]), keys, strict=True):
                s = shingles(text)
                rows.append((row_id, _set_id(s), len(s), k1, k2))
                if len(s):
                    block.append(s)
                    held += len(s)
                if held > BLOCK:
                    rows += often()
                    block, held = [], 0
                if len(rows) >= 8192:
                    yield table(rows)
                    rows = []
        if block:
            rows += often()
        if rows:
            yield table(rows)

    return docs.mapInArrow(run, "id long, node long, n long, k1 long, k2 long")


def _prefix(s, hot, hot_count, similarity: float):
    """The first items of a set in the global order, and how many are hot."""
    import numpy as np

    from math import ceil

    n = len(s)
    k = n - ceil(similarity * n - 1e-9) + 1
    if not len(hot):
        return s[:k], k
    at = np.minimum(np.searchsorted(hot, s), len(hot) - 1)
    is_hot = hot[at] == s
    rest = s[~is_hot]
    if len(rest) >= k:
        return rest[:k], k
    own, often = s[is_hot], hot_count[at[is_hot]]
    return np.concatenate([rest, own[np.lexsort((own, often))]])[:k], len(rest)


def postings(docs: DataFrame, width: int, similarity: float, hot, hot_count) -> DataFrame:
    """(grp, n, node, cold, bits, items): the members of each group with their bitmaps. A
    task gives a node once, and the prefix items with the first member of a group only."""

    def run(batches):
        import numpy as np
        import pyarrow as pa
        import xxhash

        shingles, seen, out = _hasher(width), set(), []

        def table():
            g, n, node, cold, bits, items = zip(*out, strict=True)
            ends = np.cumsum([0, *map(len, items)]).astype(np.int32)
            return pa.RecordBatch.from_arrays(
                [pa.array(g, pa.int64()), pa.array(n, pa.int32()), pa.array(node, pa.int64()),
                 pa.array(cold, pa.int32()), pa.array(bits, pa.binary()),
                 pa.ListArray.from_arrays(ends, np.concatenate(items).view(np.int64))],
                ["grp", "n", "node", "cold", "bits", "items"])

        for _, text in _texts(batches):
            s = shingles(text)
            if not len(s) or (node := _set_id(s)) in seen:
                continue
            if len(seen) > 400_000:
                seen.clear()
            seen.add(node)
            items, cold = _prefix(s, hot, hot_count, similarity)
            g = xxhash.xxh64_intdigest(items.tobytes(), seed=len(s))
            if g in seen:
                items = items[:0]
            seen.add(g)
            out.append((g - (1 << 64) if g >> 63 else g, len(s), node, cold, _parities(s), items))
            if len(out) >= 2048:
                yield table()
                out = []
        if out:
            yield table()

    return docs.mapInArrow(run, "grp long, n int, node long, cold int, bits binary, items array<long>")


def _may_link(n1, p1, n2, p2, similarity: float):
    """Whether sets of n1 and n2 items whose first shared item is at p1 and p2
    of their prefixes can reach the similarity (numpy arrays)."""
    import numpy as np

    need = np.ceil(similarity / (1 + similarity) * (n1 + n2) - 1e-9)
    return ((np.minimum(n1, n2) >= similarity * np.maximum(n1, n2) - 1e-9)
            & (np.minimum(n1 - p1, n2 - p2) >= need))


def group_pairs(posted: DataFrame, similarity: float) -> DataFrame:
    """From rows (list, item, grp, size_pos) of one kind of posting list: pairs
    (a, b, n) of groups that share an item and pass the filters, n = 1 for each
    short list they share and 0 from a leader; and the members (a, null, item, n,
    pos) of open lists. ``list`` is the item itself, or for salted lists a hash
    with ``item`` beside it. Each task streams its sorted lists and holds one
    batch and one short list at most."""
    salted = "item" in posted.columns
    cols = ["list", "grp", "size_pos"] + ["item"] * salted
    spread = posted.repartition(F.col("list")).sortWithinPartitions("list", "grp").select(*cols)
    names = ["a", "b", "item", "n", "pos"]
    kinds = ("int64", "int64", "int64", "int32", "int32")

    def run(batches):
        import numpy as np
        import pyarrow as pa

        def rows(a, b=None, item=None, n=None, pos=None):
            return pa.RecordBatch.from_arrays(
                [pa.nulls(len(a), t) if c is None else pa.array(c, t)
                 for c, t in zip((a, b, item, n, pos), map(pa.type_for_alias, kinds), strict=True)], names)

        def part_of_long(key, g, n, p, item, lead):
            """Rows of one long list against its leaders, which its first rows become."""
            lead += list(zip(g.tolist(), n.tolist(), p.tolist(), strict=True))[:LEADERS - len(lead)]
            for lg, ln, lp in lead:
                ok = (g != lg) & _may_link(n, p, ln, lp, similarity)
                if ok.any():
                    yield rows(np.full(int(ok.sum()), lg), g[ok], n=np.zeros(int(ok.sum()), np.int32))
            yield rows(g, None, item, n, p)

        def lists(key, g, n, p, item):
            """Whole lists: short ones give all pairs."""
            first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
            size = np.diff(np.r_[first, len(key)])
            long = (size > SHORT) | salted
            room = np.repeat(np.where(long, 0, size), size)
            rank = np.arange(len(key)) - np.repeat(first, size)
            for d in range(1, int(room.max(initial=0))):
                x = np.flatnonzero(rank + d < room)
                # by size only: a pair is counted in every short list that it shares
                x = x[_may_link(n[x], 0, n[x + d], 0, similarity)]
                if len(x):
                    yield rows(g[x], g[x + d], n=np.ones(len(x), np.int32))
            for k in np.flatnonzero(long):
                s = slice(first[k], first[k] + size[k])
                yield from part_of_long(key[s], g[s], n[s], p[s], item[s], [])

        held, open_key, lead = None, None, []
        for batch in batches:
            cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
            key, g, both = cols[:3]
            cols = [key, g, both >> 32, both & 0xFFFFFFFF, cols[3] if salted else key]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols, strict=True)]
            key, g = cols[:2]
            if not len(key):
                continue
            once = np.r_[True, (key[1:] != key[:-1]) | (g[1:] != g[:-1])]  # a group once a list
            cols, held = [c[once] for c in cols], None
            if open_key is not None:  # a long list that earlier batches began
                other = np.flatnonzero(cols[0] != open_key)
                m = int(other[0]) if len(other) else len(cols[0])
                if m:
                    yield from part_of_long(*(c[:m] for c in cols), lead)
                cols = [c[m:] for c in cols]
                if not len(cols[0]):
                    continue
                open_key = None
            change = np.flatnonzero(cols[0][1:] != cols[0][:-1])
            at = int(change[-1]) + 1 if len(change) else 0
            if at:
                yield from lists(*(c[:at] for c in cols))
            held = [c[at:] for c in cols]
            if len(held[0]) > SHORT:
                open_key, lead = held[0][0], []
                yield from part_of_long(*held, lead)
                held = None
        if held is not None and len(held[0]):
            yield from lists(*held)

    return spread.mapInArrow(run, "a long, b long, item long, n int, pos int")


def group_sizes(raw: DataFrame, members: DataFrame, similarity: float) -> DataFrame:
    """(grp, n, l, rest, hot, lc) of each group: its long lists, its items beyond
    the prefix and, where the prefix holds all its cold items (else null), its
    frequent items and long cold lists."""
    long = raw.filter("b IS NULL").join(members.select(F.col("grp").alias("a"), "cold").distinct(), "a") \
        .groupBy(F.col("a").alias("grp")).agg(
            F.count_distinct("item").alias("l"),
            F.count_distinct(F.when(F.col("pos") < F.col("cold"), F.col("item"))).alias("lc"))
    need = F.ceil(F.lit(similarity) * F.col("n") - 1e-9)
    whole = F.col("cold") < F.col("n") - need + 1
    return (members.groupBy("grp").agg(F.max("n").alias("n"), F.max("cold").alias("cold")).join(long, "grp", "left")
            .select("grp", "n", F.coalesce("l", F.lit(0)).alias("l"), (need - 1).alias("rest"),
                    F.when(whole, F.col("n") - F.col("cold")).alias("hot"),
                    F.when(whole, F.coalesce("lc", F.lit(0))).alias("lc")))


def likely_pairs(raw: DataFrame, sizes: DataFrame, similarity: float) -> DataFrame:
    """The distinct group pairs that can still reach the similarity.

    Up to the end of the shorter prefix (in the global order) the two share at
    most the counted short lists plus as many long ones as either is in, and
    beyond it at most what is left of that group's items. If both prefixes hold
    all cold items, the two share at most the counted short lists, the long cold
    lists of either and the frequent items of either."""
    counted = (raw.filter("b IS NOT NULL")
               .groupBy(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).agg(F.sum("n").alias("c")))
    x, y = (sizes.select(F.col("grp").alias(g), *[F.col(c).alias(c + g) for c in ("n", "l", "rest", "hot", "lc")])
            for g in ("a", "b"))
    most = F.least(F.least("la", "lb") + F.greatest("resta", "restb"),
                   F.when(F.col("hota").isNotNull() & F.col("hotb").isNotNull(),
                          F.least("lca", "lcb") + F.least("hota", "hotb")))
    share = similarity / (1 + similarity)
    return (counted.join(x, "a").join(y, "b")
            .filter(F.col("c") + most
                    >= F.ceil(F.lit(share) * (F.col("na") + F.col("nb")) - 1e-9)).select("a", "b"))


def _expanded(pairs: DataFrame, members: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Member pairs (a, b) of group pairs, and open lists (list, node, n, pos).
    Large products are compared by leaders first and stay open."""
    sizes = members.groupBy("grp").agg(F.count("*").alias("k"), F.min("node").alias("lead"))
    own = members.join(sizes, "grp")
    x, y = (own.select(*[F.col(c).alias(c + s) for c in own.columns]) for s in "xy")
    all_pairs = (pairs.join(x, pairs["a"] == F.col("grpx")).join(y, F.col("b") == F.col("grpy"),)
                 .filter("kx * ky <= 64 OR nodex = leadx OR nodey = leady")
                 .select(F.col("nodex").alias("a"), F.col("nodey").alias("b")))
    wide = (pairs.join(sizes.select(F.col("grp").alias("a"), F.col("k").alias("ka")), "a")
            .join(sizes.select(F.col("grp").alias("b"), F.col("k").alias("kb")), "b")
            .filter("ka * kb > 64").select(F.xxhash64("a", "b").alias("list"),
                                           F.explode(F.array("a", "b")).alias("grp")))
    inside = own.filter("k > 1")
    open_lists = (wide.join(members, "grp").select("list", "node", "n")
                  .union(inside.filter("k > 2").select("grp", "node", "n"))
                  .select("list", "node", "n", F.lit(0).alias("pos")))
    return all_pairs.union(inside.filter("node <> lead").select("lead", "node")), open_lists


def sifted(pairs: DataFrame, bitmaps: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b) whose sets may reach the similarity as their bitmaps tell."""

    def run(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            x, y = (batch.column(c).to_pylist() for c in ("sa", "sb"))
            na, nb = (batch.column(c).to_numpy() for c in ("na", "nb"))
            both = na + nb
            near = np.minimum(na, nb) >= similarity * np.maximum(na, nb) - 1e-9
            most = both - 2 * np.ceil(similarity / (1 + similarity) * both - 1e-9)
            kinds = {}
            for i in np.flatnonzero(near):
                kinds.setdefault((len(x[i]), len(y[i])), []).append(i)
            ok = np.zeros(len(x), bool)
            for k, rows in kinds.items():
                for r in (rows[i:i + 4096] for i in range(0, len(rows), 4096)):
                    u, v = (_folded([z[i] for i in r], min(k)) for z in (x, y))
                    ok[r] = np.bitwise_count(u ^ v).sum(axis=1, dtype=np.int64) <= most[r]
            yield pa.RecordBatch.from_arrays([batch.column(c).filter(pa.array(ok)) for c in ("a", "b")], ["a", "b"])

    for end in ("a", "b"):
        pairs = pairs.join(bitmaps.select(F.col("node").alias(end), F.col("n").alias(f"n{end}"),
                                          F.col("bits").alias(f"s{end}")), end)
    return pairs.select("a", "b", "na", "nb", "sa", "sb").mapInArrow(run, "a long, b long")


def crossing_pairs(live: DataFrame, bitmaps: DataFrame, similarity: float) -> DataFrame:
    """The pairs (a, b), a < b, of two members of one open list and of different
    components that size, position, frequent items and bitmaps leave; rows of
    ``live`` are (list, node, n, pos, hot, lc, root). One list may give as many as
    the square of its rows; :func:`crossing_links` keeps them in the tasks."""
    return _compared_in_blocks(live, bitmaps, similarity, "pairs")


def crossing_links(live: DataFrame, bitmaps: DataFrame, docs: DataFrame, rows: DataFrame, width: int,
                   similarity: float) -> DataFrame:
    """Links (a, b) among the crossing pairs, enough to join all that link.

    The rows of ``live`` that have a partner left by the bitmaps are found first; these
    alone get their whole sets and are compared again. Both times the pairs stay in the
    tasks: rows come out, then links, and a task gives none inside what it joined already."""
    marked = common.stored(_compared_in_blocks(live, bitmaps, similarity, "rows").distinct(), "marked")
    own = whole_sets(marked.select("node").distinct(), docs, rows, width)
    near = live.join(marked, ["list", "node"], "left_semi")
    links = common.stored(_compared_in_blocks(near, bitmaps, similarity, "links", own), "crossing")
    common.forget(marked)
    common.forget(own)
    return links


def _compared_in_blocks(live: DataFrame, bitmaps: DataFrame, similarity: float, give: str,
                        sets: DataFrame | None = None) -> DataFrame:
    """The crossing pairs of ``live``: themselves (a, b), the rows (list, node) that are in
    one, or the links (a, b) among them, told by the whole ``sets`` (node, items).

    A list is cut into chunks of about ``CHUNK`` rows, ``ITEMS`` items if sets are
    compared, and each pair of chunks meets in a task, which compares blocks of rows
    sorted by size."""
    size = F.count("*") / F.lit(float(CHUNK))
    if sets is not None:
        size = F.greatest(size, F.sum("n") / F.lit(float(ITEMS)))
    many = live.groupBy("list").agg(F.ceil(size).cast("int").alias("chunks")).filter("chunks > 1")
    placed = live.join(common.sized(many), "list", "left").join(bitmaps.select("node", "bits"), "node")
    if sets is not None:
        placed = placed.join(sets, "node")
    placed = placed.withColumn("chunks", F.coalesce("chunks", F.lit(1))) \
        .withColumn("own", F.pmod(F.xxhash64("node"), F.col("chunks")).cast("int")) \
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
    keys = ["list", "low", "high"]
    dealt = placed.select("list", F.least("own", "other").alias("low"), F.greatest("own", "other").alias("high"),
                          "own", "node", "n", "pos", "hot", "lc", "root", "bits", *["items"] * (sets is not None)) \
        .repartition(*keys).sortWithinPartitions(*keys, "n")
    names = ["list", "node"] if give == "rows" else ["a", "b"]

    def run(batches):
        import numpy as np
        import pyarrow as pa

        share = similarity / (1 + similarity)
        none = np.iinfo(np.int64).max

        def pairs(rows):
            """Blocks of pairs (places p, q) of one task's rows of one pair of chunks, by size."""
            low, high, own, node, n, pos, hot, lc, root = rows[:9]
            apart = low[0] < high[0]  # two chunks: pairs between them only
            widths = np.array([len(b) for b in rows[9]])
            maps = {}
            for w in np.unique(widths):
                at = np.flatnonzero(widths == w)
                maps[int(w)] = (at, [rows[9][i] for i in at])
            folded = {(w, v): _folded(maps[w][1], v) for w in maps for v in maps if v <= w}
            for w in maps:
                for v in maps:
                    if v > w:
                        continue
                    xs, ys = maps[w][0], maps[v][0]
                    x_bits, y_bits = folded[w, v], folded[v, v]
                    for s in range(0, len(xs), 256):
                        i, u = xs[s:s + 256], x_bits[s:s + 256]
                        # rows are sorted by size, so those of a fitting size are a range
                        first = np.searchsorted(n[ys], similarity * n[i[0]] - 1e-9)
                        last = np.searchsorted(n[ys], n[i[-1]] / similarity + 1e-9, "right")
                        for t in range(max(first, s) if w == v else first, last, 2048):
                            j, z = ys[t:min(t + 2048, last)], y_bits[t:min(t + 2048, last)]
                            both = n[i][:, None] + n[j][None]
                            need = np.ceil(share * both - 1e-9)
                            less, more = np.minimum(n[i][:, None], n[j][None]), np.maximum(n[i][:, None], n[j][None])
                            ok = (root[i][:, None] != root[j][None]) & (node[i][:, None] != node[j][None])
                            ok &= (less >= similarity * more - 1e-9)
                            ok &= np.minimum((n - pos)[i][:, None], (n - pos)[j][None]) >= need
                            # two sets whose prefixes hold all their cold items share no more than either has
                            h, c = hot[i][:, None], hot[j][None]
                            ok &= (h == none) | (c == none) | (
                                np.minimum(lc[i][:, None], lc[j][None]) + np.minimum(h, c) >= need)
                            if w == v:
                                ok &= i[:, None] < j[None]
                            if apart:
                                ok &= own[i][:, None] != own[j][None]
                            a, b = np.nonzero(ok)
                            for k in range(0, len(a), 65536):
                                p, q = a[k:k + 65536], b[k:k + 65536]
                                differ = np.bitwise_count(u[p] ^ z[q]).sum(axis=1, dtype=np.int64)
                                near = differ <= (both - 2 * need)[p, q]
                                if near.any():
                                    yield i[p[near]], j[q[near]]

        def linked(rows):
            """The pairs of places whose whole sets link what no link before them joined."""
            node, n, items = rows[3], rows[4], rows[10]
            group = np.unique(rows[8], return_inverse=True)[1]
            ends = np.cumsum(n)
            ids = mark = last = None
            for p, q in pairs(rows):
                for x, y in zip(p.tolist(), q.tolist(), strict=True):
                    if group[x] == group[y]:
                        continue
                    if ids is None:  # items numbered within the task
                        used, ids = np.unique(np.frombuffer(b"".join(items), np.uint64), return_inverse=True)
                        mark = np.zeros(len(used), bool)
                    if last != x:
                        if last is not None:
                            mark[ids[ends[last] - n[last]:ends[last]]] = False
                        mark[ids[ends[x] - n[x]:ends[x]]] = True
                        last = x
                    shared = int(np.count_nonzero(mark[ids[ends[y] - n[y]:ends[y]]]))
                    if shared >= similarity * (n[x] + n[y] - shared) - 1e-9:
                        group[group == group[y]] = group[x]
                        yield node[x], node[y]

        def met(key, rows):
            node, root = rows[3], rows[8]
            if (root == root[0]).all():
                return
            if give == "rows":
                found = np.zeros(len(node), bool)
                for p, q in pairs(rows):
                    found[p] = found[q] = True
                out = [np.full(int(found.sum()), key), node[found]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in out], names)
                return
            blocks = ((node[p], node[q]) for p, q in pairs(rows))
            if give == "links":
                blocks = [np.array(list(linked(rows)), np.int64).reshape(-1, 2).T]
            for a, b in blocks:
                yield pa.RecordBatch.from_arrays([pa.array(np.minimum(a, b)), pa.array(np.maximum(a, b))], names)

        held = None
        for batch in batches:
            cols = [batch.column(c).cast(pa.int64()).fill_null(none).to_numpy(zero_copy_only=False)
                    for c in range(10)]
            cols += [np.array(batch.column(c).to_pylist(), object) for c in range(10, batch.num_columns)]
            if held is not None:
                cols = [np.concatenate(c) for c in zip(held, cols, strict=True)]
            key = np.column_stack(cols[:3])
            ends = np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1
            for s, e in zip(np.r_[0, ends[:-1]], ends) if len(ends) else ():
                yield from met(cols[0][s], [c[s:e] for c in cols[1:]])
            held = [c[ends[-1]:] for c in cols] if len(ends) else cols
        if held is not None and len(held[0]):
            yield from met(held[0][0], held[1:])

    return dealt.mapInArrow(run, ", ".join(f"{c} long" for c in names))


def whole_sets(nodes: DataFrame, docs: DataFrame, rows: DataFrame, width: int) -> DataFrame:
    """(node, items): the sorted set of each of the distinct ``nodes``, read from its texts."""
    wanted = common.stored(rows.join(nodes, "node").groupBy("node").agg(F.min("id").alias("rid")), "wanted")
    few = common.sized(wanted)
    src = docs.join(few, docs["id"].eqNullSafe(few["rid"]), "left_semi")

    def sets(batches):
        import pyarrow as pa

        shingles, seen = _hasher(width), set()
        for batch in batches:
            found = [(_set_id(s), s) for s in (shingles(t) for _, t in _texts([batch]))]
            new = []
            for x in found:  # repeated sets once a task
                if x[0] not in seen:
                    seen.add(x[0])
                    new.append(x)
            if len(seen) > 1_000_000:
                seen.clear()
            yield pa.RecordBatch.from_arrays(
                [pa.array([x[0] for x in new], pa.int64()),
                 pa.array([x[1].tobytes() for x in new], pa.binary())], ["set", "items"])

    # any row of a set has its items; the rows read hold each wanted set at least once
    made = src.mapInArrow(sets, "set long, items binary")
    own = common.stored(made.join(few, made["set"] == few["node"], "left_semi")
                        .select(F.col("set").alias("node"), "items"), "sets")
    n_rows, n_sets = own.agg(F.count("*"), F.count_distinct("node")).first()
    if n_sets != wanted.count():
        raise RuntimeError(f"{n_sets} sets read of {wanted.count()} wanted")
    if n_rows > n_sets:  # read by several tasks
        own, repeated = common.stored(own.dropDuplicates(["node"]), "sets"), own
        common.forget(repeated)
    return own


def verified(pairs: DataFrame, docs: DataFrame, rows: DataFrame, width: int,
             similarity: float) -> DataFrame:
    """The pairs (a, b, shared, union) of nodes whose whole sets reach the similarity."""
    own = whole_sets(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct(), docs, rows, width)

    def check(batches):
        import numpy as np
        import pyarrow as pa

        for batch in batches:
            out = []
            a, b, s, t = batch.columns
            for x, y, u, v in zip(a.to_pylist(), b.to_pylist(), s, t, strict=True):
                u, v = (np.frombuffer(i.as_buffer(), np.uint64) for i in (u, v))
                shared = len(np.intersect1d(u, v, assume_unique=True))
                union = len(u) + len(v) - shared
                if shared >= similarity * union - 1e-9:
                    out.append((x, y, shared, union))
            if out:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in zip(*out, strict=True)], ["a", "b", "shared", "all"])

    links = common.stored(
        pairs.join(own.select(F.col("node").alias("a"), F.col("items").alias("s")), "a")
        .join(own.select(F.col("node").alias("b"), F.col("items").alias("t")), "b")
        .select("a", "b", "s", "t").mapInArrow(check, "a long, b long, shared long, all long"), "links")
    common.forget(own)
    return links


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
                    similarity: float = 0.75, frequent: float = 0.001) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row: the smallest id that
    links of Jaccard >= ``similarity`` reach from it."""
    return _placed(df, id_col, text_col, width, similarity, frequent).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("id")).alias("component_id"))


def _placed(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5,
            similarity: float = 0.75, frequent: float = 0.001) -> DataFrame:
    """(id, k1, k2, n, root, component_id) of each row: its key, the node that
    stands for its component, and the component's smallest id."""
    import numpy as np

    common.python_ready(df)
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), common.text_of(f"`{text_col}`"))
    keyed = df.select(F.col(f"`{id_col}`").cast("long").alias("id"),
                      common.text_of(f"`{text_col}`").alias("text"), k1.alias("k1"), k2.alias("k2"))
    docs = keyed.select("id", "text")
    signed = common.stored(signatures(keyed, width, frequent), "signatures")
    rows = signed.filter("n >= 0")
    total = rows.filter("n > 0").count()
    found = (signed.filter("n < 0").groupBy("node").agg((-F.sum("n")).alias("c"))
             .filter(F.col("c") >= max(8.0, frequent * total / 2)).orderBy("node").collect())
    hot = np.array([r[0] for r in found], np.int64).view(np.uint64)
    order = np.argsort(hot)
    hot, hot_count = hot[order], np.array([r[1] for r in found], np.int64)[order]

    posted = common.stored(postings(docs, width, similarity, hot, hot_count), "postings")
    members = common.stored(posted.select("grp", "node", "n", "cold").distinct(), "members")
    bitmaps = common.stored(posted.select("node", "n", "bits").distinct(), "bitmaps")
    lists = (posted.filter(F.size("items") > 0)
             .select("grp", "n", "cold", F.posexplode("items").alias("pos", "item"))
             .withColumn("size_pos", F.shiftleft(F.col("n").cast("long"), 32) + F.col("pos")))
    cold = group_pairs(lists.filter("pos < cold").select(F.col("item").alias("list"), "grp", "size_pos"),
                       similarity)
    salted = group_pairs(lists.filter("pos >= cold").select(
        F.xxhash64("item", F.pmod("grp", F.lit(SALTS))).alias("list"), "item", "grp", "size_pos"), similarity)
    raw = common.stored(cold.union(salted), "group-pairs")
    common.forget(posted)
    sizes = common.stored(group_sizes(raw, members, similarity), "sizes")
    pairs = likely_pairs(raw, sizes, similarity)
    expanded, wide = _expanded(common.stored(pairs, "pairs"), members)

    def compared(pairs):
        """The links among the pairs, and their table of candidates forgotten."""
        may = common.stored(sifted(pairs.filter("a <> b").distinct(), bitmaps, similarity), "candidates")
        links = verified(may, docs, rows, width, similarity)
        common.forget(may)
        return links

    links = compared(expanded.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")))
    roots = common.stored(components(links.select("a", "b")), "roots")

    # open lists: pairs across components only
    opened = common.stored(
        raw.filter("b IS NULL").select(F.col("a").alias("grp"), F.col("item").alias("list"), "n", "pos")
        .join(members.select("grp", "node"), "grp").join(sizes.select("grp", "hot", "lc"), "grp")
        .select("list", "node", "n", "pos", "hot", "lc")
        .union(wide.select("list", "node", "n", "pos", F.lit(None).cast("long"), F.lit(None).cast("long"))), "open")

    def unsettled(roots):
        """Rows (list, node, n, pos, hot, lc, root, lead) of the lists with several components;
        ``lead`` is a node of the list's largest component."""
        placed = opened.join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
        reps = placed.groupBy("list", "root").agg(F.min("node").alias("rep"), F.count("*").alias("size"))
        lead = reps.groupBy("list").agg(F.max(F.struct("size", "rep")).getField("rep").alias("lead"),
                                        F.count("*").alias("k")).filter("k > 1").select("list", "lead")
        return placed.join(lead, "list")

    live = unsettled(roots)
    rays = compared(live.select(F.least("lead", "node").alias("a"), F.greatest("lead", "node").alias("b")))
    roots = extended(roots, rays.select("a", "b"))
    live = common.stored(unsettled(roots).drop("lead"), "unsettled")
    crossing = crossing_links(live, bitmaps, docs, rows, width, similarity)
    roots = extended(roots, crossing.select("a", "b"))
    for table in (raw, sizes, links, rays, crossing, opened, live, bitmaps, members):
        common.forget(table)

    # class -> component -> smallest id; classes are grouped before any join
    classes = rows.filter("n > 0").groupBy("node").agg(F.min("id").alias("least")) \
        .join(roots, "node", "left").withColumn("root", F.coalesce("root", "node"))
    names = classes.groupBy("root").agg(F.min("least").alias("component_id"))
    named = classes.join(names, "root").select("node", "root", "component_id")
    return rows.join(named, "node", "left").select("id", "k1", "k2", "n", "root", "component_id")


def keep_one(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """``df`` with one row of each component, that of its smallest id (nulls
    last; ties: one of them). Rows are told apart by id and text, so that rows
    of a null or repeated id stay if their texts do. Rows without words all stay."""
    found = _placed(df, id_col, text_col, **options).filter("n > 0")
    keys = common.stored(found.groupBy("k1", "k2").agg(
        F.first("root").alias("root"), F.first("id").alias("id"), F.count("*").alias("c")), "near")
    first = (keys.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "k1", "k2"))
                                      .alias("w")).select("w.k1", "w.k2"))
    gone = keys.join(first, ["k1", "k2"], "left_anti").select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2"))
    repeated = (keys.filter("c > 1").join(first, ["k1", "k2"], "left_semi")
                .select(F.col("k1").alias("__k1"), F.col("k2").alias("__k2")))
    k1, k2 = common.row_key(F.col(f"`{id_col}`"), common.text_of(f"`{text_col}`"))
    on = ["__k1", "__k2"]
    kept = df.withColumns({"__k1": k1, "__k2": k2}).join(gone, on, "left_anti")
    if repeated.take(1):
        many = kept.join(repeated, on, "left_semi").dropDuplicates(on)
        kept = kept.join(repeated, on, "left_anti").unionByName(many)
    return kept.select(*[F.col(f"`{c}`") for c in df.columns])
