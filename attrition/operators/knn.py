"""Exact k-nearest neighbours (Euclidean) within groups, as a Spark job.

Plan, for points (id, group, vector):

1. **Cells.** Per group a tree of splits is found on a sample of bounded size
   (about ``SAMPLE`` rows a cell). A split is the one that moves the means of
   its halves furthest apart over all dimensions, so indicator columns that go
   together come first and leave wide gaps between cells.
2. **Blocks.** A shuffle brings the points of a cell together. They are packed
   in blocks of about ``chunk_size`` rows, sorted by id, together with each
   point's k-th distance inside its block, which bounds the true one from above.
   A cell of any size (equal points) is cut into chunks by hash.
3. **Visits.** A block must see another one if the bounding box of that lies
   within the bound of any of its points. Boxes (two vectors a block, at most
   ``MAX_BLOCKS`` blocks) are broadcast; the visits are found in the tasks.
4. **Search.** Each block's visits stream to its task, the nearest box first.
   Bounds tighten on the way, points that a box can't serve are left out, and
   numpy refines candidates within rounding error of the bound with exact distances.
5. **Top-k.** ``row_number`` per query id over about k rows a point; ties
   broken by neighbour id.

The result is exact; boxes only save work. Where nothing is pruned the work is
quadratic in the group size, as for any exact method, but spread over tasks.
A vector with a missing or non-finite component is nobody's neighbour and has none.
"""

from __future__ import annotations

import heapq
import math
import pickle

import numpy as np
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.random import uniform
from ..session import checkpointed, ship_package

MAX_CELLS = 2048
#: Rows of the sample per cell.
SAMPLE = 16
#: Blocks whose boxes are broadcast, about; larger groups get larger blocks.
MAX_BLOCKS = 65_536
#: Candidates that are refined at a time.
REFINED = 1 << 17


def _as_array(df: DataFrame, vec_col: str) -> DataFrame:
    dt = df.schema[vec_col].dataType
    if isinstance(dt, VectorUDT):
        return df.withColumn(vec_col, vector_to_array(F.col(vec_col), "float64"))
    return df.withColumn(vec_col, F.col(vec_col).cast("array<double>"))


def _dist_block(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Squared distances, expansion form (refined exactly for the winners)."""
    qq = np.einsum("ij,ij->i", q, q)[:, None]
    xx = np.einsum("ij,ij->i", x, x)[None, :]
    d2 = qq + xx - 2.0 * (q @ x.T)
    np.maximum(d2, 0.0, out=d2)
    return d2


def _split(x: np.ndarray):
    """(dimension, threshold) whose halves have the means furthest apart, weighed
    by the share of rows in each; None if all rows are equal."""
    best, found = 0.0, None
    total, n = x.sum(axis=0), len(x)
    for j in np.flatnonzero(x.min(axis=0) < x.max(axis=0)):
        v = x[:, j]
        t = np.partition(v, (n - 1) // 2)[(n - 1) // 2]
        if t == v.max():
            t = v[v < t].max()
        left = v <= t
        m = int(left.sum())
        part = x[left].sum(axis=0)
        gain = (((part / m - (total - part) / (n - m)) ** 2).sum()) * m * (n - m)
        if gain > best:
            best, found = gain, (int(j), float(t))
    return found


def _tree(x: np.ndarray, n_cells: int):
    """Splits of a sample into at most ``n_cells`` cells, the largest part first:
    (dim, threshold, left child, cell) per node, and the sample rows per cell."""
    dim, cut, left, rows = [-1], [0.0], [-1], {0: np.arange(len(x))}
    queue = [(-len(x), 0)]
    cells = 1
    while queue and cells < n_cells:
        _, node = heapq.heappop(queue)
        own = rows[node]
        found = _split(x[own]) if len(own) > 1 else None
        if found is None:
            continue
        dim[node], cut[node] = found
        left[node] = len(dim)
        low = x[own, dim[node]] <= cut[node]
        for part in (own[low], own[~low]):
            rows[len(dim)] = part
            heapq.heappush(queue, (-len(part), len(dim)))
            dim.append(-1)
            cut.append(0.0)
            left.append(-1)
        del rows[node]
        cells += 1
    cell = np.full(len(dim), -1)
    cell[sorted(rows)] = np.arange(len(rows))
    return (np.array(dim), np.array(cut), np.array(left), cell), [len(rows[i]) for i in sorted(rows)]


def _cell_of(x: np.ndarray, tree) -> np.ndarray:
    dim, cut, left, cell = tree
    node = np.zeros(len(x), np.int64)
    live = np.arange(len(x))
    while True:
        live = live[dim[node[live]] >= 0]
        if not len(live):
            return cell[node]
        at = node[live]
        node[live] = left[at] + (x[live, dim[at]] > cut[at])


def _packed(x: np.ndarray) -> bytes:
    """The columns of a block; one of few values as a byte a row and their table."""
    out = []
    for v in x.T:
        table, code = np.unique(v.view(np.int64) if v.flags.c_contiguous else np.ascontiguousarray(v).view(np.int64),
                                return_inverse=True)
        out.append((table.view(np.float64), code.astype(np.uint8)) if len(table) <= 256 else
                   (None, np.ascontiguousarray(v)))
    return pickle.dumps(out, protocol=5)


def _unpacked(data: bytes) -> np.ndarray:
    cols = pickle.loads(data)
    out = np.empty((len(cols[0][1]), len(cols)))
    for j, (table, v) in enumerate(cols):
        out[:, j] = v if table is None else table[v]
    return out


def _outside(x: np.ndarray, low: np.ndarray, high: np.ndarray) -> np.ndarray:
    """Squared distances of the rows from a box."""
    d = x - np.clip(x, low, high)
    return np.einsum("ij,ij->i", d, d)


def _slack(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Rounding error of the expansion form, per row of ``q``."""
    return 1e-9 * ((q ** 2).sum(axis=1) + (x ** 2).sum(axis=1).max() + 1e-300)


def _own_bounds(x: np.ndarray, h: np.ndarray, k: int) -> np.ndarray:
    """Upper bounds of the squared k-th distances from the block's own rows."""
    out = np.full(len(x), np.inf)
    if len(x) > k:
        for s in range(0, len(x), 512):
            q = x[s:s + 512]
            d2 = _dist_block(q, x)
            d2[h[s:s + 512, None] == h[None, :]] = np.inf
            out[s:s + 512] = np.partition(d2, k - 1, axis=1)[:, k - 1] + _slack(q, x)
    return out


class _Search:
    """The rows of one block and the candidates found for them so far."""

    def __init__(self, ids, h, x, bounds, k: int, null_is_equal: bool):
        self.ids, self.h, self.x, self.k, self.null_is_equal = ids, h, x, k, null_is_equal
        self.bounds, self.best = bounds.copy(), np.full((len(x), k), np.inf)
        self.found: list[tuple] = []

    def _same(self, rows, ids, cols) -> np.ndarray:
        return np.array([a == b and (a is not None or self.null_is_equal)
                         for a, b in ((self.ids[int(i)].as_py(), ids[int(j)].as_py()) for i, j in zip(rows, cols))], bool)

    def visit(self, ids, h, x) -> None:
        k = self.k
        live = np.flatnonzero(_outside(self.x, x.min(axis=0), x.max(axis=0)) <= self.bounds * (1 + 1e-9))
        for s in range(0, len(live), 512):
            rows = live[s:s + 512]
            q = self.x[rows]
            d2 = _dist_block(q, x)
            cap = self.bounds[rows]
            if np.isinf(cap).any() and len(x) > 4 * k:  # one of 4 k + 1 rows may be its own or repeat its id
                other = np.where(self.h[rows, None] == h[None, :], np.inf, d2)
                cap = np.minimum(cap, np.partition(other, k - 1, axis=1)[:, k - 1] + _slack(q, x))
            near = d2 <= (cap + _slack(q, x))[:, None]
            ends = np.cumsum(near.sum(axis=1))
            at = 0
            while at < len(rows):  # rows whose candidates fit in one step
                to = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + REFINED, "right")))
                self._refine(rows[at:to], near[at:to], ids, h, x)
                at = to

    def _refine(self, rows, near, ids, h, x) -> None:
        i, j = np.nonzero(near)
        if not len(i):
            return
        alike = np.flatnonzero(self.h[rows[i]] == h[j])
        if len(alike):
            drop = alike[self._same(rows[i[alike]], ids, j[alike])]
            i, j = np.delete(i, drop), np.delete(j, drop)
        dist = np.sqrt(((x[j] - self.x[rows[i]]) ** 2).sum(axis=1))
        order = np.lexsort((j, dist, i))  # a block's rows are sorted by id
        i, j, dist = i[order], j[order], dist[order]
        place = np.arange(len(i)) - np.searchsorted(i, i)
        keep = (place < self.k) & np.isfinite(dist)
        i, j, dist, place = i[keep], j[keep], dist[keep], place[keep]
        new = np.full((len(rows), self.k), np.inf)
        new[i, place] = dist
        self.best[rows] = np.sort(np.hstack([self.best[rows], new]), axis=1)[:, :self.k]
        self.bounds[rows] = np.minimum(self.bounds[rows], self.best[rows, -1] ** 2 * (1 + 1e-12))
        if len(i):
            import pyarrow as pa
            self.found.append((rows[i], dist, ids.take(pa.array(j)), x[j]))

    def result(self, with_vectors: bool):
        import pyarrow as pa
        for rows, dist, ids, vecs in self.found:
            keep = np.flatnonzero(dist <= self.best[rows, -1])
            if not len(keep):
                continue
            cols = {"id": self.ids.take(pa.array(rows[keep])), "neighbor_id": ids.take(pa.array(keep)),
                    "distance": pa.array(dist[keep])}
            if with_vectors:
                d = vecs.shape[1]
                cols["neighbor_vec"] = pa.ListArray.from_arrays(
                    pa.array(np.arange(0, (len(keep) + 1) * d, d), pa.int32()), pa.array(vecs[keep].ravel()))
            yield pa.RecordBatch.from_arrays(list(cols.values()), list(cols))


def knn(points: DataFrame, id_col: str, vec_col: str, k: int = 5,
        group_col: str | None = None, chunk_size: int = 2048, n_pivots: int | None = None,
        seed: int = 42, with_vectors: bool = False) -> DataFrame:
    """Top-k neighbours of every point among the points of its group.

    Returns (id, neighbor_id, rank 1..k, distance[, neighbor_vec]); a point
    is never its own neighbour; groups smaller than k+1 give fewer rows.
    ``n_pivots``: cells per group (default: by its size).
    """
    spark = points.sparkSession
    ship_package(spark)
    pts = points.select(F.col(id_col).alias("id"),
                        (F.col(group_col) if group_col else F.lit(0)).alias("grp"),
                        F.col(vec_col).alias("vec"))
    # a point of no group has no neighbours
    pts = _as_array(pts, "vec").where(F.col("grp").isNotNull() & F.forall(
        "vec", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < F.lit(float("inf")))))
    id_type = pts.schema["id"].dataType
    out_fields = [T.StructField("id", id_type), T.StructField("neighbor_id", id_type),
                  T.StructField("distance", T.DoubleType())]
    if with_vectors:
        out_fields.append(T.StructField("neighbor_vec", T.ArrayType(T.DoubleType())))

    # 1. cells: per group, a tree of splits of the points with the smallest hashes.
    sizes = {r["grp"]: r["n"] for r in pts.groupBy("grp").agg(F.count(F.lit(1)).alias("n")).collect()}
    if not sizes:
        empty = spark.createDataFrame([], T.StructType(out_fields)).withColumnRenamed("id", id_col)
        return empty.select(id_col, "neighbor_id", F.lit(0).alias("rank"), *[f.name for f in out_fields[2:]])
    total = sum(sizes.values())
    chunk_size = max(chunk_size, total // MAX_BLOCKS)
    want = {g: n_pivots or max(1, min(MAX_CELLS, n // chunk_size)) for g, n in sizes.items()}
    by_group = lambda values: F.element_at(F.create_map(
        *[x for g, v in values.items() for x in (F.lit(g), F.lit(v))]), F.col("grp"))
    share = {g: min(1.0, (SAMPLE * want[g] + 64.0) / n) for g, n in sizes.items()}
    sample: dict = {}
    for r in pts.where(uniform(F.col("id"), "pivot", seed) <= by_group(share)).select("grp", "vec").collect():
        sample.setdefault(r["grp"], []).append(r["vec"])
    code = {g: i for i, g in enumerate(sizes)}
    trees = {}
    for g, n in sizes.items():
        seen = np.array(sample.get(g) or [], dtype=np.float64)
        tree, counts = _tree(seen, want[g]) if len(seen) else ((np.array([-1]), np.zeros(1), np.array([-1]),
                                                                np.zeros(1, int)), [1])
        chunks = [max(1, math.ceil(n * c / max(1, sum(counts)) / chunk_size)) for c in counts]
        trees[code[g]] = (tree, np.array(chunks))

    # 2. blocks of the points of a cell, with the bounds that their own rows give.
    sent = spark.sparkContext.broadcast(trees)

    def vectors(col) -> np.ndarray:
        return col.flatten().to_numpy(zero_copy_only=False).reshape(len(col), -1)

    def placed(batches):
        import pyarrow as pa
        for b in batches:
            if not b.num_rows:
                continue
            g, h = b["g"].to_numpy(), b["h"].to_numpy().view(np.uint64)
            x = vectors(b["vec"])
            cell, chunk = np.zeros(len(g), np.int32), np.zeros(len(g), np.int32)
            for i in np.unique(g):
                at = np.flatnonzero(g == i)
                tree, chunks = sent.value[int(i)]
                cell[at] = _cell_of(x[at], tree)
                chunk[at] = (h[at] >> np.uint64(20)) % chunks[cell[at]].astype(np.uint64)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell), pa.array(chunk)],
                                             [*b.schema.names, "cell", "chunk"])

    rows = pts.select("id", F.xxhash64("id").alias("h"), by_group(code).cast("int").alias("g"), "vec")
    celled = rows.mapInArrow(placed, T.StructType([*rows.schema.fields, T.StructField("cell", T.IntegerType()),
                                                   T.StructField("chunk", T.IntegerType())]))
    keys = ["g", "cell", "chunk"]

    def packed(batches):
        import pyarrow as pa

        def block(b):
            x, h = vectors(b["vec"]), b["h"].to_numpy()
            return pa.RecordBatch.from_arrays(
                [pa.array([b["g"][0].as_py()], pa.int32()),
                 pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b["id"]),
                 pa.array([h.tobytes()], pa.binary()), pa.array([_packed(x)], pa.binary()),
                 pa.array([_own_bounds(x, h, k).tobytes()], pa.binary()),
                 pa.array([x.min(axis=0).tolist()]), pa.array([x.max(axis=0).tolist()])],
                ["g", "ids", "h", "x", "bounds", "low", "high"])

        held = None
        for b in batches:
            t = pa.Table.from_batches(([held] if held is not None else []) + [b]).combine_chunks()
            if not t.num_rows:
                continue
            b = t.to_batches()[0]
            key = np.column_stack([b[c].to_numpy() for c in keys])
            ends = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(axis=1)) + 1).tolist()]
            for s, e in zip(ends, ends[1:] + [b.num_rows]):
                while e - s > 2 * chunk_size:
                    yield block(b.slice(s, chunk_size))
                    s += chunk_size
                if e < b.num_rows:
                    yield block(b.slice(s, e - s))
                else:
                    held = b.slice(s, e - s)
        if held is not None:
            yield block(held)

    blocks = checkpointed(celled.repartition(*keys).sortWithinPartitions(*keys, "id").mapInArrow(packed, T.StructType([
        T.StructField("g", T.IntegerType()), T.StructField("ids", T.ArrayType(id_type)),
        *[T.StructField(c, T.BinaryType()) for c in ("h", "x", "bounds")],
        *[T.StructField(c, T.ArrayType(T.DoubleType())) for c in ("low", "high")]])))
    blocks = blocks.withColumn("block", F.monotonically_increasing_id())  # of a stored table: stays the same

    # 3. visits: the blocks whose box lies within the bound of some row.
    boxes: dict = {}
    for r in blocks.select("g", "block", "low", "high").collect():
        boxes.setdefault(r["g"], []).append((r["block"], r["low"], r["high"]))
    boxes = {g: tuple(np.array(c) for c in zip(*v)) for g, v in boxes.items()}
    sent_boxes = spark.sparkContext.broadcast(boxes)

    def visits(batches):
        import pyarrow as pa
        for b in batches:
            for own, g, data, bounds in zip(*(b[c].to_pylist() for c in ("block", "g", "x", "bounds"))):
                x, far = _unpacked(data), np.frombuffer(bounds, np.float64) * (1 + 1e-9)
                name, low, high = sent_boxes.value[g]
                gap = np.maximum(0.0, np.maximum(low - x.max(axis=0), x.min(axis=0) - high))
                out = []
                for j in np.flatnonzero(((gap ** 2).sum(axis=1) <= far.max()) & (name != own)):
                    d2 = _outside(x, low[j], high[j])
                    if (d2 <= far).any():
                        out.append((own, int(name[j]), float(d2.min())))
                if out:
                    yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*out)], ["q", "block", "gap"])

    pairs = blocks.select("block", "g", "x", "bounds").mapInArrow(visits, "q long, block long, gap double")

    # 4. search: a block's own rows come first, then its visits, the nearest first.
    sides = blocks.select(F.col("block").alias("q"), F.lit(-1.0).alias("gap"), "ids", "h", "x", "bounds").unionByName(
        blocks.drop("g", "bounds", "low", "high").join(pairs, "block")
        .select("q", "gap", "ids", "h", "x", F.lit(None).cast("binary").alias("bounds")))
    null_is_equal = not isinstance(id_type, T.NumericType)

    def search(batches):
        now, key = None, None
        for b in batches:
            ids_col = b["ids"]
            for i, (q, h, data, bounds) in enumerate(zip(*(b[c].to_pylist() for c in ("q", "h", "x", "bounds")))):
                ids, h, x = ids_col[i].values, np.frombuffer(h, np.int64), _unpacked(data)
                if q != key:
                    if now is not None:
                        yield from now.result(with_vectors)
                    now, key = _Search(ids, h, x, np.frombuffer(bounds, np.float64), k, null_is_equal), q
                now.visit(ids, h, x)
        if now is not None:
            yield from now.result(with_vectors)

    local = sides.repartition("q").sortWithinPartitions("q", "gap").mapInArrow(search, T.StructType(out_fields))
    wr = Window.partitionBy("id").orderBy("distance", "neighbor_id")
    top = local.withColumn("rank", F.row_number().over(wr)).where(F.col("rank") <= k)
    cols = ["id", "neighbor_id", "rank", "distance"] + (["neighbor_vec"] if with_vectors else [])
    out = top.select(*cols)
    if id_col != "id":
        out = out.withColumnRenamed("id", id_col)
    return out
