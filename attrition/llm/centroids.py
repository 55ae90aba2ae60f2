"""Integer k-means with PCA-rotated filtering.

Vectors become integers, floor(256 x). One pass sums the Gram matrix of all
vectors; its leading eigenvectors rotate every vector once, and a stored table
keeps the leading coordinates plus the norm of the rest. Projected distance
plus the squared difference of the residual norms never exceeds the true
squared distance, so per vector only centroids whose bound reaches the best
exact distance are compared in integers. The rotation decides how many
comparisons are made, never their outcome: slack covers the floating error.

Tasks send at most a row per centroid and component; the driver holds
centroids, never vectors. A cluster may hold all vectors: nothing is grouped by
cluster but those partial sums.

Defined cases: vectors that are null, of another length, or that hold a null
or non-finite component are dropped; equal vectors and repeated or null
vec_ids are rows of their own; rows without vec_id come last as starting
centroids, ties in the start order go by components; fewer than k vectors make
as many centroids; an empty table gives no row. Integers beyond 2^62 count as
2^62; components beyond 2^27 are compared as Python integers, and a distance
or inertia beyond a long is given as the largest long. Further columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from attrition.llm import common

DIMENSIONS, CENTROIDS, ROUNDS = 64, 40, 5
#: Share of the variance that the leading coordinates hold; the rest is one norm.
SHARE = 0.95
#: Up to here the squared distance of two vectors of 64 components fits into a long.
SMALL = 2 ** 27
LARGEST = 2 ** 63 - 1
#: Pairs that are verified at a time, and the share of the squared norms allowed for rounding.
PAIRS, SLACK = 50_000, 1e-6


def kept(embeddings: DataFrame, dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, q: whole, finite vectors as integers."""
    edge = F.lit(float(2 ** 62))
    x = F.col("embedding").cast("array<double>")
    limit = F.lit(float("inf"))
    whole = (F.size("x") == dimensions) & F.forall(
        "x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < limit))
    scaled = F.transform("x", lambda v: F.floor(F.least(F.greatest(v * 256, -edge), edge)).cast("long"))
    return embeddings.select("vec_id", x.alias("x")).filter(F.col("x").isNotNull()).filter(whole) \
        .select("vec_id", scaled.alias("q"))


def integers(batch: pa.RecordBatch, dimensions: int) -> np.ndarray:
    return batch["q"].flatten().to_numpy(zero_copy_only=False).reshape(-1, dimensions)


def _gram(batches: Iterator[pa.RecordBatch], dimensions: int) -> Iterator[pa.RecordBatch]:
    """Sums of products of the components with a constant one appended."""
    total = np.zeros((dimensions + 1, dimensions + 1))
    for b in batches:
        q = integers(b, dimensions).astype(float)
        q = np.hstack([q, np.ones((len(q), 1))])
        total += q.T @ q
    i, j = np.indices(total.shape)
    yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()),
                                      pa.array(total.ravel())], ["i", "j", "v"])


def rotation(vectors: DataFrame, dimensions: int, share: float) -> tuple[np.ndarray, np.ndarray]:
    """Mean of all vectors and the leading eigenvectors of their covariance, as
    many as hold that share of the variance."""
    cells = vectors.select("q").mapInArrow(partial(_gram, dimensions=dimensions), "i int, j int, v double") \
        .groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    g = np.zeros((dimensions + 1, dimensions + 1))
    for i, j, v in cells:
        g[i, j] = v
    n = max(g[-1, -1], 1.0)
    mean = g[-1, :-1] / n
    variance, axes = np.linalg.eigh(g[:-1, :-1] / n - np.outer(mean, mean))
    held = np.cumsum(np.maximum(variance[::-1], 0))
    leading = int(np.searchsorted(held, share * held[-1])) + 1
    return mean, axes[:, ::-1][:, :leading].copy()


def rotated(q: np.ndarray, mean: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates and, as the last column, the norm of what they leave."""
    x = q.astype(float) - mean
    y = x @ axes
    return np.column_stack([y, np.linalg.norm(x - y @ axes.T, axis=1)])


def _with_rotated(batches, mean, axes):
    for b in batches:
        z = rotated(integers(b, len(mean)), mean, axes)
        flat = pa.array(z.ravel())
        offsets = pa.array(np.arange(0, flat.__len__() + 1, z.shape[1], dtype=np.int32))
        yield pa.RecordBatch.from_arrays([b["vec_id"], b["q"], pa.ListArray.from_arrays(offsets, flat)],
                                         ["vec_id", "q", "z"])


def nearest(q: np.ndarray, z: np.ndarray, centroids: np.ndarray, cz: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Nearest centroid (ties: smaller number), exact squared distance, and the pairs compared."""
    whole = np.int64 if max(np.abs(q).max(initial=0), max(map(abs, centroids.ravel()))) <= SMALL else object
    q, c = q.astype(whole), centroids.astype(whole)

    def exact(rows, cols):
        out = np.empty(len(rows), dtype=whole)
        for s in range(0, len(rows), PAIRS):
            d = q[rows[s:s + PAIRS]] - c[cols[s:s + PAIRS]]
            out[s:s + PAIRS] = (d * d).sum(axis=1)
        return out

    scale = (z * z).sum(axis=1)[:, None] + (cz * cz).sum(axis=1)[None, :]
    low = scale - 2.0 * (z @ cz.T) - SLACK * scale - 1e-3
    best = low.argmin(axis=1)
    every = np.arange(len(q))
    distance = exact(every, best)
    reach = low <= distance.astype(float)[:, None] * (1 + SLACK)
    reach[every, best] = False
    rows, cols = np.nonzero(reach)
    found = exact(rows, cols)
    for j in range(len(c)):  # in ascending order, so a tie keeps the smaller number
        at = cols == j
        r, d = rows[at], found[at]
        better = (d < distance[r]) | ((d == distance[r]) & (j < best[r]))
        best[r[better]], distance[r[better]] = j, d[better]
    return best, distance, len(q) + len(rows)


def _assigned(batches, dimensions, centroids, cz):
    """(batch, integers, cluster, distance) of each batch; the rows are compared in blocks."""
    for b in batches:
        q = integers(b, dimensions)
        z = b["z"].flatten().to_numpy(zero_copy_only=False).reshape(len(q), -1)
        parts = [nearest(q[s:s + 4096], z[s:s + 4096], centroids, cz)[:2] for s in range(0, len(q), 4096)]
        if parts:
            yield b, q, np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def _sums(batches, dimensions, centroids, cz):
    """Per task: count and component sums of each centroid's vectors, as decimal text."""
    count, total = [0] * len(centroids), [None] * len(centroids)
    for _, q, cluster, _ in _assigned(batches, dimensions, centroids, cz):
        q = q if np.abs(q).max() <= SMALL else q.astype(object)
        for j in np.unique(cluster):
            mine = q[cluster == j]
            count[j] += len(mine)
            s = mine.sum(axis=0).astype(object)
            total[j] = s if total[j] is None else total[j] + s
    out = [{"cluster": j, "n": count[j], "sums": [str(v) for v in total[j]]}
           for j in range(len(centroids)) if count[j]]
    if out:
        yield pa.RecordBatch.from_pylist(out, pa.schema(
            [("cluster", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string()))]))


def _clusters(batches, dimensions, centroids, cz):
    for b, _, cluster, distance in _assigned(batches, dimensions, centroids, cz):
        whole = np.minimum(distance, LARGEST).astype(np.int64)
        yield pa.RecordBatch.from_arrays([b["vec_id"], pa.array(cluster, pa.int32()), pa.array(whole)],
                                         ["vec_id", "cluster", "distance"])


def start(vectors: DataFrame, k: int) -> np.ndarray:
    """The k vectors with the smallest hashes of their ids."""
    seed = F.sha2(F.concat(F.lit("2:"), F.coalesce(F.col("vec_id").cast("string"), F.lit("null"))), 256)
    rows = vectors.orderBy(F.col("vec_id").isNull(), seed, "q").select("q").limit(k).collect()
    return np.array([[int(v) for v in r["q"]] for r in rows], dtype=object)


def moved(table: DataFrame, dimensions: int, centroids: np.ndarray, cz: np.ndarray) -> np.ndarray:
    """Each centroid replaced by the floored mean of its vectors; empty ones stay."""
    parts = table.mapInArrow(partial(_sums, dimensions=dimensions, centroids=centroids, cz=cz),
                             "cluster int, n long, sums array<string>")
    sums = parts.select("cluster", "n", F.posexplode("sums").alias("i", "s")) \
        .groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("s").cast("decimal(38,0)")).alias("s")) \
        .collect()
    out = centroids.copy()
    for cluster, i, n, s in sums:
        out[cluster, i] = int(s) // n
    return out


def cluster(embeddings: DataFrame, k: int = CENTROIDS, rounds: int = ROUNDS, share: float = SHARE,
            dimensions: int = DIMENSIONS) -> DataFrame:
    """vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256."""
    common.python_ready(embeddings)
    vectors = common.stored(kept(embeddings, dimensions), "centroids-vectors")
    mean, axes = rotation(vectors, dimensions, share)
    id_type = dict(vectors.dtypes)["vec_id"]
    table = common.stored(vectors.mapInArrow(partial(_with_rotated, mean=mean, axes=axes),
                                             f"vec_id {id_type}, q array<long>, z array<double>"), "centroids-rotated")
    centroids = start(vectors, k)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(table, dimensions, centroids, rotated(centroids, mean, axes))
    if not len(centroids):
        out = vectors.select("vec_id", F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance"))
    else:
        last = partial(_clusters, dimensions=dimensions, centroids=centroids, cz=rotated(centroids, mean, axes))
        out = common.stored(table.mapInArrow(last, f"vec_id {id_type}, cluster int, distance long"),
                            "centroids-clusters")

    per = {r["cluster"]: int(r["s"]) for r in out.groupBy("cluster").agg(
        F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}  # at most k rows
    total = min(sum(per.values()), LARGEST)
    sums = embeddings.sparkSession.createDataFrame(
        [(j, min(per[j], LARGEST), total, hashlib.sha256(",".join(map(str, c)).encode()).hexdigest())
         for j, c in enumerate(centroids) if j in per],
        "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    return out.join(F.broadcast(sums), "cluster") \
        .select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def oracle(k: int = CENTROIDS, rounds: int = ROUNDS, dimensions: int = DIMENSIONS) -> str:
    """The same clustering as DuckDB SQL, a common table expression per step."""
    steps = [f"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS q
  FROM embeddings
  WHERE len(embedding) = {dimensions}
    AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = {dimensions}
), c0 AS MATERIALIZED (
  SELECT (row_number() OVER (ORDER BY vec_id IS NULL, sha256('2:' || coalesce(vec_id::VARCHAR, 'null')), q) - 1)::INTEGER
         AS cluster, q AS m
  FROM kept QUALIFY cluster < {k}
)"""]
    for i in range(rounds + 1):
        steps.append(f"""a{i} AS MATERIALIZED (
  SELECT r, any_value(vec_id) AS vec_id, any_value(q) AS q, min({{'d': d, 'c': cluster}}) AS best
  FROM (SELECT r, vec_id, q, cluster,
               list_sum(list_transform(list_zip(q, m), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d
        FROM kept CROSS JOIN c{i})
  GROUP BY r
)""")
        if i < rounds:
            steps.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c.cluster, coalesce(u.m, c.m) AS m FROM c{i} c LEFT JOIN (
    SELECT cluster, list(((s - ((s % n) + n) % n) // n)::BIGINT ORDER BY pos) AS m
    FROM (SELECT best.c AS cluster, pos, sum(v)::HUGEINT AS s, count(*) AS n
          FROM (SELECT best, unnest(q) AS v, unnest(range({dimensions})) AS pos FROM a{i}) GROUP BY ALL)
    GROUP BY cluster) u USING (cluster)
)""")
    return "WITH " + ", ".join(steps) + f"""
SELECT vec_id, best.c AS cluster, best.d AS distance,
       (sum(best.d) OVER (PARTITION BY best.c))::BIGINT AS cluster_inertia,
       (sum(best.d) OVER ())::BIGINT AS inertia, sha256(array_to_string(m, ',')) AS centroid_sha256
FROM a{rounds} JOIN c{rounds} ON best.c = cluster
"""
