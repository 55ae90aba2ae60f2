"""Many boosted models over one pre-binned table.

``bin_table`` turns rows into blocks of small integers once: quantile edges per
feature from one aggregate, then a stored table. A row carries the training
sets it belongs to (a bit each) and the fold it is held out for, so all folds and
all trials of a search read the same blocks. ``fit_boosted`` fits any
number of jobs (a ``BoostSpec``, a training set, a fold to score) together and
returns the models plus the margins of the held-out rows.

Where the rows of a training set span several slices, a level of all trees is one Spark
job: tasks sum histograms of the nodes that must be counted (the smaller child
only), an exchange by (job, feature range) adds them up, the sibling is the
parent minus the counted child, and each range's best splits, a row per node,
go to the driver. Parents' histograms stay where the exchange puts them.
Margins follow the blocks, and are checkpointed every few rounds; a lost task is
redone from there. Histograms never reach the driver.

A training set of one slice has nothing to exchange: then each job's rows go to a task
of its own, which runs all rounds of that job, and the jobs of a search run side by
side. ``slice_rows`` bounds the rows that such a task trains on, as the size of a broadcast
is bounded; other sets' rows don't reach it. Gradients are whole numbers, so given the edges (approximate
quantiles, beyond some thousand rows) both ways give the same trees to the last bit; ``tests/test_boosting.py`` holds them against each other and
against a plain fit.

The level-wise part is written on RDDs: a round is a dozen small steps over
resident numpy blocks, and a DataFrame plan for each costs several times the
work itself.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import trees as T
from ..schema import ID_COL
from ..session import checkpointed, ensure_checkpoint_dir, ship_package

LABEL = "label"
MAX_BINS = 64
#: Rows that one task may hold to fit a model alone: about 190 bytes each with 50 features, working arrays included.
SLICE_ROWS = 1 << 20
#: Rounds between checkpoints of the margins.
CHECKPOINT_ROUNDS = 20
SCORES = "job int, id string, label int, margin double"
BLOCK = "code binary, y binary, sets binary, fold binary, rid binary, ids array<string>"


@dataclass(frozen=True)
class BoostJob:
    spec: T.BoostSpec
    train_set: int = 0
    fold: int | None = None  # rows with this fold are scored


@dataclass
class BinnedTable:
    blocks: DataFrame
    layout: T.Layout
    n_rows: int
    counts: list[tuple[int, int]]  # rows of label 0 and 1, per training set


def bin_table(df: DataFrame, n_sets: int = 1, sets: Column | None = None, fold: Column | None = None,
              max_bins: int = MAX_BINS, id_col: str = ID_COL) -> BinnedTable:
    """Blocks of the rows of ``df`` (id, label, ``features`` vector).

    ``sets``: bit s is set if the row belongs to training set s (default: all to set
    0); ``fold``: the fold a row is held out for (-1: none). A NaN feature falls
    into the last bin and goes right. Rows without a label train nothing.
    """
    if n_sets > 62:
        raise ValueError("at most 62 training sets")
    ship_package(df.sparkSession)
    known = F.coalesce(F.col(LABEL).isin(0.0, 1.0), F.lit(False))
    rows = df.select(
        F.col(id_col).cast("string").alias("id"), F.when(known, F.col(LABEL)).otherwise(F.lit(0.0)).alias("y"),
        F.when(known, F.lit(1).cast("long") if sets is None else sets).otherwise(F.lit(0).cast("long")).alias("sets"),
        (F.lit(-1) if fold is None else F.coalesce(fold, F.lit(-1))).cast("int").alias("fold"),
        vector_to_array("features", "float64").alias("x"))
    first = rows.select(F.size("x")).first()
    n_features = first[0] if first else 0
    probabilities = [i / max_bins for i in range(max_bins)] + [1.0]
    quantiles = [F.percentile_approx(F.when(~F.isnan(F.get("x", F.lit(j))), F.get("x", F.lit(j))),
                                     probabilities, 10_000).alias(f"q{j}") for j in range(n_features)]
    inside = [F.col("sets").bitwiseAND(F.lit(1 << s).cast("long")) != 0 for s in range(n_sets)]
    sizes = [F.sum(F.when(inside[s] & (F.col("y") == v), 1).otherwise(0)).alias(f"n{s}_{v}")
             for s in range(n_sets) for v in (0, 1)]
    seen = rows.agg(F.count("*").alias("n"), *quantiles, *sizes).first()
    # an edge is the upper end of a bin, so the largest value needs none
    edges = [sorted(set(seen[f"q{j}"] or []))[:-1] for j in range(n_features)]
    layout = T.Layout.of(edges)
    if layout.width >= 1 << 16:
        raise ValueError("more than 65,535 bins")
    blocks = checkpointed(rows.withColumn("rid", F.xxhash64("id"))
                          .mapInArrow(partial(_blocked, layout=layout), BLOCK))
    counts = [(int(seen[f"n{s}_0"] or 0), int(seen[f"n{s}_1"] or 0)) for s in range(n_sets)]
    return BinnedTable(blocks, layout, int(seen["n"]), counts)


def _blocked(batches: Iterator[pa.RecordBatch], layout: T.Layout) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        x = b["x"].flatten().to_numpy(zero_copy_only=False).reshape(b.num_rows, -1)
        cells = [layout.binned(x).astype(np.uint16), b["y"].to_numpy(zero_copy_only=False).astype(np.uint8),
                 b["sets"].to_numpy(zero_copy_only=False).astype(np.int64),
                 b["fold"].to_numpy(zero_copy_only=False).astype(np.int32),
                 b["rid"].to_numpy(zero_copy_only=False).astype(np.int64)]
        ids = pa.ListArray.from_arrays(pa.array([0, b.num_rows], pa.int32()), b["id"].cast(pa.string()))
        yield pa.RecordBatch.from_arrays([*[pa.array([c.tobytes()], pa.binary()) for c in cells], ids],
                                         ["code", "y", "sets", "fold", "rid", "ids"])


class Block:
    """Rows of the binned table as arrays."""

    def __init__(self, code, y, sets, fold, rid, ids):
        self.code, self.y, self.sets, self.fold, self.rid, self.ids = code, y, sets, fold, rid, ids

    @classmethod
    def read(cls, code, y, sets, fold, rid, ids) -> "Block":
        y = np.frombuffer(y, np.uint8)
        return cls(np.frombuffer(code, np.uint16).reshape(len(y), -1).astype(np.int32), y,
                   np.frombuffer(sets, np.int64), np.frombuffer(fold, np.int32),
                   np.frombuffer(rid, np.int64).view(np.uint64), list(ids))

    def written(self, job: int) -> pa.RecordBatch:
        """One row (job, ...) that :meth:`read` takes."""
        cells = [self.code.astype(np.uint16), self.y, self.sets, self.fold, self.rid]
        return pa.RecordBatch.from_arrays(
            [pa.array([job], pa.int32()), *[pa.array([c.tobytes()], pa.binary()) for c in cells],
             pa.array([self.ids], pa.list_(pa.string()))], ["job", "code", "y", "sets", "fold", "rid", "ids"])

    @classmethod
    def joined(cls, blocks: list["Block"]) -> "Block":
        parts = [np.concatenate([getattr(b, k) for b in blocks]) for k in ("code", "y", "sets", "fold", "rid")]
        return cls(*parts, [i for b in blocks for i in b.ids])

    def take(self, rows: np.ndarray) -> "Block":
        return Block(self.code[rows], self.y[rows], self.sets[rows], self.fold[rows], self.rid[rows],
                     [self.ids[i] for i in rows])

    def trains(self, job: BoostJob) -> np.ndarray:
        return (self.sets >> job.train_set) & 1 == 1

    def held(self, job: BoostJob) -> np.ndarray:
        return self.fold == (-2 if job.fold is None else job.fold)

    def drawn(self, job: BoostJob, tree: int) -> np.ndarray:
        """Training rows of a tree."""
        return drawn_rows(self.trains(job), self.rid, job, tree)


def drawn_rows(train: np.ndarray, rid: np.ndarray, job: BoostJob, tree: int) -> np.ndarray:
    if job.spec.subsample < 1.0:
        return train & (T.uniform(rid, job.spec.seed, tree, 2) < job.spec.subsample)
    return train


def weights_and_start(job: BoostJob, counts: list[tuple[int, int]]) -> tuple[np.ndarray, float]:
    """Weight of label 0 and 1, and the margin that boosting starts from."""
    n0, n1 = counts[job.train_set]
    w = np.array([1.0, 1.0 if job.spec.pos_weight is None else job.spec.pos_weight])
    if job.spec.pos_weight is None and n0 and n1:
        w = np.array([(n0 + n1) / (2.0 * n0), (n0 + n1) / (2.0 * n1)])
    start = float(np.log(w[1] * n1 / (w[0] * n0))) if job.spec.from_prior and n0 and n1 else 0.0
    return w, start


# --- one slice: a task per job ---------------------------------------------------

def fit_alone(block: Block, job: BoostJob, counts, layout: T.Layout) -> tuple[T.TreeEnsemble, np.ndarray]:
    """All rounds of one job over rows that one task holds; also their margins."""
    return fit_rows(T.PackedCode(block.code, layout), block.y, block.trains(job), block.rid, job, counts)


def fit_rows(packed: T.PackedCode, y, train, rid, job: BoostJob, counts) -> tuple[T.TreeEnsemble, np.ndarray]:
    spec, layout = job.spec, packed.layout
    weight, start = weights_and_start(job, counts)
    margin, w, y = np.full(len(y), start), weight[y], y.astype(float)
    trees = []
    for t in range(spec.rounds):
        use = drawn_rows(train, rid, job, t)
        g, h = T.gradients(margin, y, w)
        allowed = T.drawn_columns(spec, t, layout.n_features)
        grower, parents, at = T.Grower(spec), None, np.zeros(len(y), np.intp)
        while grower.counted:
            packed.step(at, *grower.arrays())
            slot = grower.slots().take(at)
            live = np.flatnonzero(use & (slot >= 0))
            hist = packed.sums(live, slot[live], g, h, len(grower.counted))
            if grower.pairs is not None:
                hist = T.siblings(parents, hist, grower.pairs)
            parents = hist
            grower.take(T.best_splits(hist, layout, range(layout.n_features), spec, allowed))
        tree = grower.finished()
        trees.append(tree)
        packed.step(at, *grower.arrays())
        margin += tree["value"][grower.places()].take(at)
    return T.TreeEnsemble.of(trees, layout, start), margin


def _alone(batches, jobs, counts, layout):
    parts: dict[int, list[tuple]] = {}
    kind = np.uint8 if max(np.diff(layout.starts), default=0) <= 256 else np.uint16
    for b in batches:
        for row in b.to_pylist():
            code = np.frombuffer(row["code"], kind).reshape(layout.n_features, -1)
            bits = np.frombuffer(row["bits"], np.uint8)
            parts.setdefault(row["job"], []).append((code, bits, np.frombuffer(row["rid"], np.uint64), row["ids"]))
    for at in list(parts):
        blocks = parts.pop(at)
        code, bits, rid = (np.concatenate([b[i] for b in blocks], axis=-1) for i in range(3))
        ids = [i for b in blocks for i in b[3]]
        del blocks
        y = bits & 1
        model, margin = fit_rows(T.PackedCode.of_columns(code, layout), y, bits & 2 > 0, rid, jobs[at], counts)
        held = np.flatnonzero(bits & 4)
        yield pa.RecordBatch.from_arrays(
            [pa.array([at], pa.int32()), pa.array([model.to_bytes()], pa.binary()), pa.array([ids], pa.list_(pa.string())),
             pa.array([y[held]], pa.list_(pa.int32())), pa.array([margin[held]], pa.list_(pa.float64()))],
            ["job", "model", "ids", "labels", "margins"])


def _dealt(batches, jobs: dict[int, BoostJob], layout: T.Layout, places: list[int]):
    """The rows that each job trains on or scores: local codes by column, bits (label, trained on, held out) and ids
    of the held-out ones."""
    for b in batches:
        for row in b.to_pylist():
            block = Block.read(**row)
            local = np.ascontiguousarray(T.local_codes(block.code, layout).T)
            for j, job in jobs.items():
                train, held = block.trains(job), block.held(job)
                own = np.flatnonzero(train | held)
                if not len(own):
                    continue
                bits = block.y | train.astype(np.uint8) << 1 | held.astype(np.uint8) << 2
                yield pa.RecordBatch.from_arrays(
                    [pa.array([j], pa.int32()), pa.array([places[j]], pa.int32()),
                     pa.array([local[:, own].tobytes()], pa.binary()), pa.array([bits[own].tobytes()], pa.binary()),
                     pa.array([block.rid[own].tobytes()], pa.binary()),
                     pa.array([[block.ids[i] for i in np.flatnonzero(held)]], pa.list_(pa.string()))],
                    ["job", "place", "code", "bits", "rid", "ids"])


def rows_of(table: BinnedTable, jobs: dict[int, BoostJob], train: bool = True, held: bool = True) -> DataFrame:
    """Blocks (job, ...) of the rows that each job trains on or that are held out for it."""
    ship_package(table.blocks.sparkSession)

    def cut(batches):
        for b in batches:
            for row in b.to_pylist():
                block = Block.read(**row)
                for j, job in jobs.items():
                    own = np.zeros(len(block.y), bool)
                    if train:
                        own |= block.trains(job)
                    if held:
                        own |= block.held(job)
                    if own.any():
                        yield block.take(np.flatnonzero(own)).written(j)

    return table.blocks.mapInArrow(cut, "job int, " + BLOCK)


def _fit_in_tasks(table: BinnedTable, jobs: list[BoostJob]):
    ship_package(table.blocks.sparkSession)
    costly = sorted(range(len(jobs)), key=lambda i: -jobs[i].spec.rounds * jobs[i].spec.max_depth)
    place = [0] * len(jobs)
    for at, i in enumerate(costly):  # the longest first
        place[i] = at
    dealt = table.blocks.mapInArrow(
        partial(_dealt, jobs=dict(enumerate(jobs)), layout=table.layout, places=place),
        "job int, place int, code binary, bits binary, rid binary, ids array<string>") \
        .repartitionById(len(jobs), "place").drop("place")
    done = checkpointed(dealt.mapInArrow(partial(_alone, jobs=jobs, counts=table.counts, layout=table.layout),
                                         "job int, model binary, ids array<string>, labels array<int>, "
                                         "margins array<double>"))
    models = {r["job"]: T.TreeEnsemble.from_bytes(r["model"]) for r in done.select("job", "model").collect()}
    scores = done.select("job", F.explode(F.arrays_zip("ids", "labels", "margins")).alias("z")) \
        .select("job", F.col("z.ids").alias("id"), F.col("z.labels").alias("label"), F.col("z.margins").alias("margin"))
    empty = [T.TreeEnsemble.of([], table.layout, weights_and_start(j, table.counts)[1]) for j in jobs]
    return [models.get(i, empty[i]) for i in range(len(jobs))], scores


# --- several slices: a job per level -----------------------------------------------

def _ranges(n_features: int, parts: int) -> list[range]:
    cuts = np.linspace(0, n_features, min(parts, n_features) + 1).astype(int)
    return [range(a, b) for a, b in zip(cuts, cuts[1:]) if b > a]


def _grown(pair, trees, layout):
    """Margins of a block after one more tree per job."""
    block, margin = pair
    feature, out = layout.feature_of(), margin.copy()
    for j, tree in trees.items():
        out[j] += tree["value"][T.walk(block.code, tree["bin"], tree["left"], feature)]
    return out


def _counted(pairs, jobs, weights, plans, tree, layout, ranges):
    """Summed histograms of a task's blocks: ((job, range), array of 3 x nodes x bins)."""
    feature, total = layout.feature_of(), {}
    for block, margin in pairs:
        for j, (bins, left, slots, n) in plans.items():
            use = block.drawn(jobs[j], tree)
            at = slots[T.walk(block.code, bins, left, feature)]
            rows = np.flatnonzero(use & (at >= 0))
            g, h = T.gradients(margin[j][rows], block.y[rows].astype(float), weights[j][block.y[rows]])
            hist = T.histograms(block.code[rows], at[rows], g, h, n, layout.width, layout)
            total[j] = hist if j not in total else total[j] + hist
    for j, hist in total.items():
        for i, r in enumerate(ranges):
            yield (j, i), hist[:, :, layout.starts[r.start]:layout.starts[r.stop]]


def _added(items):
    total = {}
    for key, hist in items:
        total[key] = hist if key not in total else total[key] + hist
    yield total


def _level(pair, plans):
    """The level's histograms: what was counted, and siblings from the parents'."""
    counted, parents = pair
    return {k: v if plans[k[0]] is None else T.siblings(parents[k], v, plans[k[0]]) for k, v in counted.items()}


def _splits(level, jobs, allowed, layout, ranges):
    return [(k, T.best_splits(v, layout, ranges[k[1]], jobs[k[0]].spec, allowed[k[0]])) for k, v in level.items()]


def _fit_over_slices(table: BinnedTable, jobs: list[BoostJob]):
    spark = table.blocks.sparkSession
    sc, layout = spark.sparkContext, table.layout
    ensure_checkpoint_dir(spark)
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranges = _ranges(layout.n_features, max(1, parts // len(jobs)))
    keep = StorageLevel.MEMORY_AND_DISK
    blocks = table.blocks.rdd.map(lambda r: Block.read(*r)).persist(keep)
    known = [weights_and_start(j, table.counts) for j in jobs]
    weights, starts = [w for w, _ in known], np.array([s for _, s in known])
    margins = blocks.map(lambda b: np.repeat(starts[:, None], len(b.y), axis=1)).persist(keep)
    fitted: list[list[dict]] = [[] for _ in jobs]
    dealt = _by_key(len(ranges))
    for t in range(max(j.spec.rounds for j in jobs)):
        live = [i for i, j in enumerate(jobs) if j.spec.rounds > t]
        growers = {i: T.Grower(jobs[i].spec) for i in live}
        allowed = {i: T.drawn_columns(jobs[i].spec, t, layout.n_features) for i in live}
        parents = None
        while plans := {i: (*g.arrays(), g.slots(), len(g.counted)) for i, g in growers.items() if g.counted}:
            pairs = {i: growers[i].pairs for i in plans}
            counted = blocks.zip(margins).mapPartitions(
                partial(_counted, jobs=jobs, weights=weights, plans=plans, tree=t, layout=layout, ranges=ranges)) \
                .partitionBy(parts, dealt).mapPartitions(_added)
            joined = counted.map(lambda c: (c, {})) if parents is None else counted.zip(parents)
            level = joined.map(partial(_level, plans=pairs)).persist(keep)
            found = level.flatMap(partial(_splits, jobs=jobs, allowed=allowed, layout=layout, ranges=ranges)).collect()
            if parents is not None:
                parents.unpersist()
            parents = level
            best: dict[int, list] = {}
            for (i, _), splits in sorted(found, key=lambda f: f[0]):
                best.setdefault(i, []).append(splits)
            for i in plans:
                if i not in best:  # a training set without rows
                    best[i] = [np.tile([-np.inf, 0, 0, 0, 0, 0, 0, 0], (len(growers[i].level), 1))]
                growers[i].take(T.merged_splits(best[i]))
        if parents is not None:
            parents.unpersist()
        trees = {i: g.finished() for i, g in growers.items()}
        for i, tree in trees.items():
            fitted[i].append(tree)
        after = blocks.zip(margins).map(partial(_grown, trees=trees, layout=layout)).persist(keep)
        if (t + 1) % CHECKPOINT_ROUNDS == 0:
            after.checkpoint()
        after.count()
        margins.unpersist()
        margins = after
    models = [T.TreeEnsemble.of(f, layout, s) for f, s in zip(fitted, starts)]

    def held(pair):
        block, margin = pair
        for i, job in enumerate(jobs):
            for r in np.flatnonzero(block.held(job)):
                yield i, block.ids[r], int(block.y[r]), float(margin[i][r])

    scores = checkpointed(spark.createDataFrame(blocks.zip(margins).flatMap(held), SCORES))
    margins.unpersist()
    blocks.unpersist()
    return models, scores


def _by_key(n_ranges: int):
    return lambda key: key[0] * n_ranges + key[1]


def fit_boosted(table: BinnedTable, jobs: list[BoostJob],
                slice_rows: int = SLICE_ROWS) -> tuple[list[T.TreeEnsemble], DataFrame]:
    """Models of the jobs, in order, and (job, id, label, margin) of their held-out rows."""
    if not jobs:
        return [], table.blocks.sparkSession.createDataFrame([], SCORES)
    largest = max(sum(table.counts[j.train_set]) for j in jobs)
    return _fit_in_tasks(table, jobs) if largest <= slice_rows else _fit_over_slices(table, jobs)


@dataclass
class AppliedModel:
    """Scores a ``features`` vector with a fitted model of trees."""

    name: str
    model: object  # TreeEnsemble or Forest

    def _applied(self, df: DataFrame, out: str, method: str, kind: str) -> DataFrame:
        ship_package(df.sparkSession)
        sent, kind_of = df.sparkSession.sparkContext.broadcast(self.model.to_bytes()), type(self.model)

        @F.pandas_udf(kind)
        def apply(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            model = kind_of.from_bytes(sent.value)
            for x in batches:
                yield pd.Series(list(getattr(model, method)(np.stack(x.to_numpy()))) if len(x) else [], dtype=object)

        return df.withColumn(out, apply(vector_to_array("features", "float64")))

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        return self._applied(df, out, "probabilities", "double")

    @property
    def has_importance(self) -> bool:
        return True


class BoostedScoreModel(AppliedModel):
    """Scores and explains a ``features`` vector with a fitted tree ensemble."""

    def attributions(self, df: DataFrame, out: str = "attributions") -> DataFrame:
        """Exact path-dependent Shapley values of the margin, one per feature."""
        return self._applied(df, out, "attributions", "array<double>")
