"""Random forests over the binned table of :mod:`.boosting`.

Where a training set fits a slice, each task gets the rows of one set and grows its
share of that forest's trees. Larger sets are cut first: as long as a tree has nodes of
more drawn rows than a slice, tasks count these nodes' drawn features, an exchange by
tree adds the counts up, and each node's best split, a row, goes to the driver. Then the rows
that a tree draws meet by (tree, node) and tasks grow the subtrees, some trees at a time,
so that the exchange stays bounded. Both ways give the same trees to the last bit
(:mod:`..functions.forests`); ``tests/test_forests.py`` holds them against each other.

A forest of t trees of depth d has at most t * 2^(d + 1) nodes, however many rows there
are; one forest at a time goes to the driver.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import forests as R
from ..functions.trees import Layout
from ..params import ForestParams
from ..session import checkpointed, ship_package
from .boosting import SLICE_ROWS, AppliedModel, BinnedTable, Block, rows_of

PARTS = "job int, tree int, part binary"
SCORES = "job int, id string, label int, score double"
#: Bytes of drawn rows that are exchanged at once, about, and that meet in a partition.
EXCHANGED, MET = 2 << 30, 64 << 20
#: Share of the rows that a tree draws once at least.
DRAWN = 0.64


@dataclass(frozen=True)
class ForestJob:
    spec: R.ForestSpec
    train_set: int = 0
    fold: int | None = None  # rows with this fold are scored
    balanced: bool = False   # both classes weigh alike


def forest_spec(p: ForestParams) -> R.ForestSpec:
    return R.ForestSpec(p.num_trees, p.max_depth, p.min_instances_per_node, p.feature_subset, p.seed)


def class_weights(job: ForestJob, counts: list[tuple[int, int]]) -> np.ndarray:
    n = np.array(counts[job.train_set], float)
    return n.sum() / (2.0 * n) if job.balanced and n.all() else np.ones(2)


def _read(row: dict, layout: Layout) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    y = np.frombuffer(row["y"], np.uint8)
    code = np.frombuffer(row["code"], np.uint16).reshape(len(y), -1)
    return R.local_codes(code, layout), y, np.frombuffer(row["sets"], np.int64), \
        np.frombuffer(row["rid"], np.int64).view(np.uint64)


def _table(rows: list[tuple], names: list[str], kinds: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


_PART = (["job", "tree", "part"], [pa.int32(), pa.int32(), pa.binary()])


# --- a training set that fits a slice: some trees a task -------------------------------

def _trained(batches: Iterator[pa.RecordBatch], jobs, layout) -> Iterator[pa.RecordBatch]:
    """The rows of each job's training set, as classed codes."""
    for b in batches:
        for row in b.to_pylist():
            code, y, sets, rid = _read(row, layout)
            both = R.classed(code, y, layout)
            for j, job in jobs.items():
                own = np.flatnonzero((sets >> job.train_set) & 1)
                if len(own):
                    yield _table([(j, both[own].tobytes(), rid[own].tobytes())], ["job", "code", "rid"],
                                 [pa.int32(), pa.binary(), pa.binary()])


def _shares(batches: Iterator[pa.RecordBatch], jobs, counts, layout, groups) -> Iterator[pa.RecordBatch]:
    held: dict[tuple[int, int], list] = {}
    none = np.zeros((0, layout.n_features), np.uint8)
    kind = R.classed(none, np.zeros(0, np.uint8), layout).dtype
    for b in batches:
        for row in b.to_pylist():
            code = np.frombuffer(row["code"], kind).reshape(-1, layout.n_features)
            held.setdefault((row["job"], row["share"]), []).append((code, np.frombuffer(row["rid"], np.uint64)))
    for j, g in list(held):
        both, rid = (np.concatenate(c) for c in zip(*held.pop((j, g))))
        for t in range(g, jobs[j].spec.trees, groups[j]):
            yield _table([(j, t, R.packed(_tree(both, rid, t, jobs[j], counts, layout)))], *_PART)


def _tree(both, rid, t, job, counts, layout) -> dict[str, np.ndarray]:
    times = R.row_draws(rid, job.spec, t)
    rows = np.flatnonzero(times)
    return R.grow_rows(both, rows, times[rows], 1, t, job.spec, layout, class_weights(job, counts))


def _fit_in_tasks(table: BinnedTable, jobs: dict[int, ForestJob]) -> DataFrame:
    cores = table.blocks.sparkSession.sparkContext.defaultParallelism
    groups = {j: max(1, min(job.spec.trees, -(-2 * cores // len(jobs)))) for j, job in jobs.items()}
    units = [(j, g) for j in jobs for g in range(groups[j])]
    of_job = F.explode(F.array(*[F.struct(F.lit(j).alias("j"), F.lit(g).alias("share"), F.lit(i).alias("place"))
                                 for i, (j, g) in enumerate(units)]))
    dealt = table.blocks.select("code", "y", "sets", "rid") \
        .mapInArrow(partial(_trained, jobs=jobs, layout=table.layout), "job int, code binary, rid binary") \
        .select("*", of_job.alias("to")).where("job = to.j").select("job", "code", "rid", "to.share", "to.place") \
        .repartitionById(len(units), "place").drop("place")
    return dealt.mapInArrow(partial(_shares, jobs=jobs, counts=table.counts, layout=table.layout, groups=groups), PARTS)


# --- larger training sets: the upper nodes counted, then subtrees -----------------------

def _counted(batches, plans, jobs, layout) -> Iterator[pa.RecordBatch]:
    """Counts (job, tree, hist) of the open nodes' drawn features over a task's rows."""
    widths, total = np.diff(layout.starts), {}
    for b in batches:
        for row in b.to_pylist():
            code, y, sets, rid = _read(row, layout)
            for (j, t), (heap, bins, opened) in plans.items():
                times = R.row_draws(rid, jobs[j].spec, t) * ((sets >> jobs[j].train_set) & 1)
                rows = np.flatnonzero(times)
                at = R.routed(code[rows], heap, bins, layout)
                k = np.minimum(np.searchsorted(opened, at), len(opened) - 1)
                inside = opened[k] == at
                rows, k = rows[inside], k[inside]
                feats = R.feature_draws(opened, jobs[j].spec, t, layout.n_features)
                hist = R.counts(code[rows], y[rows].astype(np.int64), times[rows], k, feats, widths)
                total[j, t] = hist if (j, t) not in total else total[j, t] + hist
    for (j, t), hist in total.items():
        yield _table([(j, t, hist.tobytes())], ["job", "tree", "hist"], _PART[1])


_FOUND = "job int, tree int, heap long, gain double, bin long, l0 double, l1 double, n0 double, n1 double"


def _found(batches, plans, jobs, counts, layout) -> Iterator[pa.RecordBatch]:
    """The best split of each open node, its counts added up."""
    total: dict[tuple[int, int], np.ndarray] = {}
    for b in batches:
        for row in b.to_pylist():
            key, hist = (row["job"], row["tree"]), np.frombuffer(row["hist"])
            total[key] = total[key] + hist if key in total else hist
    for (j, t), hist in total.items():
        opened, job = plans[j, t][2], jobs[j]
        feats = R.feature_draws(opened, job.spec, t, layout.n_features)
        gain, bins, left, n = R.best_splits(hist.reshape(-1, 2), feats, layout, class_weights(job, counts),
                                            job.spec.min_rows)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.full(len(opened), j), pa.int32()), pa.array(np.full(len(opened), t), pa.int32()),
             *[pa.array(c) for c in (opened, gain, bins, left[:, 0], left[:, 1], n[:, 0], n[:, 1])]],
            [c.split()[0] for c in _FOUND.split(", ")])


@dataclass
class _Top:
    """The upper nodes of one tree: splits and leaves found, nodes that tasks go on from."""

    splits: list   # (heap, bin, value, gain)
    leaves: list   # (heap, -1, value, 0)
    opened: list   # heap numbers to be counted next
    rest: list     # heap numbers whose subtrees are grown from their rows

    def plan(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        s = sorted(self.splits)
        return np.array([n[0] for n in s], np.int64), np.array([n[1] for n in s], np.int64), \
            np.array(sorted(self.opened), np.int64)

    def part(self) -> dict[str, np.ndarray]:
        cols = list(zip(*(self.splits + self.leaves)))
        kinds = {"heap": np.int32, "bin": np.int32, "value": float, "gain": float}
        return {k: np.array(c, kind) for (k, kind), c in zip(kinds.items(), cols)}


def _tops(blocks: DataFrame, table: BinnedTable, jobs: dict[int, ForestJob], slice_rows: int) -> dict:
    layout, counts, parts = table.layout, table.counts, blocks.sparkSession.sparkContext.defaultParallelism
    tops = {(j, t): _Top([], [], [1], []) for j, job in jobs.items()
            for t in range(job.spec.trees)}
    while plans := {k: top.plan() for k, top in tops.items() if top.opened}:
        found = blocks.mapInArrow(partial(_counted, plans=plans, jobs=jobs, layout=layout),
                                  "job int, tree int, hist binary") \
            .repartition(parts, "job", "tree") \
            .mapInArrow(partial(_found, plans=plans, jobs=jobs, counts=counts, layout=layout), _FOUND).collect()
        for k in plans:
            tops[k].opened = []
        for r in found:  # a row per open node
            top, spec, weight = tops[r.job, r.tree], jobs[r.job].spec, class_weights(jobs[r.job], counts)
            n, left = np.array([r.n0, r.n1]), np.array([r.l0, r.l1])
            value = float(R.share(n[None], weight)[0])
            if r.bin < 0 or not R.may_split(np.array([r.heap]), n[None], spec)[0]:
                top.leaves.append((r.heap, -1, value, 0.0))
                continue
            top.splits.append((r.heap, r.bin, value, r.gain))
            for heap, own in ((2 * r.heap, left), (2 * r.heap + 1, n - left)):
                (top.opened if own.sum() > slice_rows else top.rest).append(heap)
    return tops


_UNIT = (["job", "tree", "heap", "code", "y", "times"],
         [pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary()])


def _drawn(batches, plans, jobs, layout) -> Iterator[pa.RecordBatch]:
    """The rows that trees draw, by the node whose subtree they belong to."""
    for b in batches:
        for row in b.to_pylist():
            code, y, sets, rid = _read(row, layout)
            for (j, t), (heap, bins, rest) in plans.items():
                times = R.row_draws(rid, jobs[j].spec, t) * ((sets >> jobs[j].train_set) & 1)
                rows = np.flatnonzero(times)
                at = R.routed(code[rows], heap, bins, layout)
                order = np.argsort(at, kind="stable")
                rows, at = rows[order], at[order]
                out = []
                for h in rest:
                    a, e = np.searchsorted(at, [h, h + 1])
                    if e > a:
                        own = rows[a:e]
                        out.append((j, t, h, code[own].tobytes(), y[own].tobytes(), times[own].astype(np.uint8).tobytes()))
                if out:
                    yield _table(out, *_UNIT)


def _subtrees(batches, jobs, counts, layout) -> Iterator[pa.RecordBatch]:
    kind = np.uint8 if max(np.diff(layout.starts), default=0) <= 256 else np.uint16
    key, held = None, []

    def grown():
        y, times = (np.frombuffer(b"".join(c), np.uint8) for c in list(zip(*held))[1:])
        code = np.frombuffer(b"".join(h[0] for h in held), kind).reshape(len(y), -1)
        j, t, heap = key
        part = R.grow(code, y, times, heap, t, jobs[j].spec, layout, class_weights(jobs[j], counts))
        return _table([(j, t, R.packed(part))], *_PART)

    for b in batches:
        for row in b.to_pylist():
            own = (row["job"], row["tree"], row["heap"])
            if own != key and held:
                yield grown()
                held = []
            key = own
            held.append((row["code"], row["y"], row["times"]))
    if held:
        yield grown()


def _fit_in_subtrees(table: BinnedTable, jobs: dict[int, ForestJob], slice_rows: int) -> list[DataFrame]:
    spark, layout = table.blocks.sparkSession, table.layout
    cores = spark.sparkContext.defaultParallelism
    blocks = checkpointed(table.blocks.select("code", "y", "sets", "rid").repartition(2 * cores))
    tops = _tops(blocks, table, jobs, slice_rows)
    rows = [(j, t, bytearray(R.packed(top.part()))) for (j, t), top in tops.items()]
    out = [spark.createDataFrame(rows, PARTS)]
    row_bytes = layout.n_features + 2
    a_tree = {j: int(DRAWN * sum(table.counts[job.train_set]) * row_bytes) + 1 for j, job in jobs.items()}
    units = [(k, (*top.plan()[:2], sorted(top.rest))) for k, top in tops.items() if top.rest]
    while units:
        batch, size = {}, 0
        while units and (not batch or size + a_tree[units[0][0][0]] <= EXCHANGED):
            k, plan = units.pop(0)
            batch[k], size = plan, size + a_tree[k[0]]
        parts = max(2 * cores, -(-size // MET))
        keys = ["job", "tree", "heap"]
        out.append(checkpointed(
            blocks.mapInArrow(partial(_drawn, plans=batch, jobs=jobs, layout=layout),
                              "job int, tree int, heap long, code binary, y binary, times binary")
            .repartition(parts, *keys).sortWithinPartitions(*keys)
            .mapInArrow(partial(_subtrees, jobs=jobs, counts=table.counts, layout=layout), PARTS)))
    return out


# --- fits -------------------------------------------------------------------------------

def _parts(table: BinnedTable, jobs: dict[int, ForestJob], slice_rows: int) -> list[DataFrame]:
    """Parts (job, tree, part) of all trees."""
    ship_package(table.blocks.sparkSession)
    large = {j: job for j, job in jobs.items() if sum(table.counts[job.train_set]) > slice_rows}
    small = {j: job for j, job in jobs.items() if j not in large and sum(table.counts[job.train_set])}
    out = [checkpointed(_fit_in_tasks(table, small))] if small else []
    for j, job in large.items():
        out += _fit_in_subtrees(table, {j: job}, slice_rows)
    return out


def _forest(parts: list[DataFrame], j: int, layout: Layout) -> R.Forest:
    trees: dict[int, list] = {}
    for df in parts:
        for r in df.where(F.col("job") == j).select("tree", "part").collect():
            trees.setdefault(r.tree, []).append(R.unpacked(r.part))
    return R.Forest.of([R.joined(trees[t]) for t in sorted(trees)], layout)


def fit_forest(table: BinnedTable, job: ForestJob, slice_rows: int = SLICE_ROWS) -> R.Forest:
    return _forest(_parts(table, {0: job}, slice_rows), 0, table.layout)


def held_out_scores(table: BinnedTable, jobs: list[ForestJob], slice_rows: int = SLICE_ROWS) -> DataFrame:
    """(job, id, label, score) of the rows that each job's forest is held against."""
    spark, layout = table.blocks.sparkSession, table.layout
    parts = _parts(table, dict(enumerate(jobs)), slice_rows)
    cores = spark.sparkContext.defaultParallelism
    out = spark.createDataFrame([], SCORES)
    for j, job in enumerate(jobs):
        sent = spark.sparkContext.broadcast(_forest(parts, j, layout).to_bytes())

        def scored(batches, j=j, job=job, sent=sent):
            forest = R.Forest.from_bytes(sent.value)
            for b in batches:
                for row in b.to_pylist():
                    row.pop("job")
                    block = Block.read(**row)
                    held = np.flatnonzero(block.held(job))
                    if len(held):
                        block = block.take(held)
                        p = forest.of_codes(R.local_codes(block.code, layout))
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(np.full(len(p), j), pa.int32()), pa.array(block.ids, pa.string()),
                             pa.array(block.y, pa.int32()), pa.array(p)], ["job", "id", "label", "score"])

        own = rows_of(table, {j: job}, train=False).repartition(cores)
        out = out.unionByName(checkpointed(own.mapInArrow(scored, SCORES)))
        sent.unpersist()
    return out


class ForestScoreModel(AppliedModel):
    """Scores a ``features`` vector with a fitted forest."""
