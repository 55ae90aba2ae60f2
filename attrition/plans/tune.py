"""Cross-validation and the hyper-parameter search of the boosted trees.

Folds come from a hash of the row id, so they are stable across runs and
partitionings. When SMOTE is the imbalance method it is applied inside each
training fold only, in the search as in cross-validation, never to the held-out fold.
``resample_before_cv=True`` reproduces the leaking order for comparison.

The search is an adaptive (tree-structured Parzen) sampler over the ranges of second-order
boosting: after some uniform draws, each parameter gets one density over the
good trials and one over the rest, and candidates from the good density are
taken by the ratio of the two. Trials come in batches; a batch's trials and folds are
fitted in one pass over one binned table, and its AUCs come from one
aggregate. Every finished batch is committed to a :class:`TrialStore`, so an
interrupted search goes on after the last committed batch with the same
draws.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as ST

from ..functions.trees import BoostSpec
from ..operators.metrics import auc_avg_precision
from ..params import Params
from ..session import checkpointed
from . import boosting
from .ensemble import cross_fit, fold_trains


def cv_tables(oof: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Per-fold AUC (model, fold, auc) and summary (model, auc_mean, auc_std) of out-of-fold scores."""
    per_fold = checkpointed(auc_avg_precision(oof, "churn", "score", ["model", "fold"]).select(
        "model", "fold", F.col("auc_roc").alias("auc")))
    summary = per_fold.groupBy("model").agg(F.avg("auc").alias("auc_mean"), F.stddev_pop("auc").alias("auc_std"))
    return per_fold, summary


def cross_validate(train: DataFrame, names: list[str], params: Params = Params(),
                   k: int | None = None, parallelism: int = 4,
                   resample_before_cv: bool = False) -> tuple[DataFrame, DataFrame]:
    """:func:`cv_tables` of ``train``, the prepared, not yet resampled, train side."""
    return cv_tables(cross_fit(train, names, params, k or params.cv_folds, parallelism, resample_before_cv))


# Search ranges (log = sampled on a log scale). Fixed values.
SEARCH_SPACE = {
    "rounds": (100, 600, "int"),
    "step": (0.01, 0.3, "log"),
    "max_depth": (4, 10, "int"),
    "min_child_weight": (1, 10, "int"),
    "subsample": (0.5, 1.0, "float"),
    "colsample": (0.5, 1.0, "float"),
    "min_gain": (0.0, 5.0, "float"),
    "l1": (1e-5, 10.0, "log"),
    "l2": (1e-5, 10.0, "log"),
    "pos_weight": (1.0, 6.0, "float"),
}


def search_space(params: Params = Params()) -> dict[str, tuple]:
    """The ranges; the positive weight is left out where SMOTE corrects the classes already."""
    out = dict(SEARCH_SPACE, rounds=(*params.tune.rounds_range, "int"))
    if params.imbalance.method == "smote":
        del out["pos_weight"]
    return out


@dataclass(frozen=True)
class ParzenSampler:
    """Draws trials: uniform at first, then by the ratio of two Parzen densities."""

    space: dict[str, tuple]
    seed: int = 42
    startup: int = 10
    good_share: float = 0.2
    candidates: int = 32

    def value(self, name: str, u: float) -> float:
        """A parameter from its place in [0, 1)."""
        low, high, kind = self.space[name]
        if kind == "int":
            return float(min(int(high), int(low) + int(u * (int(high) - int(low) + 1))))
        if kind == "log":
            return math.exp(math.log(low) + u * (math.log(high) - math.log(low)))
        return low + u * (high - low)

    def place(self, name: str, value: float) -> float:
        low, high, kind = self.space[name]
        if kind == "int":
            return (value - low + 0.5) / (high - low + 1)
        if kind == "log":
            return (math.log(value) - math.log(low)) / (math.log(high) - math.log(low))
        return (value - low) / (high - low)

    def ask(self, history: list[tuple[dict[str, float], float]], n: int) -> list[dict[str, float]]:
        """``n`` new trials given (parameters, value to maximise) so far; the same history gives the same draws."""
        names = list(self.space)
        rng = np.random.default_rng([self.seed, len(history)])
        if len(history) < self.startup:
            return [{k: self.value(k, rng.random()) for k in names} for _ in range(n)]
        order = sorted(range(len(history)), key=lambda i: (-history[i][1], i))
        places = np.array([[self.place(k, history[i][0][k]) for k in names] for i in order])
        n_good = max(2, math.ceil(self.good_share * len(history)))
        good, rest = places[:n_good], places[n_good:]
        out = []
        for _ in range(n):
            drawn = np.column_stack([self._draw(good[:, j], rng) for j in range(len(names))])
            ratio = sum(self._log_density(good[:, j], drawn[:, j]) - self._log_density(rest[:, j], drawn[:, j])
                        for j in range(len(names)))
            best = drawn[int(np.argmax(ratio))]
            rest = np.vstack([rest, best])  # the batch's next trial looks elsewhere
            out.append({k: self.value(k, float(u)) for k, u in zip(names, best)})
        return out

    @staticmethod
    def _kernels(points: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Centres and widths: the points, as wide as their gaps, and one broad kernel for the rest."""
        at = np.sort(points)
        gaps = np.diff(np.concatenate([[0.0], at, [1.0]]))
        least = 1.0 / min(100, len(at) + 2)
        widths = np.clip(np.maximum(gaps[:-1], gaps[1:]), least, 1.0)
        return np.append(at, 0.5), np.append(widths, 1.0)

    def _draw(self, points: np.ndarray, rng) -> np.ndarray:
        centres, widths = self._kernels(points)
        which = rng.integers(0, len(centres), self.candidates)
        u = rng.normal(centres[which], widths[which])
        u = np.abs(u) % 2.0  # reflected at both ends
        return np.clip(np.where(u > 1.0, 2.0 - u, u), 0.0, 1.0 - 1e-9)

    def _log_density(self, points: np.ndarray, at: np.ndarray) -> np.ndarray:
        centres, widths = self._kernels(points)
        z = (at[:, None] - centres[None]) / widths[None]
        return np.log((np.exp(-0.5 * z * z) / widths[None]).mean(axis=1) + 1e-12)


TRIALS = ST.StructType([
    ST.StructField("trial", ST.IntegerType()), ST.StructField("params", ST.MapType(ST.StringType(), ST.DoubleType())),
    ST.StructField("auc_mean", ST.DoubleType()), ST.StructField("auc_std", ST.DoubleType())])


class TrialStore:
    """Append-only trial table in a shared folder: a folder per batch, valid
    once Spark's writer has left its commit marker there. A batch without a
    marker is an interrupted one and is written anew."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def _batch(self, n: int) -> str:
        return f"{self.path}/batch-{n:05d}"

    def committed(self) -> list[str]:
        """The batches up to the first that isn't committed."""
        jvm, out = self.spark.sparkContext._jvm, []
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        while True:
            marker = jvm.org.apache.hadoop.fs.Path(f"{self._batch(len(out))}/_SUCCESS")
            if not marker.getFileSystem(conf).exists(marker):
                return out
            out.append(self._batch(len(out)))

    def append(self, rows: list[tuple]) -> None:
        self.spark.createDataFrame(rows, TRIALS).coalesce(1).write.mode("overwrite").parquet(
            self._batch(len(self.committed())))

    def table(self) -> DataFrame:
        done = self.committed()
        return self.spark.read.schema(TRIALS).parquet(*done) if done else self.spark.createDataFrame([], TRIALS)

    def rows(self) -> list[tuple]:
        """A row per trial, in order."""
        return sorted((r["trial"], dict(r["params"]), r["auc_mean"], r["auc_std"]) for r in self.table().collect())


def trial_spec(t: dict[str, float], seed: int = 42) -> BoostSpec:
    return BoostSpec(rounds=int(t["rounds"]), step=t["step"], max_depth=int(t["max_depth"]), l1=t["l1"], l2=t["l2"],
                     min_gain=t["min_gain"], min_child_weight=t["min_child_weight"], subsample=t["subsample"],
                     colsample=t["colsample"], pos_weight=t.get("pos_weight", 1.0), seed=seed)


def search_key(params: Params) -> str:
    """Names a search's settings, so that a store is only resumed by the same search."""
    settings = repr((params.data, params.imbalance, replace(params.tune, n_trials=0), search_space(params)))
    return hashlib.sha256(settings.encode()).hexdigest()[:16]


def search(train: DataFrame, params: Params = Params(), store: TrialStore | None = None,
           parallelism: int = 4) -> DataFrame:
    """Trial table (trial, params, auc_mean, auc_std) of ``params.tune.n_trials`` trials.

    ``train`` is the prepared, not yet resampled, train side. Trials that
    ``store`` holds already are not fitted again.
    """
    spark, n_trials, k = train.sparkSession, params.tune.n_trials, params.tune.folds
    done = store.rows() if store else []
    sampler = ParzenSampler(search_space(params), params.tune.seed, params.tune.startup)
    table = fold_trains(train, k, params, "tune_fold", parallelism).table if len(done) < n_trials else None
    while len(done) < n_trials:
        room = params.tune.startup - len(done) if len(done) < params.tune.startup else params.tune.batch
        n = min(room, n_trials - len(done))
        asked = sampler.ask([(p, auc) for _, p, auc, _ in done], n)
        jobs = [boosting.BoostJob(trial_spec(t, params.data.seed), f, f) for t in asked for f in range(k)]
        scores = boosting.fit_boosted(table, jobs)[1].select(
            F.floor(F.col("job") / k).cast("int").alias("trial"), (F.col("job") % k).alias("fold"),
            F.col("label").alias("churn"), F.col("margin").alias("score"))
        per = auc_avg_precision(scores, "churn", "score", ["trial", "fold"]).groupBy("trial").agg(
            F.avg("auc_roc").alias("m"), F.stddev_pop("auc_roc").alias("s"))
        found = {r["trial"]: (float(r["m"]), float(r["s"])) for r in per.collect()}  # a row per trial
        rows = [(len(done) + i, t, *found[i]) for i, t in enumerate(asked)]
        if store:
            store.append(rows)
        done += rows
    return spark.createDataFrame(done[:n_trials], TRIALS)


def adaptive_search(train: DataFrame, train_fit: DataFrame, params: Params = Params(),
                    store: TrialStore | None = None, parallelism: int = 4):
    """The trial table and the best trial's model, refitted on all (resampled) rows."""
    trials = search(train, params, store, parallelism)
    if params.tune.n_trials <= 0:
        return trials, None
    best = trials.orderBy(F.col("auc_mean").desc(), "trial").first()
    job = boosting.BoostJob(trial_spec(best["params"], params.data.seed))
    return trials, boosting.BoostedScoreModel("tuned_gbt", boosting.fit_boosted(boosting.bin_table(train_fit), [job])[0][0])


def best_so_far(trials: DataFrame, value: str = "auc_mean") -> DataFrame:
    """Trial value and running best (a window over the small trial table)."""
    w = Window.orderBy("trial").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return trials.select("trial", value, F.max(value).over(w).alias("best_so_far"))
