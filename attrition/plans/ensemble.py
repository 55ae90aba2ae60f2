"""Score models and ensembles (soft voting, stacking).

A *score model* turns a frame with a ``features`` vector into the same frame
plus a class-1 probability column. MLlib models are wrapped as
:class:`MLScoreModel`; :class:`SoftVoteModel` averages several of them and
:class:`StackingModel` feeds their probabilities to a logistic meta model.
All of them are plain chains of ``transform`` calls (no join: every base
writes its own column on the same rows).

``cross_fit`` scores every training row once per base by a model that never
saw its fold. Folds are cut first and each training fold is resampled by
itself, so no synthetic row stands near a held-out one. All boosted models and forests of all
folds are fitted over one binned table; they and the logistic models run concurrently from a driver thread pool. Cross-validation reads its
AUCs from that table, and stacking pivots it to one row per id (one shuffle) for the
meta model; then every base is refit on all rows.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import reduce

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.forests import Forest
from ..functions.random import uniform
from ..params import Params
from ..functions.trees import TreeEnsemble
from ..operators.resample import smote_vectors, with_class_weights
from ..operators.split import exact_folds
from ..schema import ID_COL, TARGET
from ..session import checkpointed
from . import boosting, forests
from .models import BOOSTED, LABEL, boost_params, boost_spec, fit_base, fit_boosts, forest_job, prob1


def soft_vote_columns(cols: list[str]) -> Column:
    """Mean of class-1 probability columns (one per base model)."""
    return reduce(lambda a, b: a + b, [F.col(c) for c in cols]) / F.lit(float(len(cols)))


@dataclass
class MLScoreModel:
    name: str
    model: object  # fitted MLlib classification model

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        cols = df.columns
        pred = self.model.transform(df)
        return pred.select(*cols, prob1(F.col(self.model.getProbabilityCol())).alias(out))

    @property
    def has_importance(self) -> bool:
        return hasattr(self.model, "featureImportances")


def score_model(name: str, fitted):
    """The score model around a fitted classifier of either kind."""
    if isinstance(fitted, TreeEnsemble):
        return boosting.BoostedScoreModel(name, fitted)
    return forests.ForestScoreModel(name, fitted) if isinstance(fitted, Forest) else MLScoreModel(name, fitted)


@dataclass
class SoftVoteModel:
    name: str
    bases: list[MLScoreModel]

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        cur = df
        cols = []
        for i, b in enumerate(self.bases):
            c = f"__sv{i}"
            cur = b.score(cur, c)
            cols.append(c)
        return cur.withColumn(out, soft_vote_columns(cols)).drop(*cols)


@dataclass
class StackingModel:
    name: str
    bases: list[MLScoreModel]
    meta: object  # fitted LogisticRegressionModel on the base probabilities
    meta_inputs: list[str] = field(default_factory=list)

    def base_columns(self, df: DataFrame) -> DataFrame:
        cur = df
        for b, c in zip(self.bases, self.meta_inputs):
            cur = b.score(cur, c)
        return cur

    def score(self, df: DataFrame, out: str = "score") -> DataFrame:
        cols = df.columns
        cur = self.base_columns(df)
        cur = VectorAssembler(inputCols=self.meta_inputs, outputCol="__meta").transform(cur)
        pred = self.meta.transform(cur)
        return pred.select(*cols, prob1(F.col("probability")).alias(out))


def base_id(col: str = ID_COL) -> Column:
    """Id of the original row (synthetic SMOTE rows share their base row's fold)."""
    return F.split(F.col(col), "#s").getItem(0)


def with_folds(df: DataFrame, k: int, seed: int, name: str = "fold", stream: str = "fold") -> DataFrame:
    return df.withColumn(name, F.least(F.floor(uniform(base_id(), stream, seed) * F.lit(k)),
                                       F.lit(k - 1)).cast("int"))


def fit_many(tasks, parallelism: int = 4):
    """Run independent fit callables concurrently (each is a Spark job)."""
    if parallelism <= 1:
        return [t() for t in tasks]
    with ThreadPoolExecutor(max_workers=parallelism) as ex:
        futures = [ex.submit(t) for t in tasks]
        return [f.result() for f in futures]


def fit_bases(train_fit: DataFrame, names: list[str], params: Params = Params(),
              parallelism: int = 4) -> dict[str, MLScoreModel]:
    """Fitted bases by name; the boosted ones share one pass, and a binned table with the forest."""
    boosted = [n for n in names if n in BOOSTED]
    others = [n for n in names if n not in BOOSTED]
    table = boosting.bin_table(train_fit) if boosted or "random_forest" in others else None
    tasks = [lambda n=n: {n: fit_base(n, train_fit, params, table)} for n in others]
    fitted = reduce(lambda a, b: a | b, fit_many([lambda: fit_boosts(train_fit, boosted, params, table), *tasks],
                                                 parallelism))
    return {n: score_model(n, fitted[n]) for n in names}


def soft_vote(bases: dict[str, MLScoreModel], name: str = "soft_voting") -> SoftVoteModel:
    """Soft voting over already fitted bases (refitting clones gives the same models)."""
    return SoftVoteModel(name, list(bases.values()))


@dataclass
class FoldTrains:
    """Folds of the training rows, and what each fold's models are fitted on."""

    folded: DataFrame              # the rows that are scored, with ``fold``
    trains: dict[int, DataFrame]   # per fold, resampled if that is the correction
    table: boosting.BinnedTable    # all of them binned, training set f for fold f


def fold_trains(train: DataFrame, k: int, params: Params = Params(), stream: str = "fold", parallelism: int = 4,
                resample_before: bool = False) -> FoldTrains:
    """``resample_before`` resamples all rows before the folds are cut (leaks; for comparison)."""
    smote = params.imbalance.method == "smote"

    def resampled(df):
        return smote_vectors(df.drop("is_synthetic"), params.imbalance.k_neighbors, params.data.seed)

    rows = resampled(train) if smote and resample_before else train
    if params.data.exact and rows is train:
        folded = checkpointed(exact_folds(train, k, params.data.seed, stream=stream))
    else:
        folded = checkpointed(with_folds(rows, k, params.data.seed, "fold", stream))
    rest = {f: folded.where(F.col("fold") != f).drop("fold") for f in range(k)}
    columns = [ID_COL, LABEL, "features"]
    every = F.lit((1 << k) - 1).cast("long")
    binned = folded.select(*columns, every.bitwiseXOR(F.expr("shiftleft(1L, fold)")).alias("sets"),
                           "fold")
    if smote and not resample_before:  # built concurrently, materialised once each
        built = fit_many([lambda f=f: checkpointed(resampled(rest[f])) for f in range(k)], parallelism)
        rest = dict(enumerate(built))
        for f, df in rest.items():
            binned = binned.unionByName(df.where("is_synthetic").select(
                *columns, F.lit(1 << f).cast("long").alias("sets"), F.lit(-1).alias("fold")))
    return FoldTrains(folded, rest, boosting.bin_table(binned, k, F.col("sets"), F.col("fold")))


def cross_fit(train: DataFrame, names: list[str], params: Params = Params(), k: int = 5, parallelism: int = 4,
              resample_before: bool = False) -> DataFrame:
    """Out-of-fold scores (id, churn, label, fold, model, score): each row once
    per base, by the model fitted without its fold. ``train`` is not resampled."""
    data = fold_trains(train, k, params, "fold", parallelism, resample_before)
    weighted = params.imbalance.method != "smote"
    boosted = [(n, f) for n in names if n in BOOSTED for f in range(k)]
    grown = [forest_job(params, f, f) for f in range(k)] if "random_forest" in names else []
    others = [(n, f) for n in names if n not in BOOSTED and n != "random_forest" for f in range(k)]
    jobs = [boosting.BoostJob(boost_spec(boost_params(n, params), weighted), f, f) for n, f in boosted]
    tasks = [lambda n=n, f=f: MLScoreModel(n, fit_base(n, data.trains[f], params)).score(
        data.folded.where(F.col("fold") == f)).select(ID_COL, TARGET, LABEL, "fold", F.lit(n).alias("model"), "score")
        for n, f in others]
    first, voted, *parts = fit_many([lambda: boosting.fit_boosted(data.table, jobs)[1],
                                     lambda: forests.held_out_scores(data.table, grown), *tasks], parallelism)
    if grown:
        parts.append(voted.select(
            F.col("id").alias(ID_COL), F.col("label").cast("int").alias(TARGET), F.col("label").cast("double").alias(LABEL),
            F.col("job").alias("fold"), F.lit("random_forest").alias("model"), "score"))
    if boosted:
        of_job = F.get(F.array(*[F.struct(F.lit(n).alias("model"), F.lit(f).alias("fold")) for n, f in boosted]),
                       F.col("job"))
        parts.append(first.select(
            F.col("id").alias(ID_COL), F.col("label").cast("int").alias(TARGET), F.col("label").cast("double").alias(LABEL),
            of_job["fold"].alias("fold"), of_job["model"].alias("model"),
            (1 / (1 + F.exp(-F.col("margin")))).alias("score")))
    return checkpointed(reduce(DataFrame.unionByName, parts))


def fit_stacking(train: DataFrame, train_fit: DataFrame, names: list[str], params: Params = Params(),
                 folds: int | None = None, parallelism: int = 4,
                 bases: dict[str, MLScoreModel] | None = None, oof: DataFrame | None = None,
                 name: str = "stacking_ensemble") -> tuple[StackingModel, DataFrame]:
    """Fit the stacking ensemble; also returns the out-of-fold table of its bases.

    ``oof``: scores of :func:`cross_fit` to use; ``bases``: models already
    fitted on ``train_fit``. The meta model weighs both classes alike, as the
    resampled rows do that the bases see.
    """
    if oof is None:
        oof = cross_fit(train, names, params, folds or params.stacking_folds, parallelism)
    oof = oof.where(F.col("model").isin(names))
    inputs = [f"p_{n}" for n in names]
    wide = (oof.groupBy(ID_COL, LABEL).pivot("model", names).agg(F.first("score"))
            .select(ID_COL, LABEL, *[F.col(n).alias(f"p_{n}") for n in names]))
    wide = checkpointed(VectorAssembler(inputCols=inputs, outputCol="__meta").transform(wide))
    weighted = with_class_weights(wide, LABEL, "__weight")
    meta = LogisticRegression(featuresCol="__meta", labelCol=LABEL, maxIter=1000, weightCol="__weight",
                              regParam=1.0 / max(wide.count(), 1), elasticNetParam=0.0,
                              standardization=False, tol=1e-8).fit(weighted)
    if bases is None:
        bases = fit_bases(train_fit, names, params, parallelism)
    model = StackingModel(name, [bases[n] for n in names], meta, inputs)
    return model, oof


def non_logistic(names: list[str]) -> list[str]:
    return [n for n in names if "logistic" not in n]

