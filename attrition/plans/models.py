"""Training data preparation and the base classifiers (MLlib).

``prepare`` turns raw customers into the model inputs, with every fitted
piece kept as state for scoring:

clean -> split (hash of the id) -> features (cutoff fitted on train) ->
encode (levels found in train) -> scaler (population std, fitted on train) ->
vector column ``features``; optional resampling of the train side.

The train and test frames are checkpointed (reliable checkpoint in the
shared ``spark.checkpoint.dir``), so the many passes of model fitting and
evaluation neither recompute the preparation nor depend on executors that
may be lost.

Parameter mapping of the base models (original -> MLlib):

* random forest: trees, depth, min leaf size, sqrt features, balanced weights,
  seed -> Gini trees over binned features (:mod:`.forests`; min split size is implied by
  the leaf size on both children);
* logistic regression C with summed, weighted loss -> ``regParam = 1/(C * sum w)``
  (MLlib averages the loss), features already standardised;
* boosted trees A (depth-wise) and B (leaf-wise, 63 leaves) -> second-order boosting
  over binned features (:mod:`.boosting`) with L1/L2, minimum gain and per-tree
  row and column sampling; the fallback -> ``GBTClassifier``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml.classification import (GBTClassifier, LogisticRegression,
                                       RandomForestClassifier)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.clean import clean_data
from ..operators.encode import EncoderModel, align_columns, fit_encoder
from ..operators.features import FeatureModel, fit_features
from ..operators.resample import with_class_weights
from ..operators.scale import ScalerModel, fit_scaler
from ..operators.split import exact_split, hash_split
from ..params import BoostParams, ForestParams, LogisticParams, Params
from ..schema import ID_COL, TARGET
from ..functions.trees import BoostSpec, TreeEnsemble
from ..session import checkpointed
from . import boosting, forests

LABEL = "label"
FEATURES = "features"
WEIGHT = "weight"


@dataclass
class Preparation:
    """Fitted preparation state (applied identically to any new batch)."""

    features: FeatureModel
    encoder: EncoderModel
    scaler: ScalerModel
    feature_names: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame, clean: bool = True) -> DataFrame:
        out = clean_data(df, deduplicate=False) if clean else df
        out = self.features.transform(out)
        enc = self.encoder.transform(out)
        aligned = align_columns(enc, self.feature_names, keep=(ID_COL, TARGET))
        scaled = self.scaler.transform(aligned)
        vec = VectorAssembler(inputCols=self.feature_names, outputCol=FEATURES,
                              handleInvalid="keep").transform(scaled)
        keep = [c for c in (ID_COL, TARGET) if c in vec.columns]
        out = vec.select(*keep, FEATURES)
        if TARGET in out.columns:
            out = out.withColumn(LABEL, F.col(TARGET).cast("double"))
        return out


@dataclass
class TrainingData:
    prep: Preparation
    train: DataFrame      # customer_id, churn, label, features
    test: DataFrame
    train_fit: DataFrame  # train after resampling / with weights (what models see)


def fit_preparation(train_raw: DataFrame, params: Params = Params()) -> Preparation:
    fm = fit_features(train_raw, params.features)
    featured = fm.transform(train_raw)
    enc = fit_encoder(featured)
    encoded = enc.transform(featured)
    scaler = fit_scaler(encoded, enc.feature_names)
    return Preparation(fm, enc, scaler, list(enc.feature_names))


def prepare(raw: DataFrame, params: Params = Params(), checkpoint: bool = True,
            resample: str | None = None) -> TrainingData:
    """Split, fit preparation on train, transform both sides, resample train."""
    split = exact_split if params.data.exact else hash_split
    data = split(clean_data(raw), params.data.test_size, params.data.seed)
    if checkpoint:  # cleaned + tagged once; every later pass reads this table
        data = checkpointed(data)
    train_raw = data.where(~F.col("is_test")).drop("is_test")
    test_raw = data.where(F.col("is_test")).drop("is_test")
    prep = fit_preparation(train_raw, params)
    train = prep.transform(train_raw, clean=False)
    test = prep.transform(test_raw, clean=False)
    if checkpoint:
        train, test = checkpointed(train), checkpointed(test)
    method = resample or params.imbalance.method
    if method == "smote":
        from ..operators.resample import smote_vectors
        train_fit = smote_vectors(train, k=params.imbalance.k_neighbors, seed=params.data.seed)
        if checkpoint:
            train_fit = checkpointed(train_fit)
    elif method == "class_weight":
        train_fit = with_class_weights(train, TARGET, WEIGHT)
    else:
        train_fit = train
    return TrainingData(prep, train, test, train_fit)


def _weights_needed(df: DataFrame, balanced: bool, pos_weight: float | None = None) -> tuple[DataFrame, str | None]:
    if pos_weight is not None and pos_weight != 1.0:
        return with_class_weights(df, TARGET, WEIGHT, pos_weight=pos_weight), WEIGHT
    if balanced:
        return with_class_weights(df, TARGET, WEIGHT), WEIGHT
    return df, None


def random_forest(p: ForestParams = ForestParams(), weight_col: str | None = None):
    rf = RandomForestClassifier(featuresCol=FEATURES, labelCol=LABEL, numTrees=p.num_trees,
                                maxDepth=p.max_depth, minInstancesPerNode=p.min_instances_per_node,
                                featureSubsetStrategy=p.feature_subset, seed=p.seed,
                                probabilityCol="probability", rawPredictionCol="rawPrediction")
    if weight_col:
        rf.setWeightCol(weight_col)
    return _deep_tree_settings(rf, p.max_depth)


def _deep_tree_settings(est, depth: int):
    """Deep trees: keep each row's node id in a cached RDD instead of
    shipping the trees to every task at every level (halves the 300-tree,
    depth-15 forest fit at sf0.1); the cache is checkpointed every 10
    iterations into the shared checkpoint folder."""
    if depth >= 10:
        est.setCacheNodeIds(True).setCheckpointInterval(10)
    return est


def logistic(p: LogisticParams = LogisticParams(), weight_sum: float = 1.0,
             weight_col: str | None = None, C: float | None = None):
    c = C if C is not None else p.C
    lr = LogisticRegression(featuresCol=FEATURES, labelCol=LABEL, maxIter=p.max_iter,
                            regParam=1.0 / (c * max(weight_sum, 1.0)), elasticNetParam=0.0,
                            standardization=False, tol=1e-8)
    if weight_col:
        lr.setWeightCol(weight_col)
    return lr


def gbt(p: BoostParams = BoostParams(), weight_col: str | None = None):
    g = GBTClassifier(featuresCol=FEATURES, labelCol=LABEL, maxIter=p.max_iter, stepSize=p.step_size,
                      maxDepth=p.max_depth, subsamplingRate=p.subsampling_rate,
                      featureSubsetStrategy=p.feature_subset, seed=p.seed)
    if weight_col:
        g.setWeightCol(weight_col)
    return _deep_tree_settings(g, p.max_depth)


BASE_MODELS = ["random_forest", "logistic_regression", "gbt_a", "gbt_b"]


def boost_params(name: str, params: Params) -> BoostParams:
    return {"gbt_a": params.boost_a, "gbt_fallback": params.boost_fallback, "gbt_b": params.boost_b}[name]


def boost_spec(p: BoostParams, weighted: bool = True) -> BoostSpec:
    """The engine's settings; without ``weighted`` both classes have weight 1."""
    return BoostSpec(
        rounds=p.max_iter, step=p.step_size, max_depth=p.max_depth, max_leaves=p.max_leaves, l1=p.l1, l2=p.l2,
        min_gain=p.min_gain, min_child_weight=p.min_child_weight, min_rows=p.min_rows, subsample=p.subsampling_rate,
        colsample=1.0 if p.feature_subset == "all" else float(p.feature_subset),
        pos_weight=p.pos_weight if weighted else 1.0, from_prior=p.from_prior, seed=p.seed)


#: Base models that the binned boosting engine fits.
BOOSTED = ("gbt_a", "gbt_b")


def fit_boosts(train_fit: DataFrame, names: list[str], params: Params = Params(),
               table: boosting.BinnedTable | None = None) -> dict[str, TreeEnsemble]:
    """Boosted base models over one binned table, in one pass."""
    if not names:
        return {}
    weighted = params.imbalance.method != "smote"
    jobs = [boosting.BoostJob(boost_spec(boost_params(n, params), weighted)) for n in names]
    return dict(zip(names, boosting.fit_boosted(table or boosting.bin_table(train_fit), jobs)[0]))


def forest_job(params: Params = Params(), train_set: int = 0, fold: int | None = None) -> forests.ForestJob:
    balanced = params.forest.balanced and params.imbalance.method != "smote"
    return forests.ForestJob(forests.forest_spec(params.forest), train_set, fold, balanced)


def fit_base(name: str, train_fit: DataFrame, params: Params = Params(), table: boosting.BinnedTable | None = None):
    """Fit one base model by name on the (resampled) training frame (``table``: its bins, if made already).

    Class weighting is the imbalance correction only when SMOTE is off
    (one correction, not several stacked).
    """
    weighted = params.imbalance.method != "smote"
    if name in BOOSTED:
        return fit_boosts(train_fit, [name], params, table)[name]
    if name == "random_forest":
        return forests.fit_forest(table or boosting.bin_table(train_fit), forest_job(params))
    if name == "logistic_regression":
        df, w = _weights_needed(train_fit, params.logistic.balanced and weighted)
        wsum = (df.agg(F.sum(w)).first()[0] if w else df.count())
        return logistic(params.logistic, float(wsum), w).fit(df)
    if name == "gbt_fallback":
        bp = params.boost_fallback
        if not weighted:
            df, w = train_fit, None
        elif bp.pos_weight is None:
            df, w = _weights_needed(train_fit, True)
        else:
            df, w = _weights_needed(train_fit, False, bp.pos_weight)
        return gbt(bp, w).fit(df)
    raise KeyError(name)


def prob1(vec: Column) -> Column:
    return vector_to_array(vec).getItem(1)
