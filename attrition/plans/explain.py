"""Model explanations as tables: native importance and attributions.

* ``feature_importance``: the tree model's normalised importances joined
  to the feature names, top ``n``; for ensembles the first base that has
  them; logistic models have none (``None``).
* ``tree_attribution``: exact path-dependent Shapley values of a boosted
  model's margin, a pass of numpy over each Arrow batch, and their means.
* ``linear_attribution``: exact attribution of a linear score,
  coef_j * (x_j - mean_j), summarised as mean |attribution| per feature.
* ``shapley_mc``: Monte-Carlo Shapley values for any score model as one
  Spark job: sampled rows x permutations x positions become hybrid rows
  (features before the position taken from the row, the rest from a
  background row), one batched ``score`` call evaluates them all, and the
  contribution of a feature is the score step where it switches on. The
  values of one row add up to f(x) - f(background) exactly. Rows are
  sampled by hash of the id, not "the first n".
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.forests import Forest
from ..functions.random import uniform
from ..functions.trees import TreeEnsemble
from ..schema import ID_COL
from .boosting import BoostedScoreModel


def feature_importance(model, feature_names: list[str], top_n: int = 20):
    """(feature, importance) top-n, or None when no base has importances."""
    candidates = [model] + list(getattr(model, "bases", []))
    for m in candidates:
        inner = getattr(m, "model", m)
        imp = importances(inner)
        if imp is not None:
            spark = _spark()
            rows = list(zip(feature_names, [float(v) for v in imp]))
            df = spark.createDataFrame(rows, "feature string, importance double")
            return df.orderBy(F.col("importance").desc(), F.col("feature")).limit(top_n)
    return None


def importances(fitted) -> list[float] | None:
    """Normalised importances of a fitted tree model, None for other models."""
    if isinstance(fitted, (TreeEnsemble, Forest)):
        return fitted.importances().tolist()
    return fitted.featureImportances.toArray().tolist() if hasattr(fitted, "featureImportances") else None


def attribution_rows(model: BoostedScoreModel, rows: DataFrame, feature_names: list[str],
                     id_col: str = ID_COL) -> DataFrame:
    """Long table (id, feature, attribution) of each row's Shapley values."""
    names = F.array(*[F.lit(n) for n in feature_names])
    return model.attributions(rows, "__phi").select(id_col, F.posexplode("__phi").alias("__at", "attribution")) \
        .select(id_col, F.get(names, F.col("__at")).alias("feature"), "attribution")


def tree_attribution(model: BoostedScoreModel, rows: DataFrame, feature_names: list[str],
                     top_n: int = 20) -> DataFrame:
    """Mean |attribution| per feature over ``rows``, largest first."""
    return (attribution_rows(model, rows, feature_names).groupBy("feature")
            .agg(F.avg(F.abs("attribution")).alias("mean_abs_attribution"))
            .orderBy(F.col("mean_abs_attribution").desc(), F.col("feature")).limit(top_n))


def best_of(models: dict, comparison: DataFrame, wanted) -> str | None:
    """Name of the model with the highest AUC among those that ``wanted`` takes."""
    for r in comparison.orderBy(F.col("auc_roc").desc(), "model").collect():  # a row per model
        if wanted(models[r["model"]]):
            return r["model"]
    return None


def _spark():
    from pyspark.sql import SparkSession
    return SparkSession.getActiveSession()


def linear_attribution(df: DataFrame, coefs: dict[str, float], top_n: int = 20) -> DataFrame:
    """Mean |coef * (x - mean(x))| per feature, largest first (two passes)."""
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(c) for c in coefs]).first()
    contrib = df.select(*[(F.lit(float(w)) * (F.col(c).cast("double") - F.lit(float(means[c] or 0.0))))
                          .alias(c) for c, w in coefs.items()])
    wide = contrib.agg(*[F.avg(F.abs(F.col(c))).alias(c) for c in coefs])
    long = wide.unpivot([], list(coefs), "feature", "mean_abs_attribution")
    return long.orderBy(F.col("mean_abs_attribution").desc(), F.col("feature")).limit(top_n)


def sample_rows(df: DataFrame, n: int, seed: int = 42, id_col: str = ID_COL) -> DataFrame:
    """About ``n`` rows chosen by id hash (whole-table scan, no positional head)."""
    total = df.count()
    share = min(1.0, n / max(total, 1))
    return df.where(uniform(id_col, "explain_sample", seed) < F.lit(share))


def shapley_mc(model, rows: DataFrame, background: list[float], feature_names: list[str],
               n_perm: int = 8, seed: int = 42, id_col: str = ID_COL,
               features: str = "features") -> DataFrame:
    """Per (id, feature) Monte-Carlo Shapley value of the class-1 probability."""
    d = len(feature_names)
    bg = F.array(*[F.lit(float(v)) for v in background])
    base = rows.select(F.col(id_col).alias("__id"), vector_to_array(F.col(features), "float64").alias("__x"))
    perm_key = lambda i: F.concat(F.col("__id"), F.lit(":"), F.col("__p").cast("string"),
                                  F.lit(":"), i.cast("string"))
    with_perm = (base.withColumn("__p", F.explode(F.sequence(F.lit(0), F.lit(n_perm - 1))))
                 .withColumn("__perm", F.transform(F.array_sort(F.transform(
                     F.sequence(F.lit(0), F.lit(d - 1)),
                     lambda i: F.struct(uniform(perm_key(i), "shap_perm", seed).alias("h"), i.alias("i")))),
                     lambda s: s.getField("i")))
                 .withColumn("__pos", F.transform(F.sequence(F.lit(0), F.lit(d - 1)),
                                                  lambda i: F.array_position(F.col("__perm"), i) - 1)))
    steps = with_perm.withColumn("__j", F.explode(F.sequence(F.lit(0), F.lit(d))))
    hybrid = steps.withColumn(features, array_to_vector(F.transform(
        F.sequence(F.lit(0), F.lit(d - 1)),
        lambda i: F.when(F.element_at(F.col("__pos"), i + 1) < F.col("__j"),
                         F.element_at(F.col("__x"), i + 1)).otherwise(F.element_at(bg, i + 1)))))
    scored = model.score(hybrid.select("__id", "__p", "__j", "__perm", features), "__f")
    w = Window.partitionBy("__id", "__p").orderBy("__j")  # d + 1 rows per group
    deltas = (scored.withColumn("__prev", F.lag("__f").over(w)).where(F.col("__j") > 0)
              .select("__id", "__p", F.element_at(F.col("__perm"), F.col("__j").cast("int")).alias("__feat"),
                      (F.col("__f") - F.col("__prev")).alias("__delta")))
    names = F.array(*[F.lit(n) for n in feature_names])
    return (deltas.groupBy("__id", "__feat").agg(F.avg("__delta").alias("shapley"))
            .select(F.col("__id").alias(id_col), F.element_at(names, F.col("__feat") + 1).alias("feature"),
                    "shapley"))


def shapley_summary(values: DataFrame, top_n: int = 20) -> DataFrame:
    return (values.groupBy("feature").agg(F.avg(F.abs("shapley")).alias("mean_abs_shapley"))
            .orderBy(F.col("mean_abs_shapley").desc(), F.col("feature")).limit(top_n))
