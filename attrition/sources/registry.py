"""Model registry: save and load fitted models with their preparation state.

Layout under a (shared) directory::

    <dir>/<key>/...            one model per base (ML writer; boosted trees as a Parquet row)
    <dir>/<key>/meta/          for ensembles: meta model
    <dir>/_index/              JSON rows: name, key, kind, bases, inputs
    <dir>/_prep/               JSON row: cutoff, levels, scaler, feature names

``key`` is the model name lower-cased with blanks as ``_``; the same key is
used to save and to load. Everything is written through Spark, so the
directory can live on any file system the cluster reads.
"""

from __future__ import annotations

import json

from pyspark.ml.classification import (GBTClassificationModel, LogisticRegressionModel,
                                       RandomForestClassificationModel)
from pyspark.sql import SparkSession

from ..functions.forests import Forest
from ..functions.trees import TreeEnsemble
from ..operators.encode import EncoderModel
from ..operators.features import FeatureModel
from ..operators.scale import ScalerModel
from ..params import FeatureParams

_LOADERS = {
    "RandomForestClassificationModel": RandomForestClassificationModel,
    "LogisticRegressionModel": LogisticRegressionModel,
    "GBTClassificationModel": GBTClassificationModel,
}


def model_key(name: str) -> str:
    return name.lower().replace(" ", "_")


def _save_ml(spark: SparkSession, model, path: str) -> str:
    if isinstance(model, (TreeEnsemble, Forest)):
        spark.createDataFrame([(bytearray(model.to_bytes()),)], "model binary").coalesce(1) \
            .write.mode("overwrite").parquet(path)
    else:
        model.write().overwrite().save(path)
    return type(model).__name__


def _load_ml(spark: SparkSession, kind: str, path: str):
    if kind in ("TreeEnsemble", "Forest"):
        return {"TreeEnsemble": TreeEnsemble, "Forest": Forest}[kind].from_bytes(bytes(spark.read.parquet(path).first()["model"]))
    return _LOADERS[kind].load(path)


def save_models(spark: SparkSession, models: dict, prep, directory: str) -> None:
    """Persist score models (MLScoreModel / SoftVoteModel / StackingModel) and prep."""
    index = []
    for name, m in models.items():
        key = model_key(name)
        base = f"{directory}/{key}"
        if hasattr(m, "bases"):
            bases = []
            for i, b in enumerate(m.bases):
                kind = _save_ml(spark, b.model, f"{base}/base_{i}")
                bases.append({"name": b.name, "kind": kind})
            meta_kind = _save_ml(spark, m.meta, f"{base}/meta") if hasattr(m, "meta") else None
            index.append({"name": name, "key": key, "kind": type(m).__name__,
                          "bases": json.dumps(bases), "inputs": json.dumps(getattr(m, "meta_inputs", [])),
                          "meta_kind": meta_kind or ""})
        else:
            kind = _save_ml(spark, m.model, base)
            index.append({"name": name, "key": key, "kind": kind, "bases": "[]", "inputs": "[]",
                          "meta_kind": ""})
    spark.createDataFrame(index).coalesce(1).write.mode("overwrite").json(f"{directory}/_index")
    prep_row = {
        "cutoff": prep.features.cutoff,
        "feature_params": json.dumps(prep.features.params.__dict__),
        "levels": json.dumps(prep.encoder.levels),
        "feature_names": json.dumps(prep.feature_names),
        "means": json.dumps(prep.scaler.means),
        "scales": json.dumps(prep.scaler.scales),
    }
    spark.createDataFrame([prep_row]).coalesce(1).write.mode("overwrite").json(f"{directory}/_prep")


def load_preparation(spark: SparkSession, directory: str):
    from ..plans.models import Preparation
    rows = _read(spark, f"{directory}/_prep")
    r = rows[0]
    names = json.loads(r["feature_names"])
    fm = FeatureModel(cutoff=float(r["cutoff"]), params=FeatureParams(**json.loads(r["feature_params"])))
    enc = EncoderModel(levels=json.loads(r["levels"]), keep_id=True, feature_names=names)
    scaler = ScalerModel(names, json.loads(r["means"]), json.loads(r["scales"]))
    return Preparation(fm, enc, scaler, names)


def _read(spark: SparkSession, path: str):
    try:
        return spark.read.json(path).collect()
    except Exception as exc:  # AnalysisException when the path does not exist
        raise FileNotFoundError(f"no saved model data at {path}: run training first") from exc


def load_model(spark: SparkSession, directory: str, name: str):
    """Load one saved score model by name or key."""
    from ..plans.ensemble import SoftVoteModel, StackingModel, score_model
    key = model_key(name)
    entries = {r["key"]: r for r in _read(spark, f"{directory}/_index")}
    if key not in entries:
        raise FileNotFoundError(f"model '{key}' not in {directory}/_index (have: {sorted(entries)})")
    e = entries[key]
    base = f"{directory}/{key}"
    if e["kind"] not in ("SoftVoteModel", "StackingModel"):
        return score_model(e["name"], _load_ml(spark, e["kind"], base))
    bases = [score_model(b["name"], _load_ml(spark, b["kind"], f"{base}/base_{i}"))
             for i, b in enumerate(json.loads(e["bases"]))]
    if e["kind"] == "StackingModel":
        meta = _load_ml(spark, e["meta_kind"], f"{base}/meta")
        return StackingModel(e["name"], bases, meta, json.loads(e["inputs"]))
    return SoftVoteModel(e["name"], bases)


def load_all(spark: SparkSession, directory: str) -> dict:
    """Every saved score model by name."""
    return {r["name"]: load_model(spark, directory, r["key"]) for r in _read(spark, f"{directory}/_index")}


def load_production(spark: SparkSession, directory: str, model_key_name: str = "stacking_ensemble"):
    """(model, preparation) of the production model; clear error if missing."""
    return load_model(spark, directory, model_key_name), load_preparation(spark, directory)
