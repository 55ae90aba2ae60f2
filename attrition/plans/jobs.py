"""User-level jobs: train, evaluate, score, and the whole pipeline.

Command line (``spark-submit``-able)::

    python -m attrition.plans.jobs pipeline (--sf-dir DIR | --input PATH [--format csv]) --out DIR
        [--skip-data] [--skip-train] [--no-tuning] [--exact]
    python -m attrition.plans.jobs train --input PATH [--format csv] --out DIR [--no-tuning] [--exact]
    python -m attrition.plans.jobs evaluate --input PATH [--format csv] --models DIR --out DIR
    python -m attrition.plans.jobs score --input PATH --output PATH --models DIR

``train`` saves every model, its tables and the ids it held out;
``evaluate`` loads all saved models and measures them on labelled rows.
A search that was interrupted goes on where its last committed batch ended.
"""

from __future__ import annotations

import argparse
import time
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import eda
from ..operators.clean import clean_data
from ..operators.encode import encode_features
from ..operators.features import engineer_features
from ..operators.segments import segment_counts
from ..operators.metrics import (classification_report, confusion_matrix, metrics_table, model_comparison, pr_curve,
                                 roc_curve)
from ..operators.split import exact_split, hash_split
from ..params import ImbalanceParams, Params
from ..schema import TARGET
from ..session import checkpointed, get_spark
from ..sources.customers import customers_from_tables, read_customers, write_table
from ..sources.registry import load_all, load_preparation, load_production, save_models
from .boosting import BoostedScoreModel
from .ensemble import cross_fit, fit_bases, fit_stacking, non_logistic, soft_vote
from .explain import best_of, feature_importance, importances, sample_rows, tree_attribution
from .models import BASE_MODELS, TrainingData, prepare
from .score import evaluate_segments, score_customers
from .tune import TrialStore, adaptive_search, best_so_far, cv_tables, search_key


def params_for(method: str, base: Params | None = None) -> Params:
    p = base or Params()
    return replace(p, imbalance=ImbalanceParams(method=method, k_neighbors=p.imbalance.k_neighbors))


@dataclass
class TrainingResult:
    data: TrainingData
    models: dict = field(default_factory=dict)
    cv: DataFrame | None = None
    trials: DataFrame | None = None
    oof: DataFrame | None = None


def train(raw: DataFrame, params: Params = Params(), base_models: list[str] | None = None,
          cv: bool = True, tune: bool = True, parallelism: int = 4, trials_dir: str | None = None) -> TrainingResult:
    """Prepare, fit all models, cross-validate and search. ``trials_dir``: shared
    folder of the trial table, from which an interrupted search goes on."""
    names = base_models or BASE_MODELS
    data = prepare(raw, params)
    bases = fit_bases(data.train_fit, names, params, parallelism)
    models: dict = dict(bases)
    models["soft_voting"] = soft_vote(bases)
    oof = cross_fit(data.train, names, params, params.cv_folds, parallelism) if cv else None
    stack, stack_oof = fit_stacking(
        data.train, data.train_fit, non_logistic(names), params, parallelism=parallelism,
        bases={n: bases[n] for n in non_logistic(names)}, oof=oof if params.cv_folds == params.stacking_folds else None)
    models["stacking_ensemble"] = stack
    result = TrainingResult(data, models, oof=stack_oof)
    if cv:
        result.cv = cv_tables(oof)[1]
    if tune and params.tune.n_trials > 0:
        store = TrialStore(raw.sparkSession, f"{trials_dir}/{search_key(params)}") if trials_dir else None
        result.trials, models["tuned_gbt"] = adaptive_search(data.train, data.train_fit, params, store, parallelism)
    return result


def evaluate(result: TrainingResult, params: Params = Params(),
             production: str = "stacking_ensemble") -> dict[str, DataFrame]:
    return evaluate_models(result.models, result.data.test, result.data.prep.feature_names, params, production)


def evaluate_models(models: dict, test: DataFrame, feature_names: list[str], params: Params = Params(),
                    production: str = "stacking_ensemble") -> dict[str, DataFrame]:
    """Metric tables of every model over prepared, labelled rows, in one pass per
    table; confusion matrix and report of the best model, importance of the
    best tree model, attribution of the best boosted one."""
    parts = [m.score(test, "score").select(F.lit(name).alias("model"), TARGET, "score")
             for name, m in models.items()]
    long = parts[0]
    for p in parts[1:]:
        long = long.unionByName(p)
    long = checkpointed(long)
    comparison = checkpointed(model_comparison(long))
    best = best_of(models, comparison, lambda m: True)
    threshold = params.segments.decision_threshold
    own = long.where(F.col("model") == best)
    out = {
        "model_comparison": comparison,
        "roc_curves": roc_curve(long, TARGET, "score", ["model"]),
        "pr_curves": pr_curve(long, TARGET, "score", ["model"]),
        "metrics": metrics_table(long, TARGET, "score", threshold, ["model"]),
        "best_confusion_matrix": confusion_matrix(own, TARGET, "score", threshold).withColumn("model", F.lit(best)),
        "best_report": classification_report(own, TARGET, "score", threshold).withColumn("model", F.lit(best)),
    }
    out.update(evaluate_segments(test, models.get(production, models[best]), params.segments))
    tree = best_of(models, comparison, lambda m: importances(getattr(m, "model", None)) is not None)
    if tree is not None:
        out["feature_importance"] = feature_importance(models[tree], feature_names).withColumn("model", F.lit(tree))
    boosted = best_of(models, comparison, lambda m: isinstance(m, BoostedScoreModel))
    if boosted is not None:
        out["tree_attribution"] = tree_attribution(
            models[boosted], sample_rows(test, params.attribution_rows), feature_names) \
            .withColumn("model", F.lit(boosted))
    return out


def eda_tables(raw: DataFrame) -> dict[str, DataFrame]:
    """The data behind every exploratory chart."""
    return {
        "churn_share": eda.churn_share(raw),
        "hist_tenure": eda.histogram(raw, "tenure", 30),
        "hist_monthly_charges": eda.histogram(raw, "monthly_charges", 40),
        "rate_by_contract": eda.rate_by(raw, "contract"),
        "rate_by_internet": eda.rate_by(raw, "internet_service"),
        "rate_by_payment": eda.rate_by(raw, "payment_method", ascending=True),
        "correlation_pairs": eda.correlation_pairs(
            raw, ["senior_citizen", "tenure", "monthly_charges", "total_charges", "churn"]),
    }


def training_tables(result: TrainingResult) -> dict[str, DataFrame]:
    out = {}
    if result.cv is not None:
        out["cv_scores"] = result.cv
    if result.trials is not None:
        out["tuning_trials"] = result.trials
        out["best_so_far"] = best_so_far(result.trials)
    return out


def run_pipeline(spark: SparkSession, sf_dir: str | None, out_dir: str, params: Params = Params(),
                 skip_data: bool = False, skip_train: bool = False, tune: bool = True,
                 parallelism: int = 4, input_path: str | None = None, fmt: str = "csv") -> dict[str, DataFrame]:
    """Whole pipeline: raw table (own file or generated) -> processed table -> EDA tables
    -> train, save and evaluate (or, with ``skip_train``, load every saved model and
    evaluate)."""
    raw_path = f"{out_dir}/raw"
    if input_path:
        raw = read_customers(spark, input_path, fmt)
    elif skip_data:
        raw = read_customers(spark, raw_path)
    else:
        write_table(customers_from_tables(spark, sf_dir, params.data.seed), raw_path)
        raw = read_customers(spark, raw_path)
    clean = clean_data(raw)
    processed = encode_features(engineer_features(clean, params.features), declared=True, keep_id=False)
    write_table(processed, f"{out_dir}/processed")
    tables = eda_tables(clean)
    if not skip_train:
        result = train(raw, params, tune=tune and params.tune.n_trials > 0, parallelism=parallelism,
                       trials_dir=f"{out_dir}/trials")
        save_models(spark, result.models, result.data.prep, f"{out_dir}/models")
        tables.update(evaluate(result, params))
        tables.update(training_tables(result))
    else:
        tables.update(evaluate_saved(clean, f"{out_dir}/models", params))
    return tables


def evaluate_saved(clean: DataFrame, model_dir: str, params: Params = Params()) -> dict[str, DataFrame]:
    """Every saved model on the test side of the cleaned rows, without training."""
    spark = clean.sparkSession
    split = exact_split if params.data.exact else hash_split
    held = split(clean, params.data.test_size, params.data.seed).where(F.col("is_test")).drop("is_test")
    prep = load_preparation(spark, model_dir)
    test = checkpointed(prep.transform(held, clean=False))
    return evaluate_models(load_all(spark, model_dir), test, prep.feature_names, params)


def train_job(spark: SparkSession, input_path: str, out_dir: str, fmt: str = "csv", params: Params = Params(),
              tune: bool = True, parallelism: int = 4) -> dict[str, DataFrame]:
    """Train on one's own customers; save the models and return the training tables."""
    result = train(read_customers(spark, input_path, fmt), params, tune=tune, parallelism=parallelism,
                   trials_dir=f"{out_dir}/trials")
    save_models(spark, result.models, result.data.prep, f"{out_dir}/models")
    return training_tables(result)


def evaluate_job(spark: SparkSession, input_path: str, model_dir: str, fmt: str = "csv",
                 params: Params = Params()) -> dict[str, DataFrame]:
    """All saved models on the test side of one's own customers."""
    return evaluate_saved(clean_data(read_customers(spark, input_path, fmt)), model_dir, params)


def score_job(spark: SparkSession, input_path: str, output_path: str, model_dir: str,
              fmt: str = "parquet", params: Params = Params()) -> DataFrame:
    """Score a batch with the production model; write predictions; return the
    per-segment counts of the written batch."""
    model, prep = load_production(spark, model_dir)
    batch = read_customers(spark, input_path, fmt)
    scored = score_customers(batch, model, prep, params.segments)
    write_table(scored, output_path, fmt)
    return segment_counts(read_customers_scored(spark, output_path, fmt))


def read_customers_scored(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    reader = spark.read.format(fmt)
    if fmt == "csv":
        reader = reader.schema("customer_id string, churn_probability double, churn_prediction int, "
                               "risk_segment string").option("header", True)
    return reader.load(path)


def _arguments(argv: list[str] | None) -> argparse.Namespace:
    ap = argparse.ArgumentParser(prog="attrition")
    sub = ap.add_subparsers(dest="cmd", required=True)
    options = {
        "pipeline": ["sf-dir", "input", "out!"], "train": ["input!", "out!"],
        "evaluate": ["input!", "models!", "out!"], "score": ["input!", "output!", "models!"]}
    for cmd, names in options.items():
        p = sub.add_parser(cmd)
        for n in names:
            p.add_argument(f"--{n.rstrip('!')}", required=n.endswith("!"))
        p.add_argument("--format", default="parquet" if cmd == "score" else "csv")
        p.add_argument("--exact", action="store_true")
        for flag in ("skip-data", "skip-train", "no-tuning"):
            p.add_argument(f"--{flag}", action="store_true")
    args = ap.parse_args(argv)
    if args.cmd == "pipeline" and not (args.sf_dir or args.input or args.skip_data):
        ap.error("pipeline needs --sf-dir or --input")
    return args


def main(argv: list[str] | None = None, params: Params = Params()) -> None:
    start = time.time()
    args = _arguments(argv)
    spark = get_spark()
    if args.exact:
        params = replace(params, data=replace(params.data, exact=True))
    if args.cmd == "score":
        score_job(spark, args.input, args.output, args.models, args.format).show(truncate=False)
        return
    if args.cmd == "pipeline":
        tables = run_pipeline(spark, args.sf_dir, args.out, params, skip_data=args.skip_data,
                              skip_train=args.skip_train, tune=not args.no_tuning,
                              input_path=args.input, fmt=args.format)
    elif args.cmd == "train":
        tables = train_job(spark, args.input, args.out, args.format, params, not args.no_tuning)
    else:
        tables = evaluate_job(spark, args.input, args.models, args.format, params)
    for name, df in tables.items():
        write_table(df, f"{args.out}/tables/{name}")
    took = spark.createDataFrame([(time.time() - start,)], "elapsed_sec double")
    write_table(took, f"{args.out}/tables/elapsed_sec")


if __name__ == "__main__":
    main()
