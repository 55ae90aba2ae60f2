"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Each query's result is fully computed with the ``noop`` sink (no transfer
scratch figures describe (logistic regression, 20-tree forest, 20-round
boosting; fit plus lazy transform on the prepared, not resampled, train
side). The third, ``multi_fit``, times the queries that fit many models at the
production settings: the two boosted models in one pass and the search; with
BENCH_MULTI=all also cross-validation and stacking (forests included). It is
kept out of ``value``, which stays comparable with earlier rounds. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from attrition.plans.catalog import QUERIES, raw  # noqa: E402
from attrition.session import get_spark  # noqa: E402

HEADLINE = [
    "gen_customers", "engineer_features", "encode_features", "standard_scale", "stratified_split_exact",
    "hist_tenure", "hist_monthly_charges", "rate_by_contract", "correlation_pairs",
    "segment_summary", "retention_impact", "score_customers",
    "metrics_row", "roc_curve", "pr_curve", "model_comparison", "classification_report",
    "linear_attribution", "knn_minority", "smote_counts",
]


def _time_fits(spark, sf_dir: str, times: dict) -> None:
    from attrition.params import BoostParams, ForestParams
    from attrition.plans.jobs import params_for
    from attrition.plans.models import gbt, logistic, prepare, random_forest
    t0 = time.time()
    data = prepare(raw(spark, sf_dir), params_for("none"))
    times["prepare"] = round(time.time() - t0, 3)
    n = data.train.count()
    fits = {
        "fit_logistic": lambda: logistic(weight_sum=float(n)),
        "fit_forest_20": lambda: random_forest(ForestParams(num_trees=20, max_depth=8)),
        "fit_gbt_20": lambda: gbt(BoostParams(max_iter=20, max_depth=5)),
    }
    for name, make in fits.items():
        t0 = time.time()
        model = make().fit(data.train)
        model.transform(data.test).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)


def _time_multi(spark, sf_dir: str, mode: str) -> dict:
    from attrition.plans.catalog import training
    from attrition.plans.models import BOOSTED, fit_boosts
    times: dict[str, float] = {}
    td = training(spark, sf_dir)
    t0 = time.time()
    fit_boosts(td.train_fit, list(BOOSTED))
    times["fit_gbt_a_and_b"] = round(time.time() - t0, 3)
    names = ["tuning_trials", "best_so_far"]
    if mode == "all":
        names += ["cv_scores", "stacking_scores", "stacking_model"]
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    return times


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES")
    names = names.split(",") if names else HEADLINE
    spark = get_spark(f"local[{cpus}]", app="attrition-bench", shuffle_partitions=int(cpus) * 2)
    times: dict[str, float] = {}
    for name in names:
        t0 = time.time()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t0, 3)
    if os.environ.get("BENCH_FITS", "1") == "1":
        _time_fits(spark, sf_dir, times)
    mode = os.environ.get("BENCH_MULTI", "1")
    multi = _time_multi(spark, sf_dir, mode) if mode != "0" else {}
    sf = sf_dir.rstrip("/").rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "total_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "multi_fit": multi, "sf": sf, "cpus": int(cpus)}))


if __name__ == "__main__":
    main()
