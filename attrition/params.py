"""Pipeline parameters as frozen dataclasses (defaults = the original config)."""

from __future__ import annotations

from dataclasses import dataclass, field


@dataclass(frozen=True)
class DataParams:
    seed: int = 42
    test_size: float = 0.20
    exact: bool = False  # exact class shares in the split and the folds, not by hash alone


@dataclass(frozen=True)
class FeatureParams:
    loyalty_threshold: int = 24
    high_value_quantile: float = 0.75
    tenure_include_lowest: bool = True
    approx_cutoff: bool = False  # percentile_approx for charges without a bound on distinct values


@dataclass(frozen=True)
class ImbalanceParams:
    method: str = "smote"  # smote | class_weight | none
    k_neighbors: int = 5


@dataclass(frozen=True)
class ForestParams:
    num_trees: int = 300
    max_depth: int = 15
    min_instances_per_node: int = 5
    feature_subset: str = "sqrt"
    balanced: bool = True
    seed: int = 42


@dataclass(frozen=True)
class LogisticParams:
    C: float = 0.5
    max_iter: int = 1000
    balanced: bool = True


@dataclass(frozen=True)
class BoostParams:
    max_iter: int = 300
    step_size: float = 0.05
    max_depth: int = 7
    subsampling_rate: float = 0.8
    feature_subset: str = "0.8"     # share of the columns ("all": every one)
    pos_weight: float | None = 3.0  # None => balanced weights
    seed: int = 42
    max_leaves: int | None = None   # leaf-wise growth up to so many leaves
    l1: float = 0.0
    l2: float = 1.0
    min_gain: float = 0.0
    min_child_weight: float = 1.0
    min_rows: int = 1
    from_prior: bool = False        # boosting starts at the log-odds


@dataclass(frozen=True)
class TuneParams:
    n_trials: int = 30
    folds: int = 3
    seed: int = 42
    rounds_range: tuple[int, int] = (100, 600)
    batch: int = 5                  # trials that are fitted together
    startup: int = 10               # uniform draws before the sampler adapts


@dataclass(frozen=True)
class SegmentParams:
    medium_threshold: float = 0.30
    high_threshold: float = 0.60
    retention_success_rate: float = 0.30
    decision_threshold: float = 0.5


@dataclass(frozen=True)
class Params:
    data: DataParams = field(default_factory=DataParams)
    features: FeatureParams = field(default_factory=FeatureParams)
    imbalance: ImbalanceParams = field(default_factory=ImbalanceParams)
    forest: ForestParams = field(default_factory=ForestParams)
    logistic: LogisticParams = field(default_factory=LogisticParams)
    boost_a: BoostParams = field(default_factory=BoostParams)
    boost_fallback: BoostParams = field(default_factory=lambda: BoostParams(
        max_iter=200, max_depth=5, feature_subset="all", pos_weight=1.0))
    boost_b: BoostParams = field(default_factory=lambda: BoostParams(
        max_leaves=63, pos_weight=None, l2=0.0, min_child_weight=1e-3, min_rows=20, from_prior=True))
    stacking_folds: int = 5
    cv_folds: int = 5
    tune: TuneParams = field(default_factory=TuneParams)
    segments: SegmentParams = field(default_factory=SegmentParams)
    attribution_rows: int = 2000


def check_profile() -> Params:
    """Small models for tests of the jobs: forests of 20 trees, boosted models of
    20 rounds, 10 trials of 10 to 60 rounds. Registered queries don't use it."""
    from dataclasses import replace
    p = Params()
    return replace(
        p,
        forest=replace(p.forest, num_trees=20),
        boost_a=replace(p.boost_a, max_iter=20),
        boost_fallback=replace(p.boost_fallback, max_iter=20),
        boost_b=replace(p.boost_b, max_iter=20),
        tune=replace(p.tune, n_trials=10, rounds_range=(10, 60)),
    )
