"""Standardisation with population statistics (fit on train, apply anywhere).

Fit is one aggregate pass (``avg`` and ``stddev_pop`` per column, partial
aggregation map-side, one row to the driver); transform is a projection.
A zero-variance column gets scale 1, so it maps to 0 rather than NaN.
MLlib's ``StandardScaler`` divides by the *sample* deviation, hence this
operator.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ScalerModel:
    columns: list[str]
    means: list[float]
    scales: list[float]

    def transform(self, df: DataFrame, suffix: str = "") -> DataFrame:
        # SQL text per column: one JVM call per expression (a wide feature
        # list otherwise costs thousands of driver round-trips to build).
        exprs = {}
        present = set(df.columns)
        for c, m, s in zip(self.columns, self.means, self.scales):
            src = f"cast(`{c}` as double)" if c in present else "0.0D"
            exprs[c + suffix] = F.expr(f"({src} - {m!r}D) / {s!r}D")
        return df.withColumns(exprs)


def fit_scaler(df: DataFrame, columns: list[str]) -> ScalerModel:
    aggs = []
    for i, c in enumerate(columns):
        x = f"cast(`{c}` as double)"
        aggs += [F.expr(f"avg({x}) as m{i}"), F.expr(f"stddev_pop({x}) as s{i}")]
    row = df.agg(*aggs).first()
    means, scales = [], []
    for i in range(len(columns)):
        m = row[f"m{i}"]
        s = row[f"s{i}"]
        means.append(float(m) if m is not None else 0.0)
        scales.append(float(s) if s not in (None, 0.0) else 1.0)
    return ScalerModel(list(columns), means, scales)
