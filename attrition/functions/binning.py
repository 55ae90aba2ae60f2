"""Binning expressions (right-closed intervals, equal-width histograms)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def cut(col: Column | str, edges: Sequence[float], labels: Sequence[str],
        include_lowest: bool = False) -> Column:
    """Label of the right-closed interval ``(e[i], e[i+1]]`` holding the value.

    ``include_lowest`` closes the first interval on the left too. Values
    outside every interval, and nulls, give null. (MLlib's ``Bucketizer`` is
    left-closed, hence this ``when`` chain, which stays inside codegen.)
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(edges) == len(labels) + 1")
    c = _c(col)
    lo = c >= F.lit(edges[0]) if include_lowest else c > F.lit(edges[0])
    expr = None
    for i, label in enumerate(labels):
        cond = (c <= F.lit(edges[i + 1])) & (lo if i == 0 else c > F.lit(edges[i]))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr


def equal_width_bin(col: Column | str, lo: Column, hi: Column, n_bins: int) -> Column:
    """Bin index 0..n-1 of ``n`` equal bins over [lo, hi], last bin closed.

    A constant column (lo == hi) puts every row in bin 0.
    """
    c = _c(col).cast("double")
    width = hi.cast("double") - lo.cast("double")
    raw = F.floor((c - lo) / width * F.lit(n_bins))
    return (F.when(width == 0, F.lit(0))
            .otherwise(F.least(raw, F.lit(n_bins - 1)).cast("int")))
