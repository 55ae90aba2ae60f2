"""Encoding to a numeric model matrix.

* binary map (Yes/Male -> 1, No/Female -> 0, anything else -> null),
* ordinal map of the contract,
* one-hot indicators named ``<column>_<value>`` (no level dropped, null ->
  all zeros), levels either declared or fitted from the data in one
  aggregate pass,
* booleans to int.

The fitted :class:`EncoderModel` holds the level lists, so a scoring batch
that lacks some levels still yields the training columns (alignment).
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import (BINARY_MAP, BINARY_TEXT_COLS, ID_COL, OHE_COLS, OHE_DOMAINS, ORDINAL_MAPS,
                      TARGET, TENURE_LABELS)


def map_expr(col: str, mapping: dict[str, int]) -> Column:
    """Lookup in a literal map; a missing key or null gives null."""
    pairs = []
    for k, v in mapping.items():
        pairs += [F.lit(k), F.lit(v)]
    return F.create_map(*pairs)[F.col(col)]


def encode_binary(df: DataFrame, cols: list[str] = BINARY_TEXT_COLS) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: map_expr(c, BINARY_MAP).cast("int") for c in cols if c in present})


def encode_ordinal(df: DataFrame, maps: dict[str, dict[str, int]] = ORDINAL_MAPS) -> DataFrame:
    present = set(df.columns)
    return df.withColumns({c: map_expr(c, m).cast("int") for c, m in maps.items() if c in present})


def onehot_name(col: str, value: str) -> str:
    return f"{col}_{value}"


def fit_onehot_levels(df: DataFrame, cols: list[str] = OHE_COLS,
                      declared: dict[str, list[str]] | None = None) -> dict[str, list[str]]:
    """Sorted distinct non-null levels per column in one aggregate pass.

    ``tenure_bucket`` is an ordered category: all its labels are kept, in
    label order, even when empty. The distinct (column, level) pairs are found
    by a grouped aggregate; each becomes a column of the encoded table.
    """
    declared = declared or {}
    present = set(df.columns)
    todo = [c for c in cols if c in present and c not in declared and c != "tenure_bucket"]
    levels = {}
    if todo:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("name"), F.col(c).cast("string").alias("level"))
                                    for c in todo])).alias("pair")
        found = df.select(pairs).select("pair.*").filter("level IS NOT NULL").distinct().collect()
        levels = {c: sorted(r.level for r in found if r.name == c) for c in todo}
    for c in cols:
        if c in declared:
            levels[c] = list(declared[c])
        elif c == "tenure_bucket":
            levels[c] = list(TENURE_LABELS)
    return {c: levels[c] for c in cols if c in levels}


def onehot(df: DataFrame, levels: dict[str, list[str]]) -> DataFrame:
    """Replace each source column with its int indicators (appended at the end)."""
    present = df.columns
    keep = [c for c in present if c not in levels]
    ind = [F.coalesce((F.col(c) == F.lit(v)).cast("int"), F.lit(0)).alias(onehot_name(c, v))
           for c, vals in levels.items() if c in present for v in vals]
    missing = [F.lit(0).alias(onehot_name(c, v))
               for c, vals in levels.items() if c not in present for v in vals]
    return df.select(*[F.col(c) for c in keep], *ind, *missing)


def bools_to_int(df: DataFrame) -> DataFrame:
    cols = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: F.col(c).cast("int") for c in cols}) if cols else df


@dataclass(frozen=True)
class EncoderModel:
    levels: dict[str, list[str]]
    keep_id: bool = True
    feature_names: list[str] = field(default_factory=list)

    def transform(self, df: DataFrame) -> DataFrame:
        out = encode_binary(df)
        out = encode_ordinal(out)
        out = onehot(out, self.levels)
        out = bools_to_int(out)
        if not self.keep_id and ID_COL in out.columns:
            out = out.drop(ID_COL)
        return out


def fit_encoder(df: DataFrame, declared: bool = False, keep_id: bool = True) -> EncoderModel:
    """Fit one-hot levels (from the data, or the declared domains)."""
    levels = (fit_onehot_levels(df, OHE_COLS, OHE_DOMAINS) if declared
              else fit_onehot_levels(df, OHE_COLS))
    probe = EncoderModel(levels, keep_id=False)
    names = [c for c in probe.transform(df.limit(0)).columns if c != TARGET]
    return EncoderModel(levels, keep_id=keep_id, feature_names=names)


def encode_features(df: DataFrame, declared: bool = False, keep_id: bool = True) -> DataFrame:
    """Whole encoder on a featured frame: features + label (+ id)."""
    return fit_encoder(df, declared=declared, keep_id=keep_id).transform(df)


def align_columns(df: DataFrame, columns: list[str], fill: float = 0.0,
                  keep: tuple[str, ...] = (ID_COL,)) -> DataFrame:
    """Training column order; missing ones filled with ``fill``, extras dropped.

    Columns named in ``keep`` (the row id) ride along in front.
    """
    present = set(df.columns)
    passthrough = [F.col(c) for c in keep if c in present and c not in columns]
    body = [F.col(c) if c in present else F.lit(fill).alias(c) for c in columns]
    return df.select(*passthrough, *body)
