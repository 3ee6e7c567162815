"""Scaling of continuous columns with train-fitted statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .ordering import exact_quantiles

KINDS = ("robust", "standard", "minmax")


def binary_flags_per_column(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(feature, is_binary): all non-null values are 0 or 1; an all-null column counts as binary."""
    only01 = df.agg(
        *[
            F.coalesce(F.bool_and(F.col(f"`{c}`").cast("double").isin(0.0, 1.0)), F.lit(True)).alias(c)
            for c in columns
        ]
    )
    return only01.unpivot([], [F.col(f"`{c}`") for c in columns], "feature", "is_binary")


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, T.NumericType)]


def columns_to_scale(df: DataFrame, target: str, skip: Sequence[str] = ()) -> list[str]:
    candidates = [c for c in numeric_columns(df) if c != target and c not in skip]
    if not candidates:
        return []
    rows = binary_flags_per_column(df, candidates).collect()
    continuous = {r["feature"] for r in rows if not r["is_binary"]}
    return [c for c in candidates if c in continuous]


@dataclass(frozen=True)
class ScalerState:
    kind: str
    columns: tuple[str, ...]
    center: dict[str, float | None]
    scale: dict[str, float | None]

    def apply(self, df: DataFrame) -> DataFrame:
        return df.withColumns(
            {
                c: (F.col(f"`{c}`") - F.lit(self.center[c])) / F.lit(self.scale[c])
                for c in self.columns
                if c in df.columns
            }
        )

    def table(self, spark: SparkSession) -> DataFrame:
        rows = [(c, self.center[c], self.scale[c]) for c in self.columns]
        return spark.createDataFrame(rows, "feature string, center double, scale double")


def fit_scaler(train: DataFrame, columns: Sequence[str], kind: str = "robust") -> ScalerState:
    """Center and scale per column; a spread of zero scales by one."""
    if kind not in KINDS:
        raise ValueError(f"unknown scaler {kind!r}; use one of {KINDS}")
    columns = list(columns)
    if not columns:
        return ScalerState(kind, (), {}, {})
    if kind == "robust":
        quartiles = exact_quantiles(
            train, {c: F.col(f"`{c}`") for c in columns}, [0.25, 0.5, 0.75]
        )
        pairs = {
            c: (q.values[1], q.values[2] - q.values[0] if q.n else None)
            for c, q in quartiles.items()
        }
    else:
        low, spread = (F.avg, F.stddev_pop) if kind == "standard" else (F.min, _range_width)
        row = train.agg(
            *[low(F.col(f"`{c}`").cast("double")).alias(f"c{i}") for i, c in enumerate(columns)],
            *[spread(F.col(f"`{c}`").cast("double")).alias(f"s{i}") for i, c in enumerate(columns)],
        ).first()
        pairs = {c: (row[f"c{i}"], row[f"s{i}"]) for i, c in enumerate(columns)}
    return ScalerState(
        kind,
        tuple(columns),
        {c: center for c, (center, _) in pairs.items()},
        {c: 1.0 if spread in (None, 0) else float(spread) for c, (_, spread) in pairs.items()},
    )


def _range_width(c):
    return F.max(c) - F.min(c)


def scale_train_test(
    train: DataFrame, test: DataFrame, target: str, kind: str = "robust", skip: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame, ScalerState]:
    state = fit_scaler(train, columns_to_scale(train, target, skip), kind)
    return state.apply(train), state.apply(test), state
