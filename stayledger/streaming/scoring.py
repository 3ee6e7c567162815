"""Scoring records: one column expression for tables and streams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import risk_band, threshold_label

# Fixed value: the operating threshold of the stream.
DEFAULT_THRESHOLD = 0.30


def scored_record(
    df: DataFrame,
    id_col: str,
    probability: Column,
    label: str | None = None,
    threshold: float = DEFAULT_THRESHOLD,
    keep: tuple[str, ...] = (),
) -> DataFrame:
    """Probability (4 digits), label and band from the unrounded value, and the true label if any."""
    truth = F.col(label) if label else F.lit(None).cast("int")
    return df.withColumn("_p", probability).select(
        id_col,
        F.round("_p", 4).alias("probability"),
        threshold_label("_p", threshold).alias("prediction"),
        risk_band("_p").alias("risk_band"),
        truth.alias("true_label"),
        *keep,
    )
