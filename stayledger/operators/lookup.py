"""Attach fitted state to rows: size-checked broadcast, else a join that spreads hot levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BROADCAST_ROWS = 500_000
HOT_SHARE = 1_000  # a level is hot when it holds at least 1/HOT_SHARE of the fitted rows
SPREAD = 1_024


def attach(
    df: DataFrame,
    state: DataFrame,
    on: Sequence[str],
    weight: str = "n",
    broadcast_rows: int = BROADCAST_ROWS,
    hot_share: int = HOT_SHARE,
    state_rows: int | None = None,
) -> DataFrame:
    """Left join of rows to a settled state table that holds one row per key and its row count.

    A state of at most `broadcast_rows` rows is broadcast. A larger one is joined by shuffle,
    except for its hot keys: there are at most `hot_share` of them by definition, so those are
    broadcast, and the rows they serve get a scattering salt that keeps them off any one task.
    `state_rows` saves counting a state whose size the caller has just counted.
    """
    on = list(on)
    values = [c for c in state.columns if c not in on and c != weight]
    if state_rows is None:
        state_rows = state.limit(broadcast_rows + 1).count()
    if state_rows <= broadcast_rows:
        return df.join(F.broadcast(state.select(*on, *values)), on, "left")

    total = state.agg(F.sum(weight)).first()[0]
    hot = state.where(F.col(weight) * hot_share >= total).select(
        *on, F.lit(True).alias("_hot"), *[F.col(v).alias(f"_hot_{v}") for v in values]
    )
    scatter = F.pmod(F.xxhash64(*[F.col(c) for c in df.columns]), F.lit(SPREAD)) + 1
    tagged = df.join(F.broadcast(hot), on, "left").withColumn(
        "_salt", F.when(F.col("_hot"), scatter).otherwise(F.lit(0)).cast("bigint")
    )
    cold = state.select(*on, F.lit(0).cast("bigint").alias("_salt"), *values)
    joined = tagged.join(cold, [*on, "_salt"], "left")
    return joined.select(
        *df.columns, *[F.coalesce(F.col(f"_hot_{v}"), F.col(v)).alias(v) for v in values]
    )
