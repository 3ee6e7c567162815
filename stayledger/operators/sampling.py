"""Seeded samples that any engine with md5 can reproduce."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import HASH_RANGE, hash_rank_key
from .ordering import order_statistics


def sample_n(df: DataFrame, id_col: str, n: int, seed: int | str) -> DataFrame:
    """n rows without replacement: those with the smallest hashes (top-k per task, then merged)."""
    return df.orderBy(hash_rank_key(id_col, seed), id_col).limit(n)


def sample_fraction(df: DataFrame, id_col: str, fraction: float, seed: int | str) -> DataFrame:
    """Exactly round(fraction * rows) rows, chosen by a hash cut; no rows are shuffled.

    Rows that share the cut hash fall on the same side.
    """
    key = hash_rank_key(id_col, seed)
    counts, found = order_statistics(
        df,
        {"h": key},
        lambda _name, n: [max(round(fraction * n) - 1, 0)] if n else [],
        uniform_below=HASH_RANGE,
    )
    if not counts["h"] or round(fraction * counts["h"]) == 0:
        return df.limit(0)
    cut = next(iter(found["h"].values()))
    return df.where(key <= F.lit(cut))
