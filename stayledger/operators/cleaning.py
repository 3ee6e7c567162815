"""Structural cleaning (safe on all rows) and train-fitted imputation."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import cap_at, flag, floor_at, total
from ..schema import Roles


def drop_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.drop(*columns)


def drop_exact_duplicates(df: DataFrame) -> DataFrame:
    """One copy of every distinct row. Copies are folded map-side before the shuffle."""
    return df.dropDuplicates()


def clip_negative(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, floor_at(column, 0.0))


def cap_ceiling(df: DataFrame, column: str, ceiling: float) -> DataFrame:
    return df.withColumn(column, cap_at(column, ceiling))


def party_size(parts: Sequence[str]) -> Column:
    return total([F.coalesce(F.col(p), F.lit(0)) for p in parts])


def drop_empty_parties(df: DataFrame, parts: Sequence[str]) -> DataFrame:
    return df.where(party_size(parts) > 0)


def fill_with_flag(df: DataFrame, columns: Sequence[str], fill: float = 0) -> DataFrame:
    """Missing has a meaning here: record it in a flag, then fill with a sentinel."""
    flags = {f"{c}_missing": flag(F.col(c).isNull()) for c in columns}
    fills = {c: F.coalesce(F.col(c), F.lit(fill).cast(df.schema[c].dataType)) for c in columns}
    return df.withColumns(flags).withColumns(fills)


def fill_integer(df: DataFrame, column: str, fill: int = 0) -> DataFrame:
    return df.withColumn(column, F.coalesce(F.col(column), F.lit(fill)).cast("int"))


def modal_value(train: DataFrame, column: str):
    """Most frequent non-null value, the smallest one on a tie; None when all are null."""
    top = (
        train.where(F.col(column).isNotNull())
        .groupBy(column)
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy(F.desc("n"), F.asc(column))
        .limit(1)
        .collect()
    )
    return top[0][0] if top else None


def impute_mode(
    train: DataFrame, others: Sequence[DataFrame], column: str, with_flag: bool = False
) -> tuple[list[DataFrame], object]:
    """Fill a column of all frames with the mode of `train` alone."""
    fill = modal_value(train, column)

    def filled(df: DataFrame) -> DataFrame:
        if with_flag:
            df = df.withColumn(f"{column}_missing", flag(F.col(column).isNull()))
        if fill is None:
            return df
        return df.withColumn(column, F.coalesce(F.col(column), F.lit(fill)))

    return [filled(train), *[filled(o) for o in others]], fill


def clean(df: DataFrame, roles: Roles = Roles(), ceiling: float = 1000.0) -> DataFrame:
    """All structural steps in order: leak columns out, copies out, values repaired, gaps flagged."""
    return (
        df.transform(drop_columns, roles.leaks)
        .transform(drop_exact_duplicates)
        .transform(clip_negative, roles.price)
        .transform(cap_ceiling, roles.price, ceiling)
        .transform(drop_empty_parties, roles.party)
        .transform(fill_with_flag, roles.sentinel_filled)
        .transform(fill_integer, "children")
    )


def cleaning_audit(df: DataFrame, roles: Roles = Roles(), ceiling: float = 1000.0) -> DataFrame:
    """How many rows each rule touches, counted in one pass."""
    rules: Mapping[str, Column] = {
        "negative_price": F.col(roles.price) < 0,
        "price_above_ceiling": F.col(roles.price) > ceiling,
        "empty_party": party_size(roles.party) == 0,
        **{f"{c}_null": F.col(c).isNull() for c in roles.sentinel_filled},
        "children_null": F.col("children").isNull(),
    }
    counts = df.agg(
        F.count(F.lit(1)).alias("rows"), *[F.count_if(c).alias(n) for n, c in rules.items()]
    )
    return counts.unpivot([], ["rows", *rules], "rule", "n_rows")


def remaining_nulls(df: DataFrame) -> DataFrame:
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in df.columns])
    return counts.unpivot([], df.columns, "column_name", "n_null").where("n_null > 0")
