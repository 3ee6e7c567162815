"""Profiling: one pass per question, small results."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from .ordering import exact_quantiles

LEAK_THRESHOLD = 0.85


def long_row(entries: Sequence[tuple[str, dict[str, Column]]], key: str = "feature") -> Column:
    """Generator column: one output row per entry, with its name and its values."""
    cells = [
        F.struct(F.lit(name).alias(key), *[c.alias(k) for k, c in values.items()])
        for name, values in entries
    ]
    return F.inline(F.array(*cells))


def guarded_corr(x: Column, y: Column) -> Column:
    """Pearson correlation over rows where both are present; null when either is constant."""
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.stddev_pop(x) * F.stddev_pop(y)
    return F.try_divide(F.covar_pop(x, y), F.nullif(spread, F.lit(0.0)))


def corrected_skew(c: Column) -> Column:
    """Bias-corrected skewness, null below three values or without spread."""
    n = F.count(c).cast("double")
    skew = F.when(F.stddev_pop(c) > 0, F.skewness(c))
    return F.when(n >= 3, skew * F.sqrt(n * (n - 1)) / (n - 2))


def corrected_kurtosis(c: Column) -> Column:
    """Bias-corrected excess kurtosis, null below four values or without spread."""
    n = F.count(c).cast("double")
    g2 = F.when(F.stddev_pop(c) > 0, F.kurtosis(c))
    return F.when(n >= 4, (n - 1) / ((n - 2) * (n - 3)) * ((n + 1) * g2 + 6))


def class_balance(df: DataFrame, target: str) -> DataFrame:
    return df.agg(F.avg(target).alias("positive_rate")).select(
        "positive_rate",
        F.try_divide(1 - F.col("positive_rate"), F.col("positive_rate")).alias("imbalance_ratio"),
    )


def class_counts(df: DataFrame, target: str) -> DataFrame:
    return df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))


def numeric_summary(
    df: DataFrame,
    columns: Sequence[str],
    fractions: dict[str, float] | None = None,
    kurtosis: bool = False,
) -> DataFrame:
    """Count, moments, quantiles and shape of each numeric column, one output row per column."""
    fractions = fractions or {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95}
    spots = exact_quantiles(df, columns, list(fractions.values()))
    aggs = []
    for i, c in enumerate(columns):
        v = F.col(c).cast("double")
        aggs += [
            F.count(v).alias(f"n{i}"),
            F.avg(v).alias(f"mean{i}"),
            F.stddev_samp(v).alias(f"std{i}"),
            F.min(v).alias(f"min{i}"),
            F.max(v).alias(f"max{i}"),
            corrected_skew(v).alias(f"skew{i}"),
            corrected_kurtosis(v).alias(f"kurt{i}"),
        ]
    entries = []
    for i, c in enumerate(columns):
        cells = {
            "n": F.col(f"n{i}"),
            "mean": F.col(f"mean{i}"),
            "std": F.col(f"std{i}"),
            "min": F.col(f"min{i}"),
            **{
                name: F.lit(v).cast("double")
                for name, v in zip(fractions, spots[c].values, strict=True)
            },
            "max": F.col(f"max{i}"),
            "skew": F.col(f"skew{i}"),
        }
        if kurtosis:
            cells["kurtosis"] = F.col(f"kurt{i}")
        entries.append((c, cells))
    return df.agg(*aggs).select(long_row(entries))


def rate_by(df: DataFrame, keys: Sequence[str], target: str, min_rows: int = 0) -> DataFrame:
    """Positive rate and size per group, highest rate first."""
    out = df.groupBy(*keys).agg(
        F.avg(target).alias("cancel_rate"), F.count(target).alias("n")
    )
    if min_rows:
        out = out.where(F.col("n") >= min_rows)
    return out.orderBy(F.desc("cancel_rate"), *keys)


def lift_by(df: DataFrame, key: str, target: str) -> DataFrame:
    """Positive rate per level relative to the overall rate, from the same grouping."""
    per_level = df.groupBy(key).agg(F.sum(target).alias("s"), F.count(target).alias("n"))
    overall = per_level.agg(F.try_divide(F.sum("s").cast("double"), F.sum("n"))).scalar()
    rate = F.try_divide(F.col("s").cast("double"), F.col("n"))
    return per_level.select(
        key, rate.alias("cancel_rate"), "n", F.try_divide(rate, overall).alias("lift_vs_baseline")
    )


def leakage_scan(
    df: DataFrame, columns: Sequence[str], target: str, threshold: float = LEAK_THRESHOLD
) -> DataFrame:
    """Absolute correlation of every numeric with the target; above the threshold is suspicious."""
    y = F.col(target)
    row = df.agg(
        *[F.abs(guarded_corr(F.col(c), y)).alias(f"r{i}") for i, c in enumerate(columns)]
    )
    entries = [(c, {"abs_corr": F.col(f"r{i}")}) for i, c in enumerate(columns)]
    return (
        row.select(long_row(entries))
        .withColumn("suspicious", F.coalesce(F.col("abs_corr") > threshold, F.lit(False)))
        .orderBy(F.desc_nulls_last("abs_corr"), "feature")
    )


def leakage_by_level(df: DataFrame, columns: Sequence[str], target: str) -> DataFrame:
    """Lowest and highest positive rate over the levels of each categorical."""
    cells = [(c, {"level": F.col(c).cast("string")}) for c in columns]
    return (
        df.select(target, long_row(cells))
        .where("level is not null")
        .groupBy("feature", "level")
        .agg(F.avg(target).alias("rate"))
        .groupBy("feature")
        .agg(F.min("rate").alias("min_rate"), F.max("rate").alias("max_rate"))
    )


def missingness(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Null count and share per column that has any."""
    columns = list(columns or df.columns)
    row = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        *[F.count_if(F.col(c).isNull()).alias(f"m{i}") for i, c in enumerate(columns)],
    )
    cells = [(c, {"n_missing": F.col(f"m{i}")}) for i, c in enumerate(columns)]
    return (
        row.select("_rows", long_row(cells, key="column_name"))
        .where("n_missing > 0")
        .select("column_name", "n_missing", (F.col("n_missing") / F.col("_rows")).alias("fraction"))
        .orderBy(F.desc("fraction"), "column_name")
    )


def cardinality(
    df: DataFrame, columns: Sequence[str], approximate: bool = False
) -> DataFrame:
    """Distinct non-null values per column; at most one means constant.

    The exact form groups (column, value) pairs, so a column's values spread over all tasks.
    """
    if approximate:
        row = df.agg(
            *[F.approx_count_distinct(c).alias(f"d{i}") for i, c in enumerate(columns)]
        )
        counts = row.select(
            long_row([(c, {"n_distinct": F.col(f"d{i}")}) for i, c in enumerate(columns)])
        )
    else:
        cells = [(c, {"value": F.col(c).cast("string")}) for c in columns]
        counts = (
            df.select(long_row(cells))
            .distinct()
            .groupBy("feature")
            .agg(F.count("value").alias("n_distinct"))
        )
    return counts.withColumn("is_constant", F.col("n_distinct") <= 1)


FLAT = 1e-12  # share of the squared size that a spread must exceed, else it is rounding


def pair_sums(columns: int):
    """Function of the Arrow batches of one task: the sums of every pair of columns, as one frame.

    A pair's sums run over the rows where both columns are present; batches fold into six p x p
    blocks, so memory and output depend on the number of columns only.
    """

    def run(batches):
        import numpy as np
        import pandas as pd

        n, sx, sxx, sxy = (np.zeros((columns, columns)) for _ in range(4))
        for batch in batches:
            x = batch.to_numpy(dtype="float64", na_value=np.nan)
            there = ~np.isnan(x)
            x, there = np.where(there, x, 0.0), there.astype("float64")
            n += there.T @ there
            sx += x.T @ there
            sxx += (x * x).T @ there
            sxy += x.T @ x
        i, j = (axis.ravel() for axis in np.indices((columns, columns)))
        yield pd.DataFrame(
            {"i": i, "j": j, "n": n.ravel(), "sx": sx.ravel(), "sy": sx.T.ravel(),
             "sxx": sxx.ravel(), "syy": sxx.T.ravel(), "sxy": sxy.ravel()}
        )

    return run


def corr_matrix(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Pairwise correlations, both triangles and the diagonal.

    Columns are centered on their means, then one pass adds up products of column pairs in blocks and
    folds them by pair, so the plan does not grow with the number of pairs. Missing values and
    not-a-number leave the pair's row out; a pair with a constant column has no correlation.
    """
    values = df.select(*[nan_to_null(F.col(c).cast("double")).alias(f"v{i}") for i, c in enumerate(columns)])
    middle = values.agg(*[F.avg(f"v{i}").alias(f"v{i}") for i in range(len(columns))]).first()
    centered = values.select(*[(F.col(f"v{i}") - F.lit(middle[i] or 0.0)).alias(f"v{i}") for i in range(len(columns))])
    shape = "i int, j int, n double, sx double, sy double, sxx double, syy double, sxy double"
    blocks = centered.mapInPandas(pair_sums(len(columns)), shape)
    sums = blocks.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in ("n", "sx", "sy", "sxx", "syy", "sxy")])
    n, sx, sy = F.col("n"), F.col("sx"), F.col("sy")
    x, y = F.col("sxx") - F.try_divide(sx * sx, n), F.col("syy") - F.try_divide(sy * sy, n)
    spread = (x > F.lit(FLAT) * F.col("sxx")) & (y > F.lit(FLAT) * F.col("syy"))
    r = F.when(F.col("i") == F.col("j"), F.lit(1.0)).otherwise((F.col("sxy") - sx * sy / n) / F.sqrt(x * y))
    names = F.array(*[F.lit(c) for c in columns])
    return sums.select(
        F.get(names, F.col("i")).alias("feature"),
        F.get(names, F.col("j")).alias("other"),
        F.when(spread, r).alias("corr"),
    )


def pivot_rate(
    df: DataFrame, row_key: str, column_key: str, levels: Sequence[str], target: str
) -> DataFrame:
    """Positive rate by row key, one column per listed level."""
    return df.groupBy(row_key).pivot(column_key, list(levels)).agg(F.avg(target))


def seasonality(df: DataFrame, month_name: str, month_number: Column, target: str) -> DataFrame:
    return (
        df.groupBy(F.col(month_name), month_number.alias("month_num"))
        .agg(F.count(F.lit(1)).alias("bookings"), F.avg(target).alias("cancel_rate"))
        .orderBy("month_num")
    )


def iqr_outliers(df: DataFrame, columns: Sequence[str], k: float = 1.5) -> DataFrame:
    """Values strictly beyond the quartiles by more than k interquartile ranges."""
    quartiles = exact_quantiles(df, columns, [0.25, 0.75])
    fences = {}
    for c, q in quartiles.items():
        if q.n:
            q1, q3 = q.values
            fences[c] = (q1 - k * (q3 - q1), q3 + k * (q3 - q1))
    row = df.agg(
        *[
            F.count_if((F.col(c) < lo) | (F.col(c) > hi)).alias(f"o{i}")
            for i, (c, (lo, hi)) in enumerate(fences.items())
        ]
    )
    cells = [
        (c, {"n_outliers": F.col(f"o{i}"), "lower": F.lit(lo), "upper": F.lit(hi)})
        for i, (c, (lo, hi)) in enumerate(fences.items())
    ]
    return row.select(long_row(cells))


def box_stats(df: DataFrame, columns: Sequence[str], target: str, classes: Sequence) -> DataFrame:
    """Quartiles, whiskers and outlier count per column and class.

    Whiskers end at the furthest value within 1.5 interquartile ranges of the box.
    """
    cells = {
        (c, level): F.when(F.col(target) == level, F.col(c).cast("double"))
        for c in columns
        for level in classes
    }
    spots = exact_quantiles(
        df, {f"b{i}": v for i, v in enumerate(cells.values())}, [0.25, 0.5, 0.75]
    )
    aggs, entries = [], []
    for i, ((c, level), v) in enumerate(cells.items()):
        if not spots[f"b{i}"].n:
            continue
        q1, q2, q3 = spots[f"b{i}"].values
        reach = 1.5 * (q3 - q1)
        inside = v.between(q1 - reach, q3 + reach)
        aggs += [
            F.min(F.when(inside, v)).alias(f"lo{i}"),
            F.max(F.when(inside, v)).alias(f"hi{i}"),
            F.count_if(~inside).alias(f"out{i}"),
        ]
        entries.append(
            (
                c,
                {
                    target: F.lit(level),
                    "q1": F.lit(q1),
                    "median": F.lit(q2),
                    "q3": F.lit(q3),
                    "whisker_low": F.col(f"lo{i}"),
                    "whisker_high": F.col(f"hi{i}"),
                    "n_outliers": F.col(f"out{i}"),
                },
            )
        )
    return df.agg(*aggs).select(long_row(entries))


def histogram(
    df: DataFrame, column: str, bins: int, keys: Sequence[str] = ()
) -> DataFrame:
    """Equal-width bins between the column's minimum and maximum; the last bin is closed."""
    low, high = df.agg(F.min(column).cast("double"), F.max(column).cast("double")).first()
    if low is None:
        return df.groupBy(*keys, F.lit(0).alias("bin")).agg(F.count(F.lit(1)).alias("n")).limit(0)
    width = (high - low) / bins or 1.0
    slot = F.floor((F.col(column) - F.lit(low)) / F.lit(width)).cast("int")
    return (
        df.where(F.col(column).isNotNull())
        .groupBy(*keys, F.least(slot, F.lit(bins - 1)).alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )


def composition(df: DataFrame, path: Sequence[str]) -> DataFrame:
    """Counts at every prefix of a path of columns; depth 0 is the total."""
    depth = reduce(lambda a, b: a + b, [1 - F.grouping(c) for c in path])
    return df.rollup(*path).agg(depth.cast("int").alias("depth"), F.count(F.lit(1)).alias("n"))


def category_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    cells = [(c, {"level": F.col(c).cast("string")}) for c in columns]
    return (
        df.select(long_row(cells))
        .where("level is not null")
        .groupBy("feature", "level")
        .agg(F.count(F.lit(1)).alias("n"))
        .orderBy("feature", F.desc("n"), "level")
    )
