"""Demand series, lag features, rolling-origin backtests and forecasts."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import month_angle
from ..session import null_safe_join, settle

LAGS = (1, 2, 3, 12)
ROLLS = (3, 6)
SEASON = 12
RECENT = 3
FEATURES = [
    *[f"lag_{k}" for k in LAGS],
    *[f"roll_mean_{k}" for k in ROLLS],
    "month_sin",
    "month_cos",
]


def demand_series(
    df: DataFrame, period: str, target: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Gross, cancelled and realised bookings per period, for each series key."""
    counts = df.groupBy(*keys, period).agg(
        F.count(F.lit(1)).alias("gross_bookings"), F.sum(target).alias("cancellations")
    )
    return counts.withColumns(
        {
            "realised_demand": F.col("gross_bookings") - F.col("cancellations"),
            "year": F.floor(F.col(period) / 100).cast("int"),
            "month": (F.col(period) % 100).cast("int"),
        }
    )


def _month_index(period: str) -> Column:
    return F.floor(F.col(period) / 100).cast("int") * 12 + F.col(period) % 100 - 1


def _period_of_index(index: Column) -> Column:
    return (F.floor(index / 12) * 100 + index % 12 + 1).cast("int")


def densify(series: DataFrame, period: str, keys: Sequence[str] = ()) -> DataFrame:
    """Insert absent months of each series with zero demand, so that a lag is a calendar lag."""
    index = _month_index(period)
    spans = series.groupBy(*keys).agg(F.min(index).alias("_lo"), F.max(index).alias("_hi"))
    months = spans.select(*keys, F.explode(F.sequence("_lo", "_hi")).alias("_i"))
    calendar = months.select(*keys, _period_of_index(F.col("_i")).alias(period))
    full = null_safe_join(calendar, series, [*keys, period], "left")
    zero = {c: F.coalesce(F.col(c), F.lit(0)) for c in ("gross_bookings", "cancellations", "realised_demand")}
    return full.withColumns(
        {
            **zero,
            "year": F.floor(F.col(period) / 100).cast("int"),
            "month": (F.col(period) % 100).cast("int"),
        }
    )


def _history(period: str, keys: Sequence[str]):
    return Window.partitionBy(*(keys or [F.lit(0)])).orderBy(period)


def with_time_features(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
) -> DataFrame:
    """Lags, rolling means of strictly earlier periods (null until full) and calendar angles.

    A series has as many rows as the calendar has months, so its window stays small.
    """
    order = _history(period, keys)
    rolls = {}
    for k in ROLLS:
        before = order.rowsBetween(-k, -1)
        rolls[f"roll_mean_{k}"] = F.when(
            F.count(target).over(before) == k, F.avg(target).over(before)
        )
    return series.withColumns(
        {
            **{f"lag_{k}": F.lag(target, k).over(order) for k in LAGS},
            **rolls,
            "month_sin": F.sin(month_angle("month")),
            "month_cos": F.cos(month_angle("month")),
        }
    )


def seasonal_naive(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    out: str = "forecast",
) -> DataFrame:
    """Each period as the same month one year earlier."""
    return series.withColumn(out, F.lag(target, SEASON).over(_history(period, keys)))


def _errors(actual: str, forecast: str) -> tuple[Column, Column]:
    gap = F.col(actual) - F.col(forecast)
    share = F.abs(gap / (F.col(actual) + F.lit(1e-9)))
    return F.avg(F.abs(gap)), F.avg(share) * 100


def forecast_errors(
    df: DataFrame, actual: str, forecast: str, keys: Sequence[str] = ()
) -> DataFrame:
    """Mean absolute error and mean absolute percentage error where both values exist."""
    mae, mape = _errors(actual, forecast)
    usable = df.where(F.col(actual).isNotNull() & F.col(forecast).isNotNull())
    return usable.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"), mae.alias("mae"), mape.alias("mape")
    )


def origins(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    min_train: int = 18,
) -> DataFrame:
    """Feature rows without nulls, numbered per series; rows from `min_train` on are tested."""
    feats = with_time_features(series, period, target, keys).dropna(subset=FEATURES)
    step = F.row_number().over(_history(period, keys)) - 1
    return feats.withColumn("step", step).withColumn("is_tested", F.col("step") >= min_train)


def backtest_naive(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    min_train: int = 18,
) -> DataFrame:
    tested = origins(series, period, target, keys, min_train).where("is_tested")
    return forecast_errors(tested, target, f"lag_{SEASON}", keys)


def default_regressor(label: str) -> GBTRegressor:
    return GBTRegressor(
        featuresCol="features",
        labelCol=label,
        maxIter=50,
        stepSize=0.1,
        maxDepth=4,
        minInstancesPerNode=5,
        seed=42,
    )


def _assembled(df: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=FEATURES, outputCol="features").transform(df)


def backtest_model(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    min_train: int = 18,
    make: Callable | None = None,
) -> DataFrame:
    """Rolling origin: for each tested period, fit on all earlier feature rows of all series.

    One fit per period serves every series, so the loop length is the calendar's, not the data's.
    Returns the errors of the model and of the seasonal-naive forecast on the same points.
    """
    make = make or default_regressor
    rows = settle(origins(series, period, target, keys, min_train))
    tested = [r[0] for r in rows.where("is_tested").select(period).distinct().orderBy(period).collect()]
    cells = _assembled(rows)
    parts = None
    for p in tested:
        model = make(target).fit(cells.where(F.col(period) < F.lit(p)))
        one = model.transform(cells.where((F.col(period) == F.lit(p)) & F.col("is_tested")))
        one = one.select(*keys, period, target, f"lag_{SEASON}", "prediction")
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        raise ValueError("backtest: no period has enough history")
    return _compared(parts, target, keys)


def _compared(parts: DataFrame, target: str, keys: Sequence[str]) -> DataFrame:
    """Errors of `prediction` and of the seasonal-naive forecast on the same points."""
    model_mae, model_mape = _errors(target, "prediction")
    naive_mae, naive_mape = _errors(target, f"lag_{SEASON}")
    both = parts.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n_points"),
        model_mae.alias("model_mae"),
        model_mape.alias("model_mape"),
        naive_mae.alias("naive_mae"),
        naive_mape.alias("naive_mape"),
    )
    return both.withColumn("model_beats_naive", F.col("model_mae") < F.col("naive_mae"))


def backtest_linear(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    min_train: int = 18,
    features: Sequence[str] = tuple(FEATURES),
) -> DataFrame:
    """`backtest_model` with least squares, from one pass over the rows.

    Products of features and target are summed once per period, and running sums over the calendar
    give every origin the normal equations of all earlier periods; each is one small solve, whatever
    the number of series. Features that say the same as others share their weight. An origin without
    any earlier row forecasts 0. No tested point gives no row.
    """
    rows = settle(origins(series, period, target, keys, min_train))
    x = [*[F.col(f).cast("double") for f in features], F.lit(1.0)]
    y = F.col(target).cast("double")
    m = len(x)
    upper = [(i, j) for i in range(m) for j in range(i, m)]
    products = [F.sum(x[i] * x[j]).alias(f"a{i}_{j}") for i, j in upper]
    products += [F.sum(x[i] * y).alias(f"b{i}") for i in range(m)]
    per_period = rows.groupBy(F.col(period).alias("_period")).agg(*products)
    # One row per calendar period, so the window's single task stays small.
    before = Window.partitionBy(F.lit(0)).orderBy("_period").rowsBetween(Window.unboundedPreceding, -1)
    names = [c for c in per_period.columns if c != "_period"]
    sums = per_period.select(
        "_period", F.array(*[F.coalesce(F.sum(c).over(before), F.lit(0.0)) for c in names]).alias("sums")
    )

    def solve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            weights = []
            for flat in batch["sums"]:
                a = np.zeros((m, m))
                for (i, j), v in zip(upper, flat, strict=False):
                    a[i, j] = a[j, i] = v
                size = np.sqrt(np.where(np.diag(a) > 0, np.diag(a), 1.0))
                scaled = a / size[:, None] / size[None, :]
                weights.append(np.linalg.lstsq(scaled, np.asarray(flat[len(upper) :]) / size, rcond=1e-12)[0] / size)
            yield pd.DataFrame({"_period": batch["_period"], "_w": weights})

    kind = series.schema[period].dataType.simpleString()
    solved = sums.mapInPandas(solve, f"_period {kind}, _w array<double>")
    tested = rows.where("is_tested").join(solved, F.col(period) == F.col("_period"))
    forecast = reduce(Column.__add__, [F.col("_w")[i] * x[i] for i in range(m)])
    return _compared(tested.withColumn("prediction", forecast), target, keys)


def next_period_rows(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    **more: Column,
) -> DataFrame:
    """Feature row of the period after each series' last one, with `more` columns over its series."""
    last = series.groupBy(*keys).agg(F.max(_month_index(period)).alias("_hi"))
    upcoming = last.select(*keys, _period_of_index(F.col("_hi") + 1).alias(period)).withColumn(
        "month", (F.col(period) % 100).cast("int")
    )
    grown = series.unionByName(upcoming, allowMissingColumns=True)
    feats = with_time_features(grown, period, target, keys).withColumns(more)
    return feats.where(F.col(target).isNull())


def forecast_next(
    series: DataFrame,
    period: str,
    target: str = "realised_demand",
    keys: Sequence[str] = (),
    make: Callable | None = None,
) -> DataFrame:
    """Predict the next period of each series, by a model fitted on all full feature rows.

    A series too short for all lags and means gets the mean of its last months, up to RECENT of them;
    `by_model` tells which way was taken.
    """
    make = make or default_regressor
    history = with_time_features(series, period, target, keys).dropna(subset=FEATURES)
    last = _history(period, keys).rowsBetween(-RECENT, -1)
    upcoming = next_period_rows(series, period, target, keys, recent=F.avg(target).over(last))
    full = reduce(Column.__and__, [F.col(c).isNotNull() for c in FEATURES])
    short = upcoming.where(~full).select(
        *keys, period, F.col("recent").alias("forecast"), F.lit(False).alias("by_model")
    )
    if history.isEmpty():
        return short
    model = make(target).fit(_assembled(history))
    known = model.transform(_assembled(upcoming.where(full))).select(
        *keys, period, F.col("prediction").alias("forecast"), F.lit(True).alias("by_model")
    )
    return known.unionByName(short)
