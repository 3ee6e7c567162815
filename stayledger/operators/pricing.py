"""Price grids and expected revenue, one row per priced entity; no shuffle is needed."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import revenue_at
from ..session import null_safe_join

# Grid bounds relative to the reference price, grid size, default elasticity.
LOW_FACTOR = 0.6
HIGH_FACTOR = 1.8
GRID_SIZE = 100
ELASTICITY = -1.2


def _bounds(price_min: Column | None, price_max: Column | None) -> tuple[Column, Column]:
    ref = F.col("ref_price")
    return (
        price_min if price_min is not None else ref * LOW_FACTOR,
        price_max if price_max is not None else ref * HIGH_FACTOR,
    )


def _grid_price(step: Column, low: Column, high: Column, n: int) -> Column:
    return low + step * ((high - low) / (n - 1))


def _revenue(price: Column, elasticity: Column, unit_cost: Column | None) -> Column:
    return revenue_at(
        F.col("base_demand"), price, F.col("ref_price"), F.col("base_cancel"), elasticity, unit_cost
    )


def price_curve(
    entities: DataFrame,
    elasticity: Column | None = None,
    price_min: Column | None = None,
    price_max: Column | None = None,
    n_grid: int = GRID_SIZE,
    unit_cost: Column | None = None,
) -> DataFrame:
    """Expected revenue along the price grid of each (base_demand, ref_price, base_cancel) row."""
    e = F.lit(ELASTICITY) if elasticity is None else elasticity
    low, high = _bounds(price_min, price_max)
    steps = entities.withColumn("step", F.explode(F.sequence(F.lit(0), F.lit(n_grid - 1))))
    priced = steps.withColumn("price", _grid_price(F.col("step"), low, high, n_grid))
    return priced.withColumn("revenue", _revenue(F.col("price"), e, unit_cost))


def best_price(
    entities: DataFrame,
    elasticity: Column | None = None,
    price_min: Column | None = None,
    price_max: Column | None = None,
    n_grid: int = GRID_SIZE,
    unit_cost: Column | None = None,
) -> DataFrame:
    """The first price with the highest expected revenue, computed inside each row."""
    e = F.lit(ELASTICITY) if elasticity is None else elasticity
    low, high = _bounds(price_min, price_max)

    def cell(step: Column) -> Column:
        price = _grid_price(step, low, high, n_grid)
        return F.struct(
            _revenue(price, e, unit_cost).alias("revenue"),
            (-step).alias("neg_step"),
            price.alias("price"),
        )

    best = F.array_max(F.transform(F.sequence(F.lit(0), F.lit(n_grid - 1)), cell))
    at_ref = _revenue(F.col("ref_price"), e, unit_cost)
    out = entities.withColumn("_best", best).withColumn("_ref", at_ref)
    uplift = 100 * (F.col("_best.revenue") - F.col("_ref")) / F.greatest(F.col("_ref"), F.lit(1e-9))
    return out.select(
        *entities.columns,
        F.round("_best.price", 2).alias("recommended_price"),
        F.round("_best.revenue", 2).alias("expected_revenue_at_recommended"),
        F.round("_ref", 2).alias("expected_revenue_at_reference"),
        F.round(uplift, 2).alias("revenue_uplift_pct"),
        F.col("_best.neg_step").isin(0, 1 - n_grid).alias("optimum_at_price_bound"),
    )


def elasticity_sweep(entities: DataFrame, elasticities: Sequence[float]) -> DataFrame:
    """best_price for each of a few elasticities."""
    swept = entities.withColumn(
        "elasticity", F.explode(F.array(*[F.lit(float(e)) for e in elasticities]))
    )
    return best_price(swept, F.col("elasticity"))


def base_cancel_rate(scored: DataFrame, score: str, keys: Sequence[str] = ()) -> DataFrame:
    """Mean score of all bookings, per segment if keys are given."""
    return scored.groupBy(*keys).agg(
        F.avg(score).alias("base_cancel"), F.count(F.lit(1)).alias("n_bookings")
    )


def price_for_period(
    forecasts: DataFrame,
    cancel_rates: DataFrame,
    keys: Sequence[str],
    ref_price: Column | None = None,
    elasticity: Column | None = None,
    demand_is_net: bool = False,
) -> DataFrame:
    """Price each series for its next period from its forecast and its segment's cancel rate.

    Demand net of cancellations is grossed up first, so that cancellations count once.
    `ref_price` defaults to a `ref_price` column of the forecasts.
    """
    if keys:
        joined = null_safe_join(forecasts, cancel_rates, keys)
    else:  # a single portfolio rate
        rate = cancel_rates.first()["base_cancel"]
        joined = forecasts.withColumn("base_cancel", F.lit(rate).cast("double"))
    demand = F.col("forecast")
    if demand_is_net:
        demand = F.try_divide(demand, F.lit(1.0) - F.col("base_cancel"))
    ready = joined.withColumn("base_demand", demand)
    if ref_price is not None:
        ready = ready.withColumn("ref_price", ref_price)
    return best_price(ready, elasticity).withColumn("forecast_demand", F.round("forecast", 1))
