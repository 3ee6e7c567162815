"""Demand features, backtests and pricing, per country series and in total."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import demand as D
from ..operators import pricing as P
from ..sources.tables import bookings
from .queries_features import score
from .registry import BOOKINGS, query, rounded, sql_over

KEY = ["country"]
TARGET = "realised_demand"

_SERIES = """known AS (SELECT coalesce(country, 'unknown') AS country, period, is_canceled FROM bookings),
counts AS (SELECT country, period, count(*) AS gross_bookings, sum(is_canceled)::BIGINT AS cancellations,
  (count(*) - sum(is_canceled))::BIGINT AS realised_demand FROM known GROUP BY ALL),
spans AS (SELECT country, min(period // 100 * 12 + period % 100 - 1) AS lo,
  max(period // 100 * 12 + period % 100 - 1) AS hi FROM counts GROUP BY country),
calendar AS (SELECT country, unnest(range(lo, hi + 1)) AS i FROM spans),
series AS (SELECT c.country, CAST(i // 12 * 100 + i % 12 + 1 AS INTEGER) AS period,
  coalesce(gross_bookings, 0) AS gross_bookings, coalesce(cancellations, 0) AS cancellations,
  coalesce(realised_demand, 0) AS realised_demand
  FROM calendar c LEFT JOIN counts s ON s.country = c.country AND s.period = i // 12 * 100 + i % 12 + 1)"""

_FEATS = """feats AS (SELECT country, period, realised_demand, CAST(period % 100 AS INTEGER) AS month,
  lag(realised_demand, 1) OVER w AS lag_1, lag(realised_demand, 2) OVER w AS lag_2,
  lag(realised_demand, 3) OVER w AS lag_3, lag(realised_demand, 12) OVER w AS lag_12,
  CASE WHEN count(*) OVER w3 = 3 THEN avg(realised_demand) OVER w3 END AS roll_mean_3,
  CASE WHEN count(*) OVER w6 = 6 THEN avg(realised_demand) OVER w6 END AS roll_mean_6
  FROM series WINDOW w AS (PARTITION BY country ORDER BY period),
   w3 AS (PARTITION BY country ORDER BY period ROWS BETWEEN 3 PRECEDING AND 1 PRECEDING),
   w6 AS (PARTITION BY country ORDER BY period ROWS BETWEEN 6 PRECEDING AND 1 PRECEDING))"""


def country_series(spark, sf):
    b = bookings(spark, sf, ["country", "period", "is_canceled"])
    named = b.withColumn("country", F.coalesce("country", F.lit("unknown")))
    return D.densify(D.demand_series(named, "period", "is_canceled", KEY), "period", KEY)


@query(
    "demand_by_country",
    sql_over(BOOKINGS, _SERIES, select="SELECT *, CAST(period // 100 AS INTEGER) AS year, CAST(period % 100 AS INTEGER) AS month FROM series"),
)
def _demand_by_country(spark, sf):
    return country_series(spark, sf)


@query(
    "lag_features",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        select="""SELECT country, period, lag_1, lag_2, lag_3, lag_12,
          round(sin(2 * pi() * month / 12), 6) + 0.0 AS month_sin,
          round(cos(2 * pi() * month / 12), 6) + 0.0 AS month_cos FROM feats""",
    ),
)
def _lag_features(spark, sf):
    feats = D.with_time_features(country_series(spark, sf), "period", TARGET, KEY)
    return rounded(
        feats.select("country", "period", *[f"lag_{k}" for k in D.LAGS], "month_sin", "month_cos")
    )


@query(
    "rolling_mean",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        select="""SELECT country, period, round(roll_mean_3, 6) AS roll_mean_3,
          round(roll_mean_6, 6) AS roll_mean_6 FROM feats""",
    ),
)
def _rolling_mean(spark, sf):
    feats = D.with_time_features(country_series(spark, sf), "period", TARGET, KEY)
    return rounded(feats.select("country", "period", "roll_mean_3", "roll_mean_6"))


@query(
    "seasonal_naive",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        select="SELECT country, period, realised_demand, lag_12 AS forecast FROM feats",
    ),
)
def _seasonal_naive(spark, sf):
    naive = D.seasonal_naive(country_series(spark, sf), "period", TARGET, KEY)
    return naive.select("country", "period", TARGET, "forecast")


@query(
    "forecast_errors",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        select="""SELECT count(*) AS n_points, round(avg(abs(realised_demand - lag_12)), 6) AS mae,
          round(avg(abs((realised_demand - lag_12) / (realised_demand + 1e-9))) * 100, 2) AS mape
          FROM feats WHERE lag_12 IS NOT NULL AND realised_demand > 0""",
    ),
)
def _forecast_errors(spark, sf):
    naive = D.seasonal_naive(country_series(spark, sf), "period", TARGET, KEY)
    errors = D.forecast_errors(naive.where(F.col(TARGET) > 0), TARGET, "forecast")
    return rounded(errors.withColumn("mape", F.round("mape", 2)))


@query(
    "backtest_naive",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        """steps AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY period) - 1 AS step
          FROM feats WHERE lag_12 IS NOT NULL AND roll_mean_6 IS NOT NULL)""",
        select="""SELECT country, count(*) AS n_points,
          round(avg(abs(realised_demand - lag_12)), 6) AS mae FROM steps WHERE step >= 18
          GROUP BY country""",
    ),
)
def _backtest_naive(spark, sf):
    out = D.backtest_naive(country_series(spark, sf), "period", TARGET, KEY)
    return rounded(out.drop("mape"))


_DET = "({a}*({e}*{i}-{f}*{h})-{b}*({d}*{i}-{f}*{g})+{c}*({d}*{h}-{e}*{g}))"


def _det(*cells: str) -> str:
    return _DET.format(**dict(zip("abcdefghi", cells, strict=True)))


# Least squares on two centred lags in closed form: Cramer's rule on the sums of all earlier periods.
_SUMS = ("n", "u", "v", "uu", "uv", "vv", "y", "uy", "vy")
_A = ("n", "u", "v", "u", "uu", "uv", "v", "uv", "vv")


@query(
    "backtest_linear",
    sql_over(
        BOOKINGS,
        _SERIES,
        _FEATS,
        """steps AS (SELECT *, row_number() OVER (PARTITION BY country ORDER BY period) - 1 AS step
          FROM feats WHERE lag_12 IS NOT NULL AND roll_mean_6 IS NOT NULL)""",
        """products AS (SELECT period, count(*)::DOUBLE AS n, sum(lag_1)::DOUBLE AS u, sum(lag_12)::DOUBLE AS v,
          sum(lag_1 * lag_1)::DOUBLE AS uu, sum(lag_1 * lag_12)::DOUBLE AS uv,
          sum(lag_12 * lag_12)::DOUBLE AS vv, sum(realised_demand)::DOUBLE AS y,
          sum(lag_1 * realised_demand)::DOUBLE AS uy, sum(lag_12 * realised_demand)::DOUBLE AS vy
          FROM steps GROUP BY period)""",
        "sums AS (SELECT period, "
        + ", ".join(f"sum({c}) OVER w AS {c}" for c in _SUMS)
        + """ FROM products WINDOW w AS (ORDER BY period ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))""",
        f"""weights AS (SELECT period, {_det("y", "u", "v", "uy", "uu", "uv", "vy", "uv", "vv")} / {_det(*_A)} AS w0,
          {_det("n", "y", "v", "u", "uy", "uv", "v", "vy", "vv")} / {_det(*_A)} AS w1,
          {_det("n", "u", "y", "u", "uu", "uy", "v", "uv", "vy")} / {_det(*_A)} AS w2 FROM sums)""",
        """points AS (SELECT country, realised_demand AS d, lag_12, w0 + w1 * lag_1 + w2 * lag_12 AS f
          FROM steps JOIN weights USING (period) WHERE step >= 18)""",
        select="""SELECT country, count(*) AS n_points, round(avg(abs(d - f)), 4) AS model_mae,
          round(avg(abs(d - lag_12)), 4) AS naive_mae FROM points GROUP BY country""",
    ),
)
def _backtest_linear(spark, sf):
    """Every origin from step 18 on, by least squares on last month and the same month a year ago."""
    out = D.backtest_linear(country_series(spark, sf), "period", TARGET, KEY, features=["lag_1", "lag_12"])
    return rounded(out.select("country", "n_points", "model_mae", "naive_mae"), 4)


# --- pricing ---------------------------------------------------------------------------------------

_ENTITIES = """entities AS (SELECT coalesce(country, 'unknown') AS country,
  CAST(count(*) AS DOUBLE) AS base_demand, round(avg(price), 2) AS ref_price,
  round(avg(is_canceled), 6) AS base_cancel FROM bookings GROUP BY 1)"""


def _curve(elasticity: str) -> str:
    return f"""curve AS (SELECT *, base_demand * pow(price / ref_price, {elasticity}) * price
      * (1 - least(greatest(base_cancel * (1 + 0.15 * (price / ref_price - 1)), 0), 0.95)) AS revenue
      FROM (SELECT *, ref_price * 0.6 + step * ((ref_price * 1.8 - ref_price * 0.6) / 99) AS price
            FROM grid))"""


_GRID = """grid AS (SELECT *, CAST(unnest(range(0, 100)) AS INTEGER) AS step FROM entities)"""

_BEST = """best AS (SELECT *, row_number() OVER (PARTITION BY {keys} ORDER BY revenue DESC, step) AS rn,
  base_demand * ref_price * (1 - least(greatest(base_cancel, 0), 0.95)) AS at_ref FROM curve),
priced AS (SELECT {keys}, round(price, 2) AS recommended_price,
  round(revenue, 2) AS expected_revenue_at_recommended, round(at_ref, 2) AS expected_revenue_at_reference,
  round(100 * (revenue - at_ref) / greatest(at_ref, 1e-9), 2) + 0.0 AS revenue_uplift_pct,
  step IN (0, 99) AS optimum_at_price_bound FROM best WHERE rn = 1)"""


def entities(spark, sf):
    b = bookings(spark, sf, ["country", "price", "is_canceled"])
    per = b.groupBy(F.coalesce("country", F.lit("unknown")).alias("country"))
    return per.agg(
        F.count(F.lit(1)).cast("double").alias("base_demand"),
        F.round(F.avg("price"), 2).alias("ref_price"),
        F.round(F.avg("is_canceled"), 6).alias("base_cancel"),
    )


@query(
    "price_curve",
    sql_over(
        BOOKINGS,
        _ENTITIES,
        _GRID,
        _curve("-1.2"),
        select="SELECT country, step, round(price, 2) AS price, round(revenue, 2) AS revenue FROM curve",
    ),
)
def _price_curve(spark, sf):
    curve = P.price_curve(entities(spark, sf))
    return rounded(curve.select("country", "step", "price", "revenue"), 2)


_PRICED = (
    "recommended_price expected_revenue_at_recommended expected_revenue_at_reference "
    "revenue_uplift_pct optimum_at_price_bound"
).split()


@query(
    "best_price",
    sql_over(
        BOOKINGS,
        _ENTITIES,
        _GRID,
        _curve("-1.2"),
        _BEST.format(keys="country"),
        select="SELECT * FROM priced",
    ),
)
def _best_price(spark, sf):
    return rounded(P.best_price(entities(spark, sf)).select("country", *_PRICED), 2)


@query(
    "elasticity_sweep",
    sql_over(
        BOOKINGS,
        _ENTITIES,
        "swept AS (SELECT *, unnest([-0.8, -1.2, -2.0])::DOUBLE AS elasticity FROM entities)",
        "grid AS (SELECT *, CAST(unnest(range(0, 100)) AS INTEGER) AS step FROM swept)",
        _curve("elasticity"),
        _BEST.format(keys="country, elasticity"),
        select="SELECT * FROM priced",
    ),
)
def _elasticity_sweep(spark, sf):
    swept = P.elasticity_sweep(entities(spark, sf), [-0.8, -1.2, -2.0])
    return rounded(swept.select("country", "elasticity", *_PRICED), 2)


_RATES = """rates AS (SELECT coalesce(country, 'unknown') AS country,
  avg(round(1 / (1 + exp(-(-2.5 + 0.00001 * price))), 4)) AS base_cancel, count(*) AS n_bookings,
  round(avg(price), 2) AS ref_price FROM bookings GROUP BY 1)"""


@query(
    "base_cancel_rate",
    sql_over(
        BOOKINGS,
        _RATES,
        select="SELECT country, round(base_cancel, 6) AS base_cancel, n_bookings FROM rates",
    ),
)
def _base_cancel_rate(spark, sf):
    b = bookings(spark, sf, ["country", "price"]).withColumns(
        {"p": score(), "country": F.coalesce("country", F.lit("unknown"))}
    )
    return rounded(P.base_cancel_rate(b, "p", KEY))


@query(
    "price_for_period",
    sql_over(
        BOOKINGS,
        _SERIES,
        _RATES,
        """forecasts AS (SELECT s.country, CAST(gross_bookings AS DOUBLE) AS forecast
          FROM series s JOIN spans p ON p.country = s.country
            AND s.period = (hi - 11) // 12 * 100 + (hi - 11) % 12 + 1)""",
        """grid AS (SELECT country, forecast AS base_demand, ref_price, round(base_cancel, 6) AS base_cancel,
          CAST(unnest(range(0, 100)) AS INTEGER) AS step FROM forecasts JOIN rates USING (country))""",
        _curve("-1.2"),
        _BEST.format(keys="country, base_demand"),
        select="SELECT * EXCLUDE (base_demand), round(base_demand, 1) AS forecast_demand FROM priced",
    ),
)
def _price_for_period(spark, sf):
    """Seasonal-naive forecast of gross bookings for the next month, then its best price."""
    upcoming = D.next_period_rows(country_series(spark, sf), "period", "gross_bookings", KEY)
    forecasts = upcoming.select("country", F.col("lag_12").cast("double").alias("forecast"))
    b = bookings(spark, sf, ["country", "price"]).withColumns(
        {"p": score(), "country": F.coalesce("country", F.lit("unknown"))}
    )
    rates = b.groupBy("country").agg(
        F.round(F.avg("p"), 6).alias("base_cancel"), F.round(F.avg("price"), 2).alias("ref_price")
    )
    priced = P.price_for_period(forecasts, rates, KEY)
    return rounded(priced.select("country", *_PRICED, "forecast_demand"), 2)
