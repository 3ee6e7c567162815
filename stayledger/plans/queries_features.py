"""Row-wise features and scalar functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.scalar import (
    linear,
    month_number,
    period_of,
    risk_band,
    sigmoid,
    threshold_label,
)
from ..operators import features as X
from ..schema import Roles
from ..sources.tables import bookings
from .registry import BOOKINGS, query, rounded, sql_over

ROLES = Roles(deposit_flag="1-URGENT", segment_flag="BUILDING")

FEATURE_INPUT = (
    "booking_id",
    "lead_time",
    "adr",
    "adults",
    "children",
    "babies",
    "previous_cancellations",
    "booking_changes",
    "total_of_special_requests",
    "is_repeated_guest",
    "deposit_type",
    "market_segment",
    "arrival_date_month",
)


@query(
    "log_transforms",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, round(ln(1 + lead_time), 6) AS lead_time_log,
          round(ln(1 + CASE WHEN adr < 0 THEN 0 ELSE adr END), 6) AS adr_log FROM bookings""",
    ),
)
def _log_transforms(spark, sf):
    b = X.log_transforms(bookings(spark, sf, ["booking_id", "lead_time", "adr"]), ROLES)
    return rounded(b.select("booking_id", "lead_time_log", "adr_log"))


@query(
    "binary_flags",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, CAST(previous_cancellations > 0 AS INTEGER) AS has_prev_cancellation,
          CAST(booking_changes > 0 AS INTEGER) AS has_booking_changes,
          CAST(total_of_special_requests > 0 AS INTEGER) AS has_special_requests,
          CAST(coalesce(children > 0, false) OR coalesce(babies > 0, false) AS INTEGER) AS has_children
          FROM bookings""",
    ),
)
def _binary_flags(spark, sf):
    b = X.binary_flags(bookings(spark, sf, FEATURE_INPUT))
    names = ["has_prev_cancellation", "has_booking_changes", "has_special_requests", "has_children"]
    return b.select("booking_id", *names)


@query(
    "guest_features",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, adults + children + babies AS total_guests,
          CAST(coalesce(adults + children + babies = 1, false) AS INTEGER) AS is_solo,
          CAST(coalesce(adults >= 1 AND children + babies > 0, false) AS INTEGER) AS is_family,
          round(adr / CASE WHEN adults + children + babies < 1 THEN 1
                ELSE adults + children + babies END, 6) AS adr_per_guest FROM bookings""",
    ),
)
def _guest_features(spark, sf):
    b = X.guest_features(bookings(spark, sf, ["booking_id", "adr", "adults", "children", "babies"]))
    return rounded(b.select("booking_id", "total_guests", "is_solo", "is_family", "adr_per_guest"))


@query(
    "month_lookup",
    """SELECT monthname(o_orderdate) AS arrival_date_month,
       CAST(month(o_orderdate) AS INTEGER) AS month_num, count(*) AS n FROM orders GROUP BY ALL""",
)
def _month_lookup(spark, sf):
    b = bookings(spark, sf, ["arrival_date_month"])
    named = b.withColumn("month_num", month_number("arrival_date_month"))
    return named.groupBy("arrival_date_month", "month_num").agg(F.count(F.lit(1)).alias("n"))


@query(
    "cyclical_month",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id, month_num AS arrival_month_num,
          round(sin(2 * pi() * month_num / 12), 6) + 0.0 AS month_sin,
          round(cos(2 * pi() * month_num / 12), 6) + 0.0 AS month_cos,
          CAST(month_num IN (6, 7, 8) AS INTEGER) AS is_summer,
          CAST(month_num IN (6, 7, 8, 12) AS INTEGER) AS is_peak_season FROM bookings""",
    ),
)
def _cyclical_month(spark, sf):
    b = X.cyclical_month(bookings(spark, sf, ["booking_id", "arrival_date_month"]), ROLES)
    return rounded(b.drop("arrival_date_month"))


BUCKET = """CASE WHEN lead_time IS NULL OR lead_time <= -1 OR lead_time > 10000 THEN 'nan'
  WHEN lead_time <= 7 THEN '0-7' WHEN lead_time <= 30 THEN '8-30' WHEN lead_time <= 90 THEN '31-90'
  WHEN lead_time <= 180 THEN '91-180' ELSE '180+' END"""


@query(
    "bucketize",
    sql_over(BOOKINGS, select=f"SELECT booking_id, {BUCKET} AS lead_time_bucket FROM bookings"),
)
def _bucketize(spark, sf):
    b = X.lead_buckets(bookings(spark, sf, ["booking_id", "lead_time"]), ROLES)
    return b.drop("lead_time")


@query(
    "interactions",
    sql_over(
        BOOKINGS,
        select="""SELECT booking_id,
          round(ln(1 + lead_time) * CAST(deposit_type = '1-URGENT' AS INTEGER), 6) AS lead_x_nonrefund,
          round(ln(1 + lead_time) * CAST(market_segment = 'BUILDING' AS INTEGER), 6) AS lead_x_groups,
          total_of_special_requests * is_repeated_guest AS requests_x_repeat FROM bookings""",
    ),
)
def _interactions(spark, sf):
    b = X.interactions(X.log_transforms(bookings(spark, sf, FEATURE_INPUT), ROLES), ROLES)
    return rounded(b.select("booking_id", "lead_x_nonrefund", "lead_x_groups", "requests_x_repeat"))


RISK = """2.0 * CAST(deposit_type = '1-URGENT' AS INTEGER)
  + 1.5 * CAST(market_segment = 'BUILDING' AS INTEGER)
  + CAST(coalesce(lead_time > 180, false) AS INTEGER) + CAST(previous_cancellations > 0 AS INTEGER)
  - CAST(total_of_special_requests > 0 AS INTEGER) - is_repeated_guest"""


@query(
    "risk_score",
    sql_over(
        BOOKINGS,
        select=f"SELECT booking_id, CAST({RISK} AS DOUBLE) AS risk_score FROM bookings",
    ),
)
def _risk_score(spark, sf):
    b = X.binary_flags(bookings(spark, sf, FEATURE_INPUT))
    return X.risk_score(b, ROLES).select("booking_id", "risk_score")


ENGINEERED = f"""engineered AS (
  SELECT booking_id, ln(1 + lead_time) AS lead_time_log,
    ln(1 + CASE WHEN adr < 0 THEN 0 ELSE adr END) AS adr_log,
    CAST(previous_cancellations > 0 AS INTEGER) AS has_prev_cancellation,
    CAST(booking_changes > 0 AS INTEGER) AS has_booking_changes,
    CAST(total_of_special_requests > 0 AS INTEGER) AS has_special_requests,
    CAST(coalesce(children > 0, false) OR coalesce(babies > 0, false) AS INTEGER) AS has_children,
    adults + children + babies AS total_guests,
    CAST(coalesce(adults + children + babies = 1, false) AS INTEGER) AS is_solo,
    CAST(coalesce(adults >= 1 AND children + babies > 0, false) AS INTEGER) AS is_family,
    adr / CASE WHEN adults + children + babies < 1 THEN 1
          ELSE adults + children + babies END AS adr_per_guest,
    month_num AS arrival_month_num, sin(2 * pi() * month_num / 12) AS month_sin,
    cos(2 * pi() * month_num / 12) AS month_cos,
    CAST(month_num IN (6, 7, 8) AS INTEGER) AS is_summer,
    CAST(month_num IN (6, 7, 8, 12) AS INTEGER) AS is_peak_season,
    {BUCKET} AS lead_time_bucket,
    ln(1 + lead_time) * CAST(deposit_type = '1-URGENT' AS INTEGER) AS lead_x_nonrefund,
    ln(1 + lead_time) * CAST(market_segment = 'BUILDING' AS INTEGER) AS lead_x_groups,
    total_of_special_requests * is_repeated_guest AS requests_x_repeat,
    CAST({RISK} AS DOUBLE) AS risk_score
  FROM bookings)"""

_DOUBLES = (
    "lead_time_log adr_log adr_per_guest month_sin month_cos lead_x_nonrefund lead_x_groups "
    "risk_score"
).split()


@query(
    "engineer_all",
    sql_over(
        BOOKINGS,
        ENGINEERED,
        select="SELECT * REPLACE ("
        + ", ".join(f"round({c}, 6) + 0.0 AS {c}" for c in _DOUBLES)
        + ") FROM engineered",
    ),
)
def _engineer_all(spark, sf):
    b = bookings(spark, sf, FEATURE_INPUT)
    return rounded(X.engineer(b, ROLES).drop(*[c for c in FEATURE_INPUT if c != "booking_id"]))


@query(
    "arrival_index",
    """SELECT o_orderkey AS booking_id,
       CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period FROM orders""",
)
def _arrival_index(spark, sf):
    b = bookings(spark, sf, ["booking_id", "arrival_date_year", "arrival_date_month"])
    period = period_of("arrival_date_year", month_number("arrival_date_month"))
    return b.select("booking_id", period.alias("period"))


# One score formula stands for a model's probability wherever a metric needs one.
SCORE_TERMS = {"price": 1e-5}
SCORE_INTERCEPT = -2.5
SCORE_DIGITS = 4
SCORED = """scored AS (
  SELECT o_orderkey AS booking_id, CAST(o_orderstatus = 'F' AS INTEGER) AS is_canceled,
    o_orderpriority AS deposit_type,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
    round(1 / (1 + exp(-(-2.5 + 0.00001 * o_totalprice))), 4) AS p
  FROM orders)"""


def score() -> Column:
    return F.round(sigmoid(linear(SCORE_TERMS, SCORE_INTERCEPT)), SCORE_DIGITS)


def scored(spark, sf, columns=("booking_id", "is_canceled")):
    b = bookings(spark, sf, [*columns, "price"])
    return b.withColumn("p", score()).drop("price")


@query("logistic_score", sql_over(SCORED, select="SELECT booking_id, p FROM scored"))
def _logistic_score(spark, sf):
    return scored(spark, sf, ["booking_id"])


@query(
    "risk_band",
    sql_over(
        SCORED,
        select="""SELECT booking_id, CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.6 THEN 'medium'
          ELSE 'high' END AS band FROM scored""",
    ),
)
def _risk_band(spark, sf):
    return scored(spark, sf, ["booking_id"]).select("booking_id", risk_band("p").alias("band"))


@query(
    "threshold_label",
    sql_over(
        SCORED,
        select="""SELECT booking_id, CAST(p >= 0.5 AS INTEGER) AS at_default,
          CAST(p >= 0.3 AS INTEGER) AS at_cost_optimal FROM scored""",
    ),
)
def _threshold_label(spark, sf):
    return scored(spark, sf, ["booking_id"]).select(
        "booking_id",
        threshold_label("p", 0.5).alias("at_default"),
        threshold_label("p", 0.3).alias("at_cost_optimal"),
    )
