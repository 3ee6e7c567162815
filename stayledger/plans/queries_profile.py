"""Profiling and class balance."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import month_number
from ..operators import profile as P
from ..operators.cleaning import clean
from ..operators.features import lead_buckets
from ..operators.imbalance import class_weights, pos_weight
from ..schema import Roles
from ..sources.tables import bookings, staged_bookings
from .queries_cleaning import CEILING, CLEAN
from .queries_features import BUCKET
from .registry import BOOKINGS, query, rounded, sql_over

ROLES = Roles()
NUMERIC = ("lead_time", "adr", "booking_changes", "total_of_special_requests")
CATEGORICAL = ("hotel", "market_segment", "deposit_type", "customer_type", "country")
DEPOSITS = ("1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW")


@query(
    "rate_by_category",
    sql_over(
        BOOKINGS,
        CLEAN,
        select="""SELECT deposit_type, round(avg(is_canceled), 6) AS cancel_rate, count(*) AS n
          FROM cleaned GROUP BY deposit_type ORDER BY cancel_rate DESC""",
    ),
)
def _rate_by_category(spark, sf):
    cleaned = clean(bookings(spark, sf), ROLES, CEILING)
    return rounded(P.rate_by(cleaned, ["deposit_type"], "is_canceled"))


@query(
    "class_balance",
    """SELECT round(avg(t), 6) AS positive_rate, round((1 - avg(t)) / avg(t), 6) AS imbalance_ratio
       FROM (SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS t FROM orders)""",
)
def _class_balance(spark, sf):
    return rounded(P.class_balance(bookings(spark, sf, ["is_canceled"]), "is_canceled"))


@query(
    "class_counts",
    """SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_canceled, count(*) AS n
       FROM orders GROUP BY ALL""",
)
def _class_counts(spark, sf):
    return P.class_counts(bookings(spark, sf, ["is_canceled"]), "is_canceled")


def _summary_sql(column: str, extended: bool) -> str:
    more = f", round(quantile_cont({column}, 0.99), 6) AS p99" if extended else ""
    tail = f", round(kurtosis({column}), 6) AS kurtosis" if extended else ""
    return f"""SELECT '{column}' AS feature, count({column}) AS n, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS std, CAST(min({column}) AS DOUBLE) AS min,
      round(quantile_cont({column}, 0.25), 6) AS p25, round(quantile_cont({column}, 0.5), 6) AS p50,
      round(quantile_cont({column}, 0.75), 6) AS p75,
      round(quantile_cont({column}, 0.95), 6) AS p95{more},
      CAST(max({column}) AS DOUBLE) AS max, round(skewness({column}), 6) AS skew{tail} FROM bookings"""


@query(
    "numeric_summary",
    sql_over(BOOKINGS, select=" UNION ALL ".join(_summary_sql(c, False) for c in NUMERIC)),
)
def _numeric_summary(spark, sf):
    return rounded(P.numeric_summary(staged_bookings(spark, sf, NUMERIC), NUMERIC))


@query(
    "numeric_summary_ext",
    sql_over(BOOKINGS, select=" UNION ALL ".join(_summary_sql(c, True) for c in NUMERIC)),
)
def _numeric_summary_ext(spark, sf):
    fractions = {"p25": 0.25, "p50": 0.5, "p75": 0.75, "p95": 0.95, "p99": 0.99}
    return rounded(P.numeric_summary(staged_bookings(spark, sf, NUMERIC), NUMERIC, fractions, kurtosis=True))


@query(
    "lift_by_category",
    sql_over(
        BOOKINGS,
        select="""SELECT market_segment, round(avg(is_canceled), 3) AS cancel_rate, count(*) AS n,
          round(avg(is_canceled) / (SELECT avg(is_canceled) FROM bookings), 2) AS lift_vs_baseline
          FROM bookings GROUP BY market_segment""",
    ),
)
def _lift_by_category(spark, sf):
    lift = P.lift_by(bookings(spark, sf, ["market_segment", "is_canceled"]), "market_segment", "is_canceled")
    return lift.withColumns(
        {
            "cancel_rate": F.round("cancel_rate", 3),
            "lift_vs_baseline": F.round("lift_vs_baseline", 2),
        }
    )


_SCAN = (*NUMERIC, "price", "previous_cancellations", "is_repeated_guest", "status_copy")


@query(
    "leakage_scan",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(abs(corr({c}, is_canceled)), 6) AS abs_corr,
            abs(corr({c}, is_canceled)) > 0.85 AS suspicious
            FROM (SELECT *, is_canceled AS status_copy FROM bookings)"""
            for c in _SCAN
        ),
    ),
)
def _leakage_scan(spark, sf):
    columns = [c for c in _SCAN if c != "status_copy"]
    b = bookings(spark, sf, [*columns, "is_canceled"])
    return rounded(P.leakage_scan(b.withColumn("status_copy", F.col("is_canceled")), _SCAN, "is_canceled"))


_LEAKY = (*CATEGORICAL, "reservation_status")


@query(
    "leakage_categorical",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS feature, round(min(r), 6) AS min_rate, round(max(r), 6) AS max_rate
            FROM (SELECT avg(is_canceled) AS r FROM bookings WHERE {c} IS NOT NULL GROUP BY {c})"""
            for c in _LEAKY
        ),
    ),
)
def _leakage_categorical(spark, sf):
    b = bookings(spark, sf, [*_LEAKY, "is_canceled"])
    return rounded(P.leakage_by_level(b, _LEAKY, "is_canceled"))


_GAPS = ("lead_time", "agent", "company", "children", "country", "customer_type")


@query(
    "missingness",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS column_name, count(*) FILTER (WHERE {c} IS NULL) AS n_missing,
            round(count(*) FILTER (WHERE {c} IS NULL) / count(*), 6) AS fraction FROM bookings
            HAVING count(*) FILTER (WHERE {c} IS NULL) > 0"""
            for c in (*_GAPS, "hotel", "adr")
        ),
    ),
)
def _missingness(spark, sf):
    return rounded(P.missingness(bookings(spark, sf, [*_GAPS, "hotel", "adr"])))


_CARD = ("hotel", "is_canceled", "market_segment", "country", "agent", "company", "arrival_date_month")


@query(
    "cardinality",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS feature, count(DISTINCT {c}) AS n_distinct,
            count(DISTINCT {c}) <= 1 AS is_constant FROM bookings"""
            for c in _CARD
        ),
    ),
)
def _cardinality(spark, sf):
    return P.cardinality(bookings(spark, sf, _CARD), _CARD)


_CORR = ("adr", "price", "previous_cancellations", "booking_changes", "is_repeated_guest", "is_canceled")


@query(
    "corr_matrix",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"SELECT '{a}' AS feature, '{b}' AS other, round(corr({a}, {b}), 6) + 0.0 AS corr FROM bookings"
            for a in _CORR
            for b in _CORR
        ),
    ),
)
def _corr_matrix(spark, sf):
    return rounded(P.corr_matrix(bookings(spark, sf, _CORR), _CORR))


@query(
    "demand_series",
    """SELECT CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
         count(*) AS gross_bookings, count(*) FILTER (WHERE o_orderstatus = 'F') AS cancellations,
         count(*) FILTER (WHERE o_orderstatus <> 'F') AS realised_demand,
         CAST(year(o_orderdate) AS INTEGER) AS year, CAST(month(o_orderdate) AS INTEGER) AS month
       FROM orders GROUP BY ALL""",
)
def _demand_series(spark, sf):
    from ..operators.demand import demand_series

    return demand_series(bookings(spark, sf, ["period", "is_canceled"]), "period", "is_canceled")


@query(
    "pivot_rate",
    sql_over(
        BOOKINGS,
        select=f"SELECT {BUCKET} AS lead_time_bucket, "
        + ", ".join(
            f"""round(avg(is_canceled) FILTER (WHERE deposit_type = '{d}'), 6) AS "{d}\""""
            for d in DEPOSITS
        )
        + " FROM bookings GROUP BY 1",
    ),
)
def _pivot_rate(spark, sf):
    b = lead_buckets(bookings(spark, sf, ["lead_time", "deposit_type", "is_canceled"]))
    return rounded(P.pivot_rate(b, "lead_time_bucket", "deposit_type", DEPOSITS, "is_canceled"))


@query(
    "seasonality",
    sql_over(
        BOOKINGS,
        select="""SELECT arrival_date_month, month_num, count(*) AS bookings,
          round(avg(is_canceled), 6) AS cancel_rate FROM bookings GROUP BY ALL""",
    ),
)
def _seasonality(spark, sf):
    b = bookings(spark, sf, ["arrival_date_month", "is_canceled"])
    return rounded(
        P.seasonality(b, "arrival_date_month", month_number("arrival_date_month"), "is_canceled")
    )


@query(
    "iqr_outliers",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS feature,
            count(*) FILTER (WHERE {c} < q1 - 1.5 * (q3 - q1) OR {c} > q3 + 1.5 * (q3 - q1)) AS n_outliers,
            round(any_value(q1 - 1.5 * (q3 - q1)), 6) AS lower,
            round(any_value(q3 + 1.5 * (q3 - q1)), 6) AS upper
            FROM bookings, (SELECT quantile_cont({c}, 0.25) AS q1, quantile_cont({c}, 0.75) AS q3
                            FROM bookings)"""
            for c in NUMERIC
        ),
    ),
)
def _iqr_outliers(spark, sf):
    return rounded(P.iqr_outliers(staged_bookings(spark, sf, NUMERIC), NUMERIC))


@query(
    "segment_profile",
    sql_over(
        BOOKINGS,
        select="""SELECT deposit_type, market_segment, round(avg(is_canceled), 6) AS cancel_rate,
          count(*) AS n FROM bookings GROUP BY ALL HAVING count(*) >= 200""",
    ),
)
def _segment_profile(spark, sf):
    b = bookings(spark, sf, ["deposit_type", "market_segment", "is_canceled"])
    return rounded(P.rate_by(b, ["deposit_type", "market_segment"], "is_canceled", min_rows=200))


def _histogram_sql(column: str, bins: int, keys: str = "") -> str:
    return f"""SELECT {keys} CAST(least(floor(({column} - lo) / w), {bins - 1}) AS INTEGER) AS bin,
      count(*) AS n
      FROM bookings, (SELECT min({column})::DOUBLE AS lo,
        (max({column})::DOUBLE - min({column})::DOUBLE) / {bins} AS w FROM bookings)
      WHERE {column} IS NOT NULL GROUP BY ALL"""


@query("histogram", sql_over(BOOKINGS, select=_histogram_sql("price", 40)))
def _histogram(spark, sf):
    return P.histogram(bookings(spark, sf, ["price"]), "price", 40)


@query("histogram_by_class", sql_over(BOOKINGS, select=_histogram_sql("lead_time", 60, "is_canceled,")))
def _histogram_by_class(spark, sf):
    b = bookings(spark, sf, ["lead_time", "is_canceled"])
    return P.histogram(b, "lead_time", 60, ["is_canceled"])


@query(
    "box_stats",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"""SELECT '{c}' AS feature, is_canceled, round(any_value(q1), 6) AS q1,
            round(any_value(q2), 6) AS median, round(any_value(q3), 6) AS q3,
            CAST(min({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS DOUBLE) AS whisker_low,
            CAST(max({c}) FILTER (WHERE {c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1)) AS DOUBLE) AS whisker_high,
            count(*) FILTER (WHERE NOT ({c} BETWEEN q1 - 1.5*(q3-q1) AND q3 + 1.5*(q3-q1))) AS n_outliers
            FROM bookings JOIN (SELECT is_canceled, quantile_cont({c}, 0.25) AS q1,
              quantile_cont({c}, 0.5) AS q2, quantile_cont({c}, 0.75) AS q3
              FROM bookings GROUP BY is_canceled) USING (is_canceled) GROUP BY is_canceled"""
            for c in ("lead_time", "price")
        ),
    ),
)
def _box_stats(spark, sf):
    b = staged_bookings(spark, sf, ["lead_time", "price", "is_canceled"])
    return rounded(P.box_stats(b, ["lead_time", "price"], "is_canceled", [0, 1]))


@query(
    "rollup_composition",
    sql_over(
        BOOKINGS,
        select="""SELECT hotel, deposit_type, is_canceled,
          CAST(3 - grouping(hotel) - grouping(deposit_type) - grouping(is_canceled) AS INTEGER) AS depth,
          count(*) AS n FROM bookings GROUP BY ROLLUP (hotel, deposit_type, is_canceled)""",
    ),
)
def _rollup_composition(spark, sf):
    path = ["hotel", "deposit_type", "is_canceled"]
    return P.composition(bookings(spark, sf, path), path)


@query(
    "category_counts",
    sql_over(
        BOOKINGS,
        select=" UNION ALL ".join(
            f"SELECT '{c}' AS feature, {c} AS level, count(*) AS n FROM bookings "
            f"WHERE {c} IS NOT NULL GROUP BY {c}"
            for c in CATEGORICAL
        ),
    ),
)
def _category_counts(spark, sf):
    return P.category_counts(bookings(spark, sf, CATEGORICAL), CATEGORICAL)


@query(
    "class_weights",
    """SELECT CAST(o_orderstatus = 'F' AS INTEGER) AS is_canceled, count(*) AS n,
       round((SELECT count(*) FROM orders) / (2.0 * count(*)), 6) AS weight FROM orders GROUP BY ALL""",
)
def _class_weights(spark, sf):
    return rounded(class_weights(bookings(spark, sf, ["is_canceled"]), "is_canceled"))


@query(
    "pos_weight",
    """SELECT round(count(*) FILTER (WHERE o_orderstatus <> 'F')
       / count(*) FILTER (WHERE o_orderstatus = 'F'), 6) AS pos_weight FROM orders""",
)
def _pos_weight(spark, sf):
    return rounded(pos_weight(bookings(spark, sf, ["is_canceled"]), "is_canceled"))

