"""Named queries over the driver's tables, each next to its SQL twin where there is one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name!r} registered twice")
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


def rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    """Round every double, and turn -0.0 into 0.0, so that engines can be compared."""

    def cell(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DoubleType | T.FloatType):
            return (F.round(c.cast("double"), digits) + F.lit(0.0)).alias(f.name)
        return c

    return df.select(*[cell(f) for f in df.schema])


# --- SQL building blocks ---------------------------------------------------------------------------

LINES = """lines AS (
  SELECT l_orderkey,
    min(l_shipdate) AS first_ship, min(l_suppkey) AS first_supplier,
    min(l_returnflag) AS first_flag,
    count(*) FILTER (WHERE l_returnflag = 'N') AS n_adults,
    count(*) FILTER (WHERE l_returnflag = 'R') AS n_children,
    count(*) FILTER (WHERE l_returnflag = 'A') AS n_babies,
    count(*) FILTER (WHERE l_linestatus = 'F') AS n_cancelled,
    count(*) FILTER (WHERE l_discount >= 0.09) AS n_changed,
    count(*) FILTER (WHERE l_quantity > 40) AS n_requests
  FROM lineitem GROUP BY l_orderkey)"""

BOOKINGS = (
    LINES
    + """,
bookings AS (
  SELECT o_orderkey AS booking_id, r_name AS hotel,
    CAST(o_orderstatus = 'F' AS INTEGER) AS is_canceled,
    CAST(CASE WHEN date_diff('day', o_orderdate, first_ship) < 0 THEN 0
         ELSE date_diff('day', o_orderdate, first_ship) END AS INTEGER) AS lead_time,
    CAST(year(o_orderdate) AS INTEGER) AS arrival_date_year,
    monthname(o_orderdate) AS arrival_date_month,
    CAST(year(o_orderdate) * 100 + month(o_orderdate) AS INTEGER) AS period,
    CAST(month(o_orderdate) AS INTEGER) AS month_num,
    CAST(n_adults AS INTEGER) AS adults, CAST(n_children AS INTEGER) AS children,
    CAST(n_babies AS INTEGER) AS babies,
    c_mktsegment AS market_segment, o_orderpriority AS deposit_type, first_flag AS customer_type,
    c_acctbal AS adr, o_totalprice AS price,
    CAST(coalesce(n_cancelled, 0) AS INTEGER) AS previous_cancellations,
    CAST(coalesce(n_changed, 0) AS INTEGER) AS booking_changes,
    CAST(coalesce(n_requests, 0) AS INTEGER) AS total_of_special_requests,
    CAST(c_acctbal > 5000 AS INTEGER) AS is_repeated_guest,
    CASE WHEN c_acctbal >= -950 THEN n_name END AS country,
    first_supplier AS agent,
    CASE WHEN c_acctbal > 9450 THEN o_custkey END AS company,
    o_orderstatus AS reservation_status
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey
    LEFT JOIN customer ON c_custkey = o_custkey
    LEFT JOIN nation ON n_nationkey = c_nationkey
    LEFT JOIN region ON r_regionkey = n_regionkey)"""
)

SPLIT = """cut AS (SELECT quantile_cont(period, 0.8) AS c FROM bookings),
train AS (SELECT bookings.* FROM bookings, cut WHERE period <= c),
test AS (SELECT bookings.* FROM bookings, cut WHERE period > c)"""


def sql_over(*ctes: str, select: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n" + select.strip()


def hash_key(id_col: str, seed: int | str) -> str:
    return f"CAST('0x' || substr(md5({id_col} || '-{seed}'), 1, 13) AS BIGINT)"
