"""The driver's tables and their reading as bookings."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import flag, floor_at, month_name, period_of
from ..session import stage


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_FROM_ORDER = {
    "booking_id": lambda: F.col("o_orderkey"),
    "is_canceled": lambda: flag(F.col("o_orderstatus") == "F"),
    "reservation_status": lambda: F.col("o_orderstatus"),
    "arrival_date_year": lambda: F.year("o_orderdate"),
    "arrival_date_month": lambda: month_name(F.month("o_orderdate")),
    "period": lambda: period_of(F.year("o_orderdate"), F.month("o_orderdate")),
    "price": lambda: F.col("o_totalprice"),
    "deposit_type": lambda: F.col("o_orderpriority"),
}

_FROM_CUSTOMER = {
    "adr": lambda: F.col("c_acctbal"),
    "market_segment": lambda: F.col("c_mktsegment"),
    "is_repeated_guest": lambda: flag(F.col("c_acctbal") > 5000),
    "company": lambda: F.when(F.col("c_acctbal") > 9450, F.col("o_custkey")),
}

_FROM_NATION = {
    "country": lambda: F.when(F.col("c_acctbal") >= -950, F.col("n_name")),
}

_FROM_REGION = {
    "hotel": lambda: F.col("r_name"),
}

# Aggregates over the lines of one order, and the columns read from them.
_LINE_AGGREGATES = {
    "first_ship": lambda: F.min("l_shipdate"),
    "first_supplier": lambda: F.min("l_suppkey"),
    "first_flag": lambda: F.min("l_returnflag"),
    "n_adults": lambda: F.count_if(F.col("l_returnflag") == "N"),
    "n_children": lambda: F.count_if(F.col("l_returnflag") == "R"),
    "n_babies": lambda: F.count_if(F.col("l_returnflag") == "A"),
    "n_cancelled": lambda: F.count_if(F.col("l_linestatus") == "F"),
    "n_changed": lambda: F.count_if(F.col("l_discount") >= 0.09),
    "n_requests": lambda: F.count_if(F.col("l_quantity") > 40),
}

_FROM_LINES = {
    "lead_time": (
        ("first_ship",),
        lambda: floor_at(F.datediff("first_ship", "o_orderdate"), 0),
    ),
    "agent": (("first_supplier",), lambda: F.col("first_supplier")),
    "customer_type": (("first_flag",), lambda: F.col("first_flag")),
    "adults": (("n_adults",), lambda: F.col("n_adults").cast("int")),
    "children": (("n_children",), lambda: F.col("n_children").cast("int")),
    "babies": (("n_babies",), lambda: F.col("n_babies").cast("int")),
    "previous_cancellations": (
        ("n_cancelled",),
        lambda: F.coalesce(F.col("n_cancelled"), F.lit(0)).cast("int"),
    ),
    "booking_changes": (
        ("n_changed",),
        lambda: F.coalesce(F.col("n_changed"), F.lit(0)).cast("int"),
    ),
    "total_of_special_requests": (
        ("n_requests",),
        lambda: F.coalesce(F.col("n_requests"), F.lit(0)).cast("int"),
    ),
}

BOOKING_COLUMNS = (
    "booking_id",
    "hotel",
    "is_canceled",
    "lead_time",
    "arrival_date_year",
    "arrival_date_month",
    "adults",
    "children",
    "babies",
    "market_segment",
    "deposit_type",
    "customer_type",
    "adr",
    "previous_cancellations",
    "booking_changes",
    "total_of_special_requests",
    "is_repeated_guest",
    "country",
    "agent",
    "company",
    "reservation_status",
)


def bookings(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = BOOKING_COLUMNS
) -> DataFrame:
    """Orders read as bookings, one row per order.

    Only the tables that the asked columns need are joined, so a query on order columns alone is
    a plain scan. Lines are aggregated per order before the join; both sides then share the
    order-key partitioning and a hot order is folded map-side.
    """
    wanted = list(columns)
    df = table(spark, sf_dir, "orders")

    from_lines = [c for c in wanted if c in _FROM_LINES]
    if from_lines:
        needed = sorted({a for c in from_lines for a in _FROM_LINES[c][0]})
        lines = (
            table(spark, sf_dir, "lineitem")
            .groupBy(F.col("l_orderkey").alias("o_orderkey"))
            .agg(*[_LINE_AGGREGATES[a]().alias(a) for a in needed])
        )
        df = df.join(lines, "o_orderkey", "left")

    deep = [c for c in wanted if c in _FROM_NATION or c in _FROM_REGION]
    if deep or any(c in _FROM_CUSTOMER for c in wanted):
        customer = table(spark, sf_dir, "customer")
        if deep:
            nation = table(spark, sf_dir, "nation")
            if any(c in _FROM_REGION for c in deep):
                region = table(spark, sf_dir, "region")
                nation = nation.join(
                    region, nation["n_regionkey"] == region["r_regionkey"], "left"
                )
            customer = customer.join(
                nation, customer["c_nationkey"] == nation["n_nationkey"], "left"
            )
        df = df.join(customer, df["o_custkey"] == customer["c_custkey"], "left")

    plain = _FROM_ORDER | _FROM_CUSTOMER | _FROM_NATION | _FROM_REGION
    return df.select(
        *[(plain[c]() if c in plain else _FROM_LINES[c][1]()).alias(c) for c in wanted]
    )


def staged_bookings(
    spark: SparkSession, sf_dir: str, columns: Sequence[str] = BOOKING_COLUMNS
) -> DataFrame:
    """Bookings joined once and written as a table, for work that reads them several times."""
    return stage(bookings(spark, sf_dir, columns), "bookings")
