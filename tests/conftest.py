import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from stayledger.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
            "spark.ui.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def hotel(spark):
    """1,600 hotel bookings with a known signal, derived from row numbers by hashing."""
    from pyspark.sql import functions as F

    from stayledger.functions.scalar import month_name
    from stayledger.schema import RAW_BOOKING

    def u(tag):  # uniform in [0, 1)
        return F.pmod(F.xxhash64("id", F.lit(tag)), F.lit(100_000)) / 100_000.0

    def pick(tag, *levels):
        return F.element_at(F.array(*[F.lit(x) for x in levels]), (u(tag) * len(levels)).cast("int") + 1)

    rows = spark.range(1600).select(
        "id",
        pick("hotel", "City Hotel", "Resort Hotel").alias("hotel"),
        (u("lead") * u("lead2") * 400).cast("int").alias("lead_time"),
        (2015 + F.col("id") / 600).cast("int").alias("arrival_date_year"),
        month_name(F.pmod("id", F.lit(12)) + 1).alias("arrival_date_month"),
        (u("adults") * 3).cast("int").alias("adults"),
        F.when(u("c") > 0.01, (u("children") * 1.5).cast("int")).alias("children"),
        (u("babies") * 1.1).cast("int").alias("babies"),
        pick("seg", "Groups", "Direct", "Online TA", "Corporate").alias("market_segment"),
        pick("dep", "No Deposit", "Non Refund", "Refundable").alias("deposit_type"),
        pick("cust", "Transient", "Contract").alias("customer_type"),
        F.round(u("adr") * 250 - 5, 2).alias("adr"),
        (u("prev") * 1.3).cast("int").alias("previous_cancellations"),
        (u("chg") * 1.6).cast("int").alias("booking_changes"),
        (u("req") * 4).cast("int").alias("total_of_special_requests"),
        (u("rep") > 0.85).cast("int").alias("is_repeated_guest"),
        F.when(u("n") > 0.02, pick("country", "PRT", "GBR", "FRA", "ESP", "DEU")).alias("country"),
        F.when(u("a") > 0.14, (u("agent") * 30).cast("int").cast("double")).alias("agent"),
        F.when(u("co") > 0.95, (u("company") * 10).cast("int").cast("double")).alias("company"),
    )
    z = (
        F.lit(-2.2)
        + 0.012 * F.col("lead_time")
        + 1.6 * (F.col("deposit_type") == "Non Refund").cast("int")
        + 0.9 * (F.col("market_segment") == "Groups").cast("int")
        - 0.6 * F.col("total_of_special_requests")
    )
    labelled = rows.withColumn("is_canceled", (u("label") < 1 / (1 + F.exp(-z))).cast("int")).withColumn(
        "reservation_status",
        F.when(F.col("is_canceled") == 1, "Canceled").otherwise("Check-Out"),
    )
    return labelled.select(*[F.col(f.name).cast(f.dataType) for f in RAW_BOOKING]).cache()
