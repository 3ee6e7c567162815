import math

import pytest
from pyspark.sql import functions as F

from stayledger.functions import scalar as S
from stayledger.operators import features as X


def values(df, column):
    return [r[column] for r in df.collect()]


def test_bucket_edges(spark):
    df = spark.createDataFrame([(v,) for v in (0, 7, 8, 30, 31, 90, 91, 180, 181, 10_000, 10_001, None)], "lead_time int")
    got = values(X.lead_buckets(df), "lead_time_bucket")
    assert got == ["0-7", "0-7", "8-30", "8-30", "31-90", "31-90", "91-180", "91-180", "180+", "180+", "nan", "nan"]


def test_engineer_adds_twenty_columns_and_keeps_rows(hotel):
    out = X.engineer(hotel)
    assert len(out.columns) == len(hotel.columns) + 20
    assert out.count() == hotel.count()


def test_engineer_is_row_wise(hotel):
    """Order and neighbours change nothing."""
    whole = X.engineer(hotel)
    part = X.engineer(hotel.repartition(5).where("lead_time > 50"))
    assert part.exceptAll(whole).count() == 0


def test_logs_and_flags(spark):
    df = spark.createDataFrame(
        [(0, -5.0, 0, 1, 2, None, 1), (9, 99.0, 2, 0, 0, 0, 0)],
        "lead_time int, adr double, previous_cancellations int, booking_changes int, "
        "total_of_special_requests int, children int, babies int",
    )
    out = X.binary_flags(X.log_transforms(df)).collect()
    assert out[0].lead_time_log == 0.0 and out[0].adr_log == 0.0
    assert math.isclose(out[1].adr_log, math.log(100))
    assert [out[0].has_prev_cancellation, out[0].has_booking_changes, out[0].has_special_requests] == [0, 1, 1]
    assert [r.has_children for r in out] == [1, 0]


def test_guests(spark):
    df = spark.createDataFrame([(1, 0, 0, 80.0), (2, 1, 1, 80.0), (0, 0, 0, 80.0)], "adults int, children int, babies int, adr double")
    out = X.guest_features(df).collect()
    assert [r.total_guests for r in out] == [1, 4, 0]
    assert [r.is_solo for r in out] == [1, 0, 0]
    assert [r.is_family for r in out] == [0, 1, 0]
    assert [r.adr_per_guest for r in out] == [80.0, 20.0, 80.0]


def test_months(spark):
    df = spark.createDataFrame([("December",), ("January",), ("Brumaire",), (None,)], "arrival_date_month string")
    out = X.cyclical_month(df).collect()
    assert [r.arrival_month_num for r in out] == [12, 1, None, None]
    assert [r.is_peak_season for r in out] == [1, 0, 0, 0]
    gap = math.hypot(out[0].month_sin - out[1].month_sin, out[0].month_cos - out[1].month_cos)
    assert gap < 0.6
    assert values(spark.range(1, 14).select(S.month_name("id").alias("m")), "m")[11:] == ["December", None]


def test_risk_score(spark):
    df = spark.createDataFrame(
        [("Non Refund", "Groups", 200, 1, 0, 0), ("No Deposit", "Direct", 3, 0, 1, 1)],
        "deposit_type string, market_segment string, lead_time int, has_prev_cancellation int, "
        "has_special_requests int, is_repeated_guest int",
    )
    assert values(X.risk_score(df), "risk_score") == [5.5, -2.0]


def test_bands_and_labels(spark):
    df = spark.createDataFrame([(0.2499,), (0.25,), (0.5999,), (0.6,), (None,)], "p double")
    assert values(df.select(S.risk_band("p").alias("b")), "b") == ["low", "medium", "medium", "high", None]
    psi = spark.createDataFrame([(0.09,), (0.1,), (0.25,)], "p double")
    assert values(psi.select(S.psi_class("p").alias("b")), "b") == ["no_drift", "moderate_drift", "significant_drift"]
    assert values(df.select(S.threshold_label("p", 0.25).alias("b")), "b")[:2] == [0, 1]


@pytest.mark.parametrize("side,expected", [("left", [0, 1, 1, 2, 2, None]), ("right", [0, 0, 1, 1, 2, None])])
def test_interior_bins(spark, side, expected):
    df = spark.createDataFrame([(0.0,), (1.0,), (1.5,), (2.0,), (9.0,), (None,)], "x double")
    assert values(df.select(S.interior_bin("x", [1.0, 2.0], side).alias("b")), "b") == expected


def test_price_curve_pieces(spark):
    row = spark.range(1).select(
        S.demand_at(F.lit(100.0), F.lit(50.0), F.lit(100.0), F.lit(-1.0)).alias("d"),
        S.cancel_at(F.lit(0.9), F.lit(1000.0), F.lit(100.0)).alias("c"),
        S.cancel_at(F.lit(0.3), F.lit(100.0), F.lit(100.0)).alias("at_ref"),
    ).first()
    assert row.d == 200.0 and row.c == 0.95 and math.isclose(row.at_ref, 0.3)
