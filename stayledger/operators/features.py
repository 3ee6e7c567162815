"""Stateless row-wise features; one projection after Catalyst collapses the steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import (
    LEAD_EDGES,
    LEAD_LABELS,
    flag,
    floor_at,
    month_angle,
    month_number,
    right_closed_label,
)
from ..schema import Roles

# Months counted as summer and as peak season.
SUMMER = (6, 7, 8)
PEAK = (6, 7, 8, 12)

# Lead time that counts as long, and weights of the composite risk score.
LONG_LEAD = 180
RISK_WEIGHTS = {
    "nonrefund": 2.0,
    "groups": 1.5,
    "long_lead": 1.0,
    "previous": 1.0,
    "requests": -1.0,
    "repeat": -1.0,
}


def log_transforms(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumns(
        {
            "lead_time_log": F.log1p(roles.lead),
            "adr_log": F.log1p(floor_at(roles.price, 0.0)),
        }
    )


def binary_flags(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "has_prev_cancellation": flag(F.col("previous_cancellations") > 0),
            "has_booking_changes": flag(F.col("booking_changes") > 0),
            "has_special_requests": flag(F.col("total_of_special_requests") > 0),
            "has_children": F.greatest(flag(F.col("children") > 0), flag(F.col("babies") > 0)),
        }
    )


def guest_features(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    adults, children, babies = (F.col(p) for p in roles.party)
    guests = adults + children + babies
    return df.withColumns(
        {
            "total_guests": guests,
            "is_solo": flag(guests == 1),
            "is_family": flag((adults >= 1) & (children + babies > 0)),
            "adr_per_guest": F.col(roles.price) / floor_at(guests, 1),
        }
    )


def cyclical_month(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    month = month_number(roles.month)
    return df.withColumns(
        {
            "arrival_month_num": month,
            "month_sin": F.sin(month_angle(month)),
            "month_cos": F.cos(month_angle(month)),
            "is_summer": flag(month.isin(*SUMMER)),
            "is_peak_season": flag(month.isin(*PEAK)),
        }
    )


def lead_buckets(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumn(
        "lead_time_bucket", right_closed_label(roles.lead, LEAD_EDGES, LEAD_LABELS)
    )


def interactions(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    return df.withColumns(
        {
            "lead_x_nonrefund": F.col("lead_time_log")
            * flag(F.col("deposit_type") == roles.deposit_flag),
            "lead_x_groups": F.col("lead_time_log")
            * flag(F.col("market_segment") == roles.segment_flag),
            "requests_x_repeat": F.col("total_of_special_requests") * F.col("is_repeated_guest"),
        }
    )


def risk_score(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    signals = {
        "nonrefund": flag(F.col("deposit_type") == roles.deposit_flag),
        "groups": flag(F.col("market_segment") == roles.segment_flag),
        "long_lead": flag(F.col(roles.lead) > LONG_LEAD),
        "previous": F.col("has_prev_cancellation"),
        "requests": F.col("has_special_requests"),
        "repeat": F.col("is_repeated_guest"),
    }
    score = sum((F.lit(w) * signals[name] for name, w in RISK_WEIGHTS.items()), F.lit(0.0))
    return df.withColumn("risk_score", score)


def engineer(df: DataFrame, roles: Roles = Roles()) -> DataFrame:
    """All row-wise features: twenty new columns."""
    return (
        df.transform(log_transforms, roles)
        .transform(binary_flags)
        .transform(guest_features, roles)
        .transform(cyclical_month, roles)
        .transform(lead_buckets, roles)
        .transform(interactions, roles)
        .transform(risk_score, roles)
    )
