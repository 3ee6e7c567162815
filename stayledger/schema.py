"""Declared schemas and column roles."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

_S, _I, _L, _D = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind, True) for name, kind in fields])


RAW_BOOKING = _struct(
    ("hotel", _S),
    ("is_canceled", _I),
    ("lead_time", _I),
    ("arrival_date_year", _I),
    ("arrival_date_month", _S),
    ("adults", _I),
    ("children", _I),
    ("babies", _I),
    ("market_segment", _S),
    ("deposit_type", _S),
    ("customer_type", _S),
    ("adr", _D),
    ("previous_cancellations", _I),
    ("booking_changes", _I),
    ("total_of_special_requests", _I),
    ("is_repeated_guest", _I),
    ("country", _S),
    ("agent", _D),
    ("company", _D),
    ("reservation_status", _S),
)

# What an event carries: the raw booking without outcome and leak, plus the two missing flags.
EVENT_BOOKING = _struct(
    *[
        (f.name, f.dataType)
        for f in RAW_BOOKING
        if f.name not in ("is_canceled", "reservation_status")
    ],
    ("agent_missing", _I),
    ("company_missing", _I),
)

BOOKING_EVENT = T.StructType(
    [
        T.StructField("event_id", _L, True),
        T.StructField("booking", EVENT_BOOKING, True),
        T.StructField("_true_label", _I, True),
    ]
)

ACTIVITY_EVENT = _struct(
    ("event_id", _L),
    ("ts", T.TimestampNTZType()),
    ("user_id", _L),
    ("event_type", _S),
    ("value", _D),
    ("props", _S),
)


@dataclass(frozen=True)
class Roles:
    """Which column plays which part; every operator takes these names, none are fixed."""

    id: str = "booking_id"
    target: str = "is_canceled"
    year: str = "arrival_date_year"
    month: str = "arrival_date_month"
    leaks: tuple[str, ...] = ("reservation_status",)
    party: tuple[str, ...] = ("adults", "children", "babies")
    price: str = "adr"
    lead: str = "lead_time"
    sentinel_filled: tuple[str, ...] = ("agent", "company")
    nominal: tuple[str, ...] = (
        "hotel",
        "deposit_type",
        "customer_type",
        "market_segment",
        "lead_time_bucket",
    )
    high_card: tuple[str, ...] = ("country", "agent", "company")
    drop_after_encoding: tuple[str, ...] = ("arrival_date_month",)
    deposit_flag: str = "Non Refund"
    segment_flag: str = "Groups"
