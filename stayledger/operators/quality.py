"""Window gate, record constraints and schema checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def window_verdict(
    window: DataFrame, target: str, value: str, low: float = -1, high: float = 10_000
) -> DataFrame:
    """One-row verdict: rows present, target present, value within [low, high]."""
    has_target = target in window.columns
    return window.agg(
        F.count(F.lit(1)).alias("n_rows"),
        F.count_if(~F.coalesce(F.col(value).between(low, high), F.lit(False))).alias("n_bad"),
    ).select(
        "n_rows",
        "n_bad",
        F.lit(has_target).alias("has_target"),
        ((F.col("n_rows") > 0) & (F.col("n_bad") == 0) & F.lit(has_target)).alias("ok"),
    )


def require_valid_window(window: DataFrame, target: str, value: str, **bounds: float) -> None:
    verdict = window_verdict(window, target, value, **bounds).first()
    if not verdict["ok"]:
        raise ValueError(f"window rejected: {verdict.asDict()}")


@dataclass(frozen=True)
class Rule:
    """A record is rejected for `reason` unless `holds` is true."""

    reason: str
    holds: Column


def in_range(column: str, low: float | None = None, high: float | None = None) -> Rule:
    ok = F.col(column).isNotNull()
    if low is not None:
        ok = ok & (F.col(column) >= low)
    if high is not None:
        ok = ok & (F.col(column) <= high)
    return Rule(f"{column}_out_of_range", ok)


def one_of(column: str, allowed: Sequence[str]) -> Rule:
    return Rule(f"{column}_not_allowed", F.col(column).isin(*allowed))


def present(column: str) -> Rule:
    return Rule(f"{column}_missing", F.col(column).isNotNull())


def booking_request_rules(prefix: str = "") -> list[Rule]:
    """The booking contract at the edge."""
    # Allowed levels and ranges of a booking request.
    p = prefix
    return [
        one_of(p + "hotel", ["City Hotel", "Resort Hotel"]),
        in_range(p + "lead_time", 0, 1000),
        in_range(p + "arrival_date_year", 2010, 2035),
        present(p + "arrival_date_month"),
        in_range(p + "adults", 0, 20),
        in_range(p + "children", 0, 20),
        in_range(p + "babies", 0, 20),
        present(p + "market_segment"),
        one_of(p + "deposit_type", ["No Deposit", "Non Refund", "Refundable"]),
        present(p + "customer_type"),
        in_range(p + "adr", 0, 10_000),
        in_range(p + "previous_cancellations", 0),
        in_range(p + "booking_changes", 0),
        in_range(p + "total_of_special_requests", 0),
        in_range(p + "is_repeated_guest", 0, 1),
        in_range(p + "agent_missing", 0, 1),
        in_range(p + "company_missing", 0, 1),
    ]


# What an absent optional request field reads as.
REQUEST_DEFAULTS = {
    "country": "PRT",
    "agent": 0.0,
    "company": 0.0,
    "agent_missing": 0,
    "company_missing": 1,
}


def with_defaults(df: DataFrame, defaults: Mapping[str, object] = REQUEST_DEFAULTS) -> DataFrame:
    return df.fillna({k: v for k, v in defaults.items() if k in df.columns})


def with_reject_reasons(df: DataFrame, rules: Sequence[Rule], out: str = "reasons") -> DataFrame:
    """Array of the reasons a record breaks the contract, empty for a valid one."""
    broken = [
        F.when(~F.coalesce(rule.holds, F.lit(False)), F.lit(rule.reason)) for rule in rules
    ]
    return df.withColumn(out, F.array_compact(F.array(*broken)))


def valid_and_quarantined(df: DataFrame, rules: Sequence[Rule]) -> tuple[DataFrame, DataFrame]:
    tagged = with_reject_reasons(df, rules)
    return tagged.where(F.size("reasons") == 0).drop("reasons"), tagged.where(F.size("reasons") > 0)


def align_schema(df: DataFrame, expected: Sequence[str], fill: float = 0) -> DataFrame:
    """Expected columns in order; absent ones are filled, others dropped."""
    return df.select(*[F.col(f"`{c}`") if c in df.columns else F.lit(fill).alias(c) for c in expected])


def non_numeric_columns(df: DataFrame) -> list[str]:
    return [
        f.name for f in df.schema if not isinstance(f.dataType, T.NumericType | T.BooleanType)
    ]


def require_model_ready(train: DataFrame, test: DataFrame) -> None:
    bad = non_numeric_columns(train)
    if bad:
        raise ValueError(f"non-numeric columns remain: {bad}")
    if train.columns != test.columns:
        raise ValueError("train and test columns differ")
