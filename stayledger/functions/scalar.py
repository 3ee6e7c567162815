"""Row-wise column expressions. All stay inside whole-stage code generation."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Calendar names in order.
MONTHS = (
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
)

# Lead-time bucket edges (right-closed) and labels.
LEAD_EDGES = (-1, 7, 30, 90, 180, 10_000)
LEAD_LABELS = ("0-7", "8-30", "31-90", "91-180", "180+")

# Risk bands of a probability, and population-stability classes.
RISK_BANDS = ((0.25, "low"), (0.60, "medium"))
RISK_TOP = "high"
PSI_CLASSES = ((0.10, "no_drift"), (0.25, "moderate_drift"))
PSI_TOP = "significant_drift"

NULL_LEVEL = "__null__"
OUT_OF_RANGE = "nan"


def as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def total(parts: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a + b, parts)


def month_number(name: Column | str) -> Column:
    """English month name to 1..12, null when unknown."""
    names = F.array(*[F.lit(m) for m in MONTHS])
    return F.nullif(F.array_position(names, as_col(name)), F.lit(0)).cast("int")


def month_name(number: Column | str) -> Column:
    return F.get(F.array(*[F.lit(m) for m in MONTHS]), as_col(number).cast("int") - 1)


def period_of(year: Column | str, month: Column) -> Column:
    return (as_col(year) * 100 + month).cast("int")


def floor_at(c: Column | str, low: float) -> Column:
    """Raise values below `low` to it; null stays null."""
    c = as_col(c)
    return F.when(c < low, F.lit(low)).otherwise(c)


def cap_at(c: Column | str, high: float) -> Column:
    c = as_col(c)
    return F.when(c > high, F.lit(high)).otherwise(c)


def ladder(c: Column | str, steps: Sequence[tuple[float, str]], top: str) -> Column:
    """First label whose upper bound lies strictly above the value; `top` beyond the last."""
    c = as_col(c)
    out = reduce(
        lambda acc, step: F.when(c < step[0], step[1]) if acc is None else acc.when(c < step[0], step[1]),
        steps,
        None,
    )
    return F.when(c.isNotNull(), out.otherwise(top))


def risk_band(p: Column | str) -> Column:
    return ladder(p, RISK_BANDS, RISK_TOP)


def psi_class(psi: Column | str) -> Column:
    return ladder(psi, PSI_CLASSES, PSI_TOP)


def right_closed_label(
    c: Column | str, edges: Sequence[float], labels: Sequence[str], outside: str = OUT_OF_RANGE
) -> Column:
    """Label of the interval (edge, next edge] that holds the value."""
    c = as_col(c)
    out = F.when(c.isNull() | (c <= edges[0]) | (c > edges[-1]), outside)
    for upper, label in zip(edges[1:], labels, strict=True):
        out = out.when(c <= upper, label)
    return out


def interior_bin(c: Column | str, interior: Sequence[float], side: str) -> Column:
    """0-based bin number among interior edges.

    side="left": a value on an edge opens the upper bin; side="right": it closes the lower one.
    """
    c = as_col(c)
    if not interior:
        return F.when(c.isNotNull(), F.lit(0))
    beyond = (lambda e: c >= e) if side == "left" else (lambda e: c > e)
    steps = [F.when(beyond(F.lit(float(e))), 1).otherwise(0) for e in interior]
    return F.when(c.isNotNull(), total(steps))


def month_angle(month: Column | str) -> Column:
    return 2 * F.pi() * as_col(month) / 12


def level_key(c: Column | str) -> Column:
    """Category as text, with null as a level of its own."""
    return F.coalesce(as_col(c).cast("string"), F.lit(NULL_LEVEL))


def utc_instant(wall: Column | str) -> Column:
    """Zone-less time read as UTC, whatever the session's zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_micros(F.timestamp_diff("MICROSECOND", epoch, as_col(wall)))


def utc_wall(instant: Column | str) -> Column:
    """The UTC wall-clock time of an instant, without zone."""
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return F.timestamp_add("MICROSECOND", F.unix_micros(as_col(instant)), epoch)


def nan_to_null(c: Column | str) -> Column:
    c = as_col(c)
    return F.when(~F.isnan(c), c)


def sigmoid(z: Column) -> Column:
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-z))


def linear(terms: dict[str, float], intercept: float = 0.0) -> Column:
    return total([F.lit(intercept), *[F.lit(w) * F.col(c) for c, w in terms.items()]])


def threshold_label(p: Column | str, threshold: float) -> Column:
    """Label from the unrounded probability."""
    return (as_col(p) >= F.lit(threshold)).cast("int")


HASH_RANGE = float(1 << 52)


def hash_rank_key(id_col: Column | str, seed: int | str) -> Column:
    """52-bit pseudo-random number of (id, seed), the same in any engine that has md5.

    Exactly representable as a double, so it can go through quantile sketches unchanged.
    """
    digest = F.md5(F.concat_ws("-", as_col(id_col).cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint")


# --- pricing curve -----------------------------------------------------------------------------


def demand_at(base: Column, price: Column, ref: Column, elasticity: Column) -> Column:
    """Constant-elasticity demand."""
    return base * F.pow(price / ref, elasticity)


def cancel_at(
    base: Column, price: Column, ref: Column, sensitivity: float = 0.15, ceiling: float = 0.95
) -> Column:
    raw = base * (F.lit(1.0) + F.lit(sensitivity) * (price / ref - F.lit(1.0)))
    return cap_at(floor_at(raw, 0.0), ceiling)


def revenue_at(
    base_demand: Column,
    price: Column,
    ref: Column,
    base_cancel: Column,
    elasticity: Column,
    unit_cost: Column | None = None,
) -> Column:
    margin = price if unit_cost is None else price - unit_cost
    kept = F.lit(1.0) - cancel_at(base_cancel, price, ref)
    return demand_at(base_demand, price, ref, elasticity) * margin * kept
