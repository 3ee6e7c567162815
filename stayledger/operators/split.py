"""Time split, stratified split and folds.

None of these moves the rows: each finds a few exact cut values and compares every row with them.
"""

from __future__ import annotations

import bisect
import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import HASH_RANGE, hash_rank_key, month_number, period_of, total
from ..schema import Roles
from .ordering import SORT_LIMIT, order_statistics


def with_period(df: DataFrame, roles: Roles = Roles(), out: str = "period") -> DataFrame:
    """Sortable arrival index: year * 100 + month."""
    return df.withColumn(out, period_of(roles.year, month_number(roles.month)))


def period_counts(df: DataFrame, period: str) -> list[tuple[int, int]]:
    """Rows per calendar period in order; as many entries as the calendar has periods."""
    return _counts_and_undated(df, period)[0]


def _counts_and_undated(df: DataFrame, period: str) -> tuple[list[tuple[int, int]], int]:
    rows = df.groupBy(period).agg(F.count(F.lit(1)).alias("n")).collect()
    dated = sorted((r[0], r[1]) for r in rows if r[0] is not None)
    return dated, sum(r[1] for r in rows if r[0] is None)


def weighted_quantile(counts: list[tuple[int, int]], q: float) -> float:
    """Linear-interpolation quantile of values given with their multiplicities, in order."""
    ends, seen = [], 0
    for _, n in counts:
        seen += n
        ends.append(seen)
    h = (seen - 1) * q

    def at(rank: int) -> float:
        return float(counts[bisect.bisect_right(ends, rank)][0])

    lo, hi = at(math.floor(h)), at(math.ceil(h))
    return lo + (hi - lo) * (h - math.floor(h))


@dataclass(frozen=True)
class TimeCut:
    cutoff: float
    n_train: int
    n_test: int
    n_undated: int = 0  # rows without a period, on neither side


def time_cutoff(df: DataFrame, period: str = "period", test_size: float = 0.2) -> TimeCut:
    counts, undated = _counts_and_undated(df, period)
    if not counts:
        raise ValueError("time split: no row has a period")
    if undated:
        warnings.warn(f"time split: {undated} rows have no period and are on neither side", stacklevel=2)
    cutoff = weighted_quantile(counts, 1 - test_size)
    n_train = sum(n for p, n in counts if p <= cutoff)
    n_test = sum(n for p, n in counts if p > cutoff)
    if not n_train or not n_test:
        raise ValueError("time split: one side is empty; check the span of periods")
    return TimeCut(cutoff, n_train, n_test, undated)


def time_split(
    df: DataFrame, period: str = "period", test_size: float = 0.2
) -> tuple[DataFrame, DataFrame, TimeCut]:
    """Earlier periods train, later ones test; a boundary period stays whole on the train side."""
    cut = time_cutoff(df, period, test_size)
    return (
        df.where(F.col(period) <= F.lit(cut.cutoff)),
        df.where(F.col(period) > F.lit(cut.cutoff)),
        cut,
    )


HASH = "_hash"


def _class_hash_cuts(hashed: DataFrame, target: str, ranks_of, limit: int) -> dict:
    """{class: (rows, {rank: hash})} for ranks within each class of the target.

    The hash is a column of its own, so it is computed once per row however often it is compared.
    """
    sizes = hashed.groupBy(target).agg(F.count(F.lit(1)).alias("n")).orderBy(target).collect()
    classes = [r for r in sizes if r[target] is not None]
    columns = {f"c{i}": F.when(F.col(target) == r[target], F.col(HASH)) for i, r in enumerate(classes)}
    known = {f"c{i}": r["n"] for i, r in enumerate(classes)}
    _, found = order_statistics(
        hashed, columns, lambda _name, n: ranks_of(n), limit, known, uniform_below=HASH_RANGE
    )
    return {r[target]: (r["n"], found[f"c{i}"]) for i, r in enumerate(classes)}


def stratified_split(
    df: DataFrame,
    target: str,
    id_col: str,
    test_size: float = 0.2,
    seed: int | str = 42,
    limit: int = SORT_LIMIT,
    out: str = "split",
) -> DataFrame:
    """Tag rows 'train'/'test': in each class the round(test_size * n) smallest hashes test."""

    def edge(n: int) -> list[int]:
        return [max(math.floor(test_size * n + 0.5) - 1, 0)]

    hashed = df.withColumn(HASH, hash_rank_key(id_col, seed))
    cuts = _class_hash_cuts(hashed, target, edge, limit)
    key = F.col(HASH)
    in_test = F.lit(False)
    for level, (n, found) in cuts.items():
        if math.floor(test_size * n + 0.5):
            in_test = in_test | ((F.col(target) == level) & (key <= F.lit(found[edge(n)[0]])))
    return hashed.withColumn(out, F.when(in_test, "test").otherwise("train")).drop(HASH)


def stratified_folds(
    df: DataFrame,
    target: str,
    id_col: str,
    k: int = 5,
    seed: int | str = 42,
    limit: int = SORT_LIMIT,
    out: str = "fold",
) -> DataFrame:
    """Fold 0..k-1 per row: hash order within a class, cut into k parts of equal size (+-1)."""

    def starts(n: int) -> list[int]:
        return [-(-j * n // k) for j in range(1, k)]

    hashed = df.withColumn(HASH, hash_rank_key(id_col, seed))
    cuts = _class_hash_cuts(hashed, target, starts, limit)
    key = F.col(HASH)
    fold = F.lit(0)
    for level, (n, found) in cuts.items():
        edges = [found[r] for r in starts(n) if r in found]
        steps = [F.when(key >= F.lit(e), 1).otherwise(0) for e in edges]
        if steps:
            fold = F.when(F.col(target) == level, total(steps)).otherwise(fold)
    return hashed.withColumn(out, fold.cast("int")).drop(HASH)


# --- time-ordered cross-validation ---------------------------------------------------------------


@dataclass(frozen=True)
class Fold:
    """Row positions: train [train_from, valid_from), valid [valid_from, valid_to)."""

    number: int
    train_from: int
    valid_from: int
    valid_to: int


def expanding_folds(n: int, k: int = 5) -> list[Fold]:
    """k forward blocks of n // (k + 1) rows at the end; each trains on everything before it."""
    size = n // (k + 1)
    if size == 0:
        raise ValueError(f"too few rows ({n}) for {k} folds")
    starts = range(n - k * size, n, size)
    return [Fold(i, 0, s, s + size) for i, s in enumerate(starts, 1)]


def rolling_folds(n: int, k: int = 5, window: int | None = None) -> list[Fold]:
    """Forward blocks that train on the last `window` rows (two blocks by default)."""
    size = n // (k + 1)
    width = window or 2 * size
    folds = [
        Fold(i, max(0, i * size - width), i * size, n if i == k else (i + 1) * size)
        for i in range(1, k + 1)
    ]
    return [f for f in folds if f.train_from < f.valid_from < f.valid_to]


def _order_key(id_col: str, hashed: bool) -> Column:
    return hash_rank_key(id_col, "order") if hashed else F.col(id_col)


@dataclass(frozen=True)
class TimePlan:
    """Folds with the (period, order key) row that opens each cut position."""

    n: int
    folds: list[Fold]
    opens: dict[int, tuple]  # position -> (period, order key) of the row there
    period: str
    id_col: str
    hashed: bool = False

    @property
    def key(self) -> Column:
        return _order_key(self.id_col, self.hashed)

    def at_or_after(self, position: int) -> Column:
        if position <= 0:
            return F.lit(True)
        if position >= self.n:
            return F.lit(False)
        p, i = self.opens[position]
        return (F.col(self.period) > F.lit(p)) | (
            (F.col(self.period) == F.lit(p)) & (self.key >= F.lit(i))
        )

    def between(self, start: int, stop: int) -> Column:
        return self.at_or_after(start) & ~self.at_or_after(stop)

    def train(self, df: DataFrame, fold: Fold) -> DataFrame:
        return df.where(self.between(fold.train_from, fold.valid_from))

    def valid(self, df: DataFrame, fold: Fold) -> DataFrame:
        return df.where(self.between(fold.valid_from, fold.valid_to))


def plan_time_folds(
    df: DataFrame,
    period: str,
    id_col: str,
    scheme: str = "expanding",
    k: int = 5,
    window: int | None = None,
    limit: int = SORT_LIMIT,
) -> TimePlan:
    """Turn fold positions in the order (period, id) into boundary rows.

    The period histogram says which period holds a position; an exact rank search inside that
    period gives the id. No row gets a number and none is moved. Ids that are not numbers are
    ordered by their hash.
    """
    hashed = not isinstance(df.schema[id_col].dataType, T.NumericType)
    key = _order_key(id_col, hashed)
    counts = period_counts(df, period)
    n = sum(c for _, c in counts)
    if scheme == "expanding":
        folds = expanding_folds(n, k)
    elif scheme == "rolling":
        folds = rolling_folds(n, k, window)
    else:
        raise ValueError(f"unknown scheme {scheme!r}")
    positions = {p for f in folds for p in (f.train_from, f.valid_from, f.valid_to) if 0 < p < n}

    inside: dict[str, list[int]] = {}
    where: dict[str, tuple] = {}
    known: dict[str, int] = {}
    seen = 0
    for value, size in counts:
        local = [p - seen for p in positions if seen <= p < seen + size]
        if local:
            inside[f"p{value}"] = local
            where[f"p{value}"] = (value, seen)
            known[f"p{value}"] = size
        seen += size
    columns = {
        name: F.when(F.col(period) == F.lit(value), key)
        for name, (value, _) in where.items()
    }
    _, found = order_statistics(df, columns, lambda name, _n: inside[name], limit, known)
    opens = {
        where[name][1] + rank: (where[name][0], row_id)
        for name, ranks in found.items()
        for rank, row_id in ranks.items()
    }
    return TimePlan(n, folds, opens, period, id_col, hashed)


def with_folds(df: DataFrame, plan: TimePlan) -> DataFrame:
    """One row per (row, fold it takes part in) with its role."""
    parts = []
    for f in plan.folds:
        for role, cond in (
            ("train", plan.between(f.train_from, f.valid_from)),
            ("valid", plan.between(f.valid_from, f.valid_to)),
        ):
            cell = F.struct(F.lit(f.number).alias("fold"), F.lit(role).alias("role"))
            parts.append(F.when(cond, cell))
    return df.select("*", F.inline(F.array_compact(F.array(*parts))))


def describe_folds(df: DataFrame, plan: TimePlan, target: str) -> DataFrame:
    """Size and positive rate per fold and role."""
    return (
        with_folds(df, plan)
        .groupBy("fold", "role")
        .agg(F.count(F.lit(1)).alias("n_rows"), F.avg(target).alias("positive_rate"))
    )
