"""Global order without a global sort in one task.

Three tools, all exact:

* `order_statistics` / `exact_quantiles` find values at given ranks by narrowing: a sketch brackets
  each rank, a counting pass checks the bracket, and only the rows inside it are sorted.
* `running_totals` gives cumulative sums over ordered value groups: groups are cut into value
  ranges, each range is summed in its own task, and the per-range totals supply the offsets.
* `row_positions` numbers all rows in a global order in the same way.
"""

from __future__ import annotations

import bisect
import json
import math
import sys
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.ml.feature import Bucketizer
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import as_col, nan_to_null
from ..session import null_safe_join

SORT_LIMIT = 250_000  # rows one task may sort when selecting a rank
GRID = 512  # sketch points per column
SKETCH_ACCURACY = 4_096  # rank error of a sketch, well below one grid step
MAX_ROUNDS = 24
LARGEST = sys.float_info.max


@dataclass
class Bracket:
    """Values between lo and hi (None = open) that hold some target ranks of one column."""

    name: str
    ranks: list[int]
    lo: float | None = None
    hi: float | None = None
    below: int = 0
    inside: int = 0
    outer: tuple = (None, None)

    def bounds(self) -> tuple[float | None, float | None]:
        """Finite bounds; an end beyond the largest number is open."""
        lo = None if self.lo is None or self.lo == -math.inf else min(self.lo, LARGEST)
        hi = None if self.hi is None or self.hi >= LARGEST else max(self.hi, -LARGEST)
        return lo, hi

    def cells(self, edges: Sequence[float]) -> range:
        """The cells between consecutive edges that make up the bracket."""
        lo, hi = self.bounds()
        start = 0 if lo is None else bisect.bisect_right(edges, lo)
        stop = len(edges) + 1 if hi is None else bisect.bisect_right(edges, _above(hi))
        return range(start, stop)


def _above(x: float) -> float:
    return math.nextafter(x, math.inf)


def _edges_by_column(brackets: Sequence[Bracket]) -> dict[str, list[float]]:
    edges: dict[str, set[float]] = {}
    for b in brackets:
        mine = edges.setdefault(b.name, set())
        lo, hi = b.bounds()
        mine |= {lo} if lo is not None else set()
        mine |= {_above(hi)} if hi is not None else set()
    return {name: sorted(e) for name, e in edges.items()}


def _long_cells(data: DataFrame, edges: Mapping[str, list[float]], with_value: bool) -> DataFrame:
    """One row (c, cell[, v]) per column and non-null value; the cell is found by binary search."""
    for i, (name, cuts) in enumerate(edges.items()):
        data = with_range(data, name, cuts, f"_cell_{i}")
    parts = []
    for i, name in enumerate(edges):
        cell = F.when(F.col(name).isNotNull(), F.col(f"_cell_{i}")).alias("cell")
        value = [F.col(name).alias("v")] if with_value else []
        parts.append(F.struct(F.lit(i).alias("c"), cell, *value))
    return data.select(F.inline(F.array(*parts))).where("cell is not null")


def _count_brackets(data: DataFrame, brackets: Sequence[Bracket]) -> None:
    """Fill in how many values lie below and inside each bracket, in one pass."""
    edges = _edges_by_column(brackets)
    rows = _long_cells(data, edges, False).groupBy("c", "cell").agg(F.count(F.lit(1)).alias("n"))
    seen = {(r["c"], r["cell"]): r["n"] for r in rows.collect()}  # a few cells per bracket
    number = {name: i for i, name in enumerate(edges)}
    for b in brackets:
        cells = b.cells(edges[b.name])
        c = number[b.name]
        b.below = sum(seen.get((c, k), 0) for k in range(cells.start))
        b.inside = sum(seen.get((c, k), 0) for k in cells)


def _narrow_by_sketch(data: DataFrame, brackets: Sequence[Bracket]) -> None:
    """Tighten each bracket around its rank with a quantile sketch of the values inside it."""
    spots = ",".join(f"{i / GRID}D" for i in range(GRID + 1))
    areas = list(dict.fromkeys((b.name, b.lo, b.hi) for b in brackets))
    values = []
    for j, (name, lo, hi) in enumerate(areas):
        d = F.col(name).cast("double")
        ok = d.isNotNull()
        ok = ok if lo is None else ok & (d >= F.lit(lo))
        ok = ok if hi is None else ok & (d <= F.lit(hi))
        values.append(F.when(ok, d).alias(f"a{j}"))
    sketches = [
        F.expr(f"percentile_approx(a{j}, array({spots}), {SKETCH_ACCURACY})").alias(f"a{j}")
        for j in range(len(areas))
    ]
    drawn = data.select(*values).agg(*sketches).first()
    for b in brackets:
        points = drawn[f"a{areas.index((b.name, b.lo, b.hi))}"]
        g = int((b.ranks[0] - b.below) / max(b.inside - 1, 1) * GRID)
        b.outer = (b.lo, b.hi)
        b.lo, b.hi = points[max(g - 1, 0)], points[min(g + 2, GRID)]


def _select(data: DataFrame, brackets: Sequence[Bracket]) -> dict[tuple[str, int], object]:
    """Sort the values inside the brackets and pick the asked ranks."""
    found: dict[tuple[str, int], object] = {}
    kinds: dict[str, list[Bracket]] = {}
    for b in brackets:
        kinds.setdefault(data.schema[b.name].dataType.simpleString(), []).append(b)
    for group in kinds.values():
        edges = _edges_by_column(group)
        holders = [
            [
                [j for j, b in enumerate(group) if b.name == name and cell in b.cells(cuts)]
                for cell in range(len(cuts) + 1)
            ]
            for name, cuts in edges.items()
        ]
        ints = "array<array<array<int>>>"
        where = F.from_json(F.lit(json.dumps(holders)), ints)
        wanted = F.from_json(F.lit(json.dumps([b.ranks for b in group])), "array<array<bigint>>")
        offset = F.from_json(F.lit(json.dumps([b.below for b in group])), "array<bigint>")
        running = Window.partitionBy("t").orderBy("v")
        picked = (
            _long_cells(data, edges, True)
            .select(F.explode(F.get(F.get(where, "c"), "cell")).alias("t"), "v")
            .groupBy("t", "v")
            .agg(F.count(F.lit(1)).alias("n"))
            .withColumn("upto", F.sum("n").over(running) + F.get(offset, "t"))
            .withColumn(
                "hits",
                F.filter(
                    F.get(wanted, "t"),
                    lambda r: (r < F.col("upto")) & (r >= F.col("upto") - F.col("n")),
                ),
            )
            .where(F.size("hits") > 0)
            .select("t", "v", F.explode("hits").alias("r"))
        )
        for row in picked.collect():  # one row per asked rank
            found[group[row["t"]].name, row["r"]] = row["v"]
    return found


def _without_nan(data: DataFrame) -> DataFrame:
    """Not-a-number counts as missing."""
    real = (T.DoubleType, T.FloatType)
    return data.select(
        *[
            nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, real) else f.name
            for f in data.schema
        ]
    )


def order_statistics(
    df: DataFrame,
    columns: Mapping[str, Column],
    ranks_of,
    limit: int = SORT_LIMIT,
    counts: Mapping[str, int] | None = None,
    uniform_below: float | None = None,
) -> tuple[dict[str, int], dict[str, dict[int, object]]]:
    """Exact values at 0-based ranks of each column's non-null values.

    `ranks_of(name, n)` names the ranks once the count n is known. Returns the counts and
    {name: {rank: value}}. The driver holds only sketch points and one value per rank. Counts the
    caller already knows save the counting pass; `uniform_below` says that values spread evenly over
    [0, uniform_below), as hashes do, which places the first brackets without a sketch.
    """
    names = list(columns)
    if not names:
        return {}, {}
    data = _without_nan(df.select(*[columns[n].alias(n) for n in names]))
    if counts is None:
        sizes = data.agg(*[F.count(n).alias(f"n_{i}") for i, n in enumerate(names)]).first()
        counts = {n: sizes[f"n_{i}"] for i, n in enumerate(names)}

    ready: list[Bracket] = []
    wide: list[Bracket] = []
    placed: list[Bracket] = []
    for name in names:
        n = counts[name]
        ranks = sorted({r for r in ranks_of(name, n) if 0 <= r < n})
        if not ranks:
            continue
        if n <= limit:
            ready.append(Bracket(name, ranks, inside=n))
        elif uniform_below is not None:
            reach = 6 * math.sqrt(n)
            for r in ranks:
                lo, hi = ((r + side) / n * uniform_below for side in (-reach, reach))
                placed.append(Bracket(name, [r], lo, hi))
        else:
            wide += [Bracket(name, [r], inside=n) for r in ranks]

    for _ in range(MAX_ROUNDS):
        if not wide and not placed:
            break
        if wide:
            _narrow_by_sketch(data, wide)
        placed += wide
        wide = []
        _count_brackets(data, placed)
        again: list[Bracket] = []
        for b in placed:
            r = b.ranks[0]
            if r < b.below:  # overshot: step back into the enclosing bracket
                again.append(Bracket(b.name, b.ranks, b.outer[0], b.lo, outer=b.outer))
            elif r >= b.below + b.inside:
                again.append(Bracket(b.name, b.ranks, b.hi, b.outer[1], outer=b.outer))
            elif b.inside <= limit or b.lo == b.hi:
                ready.append(b)
            else:
                wide.append(b)
        placed = again
    for b in [*wide, *placed]:  # never narrowed enough: sort all distinct values, still exact
        ready.append(Bracket(b.name, b.ranks, inside=counts[b.name]))

    # adjacent ranks share their bracket
    merged: dict[tuple, Bracket] = {}
    for b in ready:
        twin = merged.setdefault((b.name, b.lo, b.hi), b)
        if twin is not b:
            twin.ranks = sorted({*twin.ranks, *b.ranks})
    found: dict[str, dict[int, object]] = {n: {} for n in names}
    for (name, rank), value in (_select(data, list(merged.values())) if merged else {}).items():
        found[name][rank] = value
    return dict(counts), found


@dataclass
class Quantiles:
    n: int
    values: list  # one per asked fraction, None when the column holds no value


def exact_quantiles(
    df: DataFrame,
    columns: Mapping[str, Column] | Sequence[str],
    fractions: Sequence[float],
    limit: int = SORT_LIMIT,
) -> dict[str, Quantiles]:
    """Linear-interpolation quantiles of each column's non-null values, exact at any size."""
    if not isinstance(columns, Mapping):
        columns = {c: F.col(c) for c in columns}

    def spots(n: int) -> list[tuple[int, int, float]]:
        out = []
        for q in fractions:
            h = (n - 1) * q
            lo = math.floor(h)
            out.append((lo, min(math.ceil(h), n - 1), h - lo))
        return out

    def ranks(_name: str, n: int) -> list[int]:
        return [r for lo, hi, _ in spots(n) for r in (lo, hi)] if n else []

    counts, found = order_statistics(df, columns, ranks, limit)
    out = {}
    for name in columns:
        n = counts[name]
        got = found[name]
        out[name] = Quantiles(
            n,
            [float(got[lo]) + (float(got[hi]) - float(got[lo])) * part for lo, hi, part in spots(n)]
            if n
            else [None] * len(fractions),
        )
    return out


# --- value ranges ------------------------------------------------------------------------------


def range_count(df: DataFrame) -> int:
    """How many value ranges to cut: a few per shuffle partition, bounded."""
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions", "200"))
    return max(2, min(4 * parts, 4096))


def range_splits(
    df: DataFrame, columns: Mapping[str, Column], ranges: int | None = None
) -> dict[str, list[float]]:
    """Interior split points that cut each column into ranges of about equal row counts."""
    ranges = ranges or range_count(df)
    spots = ",".join(f"{i / ranges}D" for i in range(1, ranges))
    sketches = [
        F.expr(f"percentile_approx(c{i}, array({spots}), {max(1_000, 8 * ranges)})").alias(f"c{i}")
        for i in range(len(columns))
    ]
    values = [c.cast("double").alias(f"c{i}") for i, c in enumerate(columns.values())]
    row = df.select(*values).agg(*sketches).first()
    return {
        n: sorted({v for v in row[f"c{i}"] or [] if math.isfinite(v)}) for i, n in enumerate(columns)
    }


def with_range(df: DataFrame, column: str, splits: Sequence[float], out: str) -> DataFrame:
    """Add the number of the value range (0, 1, ...) that holds `column`; binary search in the JVM."""
    if not splits:
        return df.withColumn(out, F.lit(0))
    as_double = f"{out}_value"
    cut = Bucketizer(
        splits=[-math.inf, *splits, math.inf],
        inputCol=as_double,
        outputCol=out,
        handleInvalid="keep",
    )
    ready = df.withColumn(as_double, as_col(column).cast("double"))
    return cut.transform(ready).drop(as_double).withColumn(out, F.col(out).cast("int"))


def running_totals(
    groups: DataFrame,
    value: str,
    sums: Sequence[str],
    keys: Sequence[str] = (),
    range_col: str = "_range",
    descending: bool = False,
    prefix: str = "cum_",
) -> DataFrame:
    """Cumulative sums over groups ordered by `value`, within `keys`.

    `groups` holds one row per (keys, value) and the range number of the value. The window over
    ranges sees ranges x keys rows, the window over values one range; no task sees a whole key.
    """
    order = F.col(range_col).desc() if descending else F.col(range_col).asc()
    earlier = (
        Window.partitionBy(*(keys or [F.lit(0)]))
        .orderBy(order)
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        groups.groupBy(*keys, range_col)
        .agg(*[F.sum(s).alias(f"_t_{s}") for s in sums])
        .select(
            *keys,
            range_col,
            *[F.coalesce(F.sum(f"_t_{s}").over(earlier), F.lit(0)).alias(f"_o_{s}") for s in sums],
        )
    )
    inner_order = F.col(value).desc() if descending else F.col(value).asc()
    inner = Window.partitionBy(*keys, range_col).orderBy(inner_order)
    return (
        null_safe_join(groups, offsets, [*keys, range_col])
        .withColumns({f"{prefix}{s}": F.col(f"_o_{s}") + F.sum(s).over(inner) for s in sums})
        .drop(*[f"_o_{s}" for s in sums])
    )


def row_positions(
    df: DataFrame, leading: Sequence[str], id_col: str, out: str = "position"
) -> DataFrame:
    """0-based position of every row in the order (leading columns, id).

    `leading` is coarse (a calendar period); ids are unique and cut into ranges, so one hot period
    spreads over as many tasks as there are ranges.
    """
    splits = range_splits(df, {id_col: F.col(id_col)})[id_col]
    cut = with_range(df, id_col, splits, "_range")
    cells = [*leading, "_range"]
    before = (
        Window.partitionBy(F.lit(0)).orderBy(*cells).rowsBetween(Window.unboundedPreceding, -1)
    )
    offsets = (
        cut.groupBy(*cells)
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*cells, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    inner = Window.partitionBy(*cells).orderBy(id_col)
    return (
        null_safe_join(cut, offsets, cells)
        .withColumn(out, F.col("_before") + F.row_number().over(inner) - 1)
        .drop("_before", "_range")
    )
