"""Isotonic regression as a table of blocks: exact scores, whatever their number.

Scores are folded to one weighted point each. Points are cut into value ranges, each range pools its
own violators, and what is left is cut anew, with the cuts moved by half a range, until no two
neighbours violate the order. Pooling can be done in any order, so the blocks are those of one pass
over all points. A block replaces the points it pooled: after the first round a table of any size is
usually down to some thousand blocks.
"""

from __future__ import annotations

import json
import math
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.scalar import nan_to_null
from ..session import settle
from .lookup import attach
from .ordering import range_splits, with_range

POOL_ROWS = 250_000  # blocks that one task pools
INLINE_BLOCKS = 10_000  # a map of at most so many blocks is searched in place, a larger one is joined
BLOCKS = ("x_lo", "x_hi", "total", "weight")


def pool_adjacent(points: Iterator[tuple]) -> list[tuple]:
    """Pool violators among (x_lo, x_hi, total, weight) in the order of x; one stack, one pass."""
    stack: list[tuple] = []
    for lo, hi, total, weight in points:
        while stack and stack[-1][2] * weight >= total * stack[-1][3]:
            lo, _, before, more = stack.pop()
            total, weight = total + before, weight + more
        stack.append((lo, hi, total, weight))
    return stack


def pool_range(rows):
    """One value range of blocks as a pandas frame, pooled."""
    import pandas as pd

    ordered = rows.sort_values("x_lo")
    pooled = pd.DataFrame(
        pool_adjacent(ordered[list(BLOCKS)].itertuples(index=False, name=None)), columns=list(BLOCKS)
    )
    pooled["_range"] = int(rows["_range"].iloc[0])
    return pooled


def _violations_left(blocks: DataFrame) -> bool:
    """Does a range end higher than the next one begins? Sees two blocks per range."""
    mean = F.struct("total", "weight")
    ends = blocks.groupBy("_range").agg(
        F.min_by(mean, "x_lo").alias("first"), F.max_by(mean, "x_lo").alias("last")
    )
    before = F.lag("last").over(Window.partitionBy(F.lit(0)).orderBy("_range"))
    pairs = ends.select("first", before.alias("before"))
    falls = F.col("before.total") * F.col("first.weight") >= F.col("first.total") * F.col("before.weight")
    return not pairs.where(falls).isEmpty()


@dataclass
class IsotonicMap:
    """Blocks (x_lo, x_hi, y, weight): y holds between the ends and runs straight from block to block."""

    blocks: DataFrame

    def save(self, path: str) -> None:
        self.blocks.write.mode("overwrite").parquet(path)

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> IsotonicMap:
        return cls(spark.read.parquet(path))

    def apply(
        self, df: DataFrame, score: str, out: str, inline_blocks: int = INLINE_BLOCKS
    ) -> DataFrame:
        """Add the mapped score; beyond the fitted range the nearest end holds.

        A missing score stays missing, and a map of no points maps nothing. Maps of more than
        `inline_blocks` blocks are joined to the distinct scores, which needs a table, not a stream.
        """
        rows = self.blocks.limit(inline_blocks + 1).collect()
        if len(rows) > inline_blocks:
            return self._joined(df, score, out)
        rows = sorted(rows, key=lambda r: r["x_lo"])
        cut = with_range(df, score, [r["x_lo"] for r in rows[1:]], "_block")
        lo, hi, y = (
            F.from_json(F.lit(json.dumps([r[c] for r in rows])), "array<double>")
            for c in ("x_lo", "x_hi", "y")
        )
        at, after = F.col("_block"), F.col("_block") + 1
        mapped = _between(
            nan_to_null(F.col(score).cast("double")),
            F.get(hi, at), F.get(y, at), F.get(lo, after), F.get(y, after),
        )
        return cut.withColumn(out, mapped).drop("_block")

    def _joined(self, df: DataFrame, score: str, out: str) -> DataFrame:
        """Each distinct score meets the blocks of its value range, then the rows are joined to scores."""
        splits = range_splits(self.blocks, {"x_lo": F.col("x_lo")})["x_lo"]
        cut = with_range(self.blocks, "x_lo", splits, "_range")
        block = F.struct("x_lo", "x_hi", "y").alias("_block")
        own = cut.select("_range", F.col("x_lo").alias("_x"), block, F.lit(0).cast("bigint").alias("n"))
        # the first block of a range also ends the range before it
        first = own.groupBy("_range").agg(F.min_by("_block", "_x").alias("_block"))
        ends = first.select(
            (F.col("_range") - 1).alias("_range"),
            F.col("_block.x_lo").alias("_x"),
            "_block",
            F.lit(0).cast("bigint").alias("n"),
        ).where("_range >= 0")
        x = nan_to_null(F.col(score).cast("double"))
        scores = df.select(x.alias("_x")).where("_x is not null").groupBy("_x").agg(F.count(F.lit(1)).alias("n"))
        asked = with_range(scores, "_x", splits, "_range").select(
            "_range", "_x", F.lit(None).cast(own.schema["_block"].dataType).alias("_block"), "n"
        )
        line = Window.partitionBy("_range").orderBy("_x", F.col("_block").isNull())
        upto = line.rowsBetween(Window.unboundedPreceding, 0)
        beyond = line.rowsBetween(1, Window.unboundedFollowing)
        met = own.unionByName(ends).unionByName(asked).select(
            "_x",
            "n",
            F.last("_block", ignorenulls=True).over(upto).alias("at"),
            F.first("_block", ignorenulls=True).over(beyond).alias("after"),
        )
        y = F.coalesce("at.y", "after.y")
        mapped = _between(F.col("_x"), F.col("at.x_hi"), y, F.col("after.x_lo"), F.col("after.y"))
        state = settle(met.where("n > 0").select("_x", "n", mapped.alias(out)))
        return attach(df.withColumn("_x", x), state, ["_x"]).drop("_x")


def _between(x, hi, y, next_lo, next_y):
    """y up to the block's end, then a straight line to the next block."""
    slope = (next_y - y) / (next_lo - hi)
    inner = F.when(x > hi, F.when(next_lo.isNotNull(), y + (x - hi) * slope).otherwise(y))
    return F.when(x.isNotNull(), F.coalesce(inner, y))


def fit_isotonic(
    held_out: DataFrame, label: str, score: str, pool_rows: int = POOL_ROWS
) -> IsotonicMap:
    """Monotone map from score to probability, on rows the model was not trained on.

    Rows without a label or a score take no part. No task pools many more than `pool_rows` blocks,
    unless that is all there are.
    """
    x = nan_to_null(F.col(score).cast("double")).alias("x_lo")
    known = held_out.select(x, F.col(label).cast("double").alias("_y")).where("x_lo is not null and _y is not null")
    points = known.groupBy("x_lo").agg(
        F.sum("_y").alias("total"), F.count(F.lit(1)).cast("double").alias("weight")
    )
    blocks = settle(points.select("x_lo", F.col("x_lo").alias("x_hi"), "total", "weight"))
    shape = "x_lo double, x_hi double, total double, weight double, _range int"
    moved = False
    while True:
        ranges = math.ceil(blocks.count() / pool_rows)
        if ranges > 1:
            # of twice as many cuts every second one, from the first or from the second
            splits = range_splits(blocks, {"x_lo": F.col("x_lo")}, 2 * ranges)["x_lo"]
            splits = splits[0 if moved else 1 :: 2]
        else:
            splits = []
        cut = with_range(blocks.drop("_range"), "x_lo", splits, "_range")
        blocks = settle(cut.groupBy("_range").applyInPandas(pool_range, shape))
        moved = not moved
        if ranges <= 1 or not _violations_left(blocks):
            break
    return IsotonicMap(
        blocks.select("x_lo", "x_hi", (F.col("total") / F.col("weight")).alias("y"), "weight")
    )


def calibrate(
    fitted: IsotonicMap, df: DataFrame, score: str, out: str = "p_calibrated"
) -> DataFrame:
    """Apply the map; scores outside the fitted range take the nearest end."""
    return fitted.apply(df, score, out)
