"""Class weights and synthetic minority rows."""

from __future__ import annotations

import math
from collections.abc import Sequence

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import hash_rank_key
from ..session import stage
from .ordering import range_splits, with_range
from .sampling import sample_fraction


def class_weights(df: DataFrame, target: str) -> DataFrame:
    """Balanced weight per class: rows / (classes * rows of the class)."""
    per_class = df.groupBy(target).agg(F.count(F.lit(1)).alias("n"))
    whole = Window.partitionBy(F.lit(1))  # one row per class
    return per_class.select(
        target,
        "n",
        (F.sum("n").over(whole) / (F.count(F.lit(1)).over(whole) * F.col("n"))).alias("weight"),
    )


def pos_weight(df: DataFrame, target: str) -> DataFrame:
    """Negatives per positive."""
    return df.agg(
        F.try_divide(
            F.count_if(F.col(target) == 0).cast("double"), F.count_if(F.col(target) == 1)
        ).alias("pos_weight")
    )


def with_class_weight(df: DataFrame, target: str, out: str = "weight") -> DataFrame:
    """Attach the balanced class weight to each row as a constant per class."""
    weights = {r[target]: r["weight"] for r in class_weights(df, target).collect()}
    pairs = [x for c, w in weights.items() for x in (F.lit(c), F.lit(float(w)))]
    return df.withColumn(out, F.element_at(F.create_map(*pairs), F.col(target)))


# --- synthetic minority rows -----------------------------------------------------------------------

PROJECTIONS = 6
REACH = 5


def near_neighbours(
    rows: DataFrame, id_col: str, features: Sequence[str], k: int = 5, seed: int = 42
) -> DataFrame:
    """About the k nearest rows of every row: (id, neighbour arrays) without comparing all pairs.

    Each random direction orders the rows; close rows stay close in that order, so the REACH rows
    on either side are candidates, and the k closest of all directions' candidates are kept. Work
    grows linearly with the rows. A range that equal rows made too large is split by hash: among
    equal rows any are the nearest.
    """
    rng = np.random.default_rng(seed)
    vector = F.array(*[F.col(f).cast("double") for f in features])
    base = rows.select(F.col(id_col).alias("id"), vector.alias("x"))
    sides = []
    for _ in range(PROJECTIONS):
        direction = rng.normal(size=len(features))
        along = sum(
            (F.lit(float(w)) * F.col("x")[i] for i, w in enumerate(direction)), F.lit(0.0)
        )
        projected = base.withColumn("at", along)
        splits = range_splits(projected, {"at": F.col("at")})["at"]
        cut = with_range(projected, "at", splits, "_range")
        sizes = {r["_range"]: r["count"] for r in cut.groupBy("_range").count().collect()}
        fair = 2 * sum(sizes.values()) / max(len(splits) + 1, 1) + 2 * REACH
        pieces = [math.ceil(sizes.get(i, 1) / fair) for i in range(len(splits) + 1)]
        piece = F.pmod(F.xxhash64("id"), F.get(F.array(*map(F.lit, pieces)), F.col("_range")))
        cut = cut.withColumn("_piece", piece)
        order = Window.partitionBy("_range", "_piece").orderBy("at", "id")
        mate = F.struct("id", "x")
        around = F.array(
            *[F.lag(mate, d).over(order) for d in range(1, REACH + 1)],
            *[F.lead(mate, d).over(order) for d in range(1, REACH + 1)],
        )
        sides.append(cut.select("id", "x", F.array_compact(around).alias("mates")))
    merged = sides[0]
    for s in sides[1:]:
        merged = merged.unionByName(s)

    def gap(mate):
        squares = F.zip_with(F.col("x"), mate["x"], lambda a, b: (a - b) * (a - b))
        return F.aggregate(squares, F.lit(0.0), lambda s, v: s + v)

    candidates = (
        merged.groupBy("id")
        .agg(F.any_value("x").alias("x"), F.flatten(F.collect_list("mates")).alias("mates"))
        .withColumn(
            "near",
            F.array_sort(
                F.array_distinct(
                    F.transform(
                        "mates",
                        lambda m: F.struct(gap(m).alias("d"), m["id"].alias("id"), m["x"].alias("x")),
                    )
                )
            ),
        )
    )
    return candidates.select("id", "x", F.slice("near", 1, k).alias("near"))


def oversample_minority(
    train: DataFrame,
    target: str,
    id_col: str,
    features: Sequence[str],
    k: int = 5,
    seed: int = 42,
) -> DataFrame:
    """Train rows plus synthetic minority rows until both classes are equally large.

    Takes one training fold only, so nothing it makes can touch validation rows. Each synthetic row
    lies on the segment between a minority row and one of its neighbours. Returns target + features.
    Rows without a label stay and are no class.
    """
    labelled = train.where(F.col(target).isNotNull())
    counts = {r[target]: r["count"] for r in labelled.groupBy(target).count().collect()}
    kept = train.select(target, *[F.col(f).cast("double").alias(f) for f in features])
    if len(counts) != 2:
        return kept
    (minority, few), (_, many) = sorted(counts.items(), key=lambda kv: kv[1])
    needed = many - few
    if needed == 0:
        return kept

    minority_rows = train.where(F.col(target) == minority)
    near = stage(near_neighbours(minority_rows, id_col, features, k, seed), "neighbours")
    whole, rest = divmod(needed, few)
    # The `rest` rows with the smallest hashes make one synthetic row more than the others.
    extra = (
        sample_fraction(near, "id", rest / few, f"extra-{seed}")
        .select("id", F.lit(1).alias("more"))
    )
    copies = near.join(extra, "id", "left").withColumn(
        "copies", F.lit(whole) + F.coalesce("more", F.lit(0))
    )
    draws = copies.where("copies > 0").select(
        "id", "x", "near", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy")
    )
    tag = F.concat_ws("/", F.col("id").cast("string"), F.col("copy").cast("string"))
    pick = F.pmod(hash_rank_key(tag, f"mate-{seed}"), F.greatest(F.size("near"), F.lit(1))).cast("int")
    step = hash_rank_key(tag, f"step-{seed}") / F.lit(float(1 << 52))
    mate = F.coalesce(F.get("near", pick)["x"], F.col("x"))  # alone in its range: itself
    made = draws.select(
        F.lit(minority).cast(train.schema[target].dataType).alias(target),
        F.zip_with(F.col("x"), mate, lambda a, b: a + step * (b - a)).alias("made"),
    )
    synthetic = made.select(target, *[F.col("made")[i].alias(f) for i, f in enumerate(features)])
    return kept.unionByName(synthetic)
