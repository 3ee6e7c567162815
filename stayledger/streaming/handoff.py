"""Drift of a stream against reference counts that were frozen once and saved."""

from __future__ import annotations

import json
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalar import interior_bin, level_key, psi_class
from ..operators.drift import ks_of_groups, psi_of_cells, reference_edges
from ..operators.ordering import range_splits, with_range
from ..operators.profile import long_row

COUNT_KEYS = ["feature", "value", "level"]


@dataclass
class FrozenReference:
    """Counts of a reference by feature and value or level, with the bins it defines.

    `binned` numerics are compared in quantile bins and `levelled` ones level by level, as category
    features are; both kinds of numerics keep their values, so that the KS distance is exact.
    """

    counts: DataFrame
    binned: list[str]
    levelled: list[str]
    categories: list[str]
    edges: dict[str, list[float]]
    splits: dict[str, list[float]]

    @property
    def numerics(self) -> list[str]:
        return [*self.binned, *self.levelled]

    def save(self, path: str) -> None:
        self.counts.write.mode("overwrite").parquet(f"{path}/counts")
        small = {
            k: getattr(self, k) for k in ("binned", "levelled", "categories", "edges", "splits")
        }
        row = self.counts.sparkSession.createDataFrame([(json.dumps(small),)], "value string")
        row.coalesce(1).write.mode("overwrite").text(f"{path}/bins")

    @classmethod
    def load(cls, spark: SparkSession, path: str) -> FrozenReference:
        small = json.loads(spark.read.text(f"{path}/bins").first()[0])
        return cls(spark.read.parquet(f"{path}/counts"), **small)


def cell_rows(df: DataFrame, ref: FrozenReference) -> DataFrame:
    """(feature, value, level) per row and feature; numerics without a value have no cell in bins."""
    none = F.lit(None)

    def entry(f: str) -> tuple[str, dict[str, Column]]:
        value = F.col(f).cast("double") if f in ref.numerics else none.cast("double")
        level = none.cast("string") if f in ref.binned else level_key(f).cast("string")
        return f, {"value": value, "level": level}

    rows = df.select(long_row([entry(f) for f in [*ref.numerics, *ref.categories]]))
    return rows.where("value IS NOT NULL OR level IS NOT NULL")


def cell_counts(df: DataFrame, ref: FrozenReference) -> DataFrame:
    """(feature, value, level, n) of a table or a stream.

    As a stream this is one aggregation; its state has a row per level and distinct value, wherever
    the rows come from, and neither the reference nor older events are read again.
    """
    return cell_rows(df, ref).groupBy(*COUNT_KEYS).agg(F.count(F.lit(1)).alias("n"))


def freeze(
    reference: DataFrame,
    numeric: Sequence[str],
    categories: Sequence[str],
    levelled: Sequence[str] = (),
    bins: int = 10,
) -> FrozenReference:
    """The reference's bins and counts, from one pass for the bins and one for the counts.

    `levelled` names the numerics that are compared level by level.
    """
    binned = [f for f in numeric if f not in levelled]
    edges = reference_edges(reference, binned, bins) if binned else {}
    numbers = [*binned, *levelled]
    splits = range_splits(reference, {f: F.col(f) for f in numbers}) if numbers else {}
    ref = FrozenReference(reference, binned, list(levelled), list(categories), edges, splits)
    ref.counts = cell_counts(reference, ref)
    return ref


def by_feature(features: Sequence[str], make) -> Column:
    """The expression `make(feature)` in the rows of each feature."""
    out = F.lit(None)
    for f in features:
        out = F.when(F.col("feature") == f, make(f)).otherwise(out)
    return out


def with_own_range(groups: DataFrame, ref: FrozenReference) -> DataFrame:
    """Add the value range of each row's feature, by binary search: there may be thousands of ranges."""
    ranges = {f: f"_range_{i}" for i, f in enumerate(ref.numerics)}
    for f, out in ranges.items():
        groups = with_range(groups, "value", ref.splits[f], out)
    own = by_feature(ref.numerics, lambda f: F.col(ranges[f]))
    return groups.withColumn("_range", own).drop(*ranges.values())


def drift_of_counts(ref: FrozenReference, counts: DataFrame) -> DataFrame:
    """The drift report of counted rows against the frozen reference: type, psi, class, KS, p-value.

    Equal to the batch report over the same rows. All work is on counts; a feature whose rows are all
    in one cell costs one row.
    """
    zero = F.lit(0).cast("long")
    sides = ref.counts.select(*COUNT_KEYS, F.col("n").alias("n_ref"), zero.alias("n_cur")).unionByName(
        counts.select(*COUNT_KEYS, zero.alias("n_ref"), F.col("n").alias("n_cur"))
    )
    cell = F.coalesce(
        F.col("level"),
        by_feature(ref.binned, lambda f: interior_bin("value", ref.edges[f], side="left").cast("string")),
    )
    cells = sides.groupBy("feature", cell.alias("cell")).agg(
        F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
    )
    report = psi_of_cells(cells)
    if ref.numerics:
        groups = sides.where("value IS NOT NULL").groupBy("feature", "value").agg(
            F.sum("n_ref").alias("n_ref"), F.sum("n_cur").alias("n_cur")
        )
        report = report.join(ks_of_groups(with_own_range(groups, ref)), "feature", "left")
    else:
        report = report.withColumns({c: F.lit(None).cast("double") for c in ("ks_stat", "ks_pvalue")})
    kind = F.when(F.col("feature").isin(*ref.numerics), "numeric").otherwise("categorical")
    return report.select(
        "feature",
        kind.alias("type"),
        F.round("psi", 4).alias("psi"),
        psi_class("psi").alias("drift"),
        F.round("ks_stat", 4).alias("ks_stat"),
        F.round("ks_pvalue", 4).alias("ks_pvalue"),
    )
