"""Distribution drift between a reference and a current table, for all features in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import hash_rank_key, interior_bin, level_key, psi_class, total
from .ordering import exact_quantiles, range_splits, running_totals, with_range
from .profile import long_row

EPS = 1e-6
DISCRETE_LEVELS = 20


def _tagged(reference: DataFrame, current: DataFrame, columns: Sequence[str]) -> DataFrame:
    ref = reference.select(*columns, F.lit(1).alias("_ref"))
    return ref.unionByName(current.select(*columns, F.lit(0).alias("_ref")))


def _side_counts() -> list[Column]:
    return [
        F.count_if(F.col("_ref") == 1).alias("n_ref"),
        F.count_if(F.col("_ref") == 0).alias("n_cur"),
    ]


def psi_of_cells(cells: DataFrame) -> DataFrame:
    """(feature, psi) from (feature, cell, n_ref, n_cur)."""
    totals = cells.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur")
    )
    r = F.col("n_ref") / F.greatest(F.col("t_ref"), F.lit(1)) + EPS
    c = F.col("n_cur") / F.greatest(F.col("t_cur"), F.lit(1)) + EPS
    joined = cells.join(F.broadcast(totals), "feature")  # one row per feature
    return joined.groupBy("feature").agg(F.sum((c - r) * F.log(c / r)).alias("psi"))


def reference_edges(
    reference: DataFrame, features: Sequence[str], bins: int = 10
) -> dict[str, list[float]]:
    """Distinct interior quantile edges of the reference; the outer bins are open-ended."""
    spots = exact_quantiles(reference, features, [i / bins for i in range(bins + 1)])
    out = {}
    for f in features:
        distinct = sorted({v for v in spots[f].values if v is not None})
        out[f] = distinct[1:-1]
    return out


def psi_numeric(
    reference: DataFrame,
    current: DataFrame,
    features: Sequence[str],
    bins: int = 10,
    edges: dict[str, list[float]] | None = None,
) -> DataFrame:
    """Population stability over the reference's quantile bins (lower edge closed).

    Frozen `edges` let a stream compare each batch with the same reference bins.
    """
    edges = edges or reference_edges(reference, features, bins)
    binned = [(f, {"cell": interior_bin(f, edges[f], side="left")}) for f in features]
    counts = (
        _tagged(reference, current, features)
        .select("_ref", long_row(binned))
        .where("cell is not null")
        .groupBy("feature", "cell")
        .agg(*_side_counts())
    )
    # an empty bin on both sides adds nothing, so absent cells need no row
    return psi_of_cells(counts)


def psi_categorical(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    """Population stability over category levels of either side; null is a level."""
    levels = [(f, {"cell": level_key(f)}) for f in features]
    counts = (
        _tagged(reference, current, features)
        .select("_ref", long_row(levels))
        .groupBy("feature", "cell")
        .agg(*_side_counts())
    )
    return psi_of_cells(counts)


def kolmogorov_p(statistic: Column, n_ref: Column, n_cur: Column, terms: int = 50) -> Column:
    """Asymptotic two-sided p-value: 2 * sum (-1)^(k-1) exp(-2 k^2 x^2), x = d sqrt(nm / (n + m)).

    For x below 0.2 the p-value is 1 to more than ten digits and the series needs no summing.
    """
    n, m = n_ref.cast("double"), n_cur.cast("double")
    x2 = statistic * statistic * (n * m / (n + m))
    series = total(
        [F.lit(2.0 if k % 2 else -2.0) * F.exp(F.lit(-2.0 * k * k) * x2) for k in range(1, terms + 1)]
    )
    bounded = F.least(F.greatest(series, F.lit(0.0)), F.lit(1.0))
    return F.when(x2 < 0.04, F.lit(1.0)).otherwise(bounded)


def ks_two_sample(
    reference: DataFrame, current: DataFrame, features: Sequence[str]
) -> DataFrame:
    """Largest gap between the two empirical distributions of each numeric feature, with p-value."""
    both = _tagged(reference, current, features)
    splits = range_splits(both, {f: F.col(f) for f in features})
    for f in features:
        both = with_range(both, f, splits[f], f"_range_{f}")
    cells = [
        (f, {"value": F.col(f).cast("double"), "_range": F.col(f"_range_{f}")}) for f in features
    ]
    groups = (
        both.select("_ref", long_row(cells))
        .where("value is not null")
        .groupBy("feature", "value", "_range")
        .agg(*_side_counts())
    )
    return ks_of_groups(groups)


def ks_of_groups(groups: DataFrame) -> DataFrame:
    """(feature, ks_stat, ks_pvalue) from (feature, value, _range, n_ref, n_cur)."""
    curve = running_totals(groups, "value", ["n_ref", "n_cur"], keys=["feature"])
    totals = groups.groupBy("feature").agg(
        F.sum("n_ref").alias("t_ref"), F.sum("n_cur").alias("t_cur")
    )
    gap = F.abs(
        F.try_divide(F.col("cum_n_ref"), F.col("t_ref"))
        - F.try_divide(F.col("cum_n_cur"), F.col("t_cur"))
    )
    stats = (
        curve.join(F.broadcast(totals), "feature")  # one row per feature
        .groupBy("feature")
        .agg(
            F.max(gap).alias("ks_stat"),
            F.first("t_ref").alias("t_ref"),
            F.first("t_cur").alias("t_cur"),
        )
    )
    return stats.select(
        "feature",
        "ks_stat",
        kolmogorov_p(F.col("ks_stat"), F.col("t_ref"), F.col("t_cur")).alias("ks_pvalue"),
    )


def discrete_features(
    reference: DataFrame, features: Sequence[str], levels: int = DISCRETE_LEVELS
) -> list[str]:
    """Numerics with few distinct values, whose quantile bins would collapse."""
    if not features:
        return []
    row = reference.agg(*[F.approx_count_distinct(f).alias(f) for f in features]).first()
    return [f for f in features if row[f] <= levels]


def detect_drift(
    reference: DataFrame,
    current: DataFrame,
    target: str,
    features: Sequence[str] | None = None,
    discrete_as_levels: bool = True,
    bins: int = 10,
) -> DataFrame:
    """One row per shared feature: type, psi, class, and KS for numerics; largest psi first.

    With `discrete_as_levels`, numerics of few distinct values are compared level by level; without
    it every numeric goes through quantile bins.
    """
    features = features or [c for c in reference.columns if c != target]
    features = [f for f in features if f in current.columns]
    kinds = {f.name: f.dataType for f in reference.schema}
    numeric = [f for f in features if isinstance(kinds[f], T.NumericType)]
    categorical = [f for f in features if f not in numeric]
    discrete = discrete_features(reference, numeric) if discrete_as_levels else []
    binned = [f for f in numeric if f not in discrete]

    parts = []
    if binned:
        parts.append(psi_numeric(reference, current, binned, bins))
    if categorical or discrete:
        parts.append(psi_categorical(reference, current, categorical + discrete))
    psi = parts[0] if len(parts) == 1 else parts[0].unionByName(parts[1])
    if numeric:
        psi = psi.join(ks_two_sample(reference, current, numeric), "feature", "left")
    else:
        psi = psi.withColumns(
            {"ks_stat": F.lit(None).cast("double"), "ks_pvalue": F.lit(None).cast("double")}
        )
    kind = F.when(F.col("feature").isin(*numeric), "numeric").otherwise("categorical")
    return psi.select(
        "feature",
        kind.alias("type"),
        F.round("psi", 4).alias("psi"),
        psi_class("psi").alias("drift"),
        F.round("ks_stat", 4).alias("ks_stat"),
        F.round("ks_pvalue", 4).alias("ks_pvalue"),
    ).orderBy(F.desc("psi"), "feature")


def summarize(report: DataFrame, top: int = 5) -> DataFrame:
    """Overall class, counts per class, the largest psi and the features that drifted most."""
    ranked = F.array_sort(F.collect_list(F.struct((-F.col("psi")).alias("k"), F.col("feature"))))
    return report.agg(
        F.count_if(F.col("drift") == "significant_drift").alias("n_significant"),
        F.count_if(F.col("drift") == "moderate_drift").alias("n_moderate"),
        F.round(F.coalesce(F.max("psi"), F.lit(0.0)), 4).alias("max_psi"),
        F.transform(F.slice(ranked, 1, top), lambda s: s["feature"]).alias("top_drifted"),
    ).select(
        F.when(F.col("n_significant") > 0, "significant_drift")
        .when(F.col("n_moderate") > 0, "moderate_drift")
        .otherwise("no_drift")
        .alias("overall_drift"),
        "n_significant",
        "n_moderate",
        "max_psi",
        "top_drifted",
    )


# The shift used to make a drifted window.
SHIFT_FACTOR, SHIFT_ADD, FLIP_SHARE = 1.6, 20.0, 0.3


def inject_drift(
    df: DataFrame, id_col: str, numeric: str, category: str, level: str, seed: int | str = 0
) -> DataFrame:
    """A shifted copy for trials: the numeric grows, and about 30% of rows move to one level."""
    flipped = hash_rank_key(id_col, f"flip-{seed}") < F.lit(int(FLIP_SHARE * (1 << 52)))
    return df.withColumns(
        {
            numeric: F.col(numeric) * SHIFT_FACTOR + SHIFT_ADD,
            category: F.when(flipped, F.lit(level)).otherwise(F.col(category)),
        }
    )
