"""Classification metrics from one grouping by score.

Rows are first folded to (score, positives, negatives); everything tie-aware follows from running
totals over those groups, which are cut into score ranges so that no task sorts them all.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import interior_bin, total
from ..session import stage
from .ordering import exact_quantiles, range_splits, running_totals, with_range

# 0.05, 0.10, ..., 0.95.
THRESHOLDS = tuple(i / 100 for i in range(5, 100, 5))
MAX_CURVE_POINTS = 100


def score_groups(
    df: DataFrame, label: str, score: str, keys: Sequence[str] = ()
) -> DataFrame:
    """(keys, score, pos, neg, _range) over rows that have both label and score."""
    usable = df.where(F.col(label).isNotNull() & F.col(score).isNotNull())
    splits = range_splits(usable, {score: F.col(score)})[score]
    groups = usable.groupBy(*keys, score).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    return with_range(groups, score, splits, "_range")


def _ratio(a: Column, b: Column) -> Column:
    return F.try_divide(a.cast("double"), b)


def binary_metrics(
    df: DataFrame,
    label: str,
    score: str,
    threshold: float = 0.5,
    keys: Sequence[str] = (),
) -> DataFrame:
    """ROC-AUC, average precision, precision, recall, F1 and Brier score, per key if given.

    Rank metrics are null when only one class is present; precision, recall and F1 fall to 0.
    """
    return _metrics_of_groups(score_groups(df, label, score, keys), score, threshold, keys)


def metrics_of_counts(
    counts: DataFrame, score: str, threshold: float = 0.5, keys: Sequence[str] = ()
) -> DataFrame:
    """`binary_metrics` from rows that were already counted: (keys, score, pos, neg)."""
    splits = range_splits(counts, {score: F.col(score)})[score]
    return _metrics_of_groups(with_range(counts, score, splits, "_range"), score, threshold, keys)


def _metrics_of_groups(
    groups: DataFrame, score: str, threshold: float, keys: Sequence[str]
) -> DataFrame:
    curve = running_totals(groups, score, ["pos", "neg"], keys, descending=True)
    p, pos, neg = F.col(score), F.col("pos"), F.col("neg")
    above = F.col("cum_pos").cast("double")
    hit = p >= F.lit(threshold)
    sums = curve.groupBy(*keys).agg(
        F.sum("pos").alias("P"),
        F.sum("neg").alias("N"),
        F.sum(neg * (above - pos / 2)).alias("wins"),
        F.sum(pos * above / (F.col("cum_pos") + F.col("cum_neg"))).alias("ap"),
        F.sum(F.when(hit, pos).otherwise(0)).alias("tp"),
        F.sum(F.when(hit, neg).otherwise(0)).alias("fp"),
        F.sum(pos * (1 - p) * (1 - p) + neg * p * p).alias("sq"),
    )
    both = (F.col("P") > 0) & (F.col("N") > 0)
    zero = F.lit(0.0)
    return sums.select(
        *keys,
        (F.col("P") + F.col("N")).alias("n"),
        F.when(both, F.col("wins") / F.col("P") / F.col("N")).alias("roc_auc"),
        F.when(both, F.col("ap") / F.col("P")).alias("pr_auc"),
        F.coalesce(_ratio(F.col("tp"), F.col("tp") + F.col("fp")), zero).alias("precision"),
        F.coalesce(_ratio(F.col("tp"), F.col("P")), zero).alias("recall"),
        F.coalesce(_ratio(2 * F.col("tp"), F.col("tp") + F.col("fp") + F.col("P")), zero).alias("f1"),
        _ratio(F.col("sq"), F.col("P") + F.col("N")).alias("brier"),
    )


def threshold_counts(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """tp, fp, fn, tn at every threshold from one pass.

    A row falls into the cell "how many thresholds it reaches"; the few cells are then summed up.
    Rows without a score or a label are left out.
    """
    reached = total([F.when(F.col(score) >= F.lit(t), 1).otherwise(0) for t in thresholds])
    known = df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
    cells = known.groupBy(reached.alias("reached")).agg(
        F.count_if(F.col(label) == 1).alias("pos"), F.count_if(F.col(label) == 0).alias("neg")
    )
    packed = cells.agg(F.collect_list(F.struct("reached", "pos", "neg")).alias("cells"))

    def summed(field: str, at_least: bool) -> Column:
        i = F.col("i")
        hits = F.filter("cells", lambda c: c["reached"] > i if at_least else c["reached"] <= i)
        return F.aggregate(hits, F.lit(0).cast("bigint"), lambda acc, c: acc + c[field])

    levels = F.array(*[F.lit(float(t)) for t in thresholds])
    steps = packed.select("cells", F.posexplode(levels).alias("i", "threshold"))
    return steps.select(
        "threshold",
        summed("pos", True).alias("tp"),
        summed("neg", True).alias("fp"),
        summed("pos", False).alias("fn"),
        summed("neg", False).alias("tn"),
    )


def best_threshold_f1(
    df: DataFrame, label: str, score: str, thresholds: Sequence[float] = THRESHOLDS
) -> DataFrame:
    """The threshold with the highest F1, the lowest one on a tie."""
    f1 = F.coalesce(_ratio(2 * F.col("tp"), 2 * F.col("tp") + F.col("fp") + F.col("fn")), F.lit(0.0))
    return (
        threshold_counts(df, label, score, thresholds)
        .select("threshold", f1.alias("f1"))
        .orderBy(F.desc("f1"), "threshold")
        .limit(1)
    )


def cost_curve(
    df: DataFrame,
    label: str,
    score: str,
    fn_cost: float = 5.0,
    fp_cost: float = 1.0,
    thresholds: Sequence[float] = THRESHOLDS,
) -> DataFrame:
    """Cost per threshold, with the first cheapest one marked."""
    cost = F.col("fn") * F.lit(float(fn_cost)) + F.col("fp") * F.lit(float(fp_cost))
    curve = threshold_counts(df, label, score, thresholds).withColumn("cost", cost)
    order = Window.partitionBy(F.lit(1)).orderBy("cost", "threshold")  # one row per threshold
    return curve.select(
        "threshold", "fn", "fp", "cost", (F.row_number().over(order) == 1).alias("is_best")
    )


def _kept_indices(n: int, limit: int) -> list[int]:
    """Evenly spaced point numbers 0..n-1, at most `limit` of them, first and last included."""
    m = min(n, limit)
    if m < 2:
        return list(range(m))
    step = (n - 1) / (m - 1)
    return sorted({*(int(j * step) for j in range(m - 1)), n - 1})


def _staged_groups(df: DataFrame, label: str, score: str) -> tuple[DataFrame, int, int, int]:
    """Score groups written once, with the numbers of positives, negatives and groups."""
    groups = stage(score_groups(df, label, score), "score-groups")
    row = groups.agg(F.sum("pos"), F.sum("neg"), F.count(F.lit(1))).first()
    return groups, row[0] or 0, row[1] or 0, row[2]


def roc_points(
    df: DataFrame, label: str, score: str, limit: int = MAX_CURVE_POINTS
) -> DataFrame:
    """ROC curve thinned to at most `limit` points, plus the exact area on every row.

    Points in the middle of a straight stretch are left out before thinning.
    """
    groups, p_all, n_all, _ = _staged_groups(df, label, score)
    curve = running_totals(groups, score, ["pos", "neg"], descending=True)
    counts = F.struct("pos", "neg")
    heads = groups.groupBy("_range").agg(F.max_by(counts, score).alias("head"))
    ranges = Window.partitionBy(F.lit(1)).orderBy(F.desc("_range"))  # one row per range
    heads = heads.select(
        "_range",
        F.lead("head").over(ranges).alias("next_head"),
        F.row_number().over(ranges).alias("range_no"),
    )
    inner = Window.partitionBy("_range").orderBy(F.desc(score))
    following = F.coalesce(F.lead(counts).over(inner), F.col("next_head"))
    first = (F.col("range_no") == 1) & (F.row_number().over(inner) == 1)
    bends = curve.join(heads, "_range").withColumn(
        "kept", (first | following.isNull() | (counts != following)).cast("bigint")
    )
    numbered = running_totals(bends, score, ["kept"], descending=True).where("kept = 1")
    points = stage(
        numbered.select(F.col("cum_kept").cast("bigint").alias("point"), "cum_neg", "cum_pos"),
        "roc-points",
    )
    wanted = _kept_indices(points.count() + 1, limit)
    won = curve.agg(F.sum(F.col("neg") * (F.col("cum_pos").cast("double") - F.col("pos") / 2)))
    auc = (won.first()[0] or 0.0) / p_all / n_all if p_all and n_all else None
    origin = df.sparkSession.createDataFrame([(0, 0, 0)], "point bigint, cum_neg bigint, cum_pos bigint")
    return (
        origin.unionByName(points)
        .where(F.col("point").isin(wanted))
        .select(
            "point",
            F.try_divide(F.col("cum_neg").cast("double"), F.lit(n_all)).alias("fpr"),
            F.try_divide(F.col("cum_pos").cast("double"), F.lit(p_all)).alias("tpr"),
            F.lit(auc).cast("double").alias("auc"),
        )
    )


def pr_points(
    df: DataFrame, label: str, score: str, limit: int = MAX_CURVE_POINTS
) -> DataFrame:
    """Precision-recall curve from the lowest score upwards, closed by (1, 0), thinned likewise."""
    groups, p_all, n_all, g_all = _staged_groups(df, label, score)
    ones = groups.withColumn("one", F.lit(1).cast("bigint"))
    curve = running_totals(ones, score, ["pos", "neg", "one"], descending=True)
    points = curve.select(
        (F.lit(g_all) - F.col("cum_one")).cast("bigint").alias("point"),
        (F.col("cum_pos") / (F.col("cum_pos") + F.col("cum_neg"))).alias("precision"),
        F.try_divide(F.col("cum_pos").cast("double"), F.lit(p_all)).alias("recall"),
    )
    closing = df.sparkSession.createDataFrame(
        [(g_all, 1.0, 0.0)], "point bigint, precision double, recall double"
    )
    baseline = p_all / (p_all + n_all) if p_all + n_all else None
    return (
        points.unionByName(closing)
        .where(F.col("point").isin(_kept_indices(g_all + 1, limit)))
        .withColumn("baseline", F.lit(baseline).cast("double"))
    )


# --- calibration -----------------------------------------------------------------------------------


def calibration_bins(df: DataFrame, label: str, score: str, bins: int = 10) -> DataFrame:
    """Mean prediction and positive share per quantile bin (lower edge open); empty bins vanish."""
    edges = exact_quantiles(df, [score], [i / bins for i in range(bins + 1)])[score].values
    interior = [e for e in edges[1:-1] if e is not None]
    return (
        df.where(F.col(score).isNotNull() & F.col(label).isNotNull())
        .groupBy(interior_bin(score, interior, side="right").alias("bin"))
        .agg(
            F.avg(score).alias("mean_predicted"),
            F.avg(label).alias("fraction_positive"),
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col(score) - F.col(label)) * (F.col(score) - F.col(label))).alias("sq"),
        )
    )


def calibration_summary(bins: DataFrame) -> DataFrame:
    """Expected calibration error (plain mean over bins) and Brier score."""
    gap = F.abs(F.col("fraction_positive") - F.col("mean_predicted"))
    return bins.agg(
        F.avg(gap).alias("ece"),
        F.try_divide(F.sum("sq"), F.sum("n")).alias("brier"),
        F.count(F.lit(1)).alias("n_bins"),
    )
