"""Feature ranking: filters, embedded and wrapper methods, consensus."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.scalar import interior_bin
from .ordering import exact_quantiles
from .profile import long_row


def mutual_info_binned(
    df: DataFrame, features: Sequence[str], target: str, bins: int = 10
) -> DataFrame:
    """Mutual information (nats) between each feature's quantile bin and the target."""
    edges = exact_quantiles(df, features, [i / bins for i in range(1, bins)])
    cells = [
        (f, {"bin": interior_bin(f, sorted({e for e in edges[f].values if e is not None}), "left")})
        for f in features
    ]
    joint = (
        df.where(F.col(target).isNotNull())
        .select(target, long_row(cells))
        .where("bin is not null")
        .groupBy("feature", "bin", target)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    # at most bins x classes rows per feature from here on
    whole = Window.partitionBy("feature")
    per_bin = Window.partitionBy("feature", "bin")
    per_class = Window.partitionBy("feature", target)
    n = F.sum("n").over(whole)
    shares = joint.select(
        "feature",
        (F.col("n") / n).alias("p"),
        (F.sum("n").over(per_bin) / n).alias("px"),
        (F.sum("n").over(per_class) / n).alias("py"),
    )
    info = F.sum(F.col("p") * F.log(F.col("p") / (F.col("px") * F.col("py"))))
    return shares.groupBy("feature").agg(info.alias("score"))


def anova_f(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """F statistic: variance between classes over variance within, from per-class moments."""
    stats = [
        agg
        for i, f in enumerate(features)
        for agg in (
            F.count(f).alias(f"n{i}"),
            F.avg(f).alias(f"m{i}"),
            F.var_pop(F.col(f).cast("double")).alias(f"v{i}"),
        )
    ]
    per_class = df.where(F.col(target).isNotNull()).groupBy(target).agg(*stats)
    cells = [
        (f, {"n": F.col(f"n{i}"), "m": F.col(f"m{i}"), "v": F.col(f"v{i}")})
        for i, f in enumerate(features)
    ]
    long = per_class.select(long_row(cells)).where("n > 0")
    centre = F.sum(F.col("n") * F.col("m")).over(Window.partitionBy("feature")) / F.sum("n").over(
        Window.partitionBy("feature")
    )
    gap = F.col("m") - centre
    parts = long.withColumn("between", F.col("n") * gap * gap).withColumn(
        "within", F.col("n") * F.col("v")
    )
    return parts.groupBy("feature").agg(
        F.try_divide(
            F.sum("between") / F.nullif(F.count(F.lit(1)) - 1, F.lit(0)),
            F.nullif(F.sum("within"), F.lit(0.0))
            / F.nullif(F.sum("n") - F.count(F.lit(1)), F.lit(0)),
        ).alias("score")
    )


def _assemble(df: DataFrame, features: Sequence[str], target: str) -> DataFrame:
    """Feature vectors of the rows with a label; a missing feature counts as the mean of the others."""
    cut = df.select(F.col(target).cast("double").alias("label"), *features).where("label IS NOT NULL")
    means = cut.agg(*[F.avg(F.nanvl(F.col(f).cast("double"), F.lit(None))).alias(f) for f in features])
    centre = means.first()
    filled = {
        f: F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(centre[f] or 0.0))
        for f in features
    }
    return VectorAssembler(
        inputCols=list(features), outputCol="features", handleInvalid="error"
    ).transform(cut.withColumns(filled))


def _scores(df: DataFrame, pairs) -> DataFrame:
    rows = [(f, float(v)) for f, v in pairs]
    return df.sparkSession.createDataFrame(rows, "feature string, score double")


def l1_scores(
    df: DataFrame, features: Sequence[str], target: str, c: float = 0.1, max_iter: int = 200
) -> DataFrame:
    """Absolute coefficients of an L1-penalised logistic fit with inverse strength c."""
    data = _assemble(df, features, target)
    n = data.count()
    model = LogisticRegression(
        elasticNetParam=1.0, regParam=1.0 / (c * max(n, 1)), standardization=False, maxIter=max_iter
    ).fit(data)
    return _scores(df, zip(features, [abs(w) for w in model.coefficients], strict=True))


def tree_gain_scores(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    trees: int = 200,
    depth: int = 5,
    step: float = 0.05,
) -> DataFrame:
    """Impurity-gain importance of a boosted tree ensemble."""
    model = GBTClassifier(maxIter=trees, maxDepth=depth, stepSize=step, seed=42).fit(
        _assemble(df, features, target)
    )
    return _scores(df, zip(features, model.featureImportances.toArray(), strict=True))


def rfe_ranks(
    df: DataFrame, features: Sequence[str], target: str, keep: int = 20, step: float = 0.1
) -> DataFrame:
    """Recursive elimination: refit, drop the weakest tenth, until `keep` remain; rank 1 is kept."""
    left = list(features)
    drop_each = max(1, int(step * len(left)))
    dropped: list[list[str]] = []
    data = df.select(target, *features).persist()
    try:
        while len(left) > keep:
            model = LogisticRegression(maxIter=100).fit(_assemble(data, left, target))
            weak = sorted(zip([abs(w) for w in model.coefficients], left, strict=True))
            gone = [f for _, f in weak[: min(drop_each, len(left) - keep)]]
            dropped.append(gone)
            left = [f for f in left if f not in gone]
    finally:
        data.unpersist()
    ranks = {f: 1 for f in left}
    for r, gone in enumerate(reversed(dropped), 2):
        ranks |= {f: r for f in gone}
    return _scores(df, ((f, ranks[f]) for f in features))


def consensus_ranking(rankings: Mapping[str, DataFrame], lower_is_better: Sequence[str] = ("rfe",)) -> DataFrame:
    """Mean over methods of each feature's rank; ties share the average of their ranks."""
    long = None
    for method, scores in rankings.items():
        sign = 1.0 if method in lower_is_better else -1.0
        one = scores.select(
            F.lit(method).alias("method"), "feature", (F.lit(sign) * F.col("score")).alias("key")
        )
        long = one if long is None else long.unionByName(one)
    order = Window.partitionBy("method").orderBy("key")  # one row per feature
    peers = Window.partitionBy("method", "key")
    rank = F.rank().over(order) + (F.count(F.lit(1)).over(peers) - 1) / 2
    return (
        long.where("key is not null")
        .select("method", "feature", rank.alias("rank"))
        .groupBy("feature")
        .agg(F.avg("rank").alias("mean_rank"), F.count(F.lit(1)).alias("n_methods"))
        .orderBy("mean_rank", "feature")
    )
