"""Additive explanations of a linear score: contribution = coefficient * (value - train mean)."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import total
from .profile import guarded_corr, long_row

SUFFIX = "__contrib"
LOGIT = "prediction_logit"
NEAREST = 1e-15  # a probability counts as at least so far from 0 and from 1


def train_means(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    row = train.agg(*[F.avg(f).alias(f) for f in features]).first()
    return {f: row[f] for f in features}


def base_value(coefs: Mapping[str, float], intercept: float, means: Mapping[str, float]) -> float:
    """The score of an average train row."""
    return intercept + sum(w * means[f] for f, w in coefs.items())


def contributions(
    df: DataFrame, coefs: Mapping[str, float], means: Mapping[str, float]
) -> DataFrame:
    """One contribution column per feature; base value + their sum is the exact score."""
    return df.withColumns(
        {
            f"{f}{SUFFIX}": F.lit(float(w)) * (F.col(f) - F.lit(float(means[f])))
            for f, w in coefs.items()
        }
    )


def global_importance(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """Mean absolute contribution per feature, largest first."""
    row = df.agg(*[F.avg(F.abs(F.col(f + SUFFIX))).alias(f"i{i}") for i, f in enumerate(features)])
    cells = [(f, {"mean_abs": F.col(f"i{i}")}) for i, f in enumerate(features)]
    return row.select(long_row(cells)).orderBy(F.desc("mean_abs"), "feature")


def signed_effect(df: DataFrame, features: Sequence[str], top: int = 10) -> DataFrame:
    """Does a high value push the score up or down, for the most important features."""
    aggs = []
    for i, f in enumerate(features):
        aggs += [
            F.avg(F.abs(F.col(f + SUFFIX))).alias(f"i{i}"),
            F.coalesce(guarded_corr(F.col(f), F.col(f + SUFFIX)), F.lit(0.0)).alias(f"r{i}"),
        ]
    cells = [
        (f, {"mean_abs": F.col(f"i{i}"), "value_corr": F.col(f"r{i}")})
        for i, f in enumerate(features)
    ]
    return (
        df.agg(*aggs)
        .select(long_row(cells))
        .withColumn("direction", F.when(F.col("value_corr") > 0, "up").otherwise("down"))
        .orderBy(F.desc("mean_abs"), "feature")
        .limit(top)
    )


def top_contributions(features: Sequence[str], k: int = 6) -> Column:
    """The k contributions largest in size, as an array of (feature, contribution)."""
    cells = F.array(
        *[
            F.struct(
                (-F.abs(F.col(f + SUFFIX))).alias("size"),
                F.lit(f).alias("feature"),
                F.col(f + SUFFIX).alias("contribution"),
            )
            for f in features
        ]
    )
    return F.transform(
        F.slice(F.array_sort(cells), 1, k), lambda c: F.struct(c["feature"], c["contribution"])
    )


def local_explanations(
    df: DataFrame, id_col: str, features: Sequence[str], base: float, k: int = 6
) -> DataFrame:
    score = total([F.lit(float(base)), *[F.col(f + SUFFIX) for f in features]])
    return df.select(
        id_col,
        F.lit(float(base)).alias("base_value"),
        score.alias("prediction_logit"),
        top_contributions(features, k).alias("top"),
    )


def extreme_rows(explained: DataFrame, id_col: str) -> DataFrame:
    """The rows with the highest and the lowest score."""
    high = explained.orderBy(F.desc("prediction_logit"), id_col).limit(1)
    low = explained.orderBy(F.asc("prediction_logit"), id_col).limit(1)
    return high.withColumn("which", F.lit("high")).unionByName(low.withColumn("which", F.lit("low")))


# --- any fitted classifier -------------------------------------------------------------------------


def logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(NEAREST)), F.lit(1 - NEAREST))
    return F.log(inside) - F.log1p(-inside)


def occlusion(
    model: Model,
    df: DataFrame,
    id_col: str,
    features: Sequence[str],
    centers: Mapping[str, float],
    vector: str = "features",
) -> DataFrame:
    """How far the model's logit falls when one feature is set to its center, for every row.

    Works for any binary classifier; for a linear one it equals `contributions`. Every row is scored
    once per feature, and its scores meet in the task that made them before they are shuffled. Missing
    features count as their center; ids are unique. Returns (id, features, contributions, logit).
    """
    middle = {f: float(centers.get(f) or 0.0) for f in features}
    values = [
        F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(middle[f])) for f in features
    ]
    wide = df.select(id_col, F.array(*values).alias("_values")).withColumn(
        "_hidden", F.explode(F.sequence(F.lit(-1), F.lit(len(features) - 1)))
    )
    center = F.array(*[F.lit(m) for m in middle.values()])
    shown = F.transform(
        "_values", lambda v, i: F.when(i == F.col("_hidden"), F.get(center, i)).otherwise(v)
    )
    scored = model.transform(wide.withColumn(vector, array_to_vector(shown)))
    at = logit(vector_to_array("probability")[1])
    met = scored.groupBy(id_col).agg(
        F.any_value("_values").alias("_values"),
        *[F.max(F.when(F.col("_hidden") == i, at)).alias(f"_at{i}") for i in range(-1, len(features))],
    )
    return met.select(
        id_col,
        *[F.get("_values", F.lit(i)).alias(f) for i, f in enumerate(features)],
        *[(F.col("_at-1") - F.col(f"_at{i}")).alias(f + SUFFIX) for i, f in enumerate(features)],
        F.col("_at-1").alias(LOGIT),
    )


def explain_model(
    model: Model, df: DataFrame, id_col: str, features: Sequence[str], centers: Mapping[str, float]
) -> DataFrame:
    """Contributions of every row to the logit of a fitted model: exact for linear models, else by
    `occlusion`."""
    if not hasattr(model, "coefficients"):
        return occlusion(model, df, id_col, features, centers)
    middle = {f: float(centers.get(f) or 0.0) for f in features}
    coefs = dict(zip(features, [float(w) for w in model.coefficients], strict=True))
    known = df.select(
        id_col,
        *[F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(middle[f])).alias(f) for f in features],
    )
    base = F.lit(base_value(coefs, float(model.intercept), middle))
    parts = contributions(known, coefs, middle)
    return parts.withColumn(LOGIT, total([base, *[F.col(f + SUFFIX) for f in features]]))


def extreme_examples(
    explained: DataFrame, id_col: str, features: Sequence[str], k: int = 6
) -> DataFrame:
    """The rows of highest and lowest score, each with its k largest contributions."""
    top = explained.select(id_col, LOGIT, top_contributions(features, k).alias("top"))
    return extreme_rows(top, id_col)
