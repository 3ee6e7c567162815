"""Classifiers on staged feature tables: time-ordered validation, search, final fit, calibration."""

from __future__ import annotations

import math
import random
from collections.abc import Callable, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

from pyspark.ml import Estimator, Model
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalar import hash_rank_key
from ..session import settle, stage
from .imbalance import oversample_minority, pos_weight
from .isotonic import IsotonicMap, fit_isotonic
from .metrics import best_threshold_f1, binary_metrics
from .ordering import row_positions
from .split import TimePlan, stratified_folds

LABEL, WEIGHT, VECTOR = "_label", "_weight", "features"
SCORE = "p"


def train_centers(train: DataFrame, features: Sequence[str]) -> dict[str, float]:
    """Mean of each feature's known values; 0 where there are none."""
    known = [F.avg(F.nanvl(F.col(f).cast("double"), F.lit(None))).alias(f) for f in features]
    row = train.agg(*known).first()
    return {f: row[f] or 0.0 for f in features}


def assemble(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    keep: Sequence[str] = (),
    centers: Mapping[str, float] | None = None,
) -> DataFrame:
    """Feature vector, label and the kept columns.

    A missing feature counts as its center: `centers` of the training rows, or 0 for features that
    were scaled around their train center.
    """
    centers = centers or {}
    values = [
        F.coalesce(F.nanvl(F.col(f).cast("double"), F.lit(None)), F.lit(float(centers.get(f, 0.0)))).alias(f)
        for f in features
        if f not in keep
    ]
    cut = df.select(*keep, *values, F.col(target).cast("double").alias(LABEL))
    vectors = VectorAssembler(inputCols=list(features), outputCol=VECTOR, handleInvalid="keep")
    return vectors.transform(cut).select(*keep, VECTOR, LABEL)


def with_pos_weight(train: DataFrame) -> DataFrame:
    """Positive rows weigh negatives / positives, computed on these rows only."""
    weight = pos_weight(train, LABEL).first()[0] or 1.0
    return train.withColumn(WEIGHT, F.when(F.col(LABEL) == 1, F.lit(float(weight))).otherwise(1.0))


def logistic(max_iter: int = 200, **params) -> LogisticRegression:
    return LogisticRegression(
        featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, maxIter=max_iter, **params
    )


def boosted(**params) -> GBTClassifier:
    settings = {"maxIter": 50, "maxDepth": 5, "stepSize": 0.1, "seed": 42} | params
    return GBTClassifier(featuresCol=VECTOR, labelCol=LABEL, weightCol=WEIGHT, **settings)


def positive_score(model: Model, rows: DataFrame) -> DataFrame:
    return model.transform(rows).withColumn(SCORE, vector_to_array("probability")[1])


Factory = Callable[[], Estimator]


def cv_scores(
    make: Factory, df: DataFrame, plan: TimePlan, features: Sequence[str], target: str
) -> DataFrame:
    """Metrics per fold; each fold trains on its past only, with weights and centers from that past.

    Rows without a label take no part.
    """
    known = df.where(F.col(target).isNotNull())
    scored = None
    for fold in plan.folds:
        past, later = plan.train(known, fold), plan.valid(known, fold)
        centers = train_centers(past, features)
        model = make().fit(with_pos_weight(assemble(past, features, target, centers=centers)))
        rows = assemble(later, features, target, centers=centers)
        one = positive_score(model, rows).select(F.lit(fold.number).alias("fold"), LABEL, SCORE)
        scored = one if scored is None else scored.unionByName(one)
    return binary_metrics(scored, LABEL, SCORE, keys=["fold"])


def cv_score(
    make: Factory, df: DataFrame, plan: TimePlan, features: Sequence[str], target: str
) -> float:
    """Mean average precision over the folds that hold both classes."""
    return cv_scores(make, df, plan, features, target).agg(F.avg("pr_auc")).first()[0]


def prior_baseline(df: DataFrame, plan: TimePlan, target: str) -> float:
    """A constant score has the positive rate of each validation fold as its average precision."""
    rates = [
        F.avg(F.when(plan.between(f.valid_from, f.valid_to), F.col(target))).alias(f"f{f.number}")
        for f in plan.folds
    ]
    row = df.agg(*rates).first()
    return sum(row) / len(row)


def run_baselines(
    df: DataFrame, plan: TimePlan, features: Sequence[str], target: str
) -> list[tuple[str, str, float]]:
    """(baseline, metric, value): what a search has to beat."""
    return [
        ("prior", "pr_auc", prior_baseline(df, plan, target)),
        ("logistic", "pr_auc", cv_score(logistic, df, plan, features, target)),
    ]


# --- search ----------------------------------------------------------------------------------------


def draw_params(rng: random.Random) -> dict:
    """One point of the search space. Ranges follow the booking model's published search."""
    # Ranges of the search.
    return {
        "maxIter": rng.randrange(100, 601, 50),
        "stepSize": math.exp(rng.uniform(math.log(0.01), math.log(0.3))),
        "maxDepth": rng.randint(3, 12),
        "minInstancesPerNode": rng.randint(5, 100),
        "subsamplingRate": rng.uniform(0.6, 1.0),
        "featureSubsetStrategy": f"{rng.uniform(0.6, 1.0):.3f}",
    }


def search(
    df: DataFrame,
    plan: TimePlan,
    features: Sequence[str],
    target: str,
    trials: int = 40,
    seed: int = 42,
    parallel: int = 4,
    draw: Callable[[random.Random], dict] = draw_params,
    make: Callable[..., Estimator] = boosted,
) -> DataFrame:
    """Seeded random search; every trial is a row (trial, params, pr_auc), best first."""
    rng = random.Random(seed)
    points = [draw(rng) for _ in range(trials)]

    def run(point: Mapping) -> float:
        return cv_score(lambda: make(**point), df, plan, features, target)

    with ThreadPoolExecutor(max_workers=parallel) as pool:
        scores = list(pool.map(run, points))
    rows = [
        (i, {k: str(v) for k, v in p.items()}, s)
        for i, (p, s) in enumerate(zip(points, scores, strict=True))
    ]
    table = df.sparkSession.createDataFrame(
        rows, "trial int, params map<string,string>, pr_auc double"
    )
    return table.orderBy(F.desc_nulls_last("pr_auc"), "trial")


def typed_params(params: Mapping[str, str]) -> dict:
    """Undo the text form that the trial table keeps parameters in."""

    def parse(name: str, v: str):
        if name == "featureSubsetStrategy":
            return v
        return float(v) if any(ch in v for ch in ".e") else int(v)

    return {k: parse(k, v) for k, v in params.items()}


# --- final fit -------------------------------------------------------------------------------------


@dataclass
class Operating:
    """What turns a model's score into a decision: fitted on rows the scoring model never saw."""

    threshold: float | None
    calibration: IsotonicMap


@dataclass
class FittedModel:
    model: Model
    operating: Operating
    measured: list[tuple[str, float, str, float | None]]  # (threshold kind, threshold, metric, value)


def fit_operating(held: DataFrame) -> Operating:
    """Threshold of the best F1 and the calibration map of scored held-out rows."""
    held = settle(held.select(LABEL, SCORE))
    best = best_threshold_f1(held, LABEL, SCORE).first()
    return Operating(best["threshold"] if best else None, fit_isotonic(held, LABEL, SCORE))


def hold_out(
    train: DataFrame, plan: TimePlan, features: Sequence[str], target: str, make: Factory
) -> DataFrame:
    """The last validation fold, scored by a model that saw only the rows before it."""
    last = plan.folds[-1]
    past = plan.train(train, last)
    centers = train_centers(past, features)
    early = make().fit(with_pos_weight(assemble(past, features, target, centers=centers)))
    return positive_score(early, assemble(plan.valid(train, last), features, target, centers=centers))


def fit_final(
    train: DataFrame,
    test: DataFrame,
    plan: TimePlan,
    features: Sequence[str],
    target: str,
    make: Factory = boosted,
) -> FittedModel:
    """Fit on all train rows and score the sealed test once.

    The operating threshold and the calibration come from the last validation fold; the test set
    decides nothing. Missing features count as the mean of the rows that a model is fitted on, rows
    without a label take no part.
    """
    train, test = (side.where(F.col(target).isNotNull()) for side in (train, test))
    operating = fit_operating(hold_out(train, plan, features, target, make))

    centers = train_centers(train, features)
    model = make().fit(with_pos_weight(assemble(train, features, target, centers=centers)))
    sealed = assemble(test, features, target, centers=centers)
    scored = settle(positive_score(model, sealed).select(LABEL, SCORE))
    measured = []
    for kind, threshold in (("default", 0.5), ("operating", operating.threshold)):
        if threshold is not None:
            at = binary_metrics(scored, LABEL, SCORE, threshold).first().asDict()
            measured += [
                (kind, float(threshold), name, None if v is None else float(v)) for name, v in at.items()
            ]
    return FittedModel(model, operating, measured)


# --- importance on held-out rows -------------------------------------------------------------------


def permutation_importance(
    model: Model,
    held_out: DataFrame,
    id_col: str,
    features: Sequence[str],
    target: str,
    seed: int = 42,
    shuffle: Sequence[str] | None = None,
) -> DataFrame:
    """Loss of average precision when one of the model's features is shuffled among the rows.

    Two hash orders number the rows once; a feature is shuffled by joining number to number.
    `shuffle` limits which features are tried.
    """
    first = held_out.select(
        id_col, target, *features, hash_rank_key(id_col, f"a-{seed}").alias("_h")
    )
    second = held_out.select(*features, hash_rank_key(id_col, f"b-{seed}").alias("_h"))
    left = stage(row_positions(first, [], "_h"), "permute-left")
    right = stage(row_positions(second, [], "_h"), "permute-right")

    def ap(df: DataFrame) -> float | None:
        scored = positive_score(model, assemble(df, features, target))
        return binary_metrics(scored, LABEL, SCORE).first()["pr_auc"]

    base = ap(left)
    rows = []
    for f in shuffle or features:
        shuffled = left.drop(f).join(right.select("position", f), "position")
        rows.append((f, base - ap(shuffled)))
    table = held_out.sparkSession.createDataFrame(rows, "feature string, ap_loss double")
    return table.orderBy(F.desc("ap_loss"), "feature")


# --- the resampling trap ---------------------------------------------------------------------------


def resampling_trap(
    df: DataFrame,
    features: Sequence[str],
    target: str,
    id_col: str,
    k: int = 3,
    make: Factory = boosted,
) -> dict[str, float]:
    """Mean AUC when oversampling happens before the folds (wrong) and inside them (right).

    Both arms use the same stratified hash folds, so the order of the two steps is all that differs.
    """
    wanted = [target, *features]

    def auc(train: DataFrame, valid: DataFrame) -> float:
        fit_rows = assemble(train, features, target).withColumn(WEIGHT, F.lit(1.0))
        model = make().fit(fit_rows)
        scored = positive_score(model, assemble(valid, features, target))
        return binary_metrics(scored, LABEL, SCORE).first()["roc_auc"]

    grown = oversample_minority(df, target, id_col, features).withColumn(
        "_row", F.concat_ws("/", *[F.col(c).cast("string") for c in wanted])
    )
    wrong_rows = stage(stratified_folds(grown, target, "_row", k), "trap-wrong")
    right_rows = stage(
        stratified_folds(df.select(id_col, *wanted), target, id_col, k), "trap-right"
    )
    wrong, right = [], []
    for j in range(k):
        inside, outside = F.col("fold") != j, F.col("fold") == j
        wrong.append(auc(wrong_rows.where(inside), wrong_rows.where(outside)))
        fold_train = oversample_minority(right_rows.where(inside), target, id_col, features)
        right.append(auc(fold_train, right_rows.where(outside)))
    return {"wrong": sum(wrong) / k, "right": sum(right) / k}
