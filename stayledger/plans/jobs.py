"""Whole jobs: prepare, train, evaluate, score, monitor, forecast and price.

Each stage that later stages read more than once is written to the shared folder.
"""

from __future__ import annotations

import datetime
from collections.abc import Callable, Sequence

from pyspark.ml import Estimator
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import demand, drift, metrics, models, monitoring, pricing, quality, selection
from ..operators.cleaning import clean, impute_mode
from ..operators.explain import (
    LOGIT,
    SUFFIX,
    explain_model,
    extreme_examples,
    global_importance,
    signed_effect,
)
from ..operators.sampling import sample_fraction
from ..operators.split import plan_time_folds, time_split, with_period
from ..schema import Roles
from ..session import settle, stage
from ..streaming.scoring import scored_record
from .scorer import BookingScorer, PreparedTables, fit_scorer, prepare_tables


def prepare(
    raw: DataFrame, roles: Roles = Roles(), ceiling: float = 1000.0, test_size: float = 0.2
) -> tuple[DataFrame, DataFrame]:
    """Clean, split by time and impute the country from train."""
    if roles.id not in raw.columns:  # before repairs, which can make different rows alike
        raw = raw.withColumn(roles.id, F.md5(F.to_json(F.struct("*"))))
    cleaned = with_period(clean(raw, roles, ceiling), roles)
    train, test, _ = time_split(stage(cleaned, "cleaned"), "period", test_size)
    (train, test), _ = impute_mode(train, [test], "country", with_flag=True)
    return train, test


def append_run(spark: SparkSession, path: str, run: str, values: dict, kind: str) -> None:
    """One row per parameter or metric of a run, appended to the run table."""
    now = datetime.datetime.now(datetime.UTC).replace(tzinfo=None)
    rows = [(run, now, kind, k, str(v)) for k, v in values.items()]
    spark.createDataFrame(
        rows, "run string, at timestamp_ntz, kind string, name string, value string"
    ).write.mode("append").parquet(path)


def train_job(
    train: DataFrame,
    test: DataFrame,
    roles: Roles = Roles(),
    trials: int = 8,
    folds: int = 4,
    run_table: str | None = None,
    run: str = "training",
    draw: Callable | None = None,
    make: Callable[..., Estimator] = models.boosted,
) -> tuple[BookingScorer, dict]:
    """Baselines, search, final fit, sealed-test metrics and the run record."""
    spark = train.sparkSession
    tables = prepare_tables(train, test, roles)
    plan = plan_time_folds(tables.train, "period", roles.id, "expanding", folds)
    baselines = models.run_baselines(tables.train, plan, tables.features, roles.target)
    tried = models.search(
        tables.train,
        plan,
        tables.features,
        roles.target,
        trials,
        draw=draw or models.draw_params,
        make=make,
    )
    best = tried.first()
    params = models.typed_params(best["params"])
    final = models.fit_final(
        tables.train, tables.test, plan, tables.features, roles.target, lambda: make(**params)
    )
    scorer = BookingScorer(
        roles,
        tables.encoders,
        tables.scaler,
        tables.features,
        final.model,
        models.train_centers(tables.train, tables.features),
        final.operating,
    )
    results = {f"baseline/{name}/{metric}": v for name, metric, v in baselines}
    results |= {"search/pr_auc": best["pr_auc"], "threshold": final.operating.threshold}
    results |= {f"test/{kind}/{metric}": v for kind, _, metric, v in final.measured}
    if run_table:
        append_run(spark, run_table, run, {"n_trials": trials, **params}, "param")
        append_run(spark, run_table, run, results, "metric")
    return scorer, results


def evaluation_job(scorer: BookingScorer, bookings: DataFrame) -> dict[str, DataFrame]:
    """Curves, calibration before and after, and costs of a fitted or loaded scorer on labelled rows.

    Nothing is fitted here: threshold and calibration map are those saved with the model.
    """
    if scorer.operating is None:
        raise ValueError("the scorer was fitted without a threshold and a calibration map")
    y, p, q = scorer.roles.target, models.SCORE, "p_calibrated"
    labelled = bookings.where(F.col(y).isNotNull())
    scored = settle(scorer.transform(labelled, (y,), calibrated=True))
    before, after = (metrics.calibration_bins(scored, y, c) for c in (p, q))
    report = {
        "metrics": metrics.binary_metrics(scored, y, p),
        "roc": metrics.roc_points(scored, y, p),
        "pr": metrics.pr_points(scored, y, p),
        "calibration_before": before,
        "calibration_after": after,
        "summary_before": metrics.calibration_summary(before),
        "summary_after": metrics.calibration_summary(after),
        "cost": metrics.cost_curve(scored, y, p),
    }
    if scorer.operating.threshold is not None:
        report["metrics_operating"] = metrics.binary_metrics(scored, y, p, scorer.operating.threshold)
    return report


def selection_job(
    tables: PreparedTables, roles: Roles = Roles(), keep: int = 20, trees: int = 200
) -> tuple[dict[str, DataFrame], DataFrame]:
    """All five rankings and their consensus."""
    df, features, target = tables.train, tables.features, roles.target
    rankings = {
        "mutual_info": selection.mutual_info_binned(df, features, target),
        "anova_f": selection.anova_f(df, features, target),
        "l1": selection.l1_scores(df, features, target),
        "tree": selection.tree_gain_scores(df, features, target, trees),
        "rfe": selection.rfe_ranks(df, features, target, keep),
    }
    return rankings, selection.consensus_ranking(rankings)


def explanation_job(scorer: BookingScorer, bookings: DataFrame) -> dict[str, DataFrame]:
    """Explain the scorer's own model: every row, every feature, and the two extreme rows."""
    roles, features = scorer.roles, scorer.features
    rows = scorer.feature_rows(bookings, (roles.id,))
    explained = stage(explain_model(scorer.model, rows, roles.id, features, scorer.centers), "explained")
    return {
        "rows": explained.select(roles.id, *[f + SUFFIX for f in features], LOGIT),
        "global": global_importance(explained, features),
        "signed": signed_effect(explained, features),
        "examples": extreme_examples(explained, roles.id, features),
    }


def score_job(
    scorer: BookingScorer, bookings: DataFrame, threshold: float = 0.30
) -> DataFrame:
    """Scored records for a whole table in one distributed pass."""
    roles = scorer.roles
    keep = (roles.id, roles.target) if roles.target in bookings.columns else (roles.id,)
    scored = scorer.transform(bookings, keep)
    label = roles.target if roles.target in bookings.columns else None
    return scored_record(scored, roles.id, F.col(models.SCORE), label, threshold)


def monitoring_job(
    scorer: BookingScorer,
    reference: DataFrame,
    window: DataFrame,
    baseline: float,
    drift_features: Sequence[str] | None = None,
) -> tuple[str, DataFrame]:
    """Gate the window, compare it with the reference, measure the model on it, decide.

    Reference and window are the caller's tables. Returns the action and the one-row decision.
    """
    roles = scorer.roles
    quality.require_valid_window(window, roles.target, roles.price)
    report = drift.detect_drift(reference, window, roles.target, drift_features)
    summary = drift.summarize(report).first()
    scored = scorer.transform(window, (roles.target,))
    performance = monitoring.window_metric(scored, roles.target, models.SCORE)
    ready = performance.withColumns(
        {
            "overall_drift": F.lit(summary["overall_drift"]),
            "top_drifted": F.array(*[F.lit(f) for f in summary["top_drifted"]]),
        }
    )
    decision = settle(monitoring.retraining_decision(ready, baseline))
    action = "retraining_triggered" if decision.first()["retrain"] else "held"
    return action, decision


def window_for_trial(
    reference: DataFrame, id_col: str, share: float, seed: int, drifted: bool, roles: Roles = Roles()
) -> DataFrame:
    """A recent-window stand-in drawn from a table, shifted on request."""
    window = sample_fraction(reference, id_col, share, seed)
    if not drifted:
        return window
    return drift.inject_drift(
        window, id_col, roles.lead, "market_segment", roles.segment_flag, seed
    )


def pricing_job(
    cleaned: DataFrame,
    scorer: BookingScorer,
    keys: Sequence[str] = (),
    ref_price: float = 110.0,
    elasticity: float | None = None,
    make_regressor: Callable | None = None,
) -> DataFrame:
    """Forecast next-period gross demand and price it against the model's portfolio risk."""
    roles = scorer.roles
    dated = with_period(cleaned, roles)
    counts = demand.demand_series(dated, "period", roles.target, keys)
    series = settle(demand.densify(counts, "period", keys))
    upcoming = demand.forecast_next(series, "period", "gross_bookings", keys, make_regressor)
    scored = scorer.transform(cleaned, tuple(keys))
    rates = pricing.base_cancel_rate(scored, models.SCORE, keys)
    e = None if elasticity is None else F.lit(float(elasticity))
    return pricing.price_for_period(upcoming, rates, keys, F.lit(float(ref_price)), e)


__all__ = [
    "append_run",
    "evaluation_job",
    "explanation_job",
    "fit_scorer",
    "monitoring_job",
    "prepare",
    "pricing_job",
    "score_job",
    "selection_job",
    "train_job",
    "window_for_trial",
]
