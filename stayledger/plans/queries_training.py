"""Model work on the bookings: resampling, calibration, rankings, training, scoring, monitoring.

Fits are iterative, so most of these have no SQL twin; tests check them on data with a known signal.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.scalar import linear, sigmoid
from ..operators import demand as D
from ..operators import models as M
from ..operators import selection as S
from ..operators.imbalance import oversample_minority
from ..operators.isotonic import calibrate, fit_isotonic
from ..operators.split import plan_time_folds, time_split
from ..session import settle
from ..sources.tables import bookings, staged_bookings
from . import jobs
from .queries_cleaning import CEILING
from .queries_demand import KEY, country_series
from .queries_features import ROLES, SCORE_INTERCEPT, SCORE_TERMS
from .registry import BOOKINGS, SPLIT, query, rounded, sql_over
from .scorer import fit_scorer, prepare_tables

LABEL = "is_canceled"
FEATURES = ["price", "adr", "previous_cancellations", "total_of_special_requests", "booking_changes"]


def small_trees(**params):
    return M.boosted(**({"maxIter": 5, "maxDepth": 3} | params))


def _rows(spark, sf):
    return staged_bookings(spark, sf, ["booking_id", "period", LABEL, *FEATURES])


def _folds(rows, k=3):
    return plan_time_folds(rows, "period", "booking_id", "expanding", k)


@query(
    "oversample_parity",
    sql_over(
        BOOKINGS,
        SPLIT,
        select="""SELECT CAST(unnest([0, 1]) AS INTEGER) AS is_canceled, greatest(
          count(*) FILTER (WHERE is_canceled = 0), count(*) FILTER (WHERE is_canceled = 1)) AS n
          FROM train""",
    ),
)
def _oversample_parity(spark, sf):
    """Train rows after synthetic minority rows were added: both classes are equally large."""
    train, _, _ = time_split(_rows(spark, sf))
    grown = oversample_minority(train, LABEL, "booking_id", ["price", "adr"])
    return grown.groupBy(LABEL).agg(F.count(F.lit(1)).alias("n"))


@query(
    "isotonic_calibration",
    """WITH RECURSIVE rated AS (
      SELECT o_orderkey AS booking_id, CAST(o_orderstatus = 'F' AS INTEGER) AS y,
        year(o_orderdate) * 100 + month(o_orderdate) AS period,
        1 / (1 + exp(-(-2.5 + 0.00001 * o_totalprice))) AS x FROM orders),
    g AS (SELECT x, row_number() OVER (ORDER BY x) AS i, sum(y) AS s, count(*) AS w
      FROM rated WHERE period <= 199812 GROUP BY x),
    c AS (SELECT x, i, sum(s) OVER (ORDER BY i) AS cs, sum(w) OVER (ORDER BY i) AS cw FROM g),
    -- the map's blocks are the edges of the lower hull of the running sums, walked from the left
    hull(i, cs, cw) AS (
      SELECT CAST(0 AS BIGINT), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)
      UNION ALL
      SELECT e.i, e.cs, e.cw FROM (
        SELECT arg_min(struct_pack(i := c.i, cs := CAST(c.cs AS DOUBLE), cw := CAST(c.cw AS DOUBLE)),
          struct_pack(slope := (c.cs - h.cs) / (c.cw - h.cw), far := -c.i)) AS e
        FROM hull h JOIN c ON c.i > h.i GROUP BY h.i)),
    edges AS (SELECT i, lag(i) OVER (ORDER BY i) + 1 AS j,
      (cs - lag(cs) OVER (ORDER BY i)) / (cw - lag(cw) OVER (ORDER BY i)) AS y FROM hull),
    blocks AS (SELECT a.x AS lo, b.x AS hi, y, lead(a.x) OVER (ORDER BY a.x) AS lo2,
        lead(y) OVER (ORDER BY a.x) AS y2
      FROM edges JOIN c a ON a.i = edges.j JOIN c b ON b.i = edges.i),
    late AS (SELECT booking_id, greatest(x, (SELECT min(lo) FROM blocks)) AS x FROM rated
      WHERE period > 199812)
    SELECT booking_id, round(CASE WHEN x <= hi OR lo2 IS NULL THEN y
      ELSE y + (x - hi) * (y2 - y) / (lo2 - hi) END, 6) AS p_calibrated
    FROM late ASOF JOIN blocks ON late.x >= blocks.lo""",
)
def _isotonic_calibration(spark, sf):
    """Map fitted on the earlier periods' unrounded scores, applied to the later ones."""
    rows = bookings(spark, sf, ["booking_id", LABEL, "period", "price"])
    rows = rows.withColumn("p", sigmoid(linear(SCORE_TERMS, SCORE_INTERCEPT)))
    early, late = rows.where("period <= 199812"), rows.where("period > 199812")
    fitted = fit_isotonic(early, LABEL, "p")
    return rounded(calibrate(fitted, late, "p").select("booking_id", "p_calibrated"))


@query("logreg_baseline")
def _logreg_baseline(spark, sf):
    rows = _rows(spark, sf)
    return M.cv_scores(M.logistic, rows, _folds(rows), FEATURES, LABEL)


@query("l1_scores")
def _l1_scores(spark, sf):
    return S.l1_scores(_rows(spark, sf), FEATURES, LABEL)


@query("tree_gain_scores")
def _tree_gain_scores(spark, sf):
    return S.tree_gain_scores(_rows(spark, sf), FEATURES, LABEL, trees=5, depth=3)


@query("rfe_ranks")
def _rfe_ranks(spark, sf):
    return S.rfe_ranks(_rows(spark, sf), FEATURES, LABEL, keep=2)


@query("hyperparameter_search")
def _hyperparameter_search(spark, sf):
    rows = _rows(spark, sf)

    def draw(rng):
        return {"maxIter": rng.randint(2, 4), "maxDepth": rng.randint(2, 3)}

    tried = M.search(rows, _folds(rows, 2), FEATURES, LABEL, 2, draw=draw, make=small_trees)
    return tried.withColumn("params", F.to_json("params"))


@query("permutation_importance")
def _permutation_importance(spark, sf):
    train, test, _ = time_split(_rows(spark, sf))
    model = small_trees().fit(M.with_pos_weight(M.assemble(train, FEATURES, LABEL)))
    return M.permutation_importance(model, test, "booking_id", FEATURES, LABEL)


@query("final_fit_metrics")
def _final_fit_metrics(spark, sf):
    train, test, _ = time_split(_rows(spark, sf))
    fitted = M.fit_final(train, test, _folds(train), FEATURES, LABEL, small_trees)
    shape = "threshold_kind string, threshold double, metric string, value double"
    return spark.createDataFrame(fitted.measured, shape)


@query("resampling_trap")
def _resampling_trap(spark, sf):
    means = M.resampling_trap(_rows(spark, sf), ["price", "adr"], LABEL, "booking_id", 2, small_trees)
    return spark.createDataFrame(sorted(means.items()), "arm string, mean_auc double")


def _prepared(spark, sf):
    train, test = jobs.prepare(bookings(spark, sf), ROLES, CEILING)
    return train, test, prepare_tables(train, test, ROLES)


@query("train_and_score")
def _train_and_score(spark, sf):
    """Whole chain: engineer, encode, scale, fit, then score the later bookings in one pass."""
    _, test, tables = _prepared(spark, sf)
    return jobs.score_job(fit_scorer(tables, ROLES, small_trees), test)


@query("monitoring_decision")
def _monitoring_decision(spark, sf):
    """Later bookings against earlier ones: gate, drift, performance, decision."""
    train, test, tables = _prepared(spark, sf)
    scorer = fit_scorer(tables, ROLES, small_trees)
    _, decision = jobs.monitoring_job(
        scorer, train, test, 0.36, ["lead_time", "adr", "market_segment", "deposit_type"]
    )
    texts = {c: F.array_join(c, " | ") for c in ("reasons", "top_drifted")}
    return decision.withColumns(texts)


def linear_forecast(label):
    from pyspark.ml.regression import LinearRegression

    return LinearRegression(featuresCol="features", labelCol=label, regParam=0.1)


@query("forecast_next")
def _forecast_next(spark, sf):
    series = settle(country_series(spark, sf))
    return D.forecast_next(series, "period", "gross_bookings", KEY)


@query("backtest_model")
def _backtest_model(spark, sf):
    total = D.demand_series(bookings(spark, sf, ["period", LABEL]), "period", LABEL)
    series = settle(D.densify(total, "period"))
    return D.backtest_model(series, "period", min_train=48, make=linear_forecast)
