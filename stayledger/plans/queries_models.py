"""Metrics, calibration, feature ranking and explanations."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import explain as X
from ..operators import metrics as M
from ..operators import selection as S
from ..operators.split import plan_time_folds, time_split
from ..sources.tables import bookings, staged_bookings
from .queries_features import SCORED, scored
from .registry import BOOKINGS, SPLIT, query, rounded, sql_over

LABEL, SCORE = "is_canceled", "p"

_GROUPS = """groups AS (SELECT p, sum(is_canceled) AS pos, count(*) - sum(is_canceled) AS neg
  FROM scored GROUP BY p),
curve AS (SELECT p, pos, neg, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg,
  row_number() OVER w AS idx, sum(pos) OVER () AS P1, sum(neg) OVER () AS N1, count(*) OVER () AS G
  FROM groups WINDOW w AS (ORDER BY p DESC))"""


@query(
    "binary_metrics",
    sql_over(
        SCORED,
        _GROUPS,
        """c AS (SELECT count(*) FILTER (WHERE p >= 0.5 AND is_canceled = 1) AS tp,
          count(*) FILTER (WHERE p >= 0.5 AND is_canceled = 0) AS fp,
          count(*) FILTER (WHERE is_canceled = 1) AS pp,
          round(avg((p - is_canceled) * (p - is_canceled)), 6) AS brier, count(*) AS n FROM scored)""",
        select="""SELECT any_value(n) AS n,
          round(sum(neg * (cum_pos - pos / 2)) / any_value(P1) / any_value(N1), 6) AS roc_auc,
          round(sum(pos * cum_pos / (cum_pos + cum_neg)) / any_value(P1), 6) AS pr_auc,
          round(any_value(tp / (tp + fp)), 6) AS precision, round(any_value(tp / pp), 6) AS recall,
          round(any_value(2 * tp / (tp + fp + pp)), 6) AS f1, any_value(brier) AS brier
          FROM curve, c""",
    ),
)
def _binary_metrics(spark, sf):
    return rounded(M.binary_metrics(scored(spark, sf), LABEL, SCORE, 0.5))


_COUNTS = """t AS (SELECT unnest(range(5, 100, 5)) / 100.0 AS threshold),
counts AS (SELECT threshold,
  count(*) FILTER (WHERE p >= threshold AND is_canceled = 1) AS tp,
  count(*) FILTER (WHERE p >= threshold AND is_canceled = 0) AS fp,
  count(*) FILTER (WHERE p < threshold AND is_canceled = 1) AS fn
  FROM scored, t GROUP BY threshold)"""


@query(
    "best_threshold_f1",
    sql_over(
        SCORED,
        _COUNTS,
        select="""SELECT CAST(threshold AS DOUBLE) AS threshold,
          round(coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0), 6) AS f1 FROM counts
          ORDER BY 2 * tp / nullif(2 * tp + fp + fn, 0) DESC NULLS LAST, threshold LIMIT 1""",
    ),
)
def _best_threshold_f1(spark, sf):
    return rounded(M.best_threshold_f1(scored(spark, sf), LABEL, SCORE))


@query(
    "cost_curve",
    sql_over(
        SCORED,
        _COUNTS,
        select="""SELECT CAST(threshold AS DOUBLE) AS threshold, fn, fp,
          CAST(5 * fn + fp AS DOUBLE) AS cost,
          row_number() OVER (ORDER BY 5 * fn + fp, threshold) = 1 AS is_best FROM counts""",
    ),
)
def _cost_curve(spark, sf):
    return M.cost_curve(scored(spark, sf), LABEL, SCORE)


def _thinned(n: str) -> str:
    return f"""picked AS (SELECT DISTINCT CASE WHEN j = m - 1 THEN n - 1
      ELSE CAST(floor(j * ((n - 1) / (m - 1))) AS BIGINT) END AS point
      FROM (SELECT {n} AS n, least({n}, 100) AS m) s, range(0, 100) r(j) WHERE j < m)"""


@query(
    "roc_points",
    sql_over(
        SCORED,
        _GROUPS,
        """bends AS (SELECT *, idx = 1 OR idx = G OR pos <> lead(pos) OVER (ORDER BY idx)
          OR neg <> lead(neg) OVER (ORDER BY idx) AS kept FROM curve)""",
        """numbered AS (SELECT row_number() OVER (ORDER BY idx) AS point, cum_neg, cum_pos
          FROM bends WHERE kept)""",
        _thinned("(SELECT count(*) + 1 FROM numbered)"),
        """area AS (SELECT sum(neg * (cum_pos - pos / 2)) / any_value(P1) / any_value(N1) AS auc,
          any_value(P1) AS P1, any_value(N1) AS N1 FROM curve)""",
        select="""SELECT point, round(cum_neg / N1, 6) AS fpr, round(cum_pos / P1, 6) AS tpr,
          round(auc, 6) AS auc
          FROM (SELECT * FROM numbered UNION ALL SELECT 0, 0, 0) JOIN picked USING (point), area""",
    ),
)
def _roc_points(spark, sf):
    return rounded(M.roc_points(scored(spark, sf), LABEL, SCORE))


@query(
    "pr_points",
    sql_over(
        SCORED,
        _GROUPS,
        _thinned("(SELECT any_value(G) + 1 FROM curve)"),
        """points AS (SELECT G - idx AS point, cum_pos / (cum_pos + cum_neg) AS precision,
          cum_pos / P1 AS recall FROM curve
          UNION ALL SELECT any_value(G), 1.0, 0.0 FROM curve)""",
        select="""SELECT point, round(precision, 6) AS precision, round(recall, 6) AS recall,
          round((SELECT avg(is_canceled) FROM scored), 6) AS baseline
          FROM points JOIN picked USING (point)""",
    ),
)
def _pr_points(spark, sf):
    return rounded(M.pr_points(scored(spark, sf), LABEL, SCORE))


_BINS = """edges AS (SELECT unnest([quantile_cont(p, 0.1), quantile_cont(p, 0.2), quantile_cont(p, 0.3),
  quantile_cont(p, 0.4), quantile_cont(p, 0.5), quantile_cont(p, 0.6), quantile_cont(p, 0.7),
  quantile_cont(p, 0.8), quantile_cont(p, 0.9)]) AS e FROM scored),
bins AS (SELECT CAST(b AS INTEGER) AS bin, avg(p) AS mean_predicted, avg(is_canceled) AS fraction_positive,
  count(*) AS n, sum((p - is_canceled) * (p - is_canceled)) AS sq
  FROM (SELECT *, (SELECT count(*) FROM edges WHERE e < p) AS b FROM scored) GROUP BY b)"""


@query(
    "calibration",
    sql_over(
        SCORED,
        _BINS,
        select="""SELECT bin, round(mean_predicted, 6) AS mean_predicted,
          round(fraction_positive, 6) AS fraction_positive, n FROM bins""",
    ),
)
def _calibration(spark, sf):
    return rounded(M.calibration_bins(scored(spark, sf), LABEL, SCORE).drop("sq"))


@query(
    "calibration_summary",
    sql_over(
        SCORED,
        _BINS,
        select="""SELECT round(avg(abs(fraction_positive - mean_predicted)), 6) AS ece,
          round(sum(sq) / sum(n), 6) AS brier, count(*) AS n_bins FROM bins""",
    ),
)
def _calibration_summary(spark, sf):
    return rounded(M.calibration_summary(M.calibration_bins(scored(spark, sf), LABEL, SCORE)))


@query(
    "baseline_prior",
    sql_over(
        BOOKINGS,
        """placed AS (SELECT is_canceled, count(*) OVER () AS n,
          row_number() OVER (ORDER BY period, booking_id) - 1 AS pos FROM bookings)""",
        "folds AS (SELECT CAST(unnest(range(1, 5)) AS INTEGER) AS fold)",
        select="""SELECT fold, count(*) AS n, round(avg(is_canceled), 6) AS pr_auc FROM placed, folds
          WHERE pos >= n - (5 - fold) * (n // 5) AND pos < n - (4 - fold) * (n // 5) GROUP BY fold""",
    ),
)
def _baseline_prior(spark, sf):
    """Average precision of a constant score on each validation fold."""
    b = bookings(spark, sf, ["booking_id", "period", LABEL])
    plan = plan_time_folds(b, "period", "booking_id", "expanding", 4)
    out = None
    for fold in plan.folds:
        valid = plan.valid(b, fold).withColumns({"fold": F.lit(fold.number), "p": F.lit(0.5)})
        out = valid if out is None else out.unionByName(valid)
    metrics = M.binary_metrics(out, LABEL, SCORE, keys=["fold"])
    return rounded(metrics.select("fold", "n", "pr_auc"))


# --- feature ranking -------------------------------------------------------------------------------

_RANKED = ("price", "adr", "previous_cancellations", "total_of_special_requests", "booking_changes")


def _mi_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature, sum(pxy * ln(pxy / (px * py))) AS score FROM (
      SELECT n / sum(n) OVER () AS pxy, sum(n) OVER (PARTITION BY b) / sum(n) OVER () AS px,
        sum(n) OVER (PARTITION BY is_canceled) / sum(n) OVER () AS py FROM (
        SELECT b, is_canceled, count(*) AS n FROM (
          SELECT is_canceled, (SELECT count(*) FROM (SELECT DISTINCT unnest([{", ".join(
              f"quantile_cont({column}, {i / 10})" for i in range(1, 10)
          )}]) AS e FROM bookings) WHERE e <= {column}) AS b FROM bookings) GROUP BY ALL))"""


def _f_sql(column: str) -> str:
    return f"""SELECT '{column}' AS feature,
      (sum(n * (m - g) * (m - g)) / (count(*) - 1)) / (sum(n * v) / (sum(n) - count(*))) AS score
      FROM (SELECT count({column}) AS n, avg({column}) AS m, var_pop({column}) AS v
            FROM bookings GROUP BY is_canceled), (SELECT avg({column}) AS g FROM bookings)"""


_MI = "mi AS (" + " UNION ALL ".join(_mi_sql(c) for c in _RANKED) + ")"
_F = "f AS (" + " UNION ALL ".join(_f_sql(c) for c in _RANKED) + ")"


def _ranked(spark, sf):
    return staged_bookings(spark, sf, [*_RANKED, LABEL])


@query(
    "mutual_info_binned",
    sql_over(BOOKINGS, _MI, select="SELECT feature, round(score, 8) + 0.0 AS score FROM mi"),
)
def _mutual_info_binned(spark, sf):
    return rounded(S.mutual_info_binned(_ranked(spark, sf), _RANKED, LABEL), 8)


@query(
    "anova_f", sql_over(BOOKINGS, _F, select="SELECT feature, round(score, 6) AS score FROM f")
)
def _anova_f(spark, sf):
    return rounded(S.anova_f(_ranked(spark, sf), _RANKED, LABEL))


@query(
    "consensus_rank",
    sql_over(
        BOOKINGS,
        _MI,
        _F,
        "methods AS (SELECT 'mi' AS method, * FROM mi UNION ALL SELECT 'f', * FROM f "
        "UNION ALL SELECT 'rfe', feature, CASE WHEN feature IN ('price', 'adr') THEN 1 ELSE 2 END FROM f)",
        """ranks AS (SELECT feature, method, rank() OVER (PARTITION BY method ORDER BY
            CASE WHEN method = 'rfe' THEN score ELSE -score END)
          + (count(*) OVER (PARTITION BY method, score) - 1) / 2 AS r FROM methods)""",
        select="""SELECT feature, round(avg(r), 6) AS mean_rank, count(*) AS n_methods
          FROM ranks GROUP BY feature""",
    ),
)
def _consensus_rank(spark, sf):
    b = _ranked(spark, sf)
    f = S.anova_f(b, _RANKED, LABEL)
    kept = F.when(F.col("feature").isin("price", "adr"), 1.0).otherwise(2.0)
    rankings = {
        "mutual_info": S.mutual_info_binned(b, _RANKED, LABEL),
        "anova_f": f,
        "rfe": f.select("feature", kept.alias("score")),
    }
    return rounded(S.consensus_ranking(rankings))


# --- explanations ----------------------------------------------------------------------------------

COEFS = {
    "price": 2e-6,
    "adr": -1e-4,
    "previous_cancellations": 0.5,
    "total_of_special_requests": -0.35,
    "booking_changes": -0.25,
    "is_repeated_guest": -0.4,
}
INTERCEPT = -1.15
FEATURES = list(COEFS)

_CONTRIB = (
    "means AS (SELECT "
    + ", ".join(f"avg({c}) AS mean_{c}" for c in FEATURES)
    + " FROM train),\ncontrib AS (SELECT booking_id, "
    + ", ".join(f"{c}, {w!r} * ({c} - mean_{c}) AS c_{c}" for c, w in COEFS.items())
    + f", {INTERCEPT} + "
    + " + ".join(f"{w!r} * mean_{c}" for c, w in COEFS.items())
    + " AS base FROM test, means)"
)
_CONTRIB_LONG = "long AS (" + " UNION ALL ".join(
    f"SELECT booking_id, '{c}' AS feature, {c}::DOUBLE AS x, c_{c} AS c FROM contrib" for c in FEATURES
) + ")"


def explained(spark, sf):
    b = bookings(spark, sf, ["booking_id", "period", *FEATURES])
    train, test, _ = time_split(b)
    means = X.train_means(train, FEATURES)
    return X.contributions(test, COEFS, means), X.base_value(COEFS, INTERCEPT, means)


@query(
    "linear_contributions",
    sql_over(
        BOOKINGS,
        SPLIT,
        _CONTRIB,
        select="SELECT booking_id, "
        + ", ".join(f"round(c_{c}, 6) + 0.0 AS {c}__contrib" for c in FEATURES)
        + " FROM contrib",
    ),
)
def _linear_contributions(spark, sf):
    rows, _ = explained(spark, sf)
    return rounded(rows.select("booking_id", *[c + X.SUFFIX for c in FEATURES]))


@query(
    "global_importance",
    sql_over(
        BOOKINGS,
        SPLIT,
        _CONTRIB,
        _CONTRIB_LONG,
        select="SELECT feature, round(avg(abs(c)), 6) AS mean_abs FROM long GROUP BY feature",
    ),
)
def _global_importance(spark, sf):
    rows, _ = explained(spark, sf)
    return rounded(X.global_importance(rows, FEATURES))


@query(
    "signed_effect",
    sql_over(
        BOOKINGS,
        SPLIT,
        _CONTRIB,
        _CONTRIB_LONG,
        select="""SELECT feature, round(avg(abs(c)), 6) AS mean_abs,
          round(coalesce(corr(x, c), 0), 3) + 0.0 AS value_corr,
          CASE WHEN corr(x, c) > 0 THEN 'up' ELSE 'down' END AS direction FROM long GROUP BY feature""",
    ),
)
def _signed_effect(spark, sf):
    rows, _ = explained(spark, sf)
    effects = X.signed_effect(rows, FEATURES)
    return rounded(effects.withColumn("value_corr", F.round("value_corr", 3)))


@query(
    "local_explanation",
    sql_over(
        BOOKINGS,
        SPLIT,
        _CONTRIB,
        _CONTRIB_LONG,
        """ranked AS (SELECT booking_id, feature, c,
          row_number() OVER (PARTITION BY booking_id ORDER BY abs(c) DESC, feature) AS r FROM long)""",
        """tops AS (SELECT booking_id, string_agg(feature, ',' ORDER BY r) AS top_features,
          round(sum(c), 9) + 0.0 AS top_sum FROM ranked WHERE r <= 3 GROUP BY booking_id)""",
        select="SELECT booking_id, round(base, 9) AS base_value, round(base + "
        + " + ".join(f"c_{c}" for c in FEATURES)
        + ", 9) + 0.0 AS prediction_logit, top_features, top_sum FROM contrib JOIN tops USING (booking_id)",
    ),
)
def _local_explanation(spark, sf):
    rows, base = explained(spark, sf)
    local = X.local_explanations(rows, "booking_id", FEATURES, base, k=3)
    top_sum = F.aggregate("top", F.lit(0.0), lambda s, t: s + t["contribution"])
    return rounded(
        local.select(
            "booking_id",
            "base_value",
            "prediction_logit",
            F.array_join("top.feature", ",").alias("top_features"),
            top_sum.alias("top_sum"),
        ),
        9,
    )


@query(
    "extreme_rows",
    sql_over(
        BOOKINGS,
        SPLIT,
        _CONTRIB,
        "logits AS (SELECT booking_id, base + "
        + " + ".join(f"c_{c}" for c in FEATURES)
        + " AS z FROM contrib)",
        select="""(SELECT booking_id, round(z, 9) AS prediction_logit, 'high' AS which FROM logits
            ORDER BY z DESC, booking_id LIMIT 1) UNION ALL
          (SELECT booking_id, round(z, 9), 'low' FROM logits ORDER BY z, booking_id LIMIT 1)""",
    ),
)
def _extreme_rows(spark, sf):
    rows, base = explained(spark, sf)
    local = X.local_explanations(rows, "booking_id", FEATURES, base)
    return rounded(X.extreme_rows(local, "booking_id").select("booking_id", "prediction_logit", "which"), 9)


@query(
    "score_batch",
    sql_over(
        BOOKINGS,
        "raw AS (SELECT booking_id, is_canceled, 1 / (1 + exp(-("
        + f"{INTERCEPT} + "
        + " + ".join(f"{w!r} * {c}" for c, w in COEFS.items())
        + "))) AS p FROM bookings)",
        select="""SELECT booking_id, round(p, 4) AS probability, CAST(p >= 0.3 AS INTEGER) AS prediction,
          CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS risk_band,
          is_canceled AS true_label FROM raw""",
    ),
)
def _score_batch(spark, sf):
    from ..functions.scalar import linear, sigmoid
    from ..streaming.scoring import scored_record

    b = bookings(spark, sf, ["booking_id", "is_canceled", *FEATURES])
    return scored_record(b, "booking_id", sigmoid(linear(COEFS, INTERCEPT)), "is_canceled", 0.3)
