"""Drift, monitoring windows and the retraining policy."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import drift as D
from ..operators import monitoring as M
from ..operators.split import time_split
from ..sources.tables import staged_bookings
from .queries_features import SCORED, scored
from .registry import BOOKINGS, SPLIT, query, rounded, sql_over

NUMERIC = ("lead_time", "adr", "price", "previous_cancellations")
CATEGORICAL = ("market_segment", "deposit_type", "country", "customer_type")
BINNED = ("lead_time", "adr", "price")
DISCRETE = ("previous_cancellations",)


def _psi_numeric_sql(c: str, ref: str, cur: str) -> str:
    edges = ", ".join(f"quantile_cont({c}, {i / 10})" for i in range(11))
    return f"""SELECT '{c}' AS feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM (
      SELECT count(*) FILTER (WHERE is_ref) / (SELECT count({c}) FROM {ref}) + 1e-6 AS rp,
        count(*) FILTER (WHERE NOT is_ref) / (SELECT count({c}) FROM {cur}) + 1e-6 AS cp FROM (
        SELECT is_ref, (SELECT count(*) FROM e WHERE v <= x AND v > lo AND v < hi) AS b FROM (
          SELECT {c} AS x, true AS is_ref FROM {ref} UNION ALL SELECT {c}, false FROM {cur}),
          (SELECT min({c}) AS lo, max({c}) AS hi FROM {ref}) WHERE x IS NOT NULL) GROUP BY b)""".replace(
        "FROM e WHERE", f"FROM (SELECT DISTINCT unnest([{edges}]) AS v FROM {ref}) WHERE"
    )


def _psi_levels_sql(c: str, ref: str, cur: str) -> str:
    level = f"coalesce(CAST({c} AS VARCHAR), '__null__')"
    return f"""SELECT '{c}' AS feature, sum((cp - rp) * ln(cp / rp)) AS psi FROM (
      SELECT coalesce(r.n, 0) / (SELECT count(*) FROM {ref}) + 1e-6 AS rp,
        coalesce(k.n, 0) / (SELECT count(*) FROM {cur}) + 1e-6 AS cp
      FROM (SELECT {level} AS l, count(*) AS n FROM {ref} GROUP BY 1) r
      FULL JOIN (SELECT {level} AS l, count(*) AS n FROM {cur} GROUP BY 1) k USING (l))"""


def _ks_sql(c: str, ref: str, cur: str) -> str:
    return f"""SELECT '{c}' AS feature, max(abs(fr - fc)) AS d, any_value(nr) AS nr, any_value(nc) AS nc FROM (
      SELECT sum(r) OVER (ORDER BY x) / sum(r) OVER () AS fr, sum(c) OVER (ORDER BY x) / sum(c) OVER () AS fc,
        sum(r) OVER () AS nr, sum(c) OVER () AS nc FROM (
        SELECT x, sum(r) AS r, sum(1 - r) AS c FROM (
          SELECT {c} AS x, 1 AS r FROM {ref} UNION ALL SELECT {c}, 0 FROM {cur})
        WHERE x IS NOT NULL GROUP BY x))"""


def _union(make, columns, ref="train", cur="test") -> str:
    return " UNION ALL ".join(make(c, ref, cur) for c in columns)


_KS_P = """CASE WHEN d IS NULL THEN NULL WHEN d * d * (nr * nc / (nr + nc)) < 0.04 THEN 1.0 ELSE least(greatest(
  list_sum([CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * d * d * (nr * nc / (nr + nc)))
    FOR k IN range(1, 51)]), 0), 1) END"""

_CLASS = """CASE WHEN psi < 0.1 THEN 'no_drift' WHEN psi < 0.25 THEN 'moderate_drift'
  ELSE 'significant_drift' END"""


def _report_sql(ref: str, cur: str) -> str:
    return f"""psi AS ({_union(_psi_numeric_sql, BINNED, ref, cur)} UNION ALL
  {_union(_psi_levels_sql, CATEGORICAL + DISCRETE, ref, cur)}),
ks AS ({_union(_ks_sql, NUMERIC, ref, cur)}),
report AS (SELECT feature, CASE WHEN d IS NULL THEN 'categorical' ELSE 'numeric' END AS type,
  round(psi, 4) + 0.0 AS psi, {_CLASS} AS drift, round(d, 4) AS ks_stat, round({_KS_P}, 4) AS ks_pvalue
  FROM psi LEFT JOIN ks USING (feature))"""


def sides(spark, sf):
    b = staged_bookings(spark, sf, ["booking_id", "period", "is_canceled", *NUMERIC, *CATEGORICAL])
    train, test, _ = time_split(b)
    return train, test


@query(
    "psi_numeric",
    sql_over(
        BOOKINGS,
        SPLIT,
        select=f"SELECT feature, round(psi, 6) + 0.0 AS psi FROM ({_union(_psi_numeric_sql, NUMERIC)})",
    ),
)
def _psi_numeric(spark, sf):
    return rounded(D.psi_numeric(*sides(spark, sf), NUMERIC))


@query(
    "psi_categorical",
    sql_over(
        BOOKINGS,
        SPLIT,
        select=f"SELECT feature, round(psi, 6) + 0.0 AS psi FROM ({_union(_psi_levels_sql, CATEGORICAL)})",
    ),
)
def _psi_categorical(spark, sf):
    return rounded(D.psi_categorical(*sides(spark, sf), CATEGORICAL))


@query(
    "ks_two_sample",
    sql_over(
        BOOKINGS,
        SPLIT,
        f"ks AS ({_union(_ks_sql, NUMERIC)})",
        select=f"SELECT feature, round(d, 6) AS ks_stat, round({_KS_P}, 6) AS ks_pvalue FROM ks",
    ),
)
def _ks_two_sample(spark, sf):
    return rounded(D.ks_two_sample(*sides(spark, sf), NUMERIC))


_FEATURES = [*NUMERIC, *CATEGORICAL]


@query(
    "drift_report",
    sql_over(BOOKINGS, SPLIT, _report_sql("train", "test"), select="SELECT * FROM report"),
)
def _drift_report(spark, sf):
    train, test = sides(spark, sf)
    return rounded(D.detect_drift(train, test, "is_canceled", _FEATURES), 4)


_DRIFTED = """drifted AS (SELECT * REPLACE (lead_time * 1.6 + 20 AS lead_time,
  CASE WHEN CAST('0x' || substr(md5(booking_id || '-flip-0'), 1, 13) AS BIGINT) < 1351079888211148
    THEN 'BUILDING' ELSE market_segment END AS market_segment) FROM test)"""


def drifted_sides(spark, sf):
    train, test = sides(spark, sf)
    return train, D.inject_drift(test, "booking_id", "lead_time", "market_segment", "BUILDING")


@query(
    "drift_injected",
    sql_over(
        BOOKINGS, SPLIT, _DRIFTED, _report_sql("train", "drifted"), select="SELECT * FROM report"
    ),
)
def _drift_injected(spark, sf):
    train, drifted = drifted_sides(spark, sf)
    return rounded(D.detect_drift(train, drifted, "is_canceled", _FEATURES), 4)


_SUMMARY = """summary AS (SELECT CASE WHEN count(*) FILTER (WHERE drift = 'significant_drift') > 0
    THEN 'significant_drift' WHEN count(*) FILTER (WHERE drift = 'moderate_drift') > 0
    THEN 'moderate_drift' ELSE 'no_drift' END AS overall_drift,
  count(*) FILTER (WHERE drift = 'significant_drift') AS n_significant,
  count(*) FILTER (WHERE drift = 'moderate_drift') AS n_moderate, round(max(psi), 4) AS max_psi,
  (SELECT list(feature ORDER BY psi DESC, feature) FROM
    (SELECT * FROM report ORDER BY psi DESC, feature LIMIT 5)) AS top_drifted FROM report)"""


@query(
    "drift_summary",
    sql_over(
        BOOKINGS,
        SPLIT,
        _DRIFTED,
        _report_sql("train", "drifted"),
        _SUMMARY,
        select="SELECT * REPLACE (array_to_string(top_drifted, ',') AS top_drifted) FROM summary",
    ),
)
def _drift_summary(spark, sf):
    train, drifted = drifted_sides(spark, sf)
    summary = D.summarize(D.detect_drift(train, drifted, "is_canceled", _FEATURES))
    return summary.withColumn("top_drifted", F.array_join("top_drifted", ","))


_WINDOWS = """groups AS (SELECT period, p, sum(is_canceled) AS pos, count(*) - sum(is_canceled) AS neg
  FROM scored GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM groups
  WINDOW w AS (PARTITION BY period ORDER BY p DESC)),
windows AS (SELECT period, CAST(sum(pos + neg) AS BIGINT) AS n_labeled,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END AS pr_auc,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(neg * (cum_pos - pos / 2)) / sum(pos) / sum(neg) END AS roc_auc
  FROM curve GROUP BY period)"""


@query(
    "window_metric",
    sql_over(
        SCORED,
        _WINDOWS,
        select="""SELECT period, n_labeled, round(pr_auc, 6) AS pr_auc, round(roc_auc, 6) AS roc_auc
          FROM windows""",
    ),
)
def _window_metric(spark, sf):
    windows = scored(spark, sf, ["booking_id", "is_canceled", "period"])
    return rounded(M.window_metric(windows, "is_canceled", "p", ["period"]))


BASELINE = 0.36


@query(
    "retrain_policy",
    sql_over(
        BOOKINGS,
        SPLIT,
        _report_sql("train", "test"),
        _SUMMARY,
        SCORED,
        _WINDOWS,
        f"""judged AS (SELECT *, n_labeled >= 200 AND pr_auc IS NOT NULL AS ok,
          ({BASELINE} - pr_auc) / {BASELINE} AS fall FROM windows, summary)""",
        select=f"""SELECT period, overall_drift AS drift,
          coalesce(ok AND (pr_auc < 0.35 OR fall > 0.1), false) OR overall_drift = 'significant_drift'
            AS retrain, round(pr_auc, 4) AS current_prauc, {BASELINE}::DOUBLE AS baseline_prauc,
          concat_ws(' | ',
            CASE WHEN n_labeled < 200 THEN
              printf('too_few_labels: %d of 200', n_labeled) END,
            CASE WHEN ok AND pr_auc < 0.35 THEN
                printf('precision_floor: %.3f < 0.35', pr_auc)
              WHEN ok AND fall > 0.1 THEN printf('precision_fall: %.1f%% of %.3f, at most 10%%',
                fall * 100, {BASELINE}::DOUBLE)
              WHEN ok THEN printf('precision_kept: %.3f against %.3f', pr_auc,
                {BASELINE}::DOUBLE) END,
            CASE WHEN overall_drift = 'significant_drift' THEN
                'inputs_shifted: ' || array_to_string(top_drifted, ', ')
              WHEN overall_drift = 'moderate_drift' THEN
                'inputs_moving' END) AS reasons
          FROM judged""",
    ),
)
def _retrain_policy(spark, sf):
    train, test = sides(spark, sf)
    summary = D.summarize(D.detect_drift(train, test, "is_canceled", _FEATURES)).first()
    windows = M.window_metric(
        scored(spark, sf, ["booking_id", "is_canceled", "period"]), "is_canceled", "p", ["period"]
    ).withColumns(
        {
            "overall_drift": F.lit(summary["overall_drift"]),
            "top_drifted": F.array(*[F.lit(f) for f in summary["top_drifted"]]),
        }
    )
    decided = M.retraining_decision(windows, BASELINE)
    return decided.select(
        "period",
        F.col("overall_drift").alias("drift"),
        "retrain",
        "current_prauc",
        "baseline_prauc",
        F.array_join("reasons", " | ").alias("reasons"),
    )
