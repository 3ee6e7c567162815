"""Streams over the events table, drained to tables and compared with batch SQL."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import flag, sigmoid, utc_instant, utc_wall
from ..operators.ordering import order_statistics
from ..schema import ACTIVITY_EVENT
from ..session import work_path
from ..sources.tables import table
from ..streaming import jobs as J
from ..streaming import handoff as H
from ..streaming import quality as Q
from ..streaming.events import parse_events, read_stream
from ..streaming.recent import RecentWindow
from ..streaming.scoring import scored_record
from .queries_drift import _CLASS, _KS_P, _ks_sql, _psi_levels_sql, _psi_numeric_sql
from .registry import query, rounded, sql_over

SCORED = """scored AS (SELECT event_id, ts, event_type, user_id, value, p,
  round(p, 4) AS probability, CAST(p >= 0.3 AS INTEGER) AS prediction,
  CASE WHEN p < 0.25 THEN 'low' WHEN p < 0.6 THEN 'medium' ELSE 'high' END AS risk_band,
  CAST(event_type = 'error' AS INTEGER) AS true_label
  FROM (SELECT *, 1 / (1 + exp(-(-1.5 + 0.03 * value))) AS p FROM events))"""


def _source(spark, sf):
    return read_stream(spark, f"{sf}/events*.parquet", ACTIVITY_EVENT)


def _scored(events, keep=()):
    labelled = events.withColumn("_label", flag(F.col("event_type") == "error"))
    p = sigmoid(F.lit(-1.5) + F.lit(0.03) * F.col("value"))
    return scored_record(labelled, "event_id", p, "_label", 0.3, keep)


@query(
    "stream_scored",
    sql_over(
        SCORED,
        select="SELECT event_id, probability, prediction, risk_band, true_label FROM scored",
    ),
)
def _stream_scored(spark, sf):
    return J.run_to_table(_scored(_source(spark, sf)), "stream-scored")


_METRICS = """SELECT count(*) AS processed,
  round(count(*) FILTER (WHERE prediction = true_label) / count(true_label), 4) AS running_accuracy,
  count(*) FILTER (WHERE risk_band = 'low') AS n_low,
  count(*) FILTER (WHERE risk_band = 'medium') AS n_medium,
  count(*) FILTER (WHERE risk_band = 'high') AS n_high FROM scored"""


@query("stream_running_metrics", sql_over(SCORED, select=_METRICS))
def _stream_running_metrics(spark, sf):
    metrics = J.running_metrics(_scored(_source(spark, sf)))
    return J.run_to_table(metrics, "stream-metrics", "complete")


@query("stream_running_metrics_batch", sql_over(SCORED, select=_METRICS))
def _stream_running_metrics_batch(spark, sf):
    return J.running_metrics(_scored(table(spark, sf, "events")))


_LAST = """SELECT event_id, event_type, probability, true_label FROM (SELECT *,
  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM scored)
  WHERE r <= 200"""


@query("last_n", sql_over(SCORED, select=_LAST))
def _last_n(spark, sf):
    scored = _scored(table(spark, sf, "events"), keep=("ts", "event_type"))
    latest = J.latest_rows(scored, 200, ["ts", "event_id"], ["event_type"])
    return latest.select("event_id", "event_type", "probability", "true_label")


@query("stream_last_n", sql_over(SCORED, select=_LAST))
def _stream_last_n(spark, sf):
    scored = _scored(_source(spark, sf), keep=("ts", "event_type"))
    recent = RecentWindow(200, ["ts", "event_id"], ["event_type"])
    state = work_path(spark, "recent-state")
    J.available_now(recent.writer(scored, state))
    return recent.table(spark, state).select("event_id", "event_type", "probability", "true_label")


@query(
    "latency_percentiles",
    """SELECT (list(value ORDER BY value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS p50,
       (list(value ORDER BY value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95 FROM events""",
)
def _latency_percentiles(spark, sf):
    events = table(spark, sf, "events")

    def picks(_name, n):
        return [n // 2, int(n * 0.95)]

    counts, found = order_statistics(events, {"value": F.col("value")}, picks)
    p50, p95 = (found["value"].get(r) for r in picks("value", counts["value"]))
    return spark.createDataFrame([(p50, p95)], "p50 double, p95 double")


@query(
    "latency_percentiles_recent",
    """WITH r AS (SELECT value FROM events ORDER BY ts DESC, event_id DESC LIMIT 1000)
       SELECT (list(value ORDER BY value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS p50,
       (list(value ORDER BY value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95 FROM r""",
)
def _latency_percentiles_recent(spark, sf):
    events = table(spark, sf, "events").select("ts", "event_id", "value")
    recent = J.latest_rows(events, 1000, ["ts", "event_id"])
    return J.index_percentiles(recent, "value", {"p50": 0.5, "p95": 0.95})


@query(
    "latency_percentiles_by_type",
    """SELECT event_type, (list(value ORDER BY value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS p50,
       (list(value ORDER BY value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95
       FROM events GROUP BY event_type""",
)
def _latency_percentiles_by_type(spark, sf):
    return J.index_percentiles(table(spark, sf, "events"), "value", Q.PICKS, ["event_type"])


def _quality_sql(rows: str) -> str:
    """Quality per event type of the rows of a relation, in SQL."""
    return f"""groups AS (SELECT event_type, probability AS p, sum(true_label) AS pos,
    count(*) - sum(true_label) AS neg FROM {rows} GROUP BY ALL),
curve AS (SELECT *, sum(pos) OVER w AS cum_pos, sum(neg) OVER w AS cum_neg FROM groups
  WINDOW w AS (PARTITION BY event_type ORDER BY p DESC)),
ranked AS (SELECT event_type, CAST(sum(pos + neg) AS BIGINT) AS n_labeled,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(pos * cum_pos / (cum_pos + cum_neg)) / sum(pos) END AS pr_auc,
  CASE WHEN sum(pos) > 0 AND sum(neg) > 0
    THEN sum(neg * (cum_pos - pos / 2)) / sum(pos) / sum(neg) END AS roc_auc
  FROM curve GROUP BY event_type),
times AS (SELECT event_type, count(*) AS processed,
  (list(value ORDER BY value))[CAST(floor(count(*) / 2) AS BIGINT) + 1] AS p50,
  (list(value ORDER BY value))[CAST(floor(count(*) * 0.95) AS BIGINT) + 1] AS p95
  FROM {rows} GROUP BY event_type)"""


# Large values stand for the true label here, so that both classes occur in every event type.
_LABELLED = """labelled AS (SELECT * REPLACE (CAST(value > 60 OR user_id % 3 = 0 AS INTEGER) AS true_label,
  event_type AS event_type) FROM scored)"""
_QUALITY = """SELECT event_type, processed, n_labeled, round(pr_auc, 6) AS pr_auc,
  round(roc_auc, 6) AS roc_auc, p50, p95 FROM times JOIN ranked USING (event_type)"""


def _labelled(events):
    label = flag((F.col("value") > 60) | (F.col("user_id") % 3 == 0))
    p = sigmoid(F.lit(-1.5) + F.lit(0.03) * F.col("value"))
    kept = ("ts", "event_type", "value")
    return scored_record(events.withColumn("_label", label), "event_id", p, "_label", 0.3, kept)


@query("stream_quality", sql_over(SCORED, _LABELLED, _quality_sql("labelled"), select=_QUALITY))
def _stream_quality(spark, sf):
    """Quality of everything seen so far, from the counts that the stream keeps."""
    counts = Q.outcome_counts(_labelled(_source(spark, sf)), latency="value", keys=["event_type"])
    seen = J.run_to_table(counts, "stream-outcomes", "complete")
    return rounded(Q.quality_of_counts(seen, ["event_type"]))


_NEWEST = """newest AS (SELECT * FROM (SELECT *,
  row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id DESC) AS r FROM labelled)
  WHERE r <= 500)"""


@query(
    "stream_recent_quality", sql_over(SCORED, _LABELLED, _NEWEST, _quality_sql("newest"), select=_QUALITY)
)
def _stream_recent_quality(spark, sf):
    """Rolling quality over the last 500 rows of each event type, from the keyed state."""
    recent, state = RecentWindow(500, ["ts", "event_id"], ["event_type"]), work_path(spark, "rolling-state")
    J.available_now(recent.writer(_labelled(_source(spark, sf)), state))
    rows = recent.table(spark, state)
    return rounded(Q.window_quality(rows, "probability", "true_label", "value", ["event_type"]))


# The reference is the first half of the time that the table spans.
_HALVES = """cut AS (SELECT epoch_us(min(ts)) + (epoch_us(max(ts)) - epoch_us(min(ts))) // 2 AS c FROM events),
halves AS (SELECT value, user_id % 7 AS weekday, event_type, epoch_us(ts) <= c AS before FROM events, cut),
first_half AS (SELECT * FROM halves WHERE before),
second_half AS (SELECT * FROM halves WHERE NOT before)"""
_SIDES = ("first_half", "second_half")


@query(
    "stream_drift_report",
    sql_over(
        _HALVES,
        f"""psi AS ({_psi_numeric_sql("value", *_SIDES)} UNION ALL {_psi_levels_sql("weekday", *_SIDES)}
  UNION ALL {_psi_levels_sql("event_type", *_SIDES)}),
ks AS ({_ks_sql("value", *_SIDES)} UNION ALL {_ks_sql("weekday", *_SIDES)})""",
        select=f"""SELECT feature, CASE WHEN d IS NULL THEN 'categorical' ELSE 'numeric' END AS type,
          round(psi, 4) + 0.0 AS psi, {_CLASS} AS drift, round(d, 4) AS ks_stat,
          round({_KS_P}, 4) AS ks_pvalue FROM psi LEFT JOIN ks USING (feature)""",
    ),
)
def _stream_drift_report(spark, sf):
    """Events of the second half, counted by a stream, against frozen counts of the first."""
    events = table(spark, sf, "events")
    micros = F.unix_micros(utc_instant("ts"))
    ends = events.agg(F.min(micros).alias("a"), F.max(micros).alias("b")).first()
    cut = ends.a + (ends.b - ends.a) // 2

    def features(rows):
        return rows.select("value", (F.col("user_id") % 7).alias("weekday"), "event_type")

    frozen = H.freeze(features(events.where(micros <= cut)), ["value", "weekday"], ["event_type"], ["weekday"])
    path = work_path(spark, "reference")
    frozen.save(path)
    ref = H.FrozenReference.load(spark, path)
    counts = H.cell_counts(features(_source(spark, sf).where(micros > cut)), ref)
    return rounded(H.drift_of_counts(ref, J.run_to_table(counts, "stream-cells", "complete")), 4)


_WINDOWS = """SELECT CAST(date_trunc('day', ts) AS TIMESTAMP) AS window_start, event_type, count(*) AS n,
  count(*) FILTER (WHERE prediction = 1) AS n_positive, round(sum(probability), 4) AS sum_probability
  FROM scored {closed} GROUP BY ALL"""


def _summed(df):
    """Sums of four-digit probabilities compare exactly where their means may end in half a digit."""
    whole = F.round(F.col("mean_probability") * F.col("n"), 4)
    return rounded(df.withColumn("sum_probability", whole).drop("mean_probability"))


def _day(df):
    return _summed(df.withColumn("window_start", utc_wall("window_start")).drop("window_end"))


@query("event_window_metrics", sql_over(SCORED, select=_WINDOWS.format(closed="")))
def _event_window_metrics(spark, sf):
    scored = _scored(table(spark, sf, "events"), keep=("ts", "event_type"))
    timed = scored.withColumn("ts", utc_instant("ts"))
    return _day(J.window_metrics(timed, "ts", "1 day", keys=["event_type"]))


@query(
    "stream_event_windows",
    sql_over(
        SCORED,
        select=_WINDOWS.format(
            closed="""WHERE date_trunc('day', ts) + INTERVAL 1 DAY
              <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR"""
        ),
    ),
)
def _stream_event_windows(spark, sf):
    """Days the watermark has closed; the day still open is not emitted."""
    scored = _scored(_source(spark, sf), keep=("ts", "event_type"))
    timed = J.with_event_time(scored, "ts", "1 hour")
    closed = J.window_metrics(timed, "ts", "1 day", keys=["event_type"])
    return _day(J.run_to_table(closed, "stream-windows"))


_SESSIONS = (
    """marked AS (SELECT *, CASE WHEN ts - lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)
            < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS opens FROM scored)""",
    """numbered AS (SELECT *, sum(opens) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS s
            FROM marked)""",
    """sessions AS (SELECT user_id, min(ts) AS session_start, max(ts) + INTERVAL 30 MINUTE AS session_end,
          count(*) AS n, round(sum(probability), 4) AS sum_probability
          FROM numbered GROUP BY user_id, s)""",
)


@query("session_metrics", sql_over(SCORED, *_SESSIONS, select="SELECT * FROM sessions"))
def _session_metrics(spark, sf):
    scored = _scored(table(spark, sf, "events"), keep=("ts", "user_id"))
    timed = scored.withColumn("ts", utc_instant("ts"))
    sessions = J.session_metrics(timed, "ts", "user_id", 30)
    walls = {c: utc_wall(c) for c in ("session_start", "session_end")}
    return _summed(sessions.withColumns(walls))


@query(
    "stream_sessions",
    sql_over(
        SCORED,
        *_SESSIONS,
        select="""SELECT * FROM sessions
          WHERE session_end <= (SELECT max(ts) FROM events) - INTERVAL 1 HOUR""",
    ),
)
def _stream_sessions(spark, sf):
    """Sessions that the watermark has closed."""
    scored = _scored(_source(spark, sf), keep=("ts", "user_id"))
    closed = J.stream_sessions(J.with_event_time(scored, "ts", "1 hour"), "ts", "user_id", 30)
    sessions = J.run_to_table(closed, "stream-sessions")
    return _summed(sessions.withColumns({c: utc_wall(c) for c in ("session_start", "session_end")}))


@query(
    "stream_dead_letter",
    """SELECT CASE WHEN event_type = 'error' THEN 'dead' ELSE 'scored' END AS outcome,
       count(*) AS n, CAST(sum(CASE WHEN event_type = 'error' THEN NULL ELSE event_id END) AS BIGINT)
         AS sum_ids FROM events GROUP BY ALL""",
)
def _stream_dead_letter(spark, sf):
    """Events as JSON lines, those of one type cut short; broken lines go aside, the rest flow on."""
    events = table(spark, sf, "events")
    text = F.to_json(F.struct("event_id", "event_type", "value"))
    broken = F.substring(text, 1, F.length(text) - 3)
    cut = F.when(F.col("event_type") == "error", broken).otherwise(text)
    lines = work_path(spark, "event-lines")
    events.select(cut.alias("value")).write.text(lines)

    schema = T.StructType([f for f in ACTIVITY_EVENT if f.name in ("event_id", "event_type", "value")])
    good, dead = parse_events(spark.readStream.text(lines), schema)
    scored = J.run_to_table(good, "parsed")
    aside = J.run_to_table(dead, "dead-letter")
    ok = scored.agg(F.count(F.lit(1)).alias("n"), F.sum("event_id").alias("sum_ids"))
    bad = aside.agg(F.count(F.lit(1)).alias("n"), F.lit(None).cast("bigint").alias("sum_ids"))
    return ok.withColumn("outcome", F.lit("scored")).unionByName(
        bad.withColumn("outcome", F.lit("dead"))
    )
