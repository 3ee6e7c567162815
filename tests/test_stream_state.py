"""Keyed state, running quality, drift hand-off, sessions, progress and sources of streams."""

import json
import time

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from stayledger.operators import quality as rules
from stayledger.operators.drift import detect_drift
from stayledger.operators.monitoring import window_metric
from stayledger.schema import BOOKING_EVENT
from stayledger.streaming import events as E
from stayledger.streaming import handoff as H
from stayledger.streaming import jobs as J
from stayledger.streaming import progress as P
from stayledger.streaming import quality as Q
from stayledger.streaming.recent import RecentWindow, newest_of
from stayledger.streaming.scoring import scored_record

SCHEMA = "id long, at long, kind string, label int, p double, ms double, note string"


def made(i):
    """Row i: a hot key, a missing key, missing labels, tied scores and orders that go back in time."""
    kind = None if i % 17 == 0 else ("hot" if i % 3 else f"k{i % 5}")
    label = None if i % 11 == 0 else int((i * 7919) % 10 > 5)
    at = None if i % 29 == 0 else (i * 37) % 1000
    return (i, at, kind, label, round((i * 31 % 100) / 100, 2), float(i * 13 % 50), None if i % 2 else "n")


ROWS = [made(i) for i in range(600)]


class Drops:
    """A folder that gets one file of rows at a time."""

    def __init__(self, spark, path):
        self.spark, self.path, self.files = spark, str(path / "in"), 0

    def add(self, rows):
        self.spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(self.path)

    def stream(self, per_trigger=1):
        return E.read_stream(self.spark, self.path, self.spark.createDataFrame([], SCHEMA).schema,
                             files_per_trigger=per_trigger)


@pytest.fixture
def drops(spark, tmp_path):
    out = Drops(spark, tmp_path)
    for start in range(0, 600, 200):
        out.add(ROWS[start : start + 200])
    return out


def newest(rows, n):
    held = {}
    for r in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[0]), reverse=True):
        held.setdefault(r[2], []).append(r)
    return sorted((r for own in held.values() for r in own[:n]), key=lambda r: r[0])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: r[0])


def test_window_state_survives_a_restart_and_stays_bounded(spark, drops, tmp_path):
    window, state = RecentWindow(7, ["at", "id"], ["kind"]), str(tmp_path / "state")
    J.available_now(window.writer(drops.stream(), state))
    assert rows_of(window.table(spark, state)) == newest(ROWS, 7)
    late = [made(i) for i in range(600, 640)]
    drops.add(late)
    J.available_now(RecentWindow(7, ["at", "id"], ["kind"]).writer(drops.stream(), state))
    got = window.table(spark, state)
    assert rows_of(got) == newest(ROWS + late, 7)
    assert got.groupBy("kind").count().agg(F.max("count")).first()[0] == 7


def test_window_without_keys(spark, drops, tmp_path):
    window, state = RecentWindow(10, ["id"]), str(tmp_path / "state")
    J.available_now(window.writer(drops.stream(), state))
    assert [r[0] for r in rows_of(window.table(spark, state))] == list(range(590, 600))


def test_window_with_a_time_to_live(spark, drops, tmp_path):
    window, state = RecentWindow(5, ["id"], ["kind"], ttl_ms=3_600_000), str(tmp_path / "state")
    running = window.writer(drops.stream(3), state).start()
    until = time.time() + 60
    while not any(p["numInputRows"] for p in running.recentProgress) and time.time() < until:
        time.sleep(0.5)
    running.stop()
    assert {r[0] for r in newest_ids(ROWS, 5)} == {r[0] for r in rows_of(window.table(spark, state).select("id"))}


def newest_ids(rows, n):
    return newest([(r[0], r[0], *r[2:]) for r in rows], n)


def test_changed_windows_reach_the_report(spark, drops, tmp_path):
    window = RecentWindow(40, ["at", "id"], ["kind"])
    table = str(tmp_path / "runs")
    report = Q.report_each_batch(table, lambda rows: Q.window_quality(rows, "p", "label", "ms", ["kind"]))
    J.available_now(window.writer(drops.stream(), str(tmp_path / "state"), report))
    last = spark.read.parquet(table)
    newest_batch = last.agg(F.max("batch_id")).first()[0]
    assert newest_batch == 2
    held = spark.createDataFrame(newest(ROWS, 40), SCHEMA)
    want = {r.kind: r for r in window_metric(held, "label", "p", ["kind"]).collect()}
    got = {r.kind: r for r in last.where(F.col("batch_id") == newest_batch).collect()}
    assert set(got) == set(want)
    for kind, r in got.items():
        assert r.n_labeled == want[kind].n_labeled
        assert r.pr_auc == pytest.approx(want[kind].pr_auc) and r.roc_auc == pytest.approx(want[kind].roc_auc)


@pytest.mark.parametrize("keys", [[], ["kind"], ["kind", "note"]])
def test_newest_of_a_table(keys):
    table = pa.table({c: [r[k] for r in ROWS] for k, c in enumerate(("id", "at", "kind", "label", "p", "ms", "note"))})
    held = {}
    for r in sorted(ROWS, key=lambda r: r[0], reverse=True):
        held.setdefault(tuple({"kind": r[2], "note": r[6]}[k] for k in keys), []).append(r[0])
    want = sorted(i for own in held.values() for i in own[:4])
    assert sorted(newest_of(table, 4, ["id"], keys).column("id").to_pylist()) == want
    assert newest_of(table.slice(0, 0), 4, ["id"], keys).num_rows == 0


@pytest.mark.parametrize("keys", [[], ["kind"]])
def test_running_quality_equals_batch(spark, drops, keys):
    counts = J.run_to_table(Q.outcome_counts(drops.stream(), "p", "label", "ms", keys), "outcomes", "complete")
    got = {tuple(r[k] for k in keys): r for r in Q.quality_of_counts(counts, keys).collect()}
    table = spark.createDataFrame(ROWS, SCHEMA)
    metrics = {tuple(r[k] for k in keys): r for r in window_metric(table, "label", "p", keys).collect()}
    times = {tuple(r[k] for k in keys): r for r in J.index_percentiles(table, "ms", Q.PICKS, keys).collect()}
    assert set(got) == set(metrics) == set(times)
    for k, r in got.items():
        own = sorted(x[5] for x in ROWS if not keys or x[2] == k[0])
        assert (r.p50, r.p95) == (times[k].p50, times[k].p95)
        assert (r.p50, r.p95) == (own[len(own) // 2], own[int(len(own) * 0.95)])
        assert r.processed == len(own) and r.n_labeled == metrics[k].n_labeled
        assert r.pr_auc == pytest.approx(metrics[k].pr_auc, abs=1e-12)
        assert r.roc_auc == pytest.approx(metrics[k].roc_auc, abs=1e-12)


def test_quality_of_nothing_and_without_labels(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert Q.quality_of_counts(Q.outcome_counts(none, "p", "label", "ms", ["kind"]), ["kind"]).count() == 0
    blind = spark.createDataFrame([(1, 1, "a", None, 0.5, None, None)], SCHEMA)
    row = Q.quality_of_counts(Q.outcome_counts(blind, "p", "label", "ms")).first()
    assert (row.processed, row.n_labeled, row.pr_auc, row.p50) == (1, 0, None, None)


def test_hot_percentiles_have_no_list(spark):
    df = spark.range(20_000).select(F.lit("only").alias("k"), (F.col("id") % 977).cast("double").alias("v"))
    out = J.index_percentiles(df, "v", {"p50": 0.5, "p95": 0.95}, ["k"])
    assert "collect_list" not in out._jdf.queryExecution().optimizedPlan().toString()
    values = sorted(float(i % 977) for i in range(20_000))
    assert tuple(out.first()) == ("only", values[10_000], values[19_000])


def test_frozen_counts_give_the_batch_report(spark, drops, tmp_path):
    reference = spark.createDataFrame([made(i * 3 + 1) for i in range(400)], SCHEMA)
    names = ["ms", "label", "kind", "note"]
    H.freeze(reference, ["ms", "label"], ["kind", "note"], ["label"]).save(str(tmp_path / "ref"))
    ref = H.FrozenReference.load(spark, str(tmp_path / "ref"))
    counts = J.run_to_table(H.cell_counts(drops.stream(), ref), "cells", "complete")
    got = {r.feature: r for r in H.drift_of_counts(ref, counts).collect()}
    current = spark.createDataFrame(ROWS, SCHEMA)
    want = {r.feature: r for r in detect_drift(reference, current, "id", names).collect()}
    assert set(got) == set(want) == set(names)
    assert all(got[f] == want[f] for f in names)


def test_frozen_ranges_may_be_many(spark):
    """Ranges grow with the shuffle partitions; as a chain of conditions 800 of them overflowed the stack."""
    reference = spark.range(6000).select("id", (F.pmod(F.col("id") * 7919, F.lit(5003)) / 4).alias("a"),
                                         (F.pmod(F.col("id") * 31, F.lit(3001)) - 1500).alias("b"))
    current = reference.where("id % 3 > 0").withColumn("a", F.col("a") + F.col("id") % 100)
    partitions = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "512")
        ref = H.freeze(reference, ["a", "b"], [])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
    assert min(len(ref.splits[f]) for f in ("a", "b")) > 1200
    got = {r.feature: r for r in H.drift_of_counts(ref, H.cell_counts(current, ref)).collect()}
    want = {r.feature: r for r in detect_drift(reference, current, "id", ["a", "b"]).collect()}
    assert got == want and set(got) == {"a", "b"}


def test_zeros_infinities_and_missing_values_in_frozen_ranges(spark):
    """Every value of a feature is one step of the KS curve, whatever its range or sign of zero."""
    before = [-0.0] * 6 + [0.0] * 5 + [-1.0] * 3 + [2.0, float("-inf"), float("nan"), None]
    after = [0.0] * 9 + [-0.0] * 2 + [-1.0] + [2.0] * 4 + [float("inf")] * 3 + [float("nan"), None]
    reference, current = (spark.createDataFrame([(v,) for v in x], "v double") for x in (before, after))
    ref = H.freeze(reference, ["v"], [])
    assert 0.0 in ref.splits["v"]

    def shares(x):
        x = [v for v in x if v is not None]  # not-a-number comes after all others
        return [sum(v <= at for v in x) / len(x) for at in (float("-inf"), -1.0, 0.0, 2.0, float("inf"))]

    gap = max(abs(a - b) for a, b in zip(shares(before), shares(after), strict=True))
    row = H.drift_of_counts(ref, H.cell_counts(current, ref)).first()
    assert row.ks_stat == round(gap, 4)


def test_sessions_of_a_stream_and_their_late_rows(spark, tmp_path):
    def drop(*rows):
        df = spark.createDataFrame([(u, s, 0.5) for u, s in rows], "user string, ts string, probability double")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        schema = spark.read.parquet(str(tmp_path / "in")).schema
        timed = J.with_event_time(E.read_stream(spark, str(tmp_path / "in"), schema), "ts", "10 minutes")
        out = J.stream_sessions(timed, "ts", "user", 30)
        J.available_now(J.append_log(out, str(tmp_path / "out"), str(tmp_path / "cp"), "parquet"))

    with P.progress_to(spark, str(tmp_path / "progress")):
        drop(("a", "2024-01-01 10:00:00"), ("a", "2024-01-01 10:20:00"), ("b", "2024-01-01 10:05:00"),
             ("a", "2024-01-01 13:00:00"))
        run()
        drop(("a", "2024-01-01 10:10:00"), ("b", "2024-01-01 16:00:00"))  # the first row is late
        run()
    rows = {(r.user, str(r.session_start)[11:16]): r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows == {("a", "10:00"): 2, ("b", "10:05"): 1, ("a", "13:00"): 1}
    seen = P.read_progress(spark, str(tmp_path / "progress"))
    assert seen.agg(F.sum("late_rows")).first()[0] == 1
    assert seen.agg(F.sum("input_rows")).first()[0] == 6


def test_progress_is_read_back(spark, drops, tmp_path):
    path = str(tmp_path / "progress")
    with P.progress_to(spark, path):
        window = RecentWindow(3, ["id"], ["kind"])
        J.available_now(window.writer(drops.stream(), str(tmp_path / "state")))
    rows = P.read_progress(spark, path).orderBy("batch_id").collect()
    assert [r.kind for r in rows].count("started") == 1 and [r.kind for r in rows].count("ended") == 1
    batches = [r for r in rows if r.kind == "progress" and r.input_rows]
    assert [r.input_rows for r in batches] == [200, 200, 200]
    assert all(r.batch_ms > 0 and r.state_rows > 0 and r.error is None for r in batches)


def event_json(number):
    body = {"hotel": "City Hotel", "lead_time": 10, "adr": 80.0}
    return F.to_json(F.struct(
        number.alias("event_id"), F.from_json(F.lit(json.dumps(body)), BOOKING_EVENT["booking"].dataType).alias("booking")
    ))


def scored_events(raw, payload):
    good, dead = E.accepted_events(raw, payload, rules=[rules.in_range("booking.lead_time", 0, 1000)])
    p = F.lit(0.01) * F.col("booking.lead_time")
    return scored_record(good, "event_id", p, "_true_label"), dead


def test_sources_are_interchangeable(spark, tmp_path):
    lines = spark.range(5).select(event_json(F.col("id")).alias("value"))
    bad = spark.createDataFrame([("{oops",), ('{"event_id": 9, "booking": {"lead_time": -4}}',)], "value string")
    lines.unionByName(bad).coalesce(1).write.text(str(tmp_path / "in"))
    files, _ = scored_events(E.read_stream(spark, str(tmp_path / "in"), fmt="text"), "value")
    rate_source = E.read_stream(spark, fmt="rate", options={"rowsPerSecond": 50})
    assert rate_source.columns == ["timestamp", "value"]
    rates, _ = scored_events(rate_source, event_json(F.col("value")))
    assert files.schema == rates.schema
    assert sorted(r.event_id for r in J.run_to_table(files, "files").collect()) == [0, 1, 2, 3, 4]

    running = rates.writeStream.format("memory").queryName("rates").start()
    try:
        until = time.time() + 60
        while not spark.table("rates").head(1) and time.time() < until:
            time.sleep(0.5)
    finally:
        running.stop()
    assert spark.table("rates").where("probability = 0.1").count() > 0


def test_bytes_and_dead_letters(spark, tmp_path):
    lines = ["{oops", '{"event_id": 9, "booking": {"lead_time": -4}}', '{"event_id": 1, "booking": {"lead_time": 4}}']
    raw = spark.createDataFrame([(x.encode(),) for x in lines], "body binary")
    good, dead = scored_events(raw, "body")
    assert [r.event_id for r in good.collect()] == [1]
    reasons = {r.line[:8]: r.reasons for r in dead.collect()}
    assert reasons["{oops"] == ["unreadable"]
    assert reasons['{"event_'] == ["booking.lead_time_out_of_range"]


def test_latest_result_is_whole_while_the_next_is_written(spark, drops, tmp_path):
    counts = Q.outcome_counts(drops.stream(), "p", "label")
    out = str(tmp_path / "out")
    J.available_now(J.keep_latest(counts, out, str(tmp_path / "cp")))
    assert J.latest_result(spark, out, counts.schema).agg(F.sum("n")).first()[0] == 600
    spark.read.parquet(out + "/turn=0").limit(0).write.mode("overwrite").parquet(out + "/turn=0")
    assert J.latest_result(spark, out, counts.schema).agg(F.sum("n")).first()[0] == 400
