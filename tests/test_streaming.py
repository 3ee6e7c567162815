import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from stayledger.functions.scalar import sigmoid
from stayledger.operators.cleaning import fill_with_flag
from stayledger.schema import ACTIVITY_EVENT, BOOKING_EVENT, EVENT_BOOKING
from stayledger.streaming import events as E
from stayledger.streaming import jobs as J
from stayledger.streaming.scoring import scored_record


@pytest.fixture(scope="module")
def event_files(spark, hotel, tmp_path_factory):
    """Booking events as JSON lines in six files, plus two broken lines."""
    path = str(tmp_path_factory.mktemp("events"))
    ready = fill_with_flag(hotel, ["agent", "company"])
    numbered = ready.withColumn("event_id", F.monotonically_increasing_id())
    lines = E.to_json_lines(E.to_event(numbered, "event_id"))
    lines.repartition(6).write.mode("overwrite").text(path)
    spark.createDataFrame([("{not json",), ('{"booking": {}}',)], "value string").coalesce(1).write.mode("append").text(path)
    return path


def probability():
    return sigmoid(F.lit(-2.0) + 0.01 * F.col("booking.lead_time"))


def test_event_shape(hotel):
    event = E.to_event(fill_with_flag(hotel, ["agent", "company"]).withColumn("event_id", F.lit(1)), "event_id")
    assert event.columns == ["event_id", "booking", "_true_label"]
    assert event.schema["booking"].dataType.names == EVENT_BOOKING.names
    body = json.loads(E.to_json_lines(event).first().value)
    assert body["booking"]["hotel"] in ("City Hotel", "Resort Hotel") and body["_true_label"] in (0, 1)
    blind = E.to_event(hotel.drop("is_canceled").withColumn("event_id", F.lit(1)), "event_id")
    assert blind.first()._true_label is None


def test_stream_equals_batch_and_skips_broken_lines(spark, event_files, hotel):
    stream = spark.readStream.option("maxFilesPerTrigger", 2).text(event_files)
    good, dead = E.parse_events(stream)
    out = J.run_to_table(scored_record(good, "event_id", probability(), "_true_label"), "scored")
    batch_good, _ = E.parse_events(spark.read.text(event_files))
    expected = scored_record(batch_good, "event_id", probability(), "_true_label")
    assert out.count() == hotel.count()
    assert out.exceptAll(expected).count() == 0
    assert J.run_to_table(dead, "dead").count() == 2


def test_running_metrics_of_stream_and_batch(spark, event_files):
    good, _ = E.parse_events(spark.readStream.option("maxFilesPerTrigger", 1).text(event_files))
    live = J.run_to_table(
        J.running_metrics(scored_record(good, "event_id", probability(), "_true_label")), "running", "complete"
    )
    batch, _ = E.parse_events(spark.read.text(event_files))
    want = J.running_metrics(scored_record(batch, "event_id", probability(), "_true_label"))
    assert live.collect() == want.collect()


def test_accuracy_is_null_without_labels(spark, event_files):
    good, _ = E.parse_events(spark.read.text(event_files))
    row = J.running_metrics(scored_record(good, "event_id", probability())).first()
    assert row.running_accuracy is None and row.processed == row.n_low + row.n_medium + row.n_high


def test_rank_limit_runs_before_the_shuffle(spark):
    """A hot key sends at most n rows per task."""
    df = spark.range(10_000).withColumn("k", F.when(F.col("id") < 9_000, "hot").otherwise("cold"))
    plan = J.latest_rows(df, 5, ["id"], ["k"])._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_json_log_has_one_object_per_event(spark, event_files, hotel, tmp_path):
    good, _ = E.parse_events(spark.readStream.text(event_files))
    scored = scored_record(good, "event_id", probability(), "_true_label")
    J.available_now(J.append_log(scored, str(tmp_path / "log"), str(tmp_path / "cp")))
    lines = spark.read.text(str(tmp_path / "log"))
    assert lines.count() == hotel.count()
    assert set(json.loads(lines.first().value)) == {"event_id", "probability", "prediction", "risk_band", "true_label"}


def test_late_event_is_left_out(spark, tmp_path):
    schema = T.StructType([T.StructField("ts", T.TimestampNTZType()), T.StructField("prediction", T.IntegerType()), T.StructField("probability", T.DoubleType())])

    def drop(name, *stamps):
        rows = [(s, 1, 0.5) for s in stamps]
        df = spark.createDataFrame(rows, "ts string, prediction int, probability double")
        df.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))

    def run():
        stream = E.read_stream(spark, str(tmp_path / "in"), schema)
        windows = J.window_metrics(J.with_event_time(stream, "ts", "1 hour"), "ts", "1 day")
        J.available_now(J.append_log(windows, str(tmp_path / "out"), str(tmp_path / "cp"), "parquet"))

    drop("a", "2024-01-01 10:00:00", "2024-01-02 12:00:00")
    run()
    drop("b", "2024-01-01 11:00:00", "2024-01-03 12:00:00")
    run()
    rows = {str(r.window_start)[:10]: r.n for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert rows["2024-01-01"] == 1 and rows.get("2024-01-02") == 1


def test_index_percentiles_and_freshness(spark):
    df = spark.range(100).select(F.col("id").cast("double").alias("v"))
    row = J.index_percentiles(df, "v", {"p50": 0.5, "p95": 0.95}).first()
    assert (row.p50, row.p95) == (50.0, 95.0)
    age = spark.range(1).select(J.freshness_ms(F.current_timestamp() - F.expr("INTERVAL 2 SECONDS")).alias("ms"))
    assert age.first().ms >= 2000


def test_reports_come_every_nth_batch(spark):
    seen = []
    hook = J.reporter(lambda df: seen.append(df.count()), every=2)
    for i in range(4):
        hook(spark.range(i + 1), i)
    assert seen == [1, 3]


def test_activity_stream_reads_one_file_of_a_folder(spark, sf_dir):
    stream = E.read_stream(spark, f"{sf_dir}/events*.parquet", ACTIVITY_EVENT)
    assert stream.isStreaming and stream.columns == ACTIVITY_EVENT.names
    assert BOOKING_EVENT["booking"].dataType == EVENT_BOOKING
