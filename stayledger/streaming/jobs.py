"""Structured Streaming jobs over scored events.

All of them run with any trigger; `available_now` drains what is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..functions.scalar import utc_instant
from ..operators.ordering import range_splits, running_totals, with_range
from ..session import null_safe_join, work_path


def available_now(writer) -> None:
    """Start, drain and stop; a failed stream raises here."""
    started: StreamingQuery = writer.trigger(availableNow=True).start()
    started.awaitTermination()


def append_log(stream: DataFrame, path: str, checkpoint: str, fmt: str = "json"):
    """Exactly-once append of scored records to a file log."""
    return (
        stream.writeStream.outputMode("append")
        .format(fmt)
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )


def running_metrics(scored: DataFrame) -> DataFrame:
    """Processed rows, accuracy over labelled ones and rows per risk band; batch or stream."""
    labelled = F.count("true_label")
    correct = F.count_if(F.col("prediction") == F.col("true_label"))
    return scored.agg(
        F.count(F.lit(1)).alias("processed"),
        F.round(F.try_divide(correct.cast("double"), labelled), 4).alias("running_accuracy"),
        *[
            F.count_if(F.col("risk_band") == band).alias(f"n_{band}")
            for band in ("low", "medium", "high")
        ],
    )


def keep_latest(stream: DataFrame, path: str, checkpoint: str):
    """Complete-mode result of a streaming aggregation, written after every micro-batch.

    Two folders take turns, so the result before stays whole while the next one is written;
    `latest_result` reads the newer one.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        out = batch.withColumn("_batch", F.lit(batch_id).cast("long"))
        out.write.mode("overwrite").parquet(f"{path}/turn={batch_id % 2}")

    return (
        stream.writeStream.outputMode("complete")
        .option("checkpointLocation", checkpoint)
        .foreachBatch(write)
    )


def latest_result(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """What `keep_latest` wrote last."""
    both = T.StructType([*schema, T.StructField("_batch", T.LongType())])
    turns = spark.read.schema(both).parquet(path)
    newest = turns.agg(F.max("_batch")).first()[0]
    return turns.where(F.col("_batch") == F.lit(newest)).select(*[f"`{c}`" for c in schema.names])


def latest_rows(df: DataFrame, n: int, order: Sequence[str], keys: Sequence[str] = ()) -> DataFrame:
    """The last n rows in the given order, per key if any.

    The rank limit is applied map-side before the shuffle, so a hot key sends n rows per task.
    """
    newest = [F.col(c).desc() for c in order]
    if not keys:
        return df.orderBy(*newest).limit(n)
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*newest))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def percentiles_of_counts(
    counts: DataFrame, value: str, picks: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Element number floor(share * n) of the sorted values, from (keys, value, n).

    Counts are summed up inside value ranges with offsets per range, so no task sees all values of a
    key, however hot.
    """
    splits = range_splits(counts, {value: F.col(value)})[value]
    curve = running_totals(with_range(counts, value, splits, "_range"), value, ["n"], keys)
    totals = counts.groupBy(*keys).agg(F.sum("n").alias("_total"))
    on = list(keys) or ["_one"]
    if not keys:
        curve, totals = (x.withColumn("_one", F.lit(1)) for x in (curve, totals))
    met = null_safe_join(curve, totals, on)
    reached = [
        F.min(F.when(F.col("cum_n") > F.floor(F.col("_total") * F.lit(share)), F.col(value))).alias(name)
        for name, share in picks.items()
    ]
    return met.groupBy(*keys).agg(*reached)


def index_percentiles(
    df: DataFrame, column: str, picks: Mapping[str, float], keys: Sequence[str] = ()
) -> DataFrame:
    """Element number floor(share * n) of the sorted values, without interpolation.

    Rows are folded to counts per value first; missing values are left out.
    """
    counted = df.where(F.col(column).isNotNull()).groupBy(*keys, column).agg(F.count(F.lit(1)).alias("n"))
    return percentiles_of_counts(counted, column, picks, keys)


def freshness_ms(event_time: Column) -> Column:
    """Milliseconds from the event's time to now; the engine's own times are in query progress."""
    now = F.unix_millis(F.current_timestamp())
    return now - F.unix_millis(event_time)


def reporter(report: Callable[[DataFrame], None], every: int = 1) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that calls `report` on every n-th micro-batch."""

    def run(batch: DataFrame, batch_id: int) -> None:
        if batch_id % every == 0:
            report(batch)

    return run


# --- event time ------------------------------------------------------------------------------------


def window_metrics(
    scored: DataFrame,
    event_time: str,
    width: str = "1 day",
    slide: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """Rows, positives and mean probability per event-time window; batch or stream."""
    span = F.window(event_time, width, slide) if slide else F.window(event_time, width)
    return (
        scored.groupBy(span.alias("w"), *keys)
        .agg(
            F.count(F.lit(1)).alias("n"),
            F.count_if(F.col("prediction") == 1).alias("n_positive"),
            F.avg("probability").alias("mean_probability"),
        )
        .select(
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            *keys,
            "n",
            "n_positive",
            "mean_probability",
        )
    )


def session_metrics(
    scored: DataFrame, event_time: str, key: str, gap_minutes: int = 30
) -> DataFrame:
    """Rows per activity session of a key; a pause of `gap_minutes` closes the session.

    Rows are first folded per key and minute. Rows of one minute belong to one session, so a hot
    key is left with one row per minute before its minutes are put in order.
    """
    minute = F.floor(F.unix_micros(event_time) / 60_000_000)
    folded = scored.groupBy(key, minute.alias("_minute")).agg(
        F.min(event_time).alias("_from"),
        F.max(event_time).alias("_to"),
        F.count(F.lit(1)).alias("_n"),
        F.sum("probability").alias("_p"),
    )
    order = Window.partitionBy(key).orderBy("_minute")
    pause = F.make_dt_interval(mins=F.lit(gap_minutes))
    goes_on = F.col("_from") < F.lag("_to").over(order) + pause
    opens = F.when(goes_on, 0).otherwise(1)
    marked = folded.withColumn("_opens", opens).withColumn("_session", F.sum("_opens").over(order))
    return marked.groupBy(key, "_session").agg(
        F.min("_from").alias("session_start"),
        (F.max("_to") + pause).alias("session_end"),
        F.sum("_n").alias("n"),
        (F.sum("_p") / F.sum("_n")).alias("mean_probability"),
    ).drop("_session")


def stream_sessions(
    scored: DataFrame, event_time: str, key: str, gap_minutes: int = 30
) -> DataFrame:
    """`session_metrics` of a stream with a watermark: sessions come out when the watermark passes
    their end. Rows older than the watermark are left out and counted as `late_rows` in the
    stream's progress. Sessions are merged inside each task before the shuffle.
    """
    scored.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")
    span = F.session_window(event_time, f"{gap_minutes} minutes")
    return (
        scored.groupBy(key, span.alias("w"))
        .agg(F.count(F.lit(1)).alias("n"), F.avg("probability").alias("mean_probability"))
        .select(
            key,
            F.col("w.start").alias("session_start"),
            F.col("w.end").alias("session_end"),
            "n",
            "mean_probability",
        )
    )


def with_event_time(df: DataFrame, column: str, lateness: str) -> DataFrame:
    """Zone-less event times as instants, with the allowed lateness."""
    return df.withColumn(column, utc_instant(column)).withWatermark(column, lateness)


def run_to_table(stream: DataFrame, name: str, mode: str = "append") -> DataFrame:
    """Drain a stream into a table below the shared folder and read it back."""
    spark = stream.sparkSession
    path, checkpoint = work_path(spark, name), work_path(spark, f"{name}-checkpoint")
    if mode == "append":
        available_now(append_log(stream, path, checkpoint, "parquet"))
        return spark.read.schema(stream.schema).parquet(path)
    available_now(keep_latest(stream, path, checkpoint))
    return latest_result(spark, path, stream.schema)
