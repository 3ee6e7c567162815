"""Booking events: shape, parsing and sources."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.quality import Rule, valid_and_quarantined
from ..schema import BOOKING_EVENT, EVENT_BOOKING, Roles


def to_event(df: DataFrame, id_col: str, roles: Roles = Roles()) -> DataFrame:
    """Booking row as {event_id, booking, _true_label}; the label is null without a target column."""
    fields = [f.name for f in EVENT_BOOKING if f.name in df.columns]
    label = F.col(roles.target) if roles.target in df.columns else F.lit(None)
    return df.select(
        F.col(id_col).alias("event_id"),
        F.struct(*fields).alias("booking"),
        label.cast("int").alias("_true_label"),
    )


def to_json_lines(events: DataFrame) -> DataFrame:
    return events.select(F.to_json(F.struct(*events.columns)).alias("value"))


def parse_events(
    lines: DataFrame, schema: T.StructType = BOOKING_EVENT, column: str = "value"
) -> tuple[DataFrame, DataFrame]:
    """Split JSON lines into parsed events and lines that do not parse or carry no event id."""
    with_corrupt = T.StructType([*schema.fields, T.StructField("_corrupt", T.StringType(), True)])
    parsed = lines.withColumn(
        "_e",
        F.from_json(
            column, with_corrupt, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt"}
        ),
    )
    broken = F.col("_e").isNull() | F.col("_e._corrupt").isNotNull() | F.col("_e.event_id").isNull()
    good = parsed.where(~broken).select("_e.*").drop("_corrupt")
    return good, parsed.where(broken).select(F.col(column).alias("line"))


def read_stream(
    spark: SparkSession,
    path: str | None = None,
    schema: T.StructType | None = None,
    fmt: str = "parquet",
    files_per_trigger: int | None = None,
    options: Mapping[str, object] | None = None,
) -> DataFrame:
    """Any source: files of a folder or glob with a declared schema, or a source that has a schema
    of its own (a broker, a rate), which takes options and neither path nor schema."""
    reader = spark.readStream.format(fmt)
    if schema is not None:
        reader = reader.schema(schema)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    for name, value in (options or {}).items():
        reader = reader.option(name, value)
    return reader.load(path) if path else reader.load()


def accepted_events(
    raw: DataFrame,
    payload: Column | str = "value",
    schema: T.StructType = BOOKING_EVENT,
    rules: Sequence[Rule] = (),
) -> tuple[DataFrame, DataFrame]:
    """Events of any source and its dead letters (line, reasons); table or stream.

    `payload` is the column or expression that holds an event as JSON, as text or bytes. A line that
    doesn't parse or has no id is a dead letter with the reason `unreadable`; an event that breaks
    `rules` is one with the rules' reasons.
    """
    body = F.col(payload) if isinstance(payload, str) else payload
    lines = raw.select(body.cast("string").alias("value"))
    good, unread = parse_events(lines, schema)
    kept, refused = valid_and_quarantined(good, rules)
    dead = unread.select("line", F.array(F.lit("unreadable")).alias("reasons"))
    text = F.to_json(F.struct(*[f"`{c}`" for c in good.columns]))
    return kept, dead.unionByName(refused.select(text.alias("line"), "reasons"))
