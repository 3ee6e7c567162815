"""Stage files, fitted-state files and the raw scan."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.scalar import nan_to_null
from ..schema import RAW_BOOKING


def read_raw(
    spark: SparkSession, path: str, fmt: str = "csv", schema: T.StructType = RAW_BOOKING
) -> DataFrame:
    """Raw scan with a declared schema; NaN in a double column becomes null once, here."""
    reader = spark.read.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True).option("enforceSchema", False)
    df = reader.format(fmt).load(path)
    return df.select(
        *[
            nan_to_null(f.name).alias(f.name) if isinstance(f.dataType, T.DoubleType) else f.name
            for f in schema
        ]
    )


def scan_profile(df: DataFrame, name: str) -> DataFrame:
    """Row and column count of a scan as a one-row table."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).select(
        F.lit(name).alias("table_name"), "n_rows", F.lit(len(df.columns)).alias("n_cols")
    )


def write_stage(df: DataFrame, path: str, fmt: str = "parquet", partition_by: tuple = ()) -> None:
    writer = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(path)


def read_stage(spark: SparkSession, path: str, fmt: str = "parquet", schema=None) -> DataFrame:
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def write_report(df: DataFrame, path: str) -> None:
    """Small fitted state or report as JSON lines."""
    df.write.mode("overwrite").json(path)
