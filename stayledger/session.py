"""Session defaults and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession

SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(
    app: str = "stayledger", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with the defaults above; `conf` keys use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SESSION_DEFAULTS | {k.replace("__", "."): str(v) for k, v in conf.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_root(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`.

    Only a local session without that setting gets a temporary folder of its own, which goes when
    the process ends.
    """
    sc = spark.sparkContext
    named = sc.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named:
        if sc.getCheckpointDir() is None:
            sc.setCheckpointDir(named)
        return named.rstrip("/")
    current = sc.getCheckpointDir()
    if current is None:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        own = tempfile.mkdtemp(prefix="stayledger-")
        atexit.register(shutil.rmtree, own, ignore_errors=True)
        sc.setCheckpointDir(own)
        current = sc.getCheckpointDir()
    return current.rstrip("/")


def settle(df: DataFrame) -> DataFrame:
    """Compute `df` once and keep it in the shared folder, so a lost executor costs no recompute."""
    shared_root(df.sparkSession)
    return df.checkpoint(eager=True)


def null_safe_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner"
) -> DataFrame:
    """Join on `keys`, where a missing key is a value like any other; the keys come once."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = [left[f"`{k}`"].eqNullSafe(renamed[f"`_right_{k}`"]) for k in keys]
    return left.join(renamed, reduce(Column.__and__, on), how).drop(*[f"_right_{k}" for k in keys])


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder for a written table or a stream checkpoint."""
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write `df` once as a columnar table in the shared folder and read it back.

    For data that several passes read: each later pass scans only the columns it needs. `options`
    go to the writer.
    """
    path = work_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
