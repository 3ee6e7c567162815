"""Running quality of scored events: mergeable counts by score and by latency, read at each trigger."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.metrics import metrics_of_counts
from ..session import null_safe_join
from .jobs import percentiles_of_counts

PICKS = {"p50": 0.5, "p95": 0.95}


def outcome_counts(
    scored: DataFrame,
    score: str = "probability",
    label: str = "true_label",
    latency: str | None = None,
    keys: Sequence[str] = (),
) -> DataFrame:
    """(keys, what, value, n, pos, neg): rows per score and per latency; table or stream.

    As a stream this is one aggregation whose state has a row per key and distinct value: at most
    10,001 for scores of four digits, and as many as there are milliseconds for whole latencies.
    Counts add up, so any two of them merge by sums.
    """
    known = F.col(label).isNotNull() & F.col(score).isNotNull()
    cells = [
        F.struct(
            F.lit("score").alias("what"),
            F.col(score).cast("double").alias("value"),
            F.when(known, F.col(label)).alias("label"),
        )
    ]
    if latency:
        cells.append(
            F.struct(
                F.lit("latency").alias("what"),
                F.col(latency).cast("double").alias("value"),
                F.lit(None).cast(scored.schema[label].dataType).alias("label"),
            )
        )
    long = scored.select(*keys, F.inline(F.array(*cells)))
    return long.groupBy(*keys, "what", "value").agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(F.col("label") == 1).alias("pos"),
        F.count_if(F.col("label") == 0).alias("neg"),
    )


def quality_of_counts(
    counts: DataFrame, keys: Sequence[str] = (), picks: Mapping[str, float] = PICKS
) -> DataFrame:
    """Per key: processed, n_labeled, pr_auc, roc_auc and the latencies at `picks`.

    Equal to `window_metric` and `index_percentiles` over the rows that were counted. Null scores and
    latencies are counted as processed and left out of the rest.
    """
    scores = counts.where("what = 'score'")
    seen = scores.groupBy(*keys).agg(F.sum("n").alias("processed"))
    labelled = scores.where("pos + neg > 0").select(*keys, "value", "pos", "neg")
    metrics = metrics_of_counts(labelled, "value", keys=keys).select(
        *keys, F.col("n").alias("n_labeled"), "pr_auc", "roc_auc"
    )
    times = percentiles_of_counts(
        counts.where("what = 'latency' AND value IS NOT NULL").select(*keys, "value", "n"), "value", picks, keys
    )
    if not keys:
        seen, metrics, times = (x.withColumn("_one", F.lit(1)) for x in (seen, metrics, times))
    on = list(keys) or ["_one"]
    out = null_safe_join(null_safe_join(seen, metrics, on, "left"), times, on, "left")
    return out.select(
        *keys, "processed", F.coalesce("n_labeled", F.lit(0)).alias("n_labeled"), "pr_auc", "roc_auc", *picks
    )


def window_quality(
    rows: DataFrame, score: str, label: str, latency: str, keys: Sequence[str] = ()
) -> DataFrame:
    """`quality_of_counts` over the rows of recent windows."""
    return quality_of_counts(outcome_counts(rows, score, label, latency, keys), keys)


def report_each_batch(
    path: str, read: Callable[[DataFrame], DataFrame]
) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function that appends `read(batch)` to a run table, one folder a batch; a
    repeated batch rewrites its own."""

    def run(batch: DataFrame, batch_id: int) -> None:
        out = read(batch).withColumn("reported_at", F.current_timestamp())
        out.coalesce(1).write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return run

