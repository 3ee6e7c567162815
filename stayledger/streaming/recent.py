"""The last n rows per key of a stream, kept in keyed list state."""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
STATE = "newest"
SLACK_ROWS = 50_000  # rows a task gathers beyond its newest before it drops the older ones
ALL = "_all"  # the only key of a window over the whole stream


def use_keyed_state(spark: SparkSession) -> None:
    """List state lives in RocksDB; a query that is restarted keeps the provider it began with."""
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)


def newest_of(rows: pa.Table, n: int, order: Sequence[str], keys: Sequence[str]) -> pa.Table:
    """The last n rows of each key in a table, missing order values first."""
    descending = [(c, "descending") for c in order]
    rows = rows.take(pc.sort_indices(rows, sort_keys=descending, null_placement="at_end"))
    group = np.zeros(rows.num_rows, np.int64)
    for key in keys:
        codes = rows.column(key).combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(codes, pa.ChunkedArray):
            codes = codes.combine_chunks()
        own = codes.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        group = np.unique(group * (own.max(initial=0) + 1) + own, return_inverse=True)[1]
    by_group = np.argsort(group, kind="stable")
    sizes = np.bincount(group, minlength=1)
    first = np.repeat(np.cumsum(sizes) - sizes, sizes)
    kept = by_group[np.arange(len(group)) - first < n]
    return rows.take(pa.array(np.sort(kept)))


def newest_of_task(
    schema: T.StructType, n: int, order: Sequence[str], keys: Sequence[str]
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Keeps the last n rows per key of each task, so that a hot key sends n rows a task to its state."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, least = None, 0
        for batch in batches:
            more = pa.Table.from_batches([batch])
            held = more if held is None else pa.concat_tables([held, more])
            if held.num_rows > 2 * least + SLACK_ROWS:
                held = newest_of(held, n, order, keys)
                least = held.num_rows
        if held is not None and held.num_rows:
            yield from newest_of(held, n, order, keys).to_batches()

    return run


class NewestRows(StatefulProcessor):
    """List state of at most n rows per key; every trigger replaces it by the n newest rows."""

    def __init__(self, schema: T.StructType, n: int, order: Sequence[str], ttl_ms: int | None):
        self.schema, self.n, self.ttl_ms = schema, n, ttl_ms
        self.at = [schema.names.index(c) for c in order]

    def init(self, handle) -> None:
        self.rows = handle.getListState(STATE, self.schema, self.ttl_ms)

    def _rank(self, row: tuple) -> tuple:
        return tuple((row[i] is not None, row[i]) if row[i] is not None else (False, 0) for i in self.at)

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:  # noqa: N802, N803
        held = self.rows.get() if self.rows.exists() else iter(())
        best = heapq.nlargest(self.n, (tuple(r) for r in chain(held, rows)), key=self._rank)
        self.rows.put(best)
        make = Row(*self.schema.names)
        for row in best:
            yield make(*row)

    def close(self) -> None:
        pass


class RecentWindow:
    """The last n rows per key, in the order of `order`, whose values should not repeat in a key.

    State is one list of n rows per key in RocksDB, so it doesn't grow with the stream; with
    `ttl_ms` rows also go that long after they were last written; such a stream keeps looking for rows
    to drop, so it takes a timed trigger and doesn't end by itself. Exactly-once restarts come from
    the stream's own checkpoint. A null key is a key of its own; a missing order value is older than any
    other. Without keys there is one window over the whole stream.
    """

    def __init__(self, n: int, order: Sequence[str], keys: Sequence[str] = (), ttl_ms: int | None = None):
        self.n, self.order, self.keys, self.ttl_ms = n, list(order), list(keys), ttl_ms

    def rows(self, stream: DataFrame) -> DataFrame:
        """Streaming rows of the windows that a trigger changed, whole windows each time."""
        use_keyed_state(stream.sparkSession)
        keyed = stream if self.keys else stream.withColumn(ALL, F.lit(0))
        keys = self.keys or [ALL]
        slim = keyed.mapInArrow(newest_of_task(keyed.schema, self.n, self.order, keys), keyed.schema)
        processor = NewestRows(keyed.schema, self.n, self.order, self.ttl_ms)
        time = "ProcessingTime" if self.ttl_ms else "None"
        kept = slim.groupBy(*keys).transformWithState(processor, keyed.schema, "Update", time)
        return kept.select(*[f"`{c}`" for c in stream.columns])

    def writer(
        self, stream: DataFrame, checkpoint: str, report: Callable[[DataFrame, int], None] | None = None
    ):
        """A stream writer that keeps the state, and gives changed windows to `report` if there is one."""
        out = self.rows(stream).writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return out.foreachBatch(report) if report else out.format("noop")

    @staticmethod
    def table(spark: SparkSession, checkpoint: str) -> DataFrame:
        """What the state holds, read from the checkpoint of a stopped or running stream."""
        state = spark.read.format("statestore").option("path", checkpoint).option("stateVarName", STATE)
        held = state.load()
        timed = "ttlExpirationMs" in held.schema["list_element"].dataType.names
        return held.select("list_element.value.*" if timed else "list_element.*").drop(ALL)
