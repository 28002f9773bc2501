"""Starting, stopping and watching streaming queries."""

from __future__ import annotations

import json
import threading
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.streaming.listener import StreamingQueryListener

from weirflow.session import drop_shuffles, passing, settings_of

MODES = ("append", "update", "complete")
SINKS = ("console", "memory", "parquet", "kafka", "batch")
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"

BatchWriter = Callable[[DataFrame, int], None]


def check_sink(
    mode: str,
    sink: str,
    checkpoint: str | None,
    name: str | None,
    path: str | None,
    on_batch: BatchWriter | None,
) -> None:
    """Refuse what Spark cannot run, before any work starts."""
    if mode not in MODES:
        raise ValueError(f"output mode {mode!r} is not one of {MODES}")
    if sink not in SINKS:
        raise ValueError(f"sink {sink!r} is not one of {SINKS}")
    if sink in ("parquet", "kafka", "batch") and checkpoint is None:
        raise ValueError(f"the {sink} sink needs a checkpoint folder of its own to resume from")
    if sink == "parquet":
        if mode != "append":
            raise ValueError("the parquet sink takes append mode only; use the batch sink for whole results")
        if path is None:
            raise ValueError("the parquet sink needs a path")
    if sink == "memory":
        if mode == "update":
            raise ValueError("the memory sink takes append or complete mode")
        if name is None:
            raise ValueError("the memory sink needs a name to be queried by")
    if sink == "batch" and on_batch is None:
        raise ValueError("the batch sink needs a function to hand each batch to")


def run_stream(
    df: DataFrame,
    mode: str,
    sink: str,
    checkpoint: str | None = None,
    name: str | None = None,
    path: str | None = None,
    on_batch: BatchWriter | None = None,
    trigger: str = "5 seconds",
    available_now: bool = False,
    options: dict[str, str] | None = None,
    state_partitions: int | None = None,
    rocksdb: bool = False,
    count_state: bool = True,
) -> StreamingQuery:
    """Start a streaming query; with ``available_now`` take in what is there, finish and return.

    A query resumes from its ``checkpoint``. ``state_partitions`` fixes the number of state partitions for the
    life of the checkpoint; ``rocksdb`` keeps large state on disk instead of in the executors' heap.
    Without ``count_state`` it does not look up each key a second time to keep the metric ``state_rows``, which then means
    nothing; :func:`state_sizes` counts the rows from the checkpoint all the same.

    With ``rocksdb`` the changes in a new checkpoint are compressed by zstd. When ``on_batch`` has returned, the shuffle files of its batch are dropped, as are those
    of each write it made; with other sinks they stay until the driver happens to collect its garbage.
    """
    check_sink(mode, sink, checkpoint, name, path, on_batch)
    writer = df.writeStream.outputMode(mode).options(**(options or {}))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=trigger)
    if name is not None:
        writer = writer.queryName(name)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if path is not None:
        writer = writer.option("path", path)

    def whole_batch(batch: DataFrame, epoch: int) -> None:
        with passing(batch.sparkSession):
            on_batch(batch, epoch)
        drop_shuffles(batch)

    writer = writer.foreachBatch(whole_batch) if sink == "batch" else writer.format(sink)

    # Merge the sessions of a task before the shuffle, so a hot key sends on its sessions and not its rows.
    settings = {"spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition": "true"}
    if state_partitions is not None:
        settings["spark.sql.shuffle.partitions"] = str(state_partitions)
    if rocksdb:
        settings["spark.sql.streaming.stateStore.providerClass"] = ROCKSDB
        # Upload only what changed since the last commit.
        settings["spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled"] = "true"
        settings["spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"] = str(count_state).lower()
        settings["spark.sql.streaming.stateStore.compression.codec"] = "zstd"
        # Else the log of each partition's files takes 4 MB, however little it says.
        settings["spark.sql.streaming.stateStore.rocksdb.allowFAllocate"] = "false"
    with settings_of(df.sparkSession, settings):
        query = writer.start()
    if available_now:
        query.awaitTermination()
    return query


def stop_all(spark: SparkSession) -> int:
    """Stop every active query of the session and say how many there were."""
    active = spark.streams.active
    for query in active:
        query.stop()
    return len(active)


_METRICS = (
    "batch_id bigint, input_rows bigint, watermark string, operator string, state_rows bigint, "
    "state_bytes bigint, rows_dropped bigint"
)


def metric_rows(report: str) -> list[tuple]:
    """A progress report as rows of metrics, one per stateful operator, or one without."""
    progress = json.loads(report)
    watermark = progress.get("eventTime", {}).get("watermark")
    return [
        (
            progress["batchId"],
            progress["numInputRows"],
            watermark,
            operator.get("operatorName"),
            operator.get("numRowsTotal"),
            operator.get("memoryUsedBytes"),
            operator.get("numRowsDroppedByWatermark"),
        )
        for operator in progress.get("stateOperators") or [{}]
    ]


def progress_writer(spark: SparkSession, path: str, every: int = 100) -> StreamingQueryListener:
    """A listener that adds the metrics of every batch of the session's queries to a table, so that none is lost.

    Reports are held until there are ``every`` of them, or a query ends, and then written by one small job, so a batch costs no job of
    its own; ``flush`` writes what is held. Register it with ``spark.streams.addListener`` and take it out again with ``removeListener``.
    """

    class Writer(StreamingQueryListener):
        def __init__(self):
            self.held: list[tuple] = []
            self.lock = threading.Lock()

        def onQueryStarted(self, event):
            pass

        def onQueryProgress(self, event):
            rows = [(str(event.progress.id), *row) for row in metric_rows(event.progress.json)]
            with self.lock:
                self.held += rows
                full = len(self.held) >= every
            if full:
                self.flush()

        def onQueryIdle(self, event):
            pass

        def onQueryTerminated(self, event):
            self.flush()

        def flush(self):
            with self.lock:
                rows, self.held = self.held, []
            if rows:
                spark.createDataFrame(rows, f"query_id string, {_METRICS}").coalesce(1).write.mode("append").parquet(path)

    return Writer()


def state_stores(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The stateful operators of a query, from its checkpoint: operator_id, operator, store, partitions and the batches that can be read."""
    found = spark.read.format("state-metadata").load(checkpoint)
    return found.select(
        F.col("operatorId").alias("operator_id"),
        F.col("operatorName").alias("operator"),
        F.col("stateStoreName").alias("store"),
        F.col("numPartitions").alias("partitions"),
        F.col("minBatchId").alias("first_batch"),
        F.col("maxBatchId").alias("last_batch"),
    )


def read_state(spark: SparkSession, checkpoint: str, operator_id: int = 0, store: str = "default", batch: int | None = None) -> DataFrame:
    """What a stateful operator holds, one row per key: ``key``, ``value`` and ``partition_id``, after the last batch or an earlier one."""
    reader = spark.read.format("statestore").option("operatorId", operator_id).option("storeName", store)
    return (reader if batch is None else reader.option("batchId", batch)).load(checkpoint)


def state_sizes(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Rows that each store of a query holds, in all and in its fullest partition: whether state grows, and whether a key fills one task."""
    parts = []
    for store in state_stores(spark, checkpoint).collect():
        held = read_state(spark, checkpoint, store.operator_id, store.store).groupBy("partition_id").agg(F.count("*").alias("n"))
        held = held.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("state_rows"), F.coalesce(F.max("n"), F.lit(0)).alias("fullest"))
        named = [F.lit(store[c]).alias(c) for c in ("operator_id", "operator", "store", "partitions")]
        parts.append(held.select(*named, "state_rows", "fullest"))
    if not parts:
        fields = "operator_id long, operator string, store string, partitions int, state_rows long, fullest long"
        return spark.createDataFrame([], fields)
    return reduce(DataFrame.unionByName, parts)


def recent_metrics(query: StreamingQuery) -> DataFrame:
    """One row per recent batch and stateful operator: rows read, state held, late rows dropped.

    Spark keeps a bounded number of progress reports (``spark.sql.streaming.numRecentProgressUpdates``), so on a long run this is
    the recent past only; ``progress_writer`` keeps all of them.
    """
    rows = [row for report in query.recentProgress for row in metric_rows(report.json)]
    return SparkSession.active().createDataFrame(rows, _METRICS)
