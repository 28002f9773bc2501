"""Batch writers for the ``batch`` sink, and readers of what they keep.

Each writer takes in the whole batch with one write, which a stateful query requires, and writing the same
batch again replaces it, so a batch that is retried after a failure leaves no duplicates.

A store that puts its folders in order names the current ones in a small pointer, which is written after them; what a pointer named
stays for some batches more, so whoever has begun to read is not disturbed.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.measures import Measure
from weirflow.functions.time import duration
from weirflow.operators.rank import top_n
from weirflow.operators.windows import sliding_from_panes
from weirflow.session import drop_shuffles, files_of, passing, remove
from weirflow.streaming.runner import BatchWriter

#: Snapshots that stay beside the current one.
KEPT = 3

Shape = Callable[[DataFrame], DataFrame]


def fan_out(*writers: BatchWriter) -> BatchWriter:
    """One writer that hands each batch to several stores. The batch is computed once and its source read once.

    If a store fails, the batch fails, and all stores are given it again: each replaces what it wrote the first time.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()
        try:
            for each in writers:
                each(held, epoch)
        finally:
            held.unpersist()

    return write


def _write(df: DataFrame, path: str) -> None:
    """Replace a table of this module. Its shuffle files go as soon as it has been written."""
    with passing(df.sparkSession):
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)


def snapshot_writer(
    path: str,
    shape: Shape | None = None,
    view: str | None = None,
    report: Callable[[int, int], None] | None = None,
) -> BatchWriter:
    """Keep the result of a complete-mode query as a table that always holds the latest state.

    ``shape`` is applied to each batch, which is an ordinary table: it may rank or sort. Each snapshot has a folder of
    its own, and a small file written after it names it as the current one. Of the older ones the last ``KEPT`` stay, so
    whoever has begun to read one is not disturbed by that many batches. ``view`` publishes the current one as
    ``global_temp.<view>``; ``report`` is given the batch number and its number of rows.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        spark, result, taken = batch.sparkSession, batch, f"{path}/taken-{epoch:012d}"
        if shape:
            # The batch is computed once, and then read from the store: its shuffle files are not held while it is shaped.
            _write(batch, taken)
            drop_shuffles(batch)
            result = shape(spark.read.schema(batch.schema).parquet(taken))
        target = f"{path}/snapshot-{epoch:012d}"
        counted = Observation()
        _write(result.observe(counted, F.count(F.lit(1)).alias("rows")), target)
        if shape:
            remove(spark, taken)
        _point(spark, f"{path}/current", epoch)
        for old in range(max(0, epoch - KEPT - 8), epoch - KEPT):
            for name in ("current", "snapshot"):
                remove(spark, f"{path}/{name}-{old:012d}")
        if view is not None:
            spark.read.schema(result.schema).parquet(target).createOrReplaceGlobalTempView(view)
        if report is not None:
            report(epoch, counted.get["rows"])

    return write


def read_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """The latest snapshot below ``path``, also if it is empty."""
    latest = spark.read.parquet(f"{path}/current-*").agg(F.max("epoch_id")).first()[0]
    return spark.read.parquet(f"{path}/snapshot-{latest:012d}")


def _point(spark: SparkSession, pointer: str, epoch: int) -> None:
    spark.createDataFrame([(epoch,)], "epoch_id long").coalesce(1).write.mode("overwrite").parquet(f"{pointer}-{epoch:012d}")


def _names(spark: SparkSession, path: str) -> list[str]:
    """The folders and files right below a path; none if there is no such path."""
    files, where = files_of(spark, path)
    return sorted(s.getPath().getName() for s in files.listStatus(where)) if files.exists(where) else []


def _complete(spark: SparkSession, path: str, pointer: str) -> list[int]:
    """Batches that finished pointers name, ascending."""
    names = [n for n in _names(spark, path) if n.startswith(f"{pointer}-")]
    return [int(n.rpartition("-")[2]) for n in names if "_SUCCESS" in _names(spark, f"{path}/{n}")]


def changes_writer(path: str, shape: Shape | None = None, keys: Sequence[str] | None = None, every: int = 20) -> BatchWriter:
    """Keep every batch of an update- or append-mode query, one folder per batch.

    With ``keys`` the store is put in order after each ``every`` batches: the last row of each key goes into a base, and folders
    that an older base had taken in already are removed. So there are never more than about twice as many folders as that,
    however long the stream runs. Both kinds are read by :func:`read_latest_changes`.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        result = shape(batch) if shape else batch
        _write(result, f"{path}/epoch_id={epoch}")
        if keys is not None and epoch % every == every - 1:
            _put_in_order(batch.sparkSession, path, keys, epoch)

    return write


def _put_in_order(spark: SparkSession, path: str, keys: Sequence[str], epoch: int) -> None:
    bases = _complete(spark, path, "_current")
    if bases and bases[-1] >= epoch:
        return  # a batch that is written again after its base was made
    _write(_latest(_changes(spark, path, bases[-1] if bases else None, epoch), keys), f"{path}/_base-{epoch:012d}")
    _point(spark, f"{path}/_current", epoch)
    # Readers of the base before this one may still ask for what came after it.
    for old in bases[:-1]:
        for name in ("_current", "_base"):
            remove(spark, f"{path}/{name}-{old:012d}")
    if bases:
        for name in _names(spark, path):
            if name.startswith("epoch_id=") and int(name.partition("=")[2]) <= bases[-1]:
                remove(spark, f"{path}/{name}")


def _changes(spark: SparkSession, path: str, base: int | None, until: int | None = None) -> DataFrame:
    """The rows of a base, and of all batches after it, with ``epoch_id``."""
    changes = spark.read.parquet(path)
    changes = changes.withColumn("epoch_id", F.col("epoch_id").cast("long"))
    if until is not None:
        changes = changes.where(F.col("epoch_id") <= until)
    if base is None:
        return changes
    return spark.read.parquet(f"{path}/_base-{base:012d}").unionByName(changes.where(F.col("epoch_id") > base))


def _latest(changes: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The last row of each key, with its ``epoch_id``."""
    values = [c for c in changes.columns if c not in (*keys, "epoch_id")]
    last = F.max_by(F.struct(*values), "epoch_id").alias("last")
    return changes.groupBy(*keys).agg(last, F.max("epoch_id").alias("epoch_id")).select(*keys, "last.*", "epoch_id")


def read_latest_changes(spark: SparkSession, path: str, keys: Sequence[str]) -> DataFrame:
    """The last written row of each key."""
    bases = _complete(spark, path, "_current")
    return _latest(_changes(spark, path, bases[-1] if bases else None), keys).drop("epoch_id")


def _micros(time: str) -> Column:
    return F.unix_micros(F.col(time).cast("timestamp"))


def leaderboard_writer(
    path: str,
    keys: Sequence[str],
    order: Sequence[Column],
    n: int,
    delay: str,
    within: Sequence[str] = (),
    sliding: tuple[str, str, Sequence[Measure]] | None = None,
) -> BatchWriter:
    """Keep the ``n`` best rows of every window, by ``within``, of an update-mode query over windows.

    The batch brings the new totals of some ``keys`` in some windows (``window_start``, ``window_end``). Only those windows are ranked anew; the
    ranks of the other open ones are carried over. A window is closed once no event may come for it: its end is ``delay``, the query's watermark,
    before the start of a window seen in an earlier batch. Its ranks are then written for good and its totals dropped. So
    what a batch reads and writes is bounded by the windows that are open, not by how long the stream has run.

    With ``sliding``, which is size, slide and measures, the batch brings the totals of :func:`weirflow.operators.windows.open_panes`, and ``delay``
    is the watermark that was given there. The sliding windows are formed here, so neither the state nor the store holds an event
    more than once. They are closed by the latest event of the earlier batches: just when the watermark would end their state.
    """
    span = ("window_start", "window_end")
    late = int(duration(delay).total_seconds() * 1_000_000)
    # A pane is held until its last window is closed.
    held_on = timedelta(0) if sliding is None else duration(sliding[0]) - duration(sliding[1])

    def windows(panes: DataFrame) -> DataFrame:
        return panes if sliding is None else sliding_from_panes(panes, [*within, *keys], sliding[2], *sliding[:2])

    def write(batch: DataFrame, epoch: int) -> None:
        spark = batch.sparkSession
        before = [e for e in _complete(spark, path, "current") if e < epoch]
        last = before[-1] if before else None
        # The batch is computed once, and then read from the store: its shuffle files are not held while it is ranked.
        changes, ranked = f"{path}/changes-{epoch:012d}", f"{path}/ranked-{epoch:012d}"
        _write(batch, changes)
        drop_shuffles(batch)
        held = spark.read.schema(batch.schema).parquet(changes)
        if sliding is None:
            totals, touched, seen = held, held.select(*span).distinct(), _micros("window_start")
        else:
            totals, seen = held.drop("newest"), F.unix_millis(F.col("newest").cast("timestamp")) * 1000
            touched = held.select("window_start").distinct().select(F.window("window_start", *sliding[:2]).alias("w"))
            touched = touched.select(F.col("w.start").alias(span[0]), F.col("w.end").alias(span[1])).distinct()
        recent, ranks, horizon = totals, None, None
        newest = held.agg(F.max(seen).alias("newest"))
        if last is not None:
            mark = spark.read.parquet(f"{path}/mark-{last:012d}")
            known = mark.first().asDict()
            horizon, closed_until = known["newest"], known.get("closed_until")
            newest = newest.unionByName(mark.select("newest")).agg(F.max("newest").alias("newest"))
            if sliding is not None and closed_until is not None:
                # An event of an open window may lie in a pane of closed ones too, for which it is late.
                touched = touched.where(_micros("window_end") > closed_until)
            # Windows that are open are few: as many as the delay is long.
            old = spark.read.parquet(f"{path}/totals-{last:012d}").withColumn("epoch_id", F.lit(last))
            both = old.unionByName(totals.withColumn("epoch_id", F.lit(epoch)))
            totals = _latest(both, [*span, *within, *keys]).drop("epoch_id")
            # Nothing older than the first window to be ranked is part of one.
            first = touched.agg(F.min(_micros(span[0]))).first()[0]
            recent = totals.where(F.lit(False) if first is None else _micros(span[0]) >= first)
            ranks = spark.read.parquet(f"{path}/ranks-{last:012d}").join(F.broadcast(touched), list(span), "left_anti")
        fresh = top_n(windows(recent).join(F.broadcast(touched), list(span), "left_semi"), [*span, *within], order, n)
        ranks = fresh if ranks is None else ranks.unionByName(fresh)
        until = None if horizon is None else horizon - late

        def closed(end: Column) -> Column:
            return F.lit(False) if until is None else F.unix_micros(end.cast("timestamp")) <= until

        _write(ranks, ranked)
        ranks = spark.read.schema(ranks.schema).parquet(ranked)
        _write(ranks.where(closed(F.col("window_end"))), f"{path}/final/epoch_id={epoch}")
        _write(ranks.where(~closed(F.col("window_end"))), f"{path}/ranks-{epoch:012d}")
        _write(totals.where(~closed(F.col("window_end") + F.lit(held_on))), f"{path}/totals-{epoch:012d}")
        newest = newest.select("newest", F.lit(until).cast("long").alias("closed_until"))
        newest.coalesce(1).write.mode("overwrite").parquet(f"{path}/mark-{epoch:012d}")
        for passed in (changes, ranked):
            remove(spark, passed)
        _point(spark, f"{path}/current", epoch)
        for old in before[:-KEPT]:
            for name in ("current", "mark", "totals", "ranks"):
                remove(spark, f"{path}/{name}-{old:012d}")

    return write


def read_leaderboard(spark: SparkSession, path: str) -> DataFrame:
    """All ranks that :func:`leaderboard_writer` keeps: those of closed windows, and of open ones as they stand."""
    last = _complete(spark, path, "current")[-1]
    final = spark.read.parquet(f"{path}/final").where(F.col("epoch_id") <= last).drop("epoch_id")
    return final.unionByName(spark.read.parquet(f"{path}/ranks-{last:012d}"))


def jdbc_writer(url: str, table: str, properties: dict[str, str]) -> BatchWriter:
    """Append each batch to a database table.

    The rows carry their batch number, by which a reader can leave out a batch that was written twice.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        batch.withColumn("epoch_id", F.lit(epoch).cast("long")).write.jdbc(url, table, "append", properties)

    return write
