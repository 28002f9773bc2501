"""Late events: back-dating for trials, and an audit of what a watermark would keep."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.time import interval


def backdate_every_nth(
    df: DataFrame, n: int = 50, delay: str = "90 seconds", time: str = "event_time", sequence: str = "event_id"
) -> DataFrame:
    """Move the event time of every ``n``-th row back by ``delay``."""
    moved = F.when(F.col(sequence) % n == 0, F.col(time) - interval(delay)).otherwise(F.col(time))
    return df.withColumn(time, moved)


def _whole_part(number: str, width: int) -> Column:
    # Division counts as nullable; the coalesce says it is not. Otherwise each join on the result would add
    # its own null filter to the scan below it, and Spark could no longer see that the scans are the same and
    # share them.
    return F.coalesce(F.expr(f"{number} div {width}"), F.lit(0).cast("long"))


def max_before(df: DataFrame, order: str, value: str, name: str, width: int = 4096, levels: int = 2) -> DataFrame:
    """For each row, the largest ``value`` among rows with a smaller ``order`` (a whole number, unique).

    A window over the whole table would be one task. Here the rows are cut into blocks of ``width`` numbers,
    each block is scanned on its own, and what the earlier blocks contribute is found the same way from one
    row per block. Each level divides the rows by ``width``.
    """
    if levels == 0:
        before = Window.orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
        return df.withColumn(name, F.max(value).over(before))

    block, carried = f"_block{levels}", f"_carried{levels}"
    blocked = df.withColumn(block, _whole_part(order, width))
    per_block = blocked.groupBy(block).agg(F.max(value).alias("_latest"))
    earlier = max_before(per_block, block, "_latest", carried, width, levels - 1).select(block, carried)
    before = Window.partitionBy(block).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return (
        blocked.withColumn("_inside", F.max(value).over(before))
        .join(earlier, block)
        .withColumn(name, F.greatest("_inside", carried))
        .drop(block, carried, "_inside")
    )


def batch_watermarks(events: DataFrame, batch: Column, delay: str, time: str = "event_time") -> DataFrame:
    """The watermark in force while each micro-batch is processed, null before the first one moved it."""
    latest = events.groupBy(batch.alias("batch_id")).agg(F.max(time).alias("latest"))
    before = max_before(latest, "batch_id", "latest", "latest_before")
    return before.select("batch_id", (F.col("latest_before") - interval(delay)).alias("watermark"))


def late_event_audit(
    events: DataFrame,
    batch_rows: int,
    delay: str,
    size: str,
    time: str = "event_time",
    sequence: str = "event_id",
) -> DataFrame:
    """Add ``watermark`` and ``status`` to each event of a batch table.

    Arrival is simulated: micro-batch b holds the events numbered ``b * batch_rows`` onwards. An event is
    ``dropped`` if its window had ended by the watermark, ``late_kept`` if it is behind the watermark but its
    window is still open, ``on_time`` otherwise.
    """
    events = events.filter(F.col(sequence).isNotNull() & F.col(time).isNotNull())
    batch = _whole_part(sequence, batch_rows)
    watermarks = batch_watermarks(events, batch, delay, time)
    status = (
        F.when(F.col("window_end") <= F.col("watermark"), "dropped")
        .when(F.col(time) < F.col("watermark"), "late_kept")
        .otherwise("on_time")
    )
    return (
        events.withColumn("batch_id", batch)
        .withColumn("window_end", F.window(time, size))
        .withColumn("window_end", F.col("window_end.end"))
        .join(watermarks, "batch_id")
        .withColumn("status", status)
    )


def late_event_counts(audit: DataFrame) -> DataFrame:
    return audit.groupBy("status").agg(F.count(F.lit(1)).alias("events"))
