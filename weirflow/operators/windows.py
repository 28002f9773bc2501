"""Aggregation over tumbling and sliding time windows."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.measures import Measure, highest
from weirflow.functions.time import duration, event_clock, flat_span, interval


def with_watermark(df: DataFrame, time: str, watermark: str | None) -> DataFrame:
    """Watermark a stream; a batch table has none."""
    if not df.isStreaming or watermark is None:
        return df
    return event_clock(df, time).withWatermark(time, watermark)


def _by_window(
    df: DataFrame, span: Column, size: str, keys: Sequence[str], measures: Sequence[Measure], merge: bool = False
) -> DataFrame:
    aggregates = [m.merge if merge else m.start for m in measures]
    if df.isStreaming:
        # The watermark closes groups by their window struct.
        return flat_span(df.groupBy(span.alias("w"), *keys).agg(*aggregates), "w", "window")
    # The end follows from the start, so only the start is grouped and shuffled.
    grouped = (
        df.withColumn("_window", span)
        .withColumn("_window", F.col("_window.start"))
        .groupBy(F.col("_window").alias("window_start"), *keys)
        .agg(*aggregates)
    )
    return grouped.select(
        "window_start",
        (F.col("window_start") + interval(size)).alias("window_end"),
        *keys,
        *[m.name for m in measures],
    )


def tumbling_agg(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    size: str,
    watermark: str | None = None,
    time: str = "event_time",
) -> DataFrame:
    """One row per half-open window ``[start, end)`` and key; windows align to the epoch.

    The sums are combined before the shuffle, so a hot key costs one row per task and window.
    """
    return _by_window(with_watermark(df, time, watermark), F.window(time, size), size, keys, measures)


def sliding_agg(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    size: str,
    slide: str,
    watermark: str | None = None,
    time: str = "event_time",
    panes: bool = True,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """As :func:`tumbling_agg` with overlapping windows, one every ``slide``.

    An event belongs to ``size / slide`` windows. A batch table is first totalled per pane of length
    ``slide``, so the copies are made of the totals and not of the rows; a slide that does not divide the size
    has no such panes. A stream keeps to one stateful step. ``by`` is that of :func:`sliding_from_panes`.
    """
    if not panes or df.isStreaming or duration(size) % duration(slide):
        span = F.window(time, size, slide)
        return _by_window(with_watermark(df, time, watermark), span, size, keys, measures)

    return sliding_from_panes(tumbling_agg(df, keys, measures, slide, time=time), keys, measures, size, slide, by)


#: Windows that overlap, at most, for their totals to be formed in order of time.
MOST_FRAMES = 64
#: Panes, at least, whose windows are formed together.
BLOCK = 256


def sliding_from_panes(
    panes: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    size: str,
    slide: str,
    by: Sequence[str] | None = None,
) -> DataFrame:
    """Sliding windows from a batch table of totals per window of length ``slide``, as :func:`tumbling_agg`
    gives them. ``slide`` has to divide ``size``.

    The panes are shuffled and put in order per key and block of time, and not once for every window they lie in. A window is
    formed at the first of its panes, by running sums over those that follow, so no task holds the windows: they go on row by row. The
    shuffle keeps to ``spark.sql.shuffle.partitions``, as what comes after it is ``size / slide`` times as much as what adaptive
    execution would measure. ``by`` names some of the keys to shuffle by, if a join by them comes next. Where more than
    ``MOST_FRAMES`` windows overlap, their copies of the panes are grouped.
    """
    if duration(size) % duration(slide):
        raise ValueError(f"{slide} does not divide {size}")
    overlap, step = duration(size) // duration(slide), duration(slide) // timedelta(microseconds=1)
    if overlap > MOST_FRAMES:
        return _by_window(panes, F.window("window_start", size, slide), size, keys, measures, merge=True)

    length = max(BLOCK, 16 * overlap) * step

    def block(back: int) -> Column:
        """The block in which a window starts that is ``back`` slides older than the pane."""
        return F.floor((F.col("_at") - back * step) / F.lit(length).cast("decimal(20,0)"))

    spark = panes.sparkSession
    placed = panes.where("window_start IS NOT NULL").withColumn("_at", F.unix_micros(F.col("window_start").cast("timestamp")))
    # The windows of a pane start in one block or two.
    placed = placed.withColumn("_block", F.explode(F.array_distinct(F.array(block(0), block(overlap - 1)))))
    placed = placed.repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *(by or [*keys, "_block"]))
    in_order = Window.partitionBy(*keys, "_block").orderBy("_at")
    before = F.lag("_at").over(in_order)
    formed = []
    for back in range(overlap):
        frame = in_order.rangeBetween(Window.currentRow, (overlap - 1 - back) * step)
        totals = [m.over_partials(F.col(m.name)).over(frame).alias(m.name) for m in measures]
        first = before.isNull() | (before < F.col("_at") - back * step)
        start = (F.col("window_start") - F.lit(back * duration(slide))).alias("window_start")
        formed.append(F.when(first & (block(back) == F.col("_block")), F.struct(start, *totals)))
    windows = placed.select(*keys, F.array(*formed).alias("_w")).select(*keys, F.explode(F.array_compact("_w")).alias("_w"))
    return windows.select(
        "_w.window_start",
        (F.col("_w.window_start") + interval(size)).alias("window_end"),
        *keys,
        *[f"_w.{m.name}" for m in measures],
    )


def open_panes(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    size: str,
    slide: str,
    watermark: str,
    time: str = "event_time",
) -> DataFrame:
    """Totals per window of length ``slide`` of a stream, from which the sliding windows of a ``watermark`` can be formed.

    The state holds each event once. A pane stays open for as long as any window that holds it, so its watermark is longer
    by ``size - slide``. ``newest`` is the time of a pane's latest event, by which a window that the watermark has passed is told.
    """
    longer = (duration(watermark) + duration(size) - duration(slide)) // timedelta(microseconds=1)
    return tumbling_agg(df, keys, [*measures, highest(time, "newest")], slide, f"{longer} microseconds", time)
