"""Session windows: runs of events of one key in which neighbours are at most ``gap`` apart.

A stream uses Spark's ``session_window``. A batch table takes a route that no hot key can hold up. Two events
of a key within the same epoch-aligned slot of length ``gap`` are less than ``gap`` apart, so a slot never
straddles a session border. The rows are therefore first totalled per key and slot, which Spark combines
before the shuffle, and only the slots are put in order per key. A key has at most (time span / gap) slots
however many rows it holds.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.functions.measures import Measure
from weirflow.functions.time import epoch_seconds, flat_span, interval
from weirflow.operators.windows import with_watermark


def _with_slot(df: DataFrame, gap: str, time: str) -> DataFrame:
    # window() leaves out rows without a time, as a session does.
    return df.withColumn("_slot", F.window(time, gap)).withColumn("_slot", F.col("_slot.start"))


def session_slots(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    gap: str,
    time: str = "event_time",
) -> DataFrame:
    """Totals per key and slot, with the first and last event time of the slot."""
    return (
        _with_slot(df, gap, time)
        .groupBy(*keys, "_slot")
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"), *[m.start for m in measures])
    )


def number_sessions(slots: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """Give the slots of each key a running session number. Without keys all slots would be ordered in one task."""
    if not keys:
        raise ValueError("sessions need a key")
    in_order = Window.partitionBy(*keys).orderBy("_slot")
    last_before = F.lag("_last").over(in_order)
    opens = last_before.isNull() | (F.col("_first") > last_before + interval(gap))
    return slots.withColumn("_opens", opens.cast("long")).withColumn(
        "_session", F.sum("_opens").over(in_order.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    )


def session_agg(
    df: DataFrame,
    keys: Sequence[str],
    measures: Sequence[Measure],
    gap: str,
    watermark: str | None = None,
    time: str = "event_time",
) -> DataFrame:
    """One row per session and key. A session ends ``gap`` after its last event; a gap of exactly that
    length does not split it."""
    if df.isStreaming:
        grouped = (
            with_watermark(df, time, watermark)
            .groupBy(F.session_window(time, gap).alias("s"), *keys)
            .agg(*[m.start for m in measures])
        )
        return flat_span(grouped, "s", "session")

    return merge_slots(session_slots(df, keys, measures, gap, time), keys, measures, gap)


def durations_by_window(
    df: DataFrame,
    keys: Sequence[str],
    by: Sequence[str],
    gap: str,
    size: str,
    watermark: str,
    time: str = "event_time",
) -> DataFrame:
    """Number and mean length in seconds of the sessions that end in each window of ``size``, by some of their ``keys``.

    A table or a stream. A stream has two stateful steps in one append-mode query: sessions first, and what the watermark has closed of them is
    grouped by windows of its own event time. A session belongs to the window of its last microsecond.
    """
    if df.isStreaming:
        opened = with_watermark(df, time, watermark).groupBy(F.session_window(time, gap).alias("s"), *keys).agg(F.count("*").alias("n"))
        ended = opened.select(F.window_time("s").alias("_ended"), F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"), *by)
    else:
        ended = session_agg(df, keys, (), gap, time=time)
        ended = ended.select((F.col("session_end") - F.expr("INTERVAL 1 MICROSECOND")).alias("_ended"), "session_start", "session_end", *by)
    seconds = epoch_seconds(F.col("session_end")) - epoch_seconds(F.col("session_start"))
    grouped = ended.groupBy(F.window("_ended", size).alias("w"), *by)
    return flat_span(grouped.agg(F.count("*").alias("n_sessions"), F.avg(seconds).alias("avg_session_s")), "w", "window")


def merge_slots(slots: DataFrame, keys: Sequence[str], measures: Sequence[Measure], gap: str) -> DataFrame:
    """Sessions from the output of :func:`session_slots`."""
    return (
        number_sessions(slots, keys, gap)
        .groupBy(*keys, "_session")
        .agg(
            F.min("_first").alias("session_start"),
            (F.max("_last") + interval(gap)).alias("session_end"),
            *[m.merge for m in measures],
        )
        .select("session_start", "session_end", *keys, *[m.name for m in measures])
    )


def slot_sessions(slots: DataFrame, keys: Sequence[str], gap: str) -> DataFrame:
    """The session each slot belongs to: keys, ``_slot``, ``session_start``, ``session_end``."""
    # The rows are already partitioned by the keys, so this window sorts but does not shuffle.
    whole = Window.partitionBy(*keys, "_session")
    return number_sessions(slots, keys, gap).select(
        *keys,
        "_slot",
        F.min("_first").over(whole).alias("session_start"),
        (F.max("_last").over(whole) + interval(gap)).alias("session_end"),
    )


def slot_values(
    df: DataFrame, keys: Sequence[str], value: str, gap: str, time: str = "event_time"
) -> DataFrame:
    """The different values of each key and slot, with their last time and the start of the session they lie in.

    The rows are reduced before the shuffle. Of a slot's first and last time all of its values know, so the session's
    start is a running maximum over the slots that open one, and all windows share one partitioning.
    """
    values = (
        _with_slot(df.select(*keys, time, value), gap, time)
        .groupBy(*keys, "_slot", value)
        .agg(F.min(time).alias("_first"), F.max(time).alias("_last"))
        .withColumn("_at", F.unix_micros(F.col("_slot").cast("timestamp")))
    )
    in_slot = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.currentRow, Window.currentRow)
    before = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, -1)
    so_far = Window.partitionBy(*keys).orderBy("_at").rangeBetween(Window.unboundedPreceding, Window.currentRow)
    values = values.withColumns({"_slot_first": F.min("_first").over(in_slot), "_before": F.max("_last").over(before)})
    opens = F.col("_before").isNull() | (F.col("_slot_first") > F.col("_before") + interval(gap))
    values = values.withColumn("_opened", F.when(opens, F.col("_slot_first")))
    return values.withColumn("session_start", F.max("_opened").over(so_far)).select(*keys, value, "_last", "session_start")


def with_sessions(df: DataFrame, keys: Sequence[str], gap: str, time: str = "event_time") -> DataFrame:
    """Add to every row of a batch table the start and end of its session.

    Rows find their session by key and slot. There is one match per row, the slot table is small against the
    rows, and a key that holds a third of the rows is spread over its slots.
    """
    sessions = slot_sessions(session_slots(df, keys, (), gap, time), keys, gap)
    return join_slots(_with_slot(df, gap, time), sessions, keys)


def join_slots(rows: DataFrame, sessions: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join rows that carry ``_slot`` with the output of :func:`slot_sessions`. Null keys match each other."""
    renamed = sessions.withColumnsRenamed({c: f"_s_{c}" for c in (*keys, "_slot")})
    matches = F.col("_slot") == F.col("_s__slot")
    for key in keys:
        matches &= F.col(key).eqNullSafe(F.col(f"_s_{key}"))
    return rows.join(renamed, matches).select(
        "session_start", "session_end", *[c for c in rows.columns if c != "_slot"]
    )
