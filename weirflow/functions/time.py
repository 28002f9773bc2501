"""Durations, event-time types and flat window columns."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = ("microsecond", "millisecond", "second", "minute", "hour", "day", "week")


def duration(text: str) -> timedelta:
    """``"30 seconds"`` or ``"1 day 12 hours"`` as a timedelta. Months and years have no fixed length."""
    words = text.lower().split()
    if not words or len(words) % 2:
        raise ValueError(f"not a duration: {text!r}")
    total = timedelta()
    for number, unit in zip(words[::2], words[1::2]):
        unit = unit.rstrip("s")
        if unit not in _UNITS:
            raise ValueError(f"no fixed-length unit {unit!r} in {text!r}")
        total += timedelta(**{unit + "s": int(number)})
    return total


def interval(text: str) -> Column:
    """The same duration as an interval literal."""
    return F.lit(duration(text))


def event_clock(df: DataFrame, time: str = "event_time") -> DataFrame:
    """Make ``time`` usable as a stream's event time: watermarks refuse TIMESTAMP_NTZ."""
    if df.isStreaming and isinstance(df.schema[time].dataType, T.TimestampNTZType):
        return df.withColumn(time, F.col(time).cast("timestamp"))
    return df


def zoneless(df: DataFrame) -> DataFrame:
    """Every TIMESTAMP column as TIMESTAMP_NTZ, the type of the stored tables."""
    stamps = [f.name for f in df.schema if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in stamps})


def epoch_seconds(time: Column) -> Column:
    return F.unix_timestamp(time.cast("timestamp"))


def flat_span(df: DataFrame, span: str, prefix: str) -> DataFrame:
    """Replace a window struct by ``<prefix>_start`` and ``<prefix>_end`` as the leading columns."""
    rest = [c for c in df.columns if c != span]
    return df.select(
        F.col(f"{span}.start").alias(f"{prefix}_start"),
        F.col(f"{span}.end").alias(f"{prefix}_end"),
        *rest,
    )
