"""Alert rules on transactions, batch or stream."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weirflow.functions.measures import row_count
from weirflow.functions.time import flat_span, interval
from weirflow.operators.sessions import slot_values
from weirflow.operators.windows import tumbling_agg, with_watermark

# What the alert texts say. With the default thresholds they read "High Value > 900",
# "Burst Activity > 5 txns/min" and "Multiple Regions in Session".
HIGH_VALUE = "High Value > {threshold:g}"
BURST = "Burst Activity > {more_than} txns/{size}"
SWITCH = "Multiple {attribute}s in Session"
_SHORT = {"1 minute": "min", "1 hour": "h", "1 day": "day"}

ALERT_COLUMNS = ("transaction_id", "user_id", "amount", "region", "event_time", "fraud_reason")


def _reason(text: str) -> Column:
    return F.lit(text).alias("fraud_reason")


def high_value(transactions: DataFrame, threshold: float = 900, reason: str | None = None) -> DataFrame:
    reason = reason or HIGH_VALUE.format(threshold=threshold)
    return transactions.filter(F.col("amount") > threshold).select("*", _reason(reason))


def burst_activity(
    transactions: DataFrame,
    more_than: int = 5,
    size: str = "1 minute",
    watermark: str | None = "2 minutes",
    reason: str | None = None,
) -> DataFrame:
    """Users with more than ``more_than`` transactions in one window."""
    reason = reason or BURST.format(more_than=more_than, size=_SHORT.get(size, size))
    counts = tumbling_agg(transactions, ["user_id"], [row_count("n")], size, watermark)
    return counts.filter(F.col("n") > more_than).select("*", _reason(reason))


def attribute_switch(
    transactions: DataFrame,
    attribute: str = "region",
    more_than: int = 1,
    gap: str = "2 minutes",
    watermark: str | None = "5 minutes",
    reason: str | None = None,
) -> DataFrame:
    """User sessions with more than ``more_than`` different values of ``attribute``.

    A batch table is reduced to the values of each user and time slot before sessions are found, so its rows are
    shuffled once and a busy user by slots. A stream that looks for more than one value keeps the least and the
    largest of each open session: it does not count, and has ``switched`` instead of ``distinct_values``. For a higher limit it has to
    hold the values of an open session.
    """
    reason = reason or SWITCH.format(attribute=attribute.capitalize())
    if transactions.isStreaming:
        found = F.size(F.collect_set(attribute)).cast("long").alias("distinct_values")
        if more_than == 1:
            found = F.coalesce(F.min(attribute) < F.max(attribute), F.lit(False)).alias("switched")
        grouped = (
            with_watermark(transactions, "event_time", watermark)
            .groupBy(F.session_window("event_time", gap).alias("s"), "user_id")
            .agg(found)
        )
        counts = flat_span(grouped, "s", "session")
        if more_than == 1:
            return counts.filter("switched").select("*", _reason(reason))
    else:
        counts = (
            slot_values(transactions, ["user_id"], attribute, gap)
            .groupBy("user_id", "session_start")
            .agg(
                (F.max("_last") + interval(gap)).alias("session_end"),
                F.count_distinct(attribute).alias("distinct_values"),
            )
            .select("session_start", "session_end", "user_id", "distinct_values")
        )
    return counts.filter(F.col("distinct_values") > more_than).select("*", _reason(reason))


def fraud_alerts(*alerts: DataFrame) -> DataFrame:
    """All alerts in one table with duplicates kept. Columns a rule does not have are null."""
    rows = [a.select(*[c for c in ALERT_COLUMNS if c in a.columns]) for a in alerts]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), rows).select(*ALERT_COLUMNS)
