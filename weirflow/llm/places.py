"""The place of every row within its group, without one task seeing a whole group."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weirflow.llm.common import partitions, saved

_AT, _PART = "_llm_at", "_llm_part"
#: ``monotonically_increasing_id`` counts the rows of a partition in its lower 33 bits.
_ROW_BITS = 33


def numbered(df: DataFrame, group: str, order: Sequence[str], place: str = "place", total: str = "total") -> DataFrame:
    """``df`` with each row's place in its group, from 0 in ascending ``order``, nulls first, and the group's number of rows.

    The rows are dealt by ranges of (group, order), so a group that holds most of the table lies in many partitions. A row knows
    its place in its partition, and only one row per partition and group is summed up to tell how many stand before.
    Rows that are equal in ``order`` get places in any order. ``group`` must not be null. An empty table gives an empty one.
    """
    ranged = df.repartitionByRange(4 * partitions(df.sparkSession), group, *order).sortWithinPartitions(group, *order)
    ranged = saved(ranged.withColumn(_AT, F.monotonically_increasing_id()), "places").withColumn(_PART, F.shiftright(_AT, _ROW_BITS))
    whole = Window.partitionBy("g")
    before = whole.orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    spans = ranged.groupBy(F.col(_PART).alias("p"), F.col(group).alias("g")).agg(F.min(_AT).alias("first"), F.count("*").alias("n"))
    spans = spans.select(
        F.col("p").alias(_PART),
        F.col("g").alias(group),
        (F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("_llm_shift"),
        F.sum("n").over(whole).alias(total),
    )
    joined = ranged.join(spans, [_PART, group])
    return joined.select(*df.columns, (F.col(_AT) + F.col("_llm_shift")).alias(place), total)
