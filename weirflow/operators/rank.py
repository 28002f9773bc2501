"""Top-N within groups."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def top_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, rank: str = "rank") -> DataFrame:
    """Rows of dense rank 1 to ``n`` within ``by``. Ties share a rank, so a group may keep more than n rows.

    Spark applies the limit on ``rank`` before the shuffle as well as after it (window group limit), so a
    group that holds most of the rows sends few of them on.
    """
    ranked = df.withColumn(rank, F.dense_rank().over(Window.partitionBy(*by).orderBy(*order)))
    return ranked.filter(F.col(rank) <= n)


def first_n(df: DataFrame, by: Sequence[str], order: Sequence[Column], n: int, position: str = "position") -> DataFrame:
    """At most ``n`` rows within ``by``, numbered from 1."""
    numbered = df.withColumn(position, F.row_number().over(Window.partitionBy(*by).orderBy(*order)))
    return numbered.filter(F.col(position) <= n)


def by_sales(revenue: str = "revenue", units: str = "units") -> list[Column]:
    """Highest revenue first, then most units."""
    return [F.col(revenue).desc(), F.col(units).desc()]
