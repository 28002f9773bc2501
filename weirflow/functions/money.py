"""Money as whole steps of 1 / SCALE of its unit.

Sums of steps in a long are exact, so they do not depend on the order of the rows and equal totals rank as
equal, and they cost what a sum of longs costs. A sum that leaves the range of a long fails; it cannot wrap.
What has more decimals than four is rounded to the next step before it is summed. Thresholds and rows that are
handed on as they are use the amount itself.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SCALE = 10_000


def steps(amount: str) -> Column:
    return F.round(F.col(amount) * SCALE).cast("long")


def in_units(df: DataFrame, *columns: str) -> DataFrame:
    """Columns of steps as doubles, for output."""
    return df.withColumns({c: F.col(c) / SCALE for c in columns})
