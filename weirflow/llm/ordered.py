"""Rows beside their neighbours in a total order, without one task seeing the whole order."""

from __future__ import annotations

from bisect import bisect_right
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.llm.common import partitions


def in_runs(
    df: DataFrame, key: str, before: bool = False, wrap: bool = False, prepare: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """Cut the table into runs of ascending ``key``, each in one partition and in order there.

    Adds ``run`` and ``guest``. The first row of each run also stands, as a guest, behind the run before it, and with
    ``before`` the last row of each run also before the run after it; with ``wrap`` the table's first row follows the
    last. So each row has its neighbours in its own partition. Spark's range partitioning finds the bounds; the driver sees
    two keys per run. ``key`` must not be null; rows with equal keys share a run. ``prepare`` makes of each
    row what is moved to its place; it must hand on ``run``.
    """
    ranged = df.select(key).repartitionByRange(4 * partitions(df.sparkSession), key)
    ends = ranged.groupBy(F.spark_partition_id().alias("p")).agg(F.min(key), F.max(key)).collect()
    ends = sorted((low, high) for _, low, high in ends)
    lows, highs = [low for low, _ in ends], [high for _, high in ends]

    def places(keys: pd.Series) -> pd.Series:
        out = []
        for k in keys:
            at = bisect_right(lows, k) - 1
            mine = [at]
            if k == lows[at] and (at or wrap):
                mine.append(-1 - (at - 1) % len(lows))
            if before and k == highs[at] and at + 1 < len(lows):
                mine.append(-2 - at)
            out.append(mine)
        return pd.Series(out, dtype=object)

    placed = df.select("*", F.explode(F.pandas_udf(places, "array<int>")(key)).alias("run"))
    placed = placed.select(
        *df.columns, (F.col("run") < 0).alias("guest"), F.when(F.col("run") < 0, -1 - F.col("run")).otherwise(F.col("run")).alias("run")
    )
    return (prepare(placed) if prepare else placed).repartition("run")
