"""Hot keys of a long stream: kept up with every micro-batch, in a sketch of fixed size."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.operators.enrich import join_hot, rows_of
from weirflow.streaming.runner import BatchWriter
from weirflow.session import remove
from weirflow.streaming.stores import KEPT, _complete, _point


class HotKeys:
    """The keys that hold more than about ``share`` of a stream's rows so far, or of its latest micro-batch.

    Each batch is sketched in one pass (the most frequent values, by a sketch of fixed size, combined within tasks before anything is
    sent), and its sketch is merged with that of the batches before, which lies below ``path``. So a key that turns hot
    later is found in the batch in which it does, and the cost of a batch does not grow with the stream. A batch that is repeated
    merges with the same sketch again.
    """

    def __init__(self, path: str, key: str, share: float = 0.002):
        self.path, self.key, self.share = path, key, share
        self.most = int(1 / share)

    def update(self, batch: DataFrame, epoch: int) -> DataFrame:
        """Take in a batch; at most ``2 / share`` hot keys, as a local table with the one column ``key``."""
        spark, size = batch.sparkSession, 8 * self.most
        now = batch.agg(F.expr(f"approx_top_k_accumulate({self.key}, {size})").alias("sketch"), F.count(F.lit(1)).alias("n"))
        before = [e for e in _complete(spark, self.path, "current") if e < epoch]
        both = now
        if before:
            both = now.unionByName(spark.read.parquet(f"{self.path}/sketch-{before[-1]:012d}"))
        merged = both.agg(F.expr(f"approx_top_k_combine(sketch, {size})").alias("sketch"), F.sum("n").alias("n"))
        target = f"{self.path}/sketch-{epoch:012d}"
        merged.coalesce(1).write.mode("overwrite").parquet(target)
        _point(spark, f"{self.path}/current", epoch)
        for old in before[:-KEPT]:
            for name in ("current", "sketch"):
                remove(spark, f"{self.path}/{name}-{old:012d}")
        tops = spark.read.parquet(target).unionByName(now)
        tops = tops.select(F.explode(F.expr(f"approx_top_k_estimate(sketch, {self.most})")).alias("t"), "n")
        hot = tops.where(F.col("t.count") > F.col("n") * self.share).select(F.col("t.item").alias(self.key))
        return spark.createDataFrame(hot.where(f"{self.key} is not null").distinct().collect(), hot.schema)


def enriched_writer(
    path: str,
    hot: HotKeys,
    lookup: Callable[[DataFrame], DataFrame],
    how: str = "left",
    shape: Callable[[DataFrame], DataFrame] | None = None,
) -> BatchWriter:
    """Join each micro-batch with a lookup by the key of ``hot`` and keep the result, one folder per batch.

    ``lookup`` makes the lookup for a batch, for its session. Rows of the keys that are hot now are spread. What is written is a
    table, and a source for further streams: aggregate it there, in a query with a state of its own.
    """

    def write(batch: DataFrame, epoch: int) -> None:
        held = batch.persist()
        try:
            static = lookup(held)
            rows = rows_of(static, hot.key, hot.update(held, epoch))
            joined = join_hot(held, static, hot.key, how, rows)
            (shape(joined) if shape else joined).write.mode("overwrite").parquet(f"{path}/epoch_id={epoch}")
        finally:
            held.unpersist()

    return write
