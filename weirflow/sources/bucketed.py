"""Lookup tables stored in buckets of their key, for joins that are made again and again."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from weirflow.session import passing, work_dir


def bucketed(df: DataFrame, key: str, purpose: str, buckets: int | None = None) -> DataFrame:
    """``df`` as a table of the session's catalog, in ``buckets`` files by ``key`` below ``spark.checkpoint.dir``.

    A join by ``key`` reads it bucket by bucket: the table is shuffled once, here, and not in every micro-batch of a stream.
    Spark keeps to the buckets if there are at least ``spark.sql.shuffle.partitions`` of them, which is the default; so
    that number has to fit the data, as for any shuffle. The table's files and its entry
    in the catalog stay for as long as its readers need them.
    """
    spark = df.sparkSession
    n = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"{purpose}_{uuid.uuid4().hex}".replace("-", "_")
    # Dealt like the buckets, so each task writes one file.
    dealt = df.repartition(n, key)
    with passing(spark):
        writer = dealt.write.bucketBy(n, key).sortBy(key).option("compression", "zstd")
        writer.option("path", work_dir(spark, purpose)).format("parquet").saveAsTable(name)
    return spark.table(name)

