"""The stored tables, and the sales and action events read from them.

Prices and ``steps`` are in steps of :mod:`weirflow.functions.money`, for sums; ``amount`` is the amount itself.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.money import steps
from weirflow.functions.time import event_clock
from weirflow.operators.enrich import ROW, join_lookup

_schemas: dict[tuple, T.StructType] = {}


def read_table(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A stored table. Its schema is read from a file footer once per application, and again if the table has been rewritten since."""
    path = f"{root}/{name}.parquet"
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
    known = (spark.sparkContext.applicationId, path, status.getModificationTime(), status.getLen())
    if known not in _schemas:
        _schemas[known] = spark.read.parquet(path).schema
    return spark.read.schema(_schemas[known]).parquet(path)


def stream_table(spark: SparkSession, root: str, name: str, files_per_batch: int | None = None) -> DataFrame:
    """The same table as a file stream."""
    reader = spark.readStream.schema(read_table(spark, root, name).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    # A file stream takes folders or patterns. The pattern matches the table whether it is one file or a
    # folder of part files.
    return reader.parquet(f"{root}/{name}.parque[t]")


def customer_lookup(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "customer").select(
        F.col("c_custkey").alias("customer_id"),
        F.col("c_name").alias("customer_name"),
        F.col("c_nationkey").alias("nation_id"),
    )


def region_steps(spark: SparkSession, root: str) -> list[DataFrame]:
    """From a nation to its region, and from there to the name."""
    return [
        read_table(spark, root, "nation").select(
            F.col("n_nationkey").alias("nation_id"), F.col("n_regionkey").alias("region_id")
        ),
        read_table(spark, root, "region").select(
            F.col("r_regionkey").alias("region_id"), F.col("r_name").alias("region")
        ),
    ]


def product_lookup(spark: SparkSession, root: str) -> DataFrame:
    return read_table(spark, root, "part").select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        steps("p_retailprice").alias("base_price"),
    )


def sales_events(lineitem: DataFrame, orders: DataFrame, hot: DataFrame | None = None, *columns: str) -> DataFrame:
    """Order lines as sales events. ``lineitem`` may be a stream.

    Both sides grow with the data, so the join is left to a shuffle. In a batch adaptive execution splits an
    order key with too many lines; for a stream ``hot`` can name such keys. ``columns`` of the orders are kept.
    With ``hot``, ``ROW`` tells the lines apart, so that joins to come can spread equal ones.
    """
    placed = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate", "o_custkey", *columns)
    lines = lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    events = join_lookup(lines, placed, "l_orderkey", "inner", hot).select(
        F.col("o_orderdate").alias("event_time"),
        F.col("o_custkey").alias("customer_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").alias("quantity"),
        *columns,
        *([F.xxhash64("l_orderkey", "l_linenumber").alias(ROW)] if hot is not None else []),
    )
    return event_clock(events)


def action_events(events: DataFrame) -> DataFrame:
    """The events table as user actions. ``events`` may be a stream."""
    actions = events.select(
        "event_id",
        F.col("ts").alias("event_time"),
        "user_id",
        F.col("event_type").alias("action"),
        F.col("value").alias("amount"),
        steps("value").alias("steps"),
    )
    return event_clock(actions)


def transactions(events: DataFrame) -> DataFrame:
    """The events table as card transactions; the event type stands for the region."""
    return event_clock(
        events.select(
            F.col("event_id").alias("transaction_id"),
            "user_id",
            F.col("value").alias("amount"),
            F.col("event_type").alias("region"),
            F.col("ts").alias("event_time"),
        )
    )
