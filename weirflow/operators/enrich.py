"""Joins of events with lookup tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


#: A column by which equal rows can be told apart.
ROW = "_row"


def hot_keys(df: DataFrame, key: str, share: float = 0.002) -> DataFrame:
    """Keys that hold more than about ``share`` of the rows, null among them; at most ``1 / share`` keys.

    One pass over the column with a sketch of fixed size: the keys are not shuffled. What it finds decides how
    rows are spread over tasks and not what a join returns.
    """
    return hot_keys_of(df, [key], share).select(F.col("hot").alias(key))


def hot_keys_of(df: DataFrame, keys: Sequence[str], share: float = 0.002) -> DataFrame:
    """(name, hot): the hot keys of several columns of one type, found in one scan."""
    most = int(1 / share)
    sketches = [F.expr(f"approx_top_k({key}, {most}, {8 * most})").alias(key) for key in keys]
    found = df.agg(*sketches, F.count(F.lit(1)).alias("_n"))
    tops = F.explode(F.array(*[F.struct(F.lit(key).alias("name"), F.col(key).alias("top")) for key in keys]))
    return (
        found.select(tops.alias("k"), "_n")
        .select("k.name", F.explode("k.top").alias("t"), "_n")
        .filter(F.col("t.count") > F.col("_n") * share)
        .select("name", F.col("t.item").alias("hot"))
    )


def join_lookup(
    events: DataFrame,
    lookup: DataFrame,
    key: str,
    how: str = "left",
    hot: DataFrame | None = None,
    salts: int = 1 << 30,
) -> DataFrame:
    """Join events with a table that holds each ``key`` at most once.

    No broadcast is forced. Catalyst broadcasts the lookup while its size is below
    ``spark.sql.autoBroadcastJoinThreshold`` and shuffles both sides beyond that, where adaptive execution
    splits a hot key.

    A stateful stream runs without adaptive execution. For a stream with a lookup too large to broadcast,
    ``hot`` names the hot keys, as :func:`hot_keys` finds them: see :func:`join_hot`.
    """
    if hot is None:
        return events.join(lookup, key, how)
    return join_hot(events, lookup, key, how, rows_of(lookup, key, hot), salts)


def rows_of(lookup: DataFrame, key: str, hot: DataFrame) -> DataFrame:
    """The lookup's rows of the hot keys, of which :func:`hot_keys` bounds the number, as a local table: read once, not per micro-batch."""
    found = lookup.join(F.broadcast(hot.select(key).distinct()), key, "left_semi")
    return lookup.sparkSession.createDataFrame(found.collect(), found.schema)


def join_hot(events: DataFrame, lookup: DataFrame, key: str, how: str, rows: DataFrame, salts: int = 1 << 30) -> DataFrame:
    """:func:`join_lookup` where ``rows`` are the lookup's rows of the hot keys, few enough to be sent to all tasks.

    Events of these keys find their row there. They, and events without a key, still pass the shuffle of the other join, but under made-up
    keys, ``salts`` of them at most, that spread them evenly, so neither a hot key fills a task nor is a row of the lookup repeated, and a lookup
    stored in buckets of the key (:mod:`weirflow.sources.bucketed`) is not shuffled. Equal events are spread too if
    a column ``ROW`` tells them apart.
    """
    kind = events.schema[key].dataType
    values = [c for c in lookup.columns if c != key]
    known = rows.select(F.col(key).alias("_hot_key"), *[F.col(c).alias(f"_hot_{c}") for c in values])
    marked = events.join(F.broadcast(known), F.col(key) == F.col("_hot_key"), "left")
    own = [ROW] if ROW in events.columns else events.columns
    spread = (-1 - F.pmod(F.xxhash64(*own), F.lit(salts))).cast(kind)
    away = F.col("_hot_key").isNotNull() | F.col(key).isNull()
    marked = marked.withColumn("_key", F.when(away, spread).otherwise(F.col(key)))
    others = lookup.select(F.col(key).cast(kind).alias("_key"), F.lit(True).alias("_there"), *[F.col(c).alias(f"_cold_{c}") for c in values])
    joined = marked.join(others, "_key", "left")
    # A made-up key may be that of some row: it counts for nothing.
    pick = [F.when(F.col("_hot_key").isNotNull(), F.col(f"_hot_{c}")).when(F.col(key).isNotNull(), F.col(f"_cold_{c}")).alias(c) for c in values]
    if how == "inner":
        joined = joined.where(F.col("_hot_key").isNotNull() | (F.col(key).isNotNull() & F.col("_there")))
    elif how != "left":
        raise ValueError(f"no {how!r} join with hot keys")
    return joined.select(key, *[c for c in events.columns if c != key], *pick)


def price_sales(
    events: DataFrame, products: DataFrame, *columns: str, how: str = "left", hot: DataFrame | None = None
) -> DataFrame:
    """Add unit price and line amount, and further ``columns`` of the products. An unknown product costs 0."""
    amount = F.col("unit_price") * F.col("quantity")
    price_type = products.schema["base_price"].dataType
    if isinstance(price_type, T.DecimalType):
        # 18 digits keep the amount in a long.
        amount = amount.cast(T.DecimalType(18, price_type.scale))
    if isinstance(price_type, T.LongType):
        # A price in whole steps gives an amount in whole steps, also for a part of a unit.
        amount = F.round(amount).cast("long")
    return (
        join_lookup(events, products.select("product_id", *columns, "base_price"), "product_id", how, hot)
        .withColumn("unit_price", F.coalesce("base_price", F.lit(0)))
        .withColumn("total_amount", amount)
        .drop("base_price")
    )


def add_region(
    df: DataFrame,
    customers: DataFrame,
    steps: Sequence[DataFrame] = (),
    how: str = "left",
    hot: DataFrame | None = None,
) -> DataFrame:
    """Add the region of the customer.

    ``customers`` has a column ``region``, or ``steps`` lead to it: tables that are joined one after another,
    each by its first column. They stay apart so that Catalyst knows each one's size from its files; of a join
    of them it would assume the product. A report per customer adds the region last, since its rows are fewer
    than the events.
    """
    keys = [step.columns[0] for step in steps]
    wanted = keys[0] if keys else "region"
    joined = join_lookup(df, customers.select("customer_id", wanted), "customer_id", how, hot)
    for step, key in zip(steps, keys):
        joined = join_lookup(joined, step, key, how)
    return joined.drop(*keys)


def add_product(df: DataFrame, products: DataFrame, *columns: str, how: str = "left") -> DataFrame:
    """Add columns of the products to a report per product. They need not be grouped or shuffled before."""
    return join_lookup(df, products.select("product_id", *columns), "product_id", how)


def price_report(report: DataFrame, products: DataFrame, *columns: str, prefix: str = "", how: str = "left") -> DataFrame:
    """Add ``revenue`` and further ``columns`` of the products to a report of ``units`` per product.

    The names of the report's units and of its revenue may have a ``prefix``. A price belongs to the product, so it need not
    be known before the units are summed. Prices are in steps of :mod:`weirflow.functions.money`, as is the revenue, which is rounded to a step
    once per row of the report; :func:`price_sales` rounds each line. Both agree while quantities are whole.
    """
    priced = join_lookup(report, products.select("product_id", *columns, "base_price"), "product_id", how)
    # Both factors may be large: the product is formed in decimals and must fit a long.
    units = F.col(f"{prefix}units").cast(T.DecimalType(18, 4))
    revenue = F.round(F.coalesce("base_price", F.lit(0)).cast(T.DecimalType(18, 0)) * units).cast("long")
    return priced.withColumn(f"{prefix}revenue", revenue).drop("base_price")


def enrich_sales(
    events: DataFrame,
    customers: DataFrame,
    products: DataFrame,
    region_steps: Sequence[DataFrame] = (),
    how: str = "left",
    hot_customers: DataFrame | None = None,
    hot_products: DataFrame | None = None,
) -> DataFrame:
    """Sales events with region, product columns, unit price and line amount, batch or stream.

    With ``how="left"`` an event without a match stays; with ``how="inner"`` it is dropped.
    """
    names = [c for c in ("product_name", "category") if c in products.columns]
    placed = add_region(events, customers, region_steps, how, hot_customers)
    return price_sales(placed, products, *names, how=how, hot=hot_products).select(
        *[c for c in events.columns if c != ROW], "region", *names, "unit_price", "total_amount"
    )
