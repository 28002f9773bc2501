from decimal import Decimal

import pytest
from helpers import at, rows
from pyspark.sql import functions as F

from weirflow.operators.enrich import ROW, price_report, add_product, add_region, enrich_sales, hot_keys, join_lookup
from weirflow.sources.schemas import CUSTOMER, PRODUCT, RAW_SALE


@pytest.fixture
def events(spark):
    return spark.createDataFrame(
        [
            (at("10:00"), 1, 11, 2),
            (at("10:01"), 2, 12, 1),
            (at("10:02"), 9, 11, 3),
            (at("10:03"), 1, 99, 4),
            (at("10:04"), None, None, 5),
        ],
        RAW_SALE,
    )


@pytest.fixture
def customers(spark):
    return spark.createDataFrame([(1, "Ann", "East", "f"), (2, "Bo", "West", "m")], CUSTOMER)


@pytest.fixture
def products(spark):
    return spark.createDataFrame([(11, "pen", "office", "desk", 1.5), (12, "cup", "home", "kitchen", None)], PRODUCT)


def test_left_keeps_events_without_match(events, customers, products):
    enriched = enrich_sales(events, customers, products)
    assert enriched.columns == [
        "event_time", "customer_id", "product_id", "quantity", "region", "product_name", "category",
        "unit_price", "total_amount",
    ]
    result = {r.event_time: r for r in enriched.collect()}
    assert len(result) == 5
    assert result[at("10:00")][4:] == ("East", "pen", "office", 1.5, 3.0)
    # A product without a price and one that is not known both cost 0.
    assert result[at("10:01")][4:] == ("West", "cup", "home", 0.0, 0.0)
    assert result[at("10:02")][4:] == (None, "pen", "office", 1.5, 4.5)
    assert result[at("10:03")][4:] == ("East", None, None, 0.0, 0.0)
    assert result[at("10:04")][4:] == (None, None, None, 0.0, 0.0)


def test_inner_drops_them(events, customers, products):
    kept = enrich_sales(events, customers, products, how="inner")
    assert sorted(r.event_time for r in kept.collect()) == [at("10:00"), at("10:01")]


def test_products_without_category(events, customers, products):
    enriched = enrich_sales(events, customers, products.drop("category"))
    assert "category" not in enriched.columns and enriched.count() == 5


@pytest.mark.parametrize("how", ["left", "inner"])
def test_spreading_hot_keys_changes_nothing(events, customers, products, how):
    many = events.unionAll(events).unionAll(events)
    hot_customers, hot_products = hot_keys(many, "customer_id", 0.3), hot_keys(many, "product_id", 0.3)
    assert rows(hot_customers) == [(1,)] and rows(hot_products) == [(11,)]
    spread = enrich_sales(many, customers, products, (), how, hot_customers, hot_products)
    assert rows(spread) == rows(enrich_sales(many, customers, products, how=how))


def test_hot_key_is_spread(spark):
    events = spark.range(1000).selectExpr("if(id < 900, 1, id) as k", "id as v")
    lookup = spark.range(1000).selectExpr("id as k", "id * 2 as w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        joined = join_lookup(events, lookup, "k", "inner", hot_keys(events, "k", 0.1), 16)
        sizes = [r[0] for r in joined.groupBy(F.spark_partition_id()).agg(F.count("*")).select("count(1)").collect()]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert sum(sizes) == 1000 and max(sizes) < 600


def test_equal_rows_of_a_hot_key_are_spread(spark):
    events = spark.range(20_000).select(F.lit(7).cast("long").alias("k"), F.lit(1).alias("v"), F.xxhash64("id").alias(ROW))
    lookup = spark.range(100).selectExpr("id as k", "id as w")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        joined = join_lookup(events, lookup, "k", "inner", hot_keys(events, "k"), 64)
        tasks = joined.groupBy(F.spark_partition_id()).count().collect()
    finally:
        for key in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(key)
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert sum(r["count"] for r in tasks) == 20_000 and len(tasks) > 30


def test_prices_after_the_sum(spark):
    products = spark.createDataFrame([(1, "pen", 15_000), (2, "cup", None)], "product_id int, product_name string, base_price bigint")
    report = spark.createDataFrame([(1, 2.5), (2, 3.0), (3, 1.0)], "product_id int, units double")
    assert rows(price_report(report, products, "product_name")) == [(1, 2.5, "pen", 37_500), (2, 3.0, "cup", 0), (3, 1.0, None, 0)]


def test_decimal_prices_stay_exact(events, customers, products):
    exact = products.withColumn("base_price", products.base_price.cast("decimal(12,2)"))
    enriched = enrich_sales(events, customers, exact)
    assert dict(enriched.dtypes)["total_amount"] == "decimal(18,2)"
    assert enriched.filter("customer_id = 9").first().total_amount == Decimal("4.50")


def test_region_through_nation(spark, events, customers):
    nations = spark.createDataFrame([(5, 50), (6, 60)], "nation_id int, region_id int")
    regions = spark.createDataFrame([(50, "East"), (60, "West")], "region_id int, region string")
    by_nation = spark.createDataFrame([(1, 5), (2, 6)], "customer_id int, nation_id int")
    assert rows(add_region(events, by_nation, [nations, regions]).select("customer_id", "region")) == rows(
        add_region(events, customers).select("customer_id", "region")
    )


def test_product_columns_added_to_a_report(spark, products):
    report = spark.createDataFrame([(11, 5), (99, 6)], "product_id int, units int")
    assert rows(add_product(report, products, "product_name")) == [(11, 5, "pen"), (99, 6, None)]


def test_large_lookup_is_not_broadcast(spark, events, customers):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1")
    try:
        joined = join_lookup(events, customers, "customer_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" not in plan and "SortMergeJoin" in plan
        assert joined.count() == 5
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
