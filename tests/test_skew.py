"""Tables in which one order, customer and product hold a third of the lines give the right results."""

import pytest
from oracle_check import compare, duck
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from weirflow.plans.streams import hot_sale_keys
from weirflow.sources.tables import read_table


@pytest.fixture(scope="module")
def skewed(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("skewed"))
    for name in ("region", "nation", "customer", "part", "orders", "lineitem", "events"):
        table = read_table(spark, "/root/testdata/sf0.001", name)
        if name == "lineitem":
            third = F.col("l_linenumber") <= 2
            table = table.withColumns(
                {c: F.when(third, F.lit(7)).otherwise(F.col(c)).cast("long") for c in ("l_orderkey", "l_partkey")}
            )
        if name == "orders":
            table = table.withColumn("o_custkey", F.when(F.col("o_orderkey") % 3 == 1, 3).otherwise(F.col("o_custkey")))
            table = table.withColumn("o_custkey", F.col("o_custkey").cast("long"))
        if name == "events":
            table = table.withColumn("user_id", F.when(F.col("event_id") % 3 == 1, 5).otherwise(F.col("user_id")))
            table = table.withColumn("user_id", F.col("user_id").cast("long"))
        table.coalesce(1).write.parquet(f"{root}/{name}.parquet")
    return root


@pytest.fixture
def no_broadcast(spark):
    """Join as with lookups that are too large to broadcast."""
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_hot_keys_are_found(spark, skewed):
    hot = hot_sale_keys(spark, skewed)
    assert 7 in [r[0] for r in hot["l_orderkey"].collect()]
    assert 7 in [r[0] for r in hot["product_id"].collect()]
    assert 3 in [r[0] for r in hot["customer_id"].collect()]


@pytest.mark.parametrize(
    "name",
    [
        "enrich_sales",
        "topn_products_sliding",
        "session_kpis",
        "session_product_mix",
        "fraud_alerts",
        "stream_topn_snapshot",
        "stream_session_product_mix",
        "stream_late_enrichment",
        "stream_session_append",
    ],
)
def test_skewed_tables(spark, skewed, no_broadcast, name):
    con = duck(skewed, "/*.parquet")
    assert compare(queries()[name](spark, skewed), con, oracle_sql()[name]) is None
