"""What the plans of the larger reports do, with lookups too large to broadcast."""

import pytest

import weirflow.plans.streams  # noqa: F401
from weirflow.plans.catalog import QUERIES, product_revenue
from weirflow.session import configure


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_the_region_is_joined_to_the_orders(spark, small, no_broadcast):
    """Below the aggregation the lines meet one join: that with their orders, which know their region."""
    plan = plan_of(product_revenue(configure(spark), small, "30 days"))
    lines = plan.index("lineitem.parquet")
    below = plan[plan.index("partial_sum") : lines]
    assert plan.count("lineitem.parquet") == 1 == plan.count("orders.parquet")
    # Everything between the partial sums and the scan of the lines: one join, and the shuffle and sort it needs.
    assert below.count("SortMergeJoin") == 1


def test_the_product_mix_reads_its_facts_once(spark, small):
    plan = plan_of(QUERIES["session_product_mix"](spark, small))
    assert "lineitem.parquet" not in plan and "orders.parquet" not in plan and "product-slots" in plan


def test_the_region_switch_shuffles_rows_once(spark, small):
    plan = plan_of(QUERIES["fraud_attribute_switch"](spark, small))
    assert plan.count("FileScan parquet") == 1 and "Join" not in plan


@pytest.mark.parametrize("name", ["tumbling_sales_by_region_category", "tumbling_total_by_region"])
def test_reports_without_a_product_shuffle_few_rows(spark, small, name):
    """The price is joined before the first sums, so these leave a row per window and group, not one per product."""
    df = QUERIES[name](spark, small)
    assert df.count() > 0
    plan = plan_of(df)
    below = plan[plan.index("partial_sum") :]
    assert "part.parquet" in below and "orders.parquet" in below
    assert "product_id" not in plan[: plan.index("partial_sum")]


def test_a_micro_batch_does_not_shuffle_the_orders(spark, small, no_broadcast, tmp_path):
    """The static side of the stream is stored in buckets of its key: each batch joins it without an exchange."""
    from weirflow.plans.streams import line_stream
    from weirflow.streaming.runner import run_stream

    plans = []
    configure(spark)
    hot = {"l_orderkey": spark.createDataFrame([(7,)], "l_orderkey bigint")}
    query = run_stream(
        line_stream(spark, small, hot, "left"), "append", "batch", checkpoint=str(tmp_path / "cp"),
        on_batch=lambda batch, epoch: (batch.count(), plans.append(epoch)), available_now=True,
    )
    assert len(plans) >= 2
    plan = query._jsq.streamingQuery().explainInternal(False) if hasattr(query._jsq, "streamingQuery") else ""
    plan = plan or query._jsq.explainInternal(False)
    join = plan[plan.index("SortMergeJoin") :]
    streamed, static = join.split("FileScan parquet spark_catalog", 1)[0], join
    assert "Bucketed: true" in static
    # The lines are shuffled to the buckets; between the join and the scan of the orders is no exchange.
    between = join[: join.index("Bucketed: true")]
    last = between.rindex("FileScan parquet")
    side = between[between.rindex("+- ", 0, last) :]
    assert "Exchange" not in side


@pytest.mark.parametrize("name", ["sliding_product_revenue", "topn_products_sliding", "stream_session_product_mix"])
def test_many_rows_meet_a_lookup_unsorted(spark, small, no_broadcast, name):
    """What is joined with a side of small partitions is not sorted for it, so no task holds it for the join."""
    df = QUERIES[name](spark, small)
    assert df.collect()
    final = plan_of(df).split("Initial Plan")[0]
    assert "ShuffledHashJoin" in final and "SortMergeJoin" not in final
