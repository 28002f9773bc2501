import random
from collections import Counter
from datetime import timedelta

import pytest
from helpers import at, order, rows

from pyspark.sql import functions as F

from weirflow.operators import fraud
from weirflow.operators.late import backdate_every_nth, late_event_audit, max_before
from weirflow.operators.rank import by_sales, first_n, top_n
from weirflow.plans.reports import product_revenue, ranking_order, top_products
from weirflow.sources.tables import transactions


def test_ties_share_a_rank(spark):
    df = spark.createDataFrame(
        [("e", 9, 1), ("e", 9, 1), ("e", 9, 0), ("e", 7, 5), ("e", 6, 1), ("w", 1, 1)],
        "region string, revenue int, units int",
    )
    best = top_n(df, ["region"], by_sales(), 3)
    assert rows(best) == sorted(
        [("e", 9, 1, 1), ("e", 9, 1, 1), ("e", 9, 0, 2), ("e", 7, 5, 3), ("w", 1, 1, 1)], key=order
    )
    assert first_n(df, ["region"], by_sales(), 3).count() == 4


def test_limit_is_applied_before_the_shuffle(spark):
    df = spark.range(100).selectExpr("id % 2 as region", "id as revenue", "id as units")
    plan = top_n(df, ["region"], by_sales(), 5)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.rindex("Partial")


def test_top_products_newest_first(spark):
    events = spark.createDataFrame(
        [(at("10:00"), "East", p, q, p * q) for p in range(1, 8) for q in (1, 2)]
        + [(at("10:01"), "East", 1, 1, 1)],
        "event_time timestamp_ntz, region string, product_id int, quantity int, total_amount int",
    )
    best = ranking_order(top_products(product_revenue(events)), newest_first=True).collect()
    assert [r.product_id for r in best] == [1, 7, 6, 5, 4, 3]
    assert [r.revenue for r in best[1:3]] == [21, 18]


TX = "transaction_id bigint, user_id int, amount int, region string, event_time timestamp_ntz"


@pytest.fixture
def tx(spark):
    burst = [(i, 1, 10, "US", at(f"10:00:{i:02d}")) for i in range(6)]
    switch = [(10, 2, 5, "US", at("11:00")), (11, 2, 5, "EU", at("11:01:30")), (12, 2, 5, "EU", at("12:00"))]
    high = [(20, 3, 901, "EU", at("13:00")), (21, 3, 900, "EU", at("14:00"))]
    return spark.createDataFrame(burst + switch + high, TX)


def test_default_rules(tx):
    assert [r.transaction_id for r in fraud.high_value(tx).collect()] == [20]
    assert [tuple(r)[:4] for r in fraud.burst_activity(tx).collect()] == [(at("10:00"), at("10:01"), 1, 6)]
    assert [tuple(r)[:4] for r in fraud.attribute_switch(tx).collect()] == [(at("11:00"), at("11:03:30"), 2, 2)]


def test_alerts_are_one_table(tx):
    alerts = fraud.fraud_alerts(fraud.high_value(tx), fraud.burst_activity(tx), fraud.attribute_switch(tx))
    assert alerts.columns == list(fraud.ALERT_COLUMNS)
    assert Counter((r.user_id, r.fraud_reason) for r in alerts.collect()) == Counter(
        [(3, "High Value > 900"), (1, "Burst Activity > 5 txns/min"), (2, "Multiple Regions in Session")]
    )
    assert fraud.fraud_alerts(fraud.high_value(tx), fraud.high_value(tx)).count() == 2


def test_labels_say_what_the_rule_is(tx):
    assert {r.fraud_reason for r in fraud.high_value(tx, 100).collect()} == {"High Value > 100"}
    assert {r.fraud_reason for r in fraud.high_value(tx, 899.5).collect()} == {"High Value > 899.5"}
    assert {r.fraud_reason for r in fraud.burst_activity(tx, 2, "1 hour").collect()} == {"Burst Activity > 2 txns/h"}


def test_thresholds_see_the_amount_itself(spark):
    frame = spark.createDataFrame([(1, at("10:00"), 7, "US", 200.004), (2, at("10:00"), 7, "US", 200.0)], "event_id bigint, ts timestamp_ntz, user_id int, event_type string, value double")
    alerts = fraud.high_value(transactions(frame), 200).collect()
    assert [(r.transaction_id, r.amount) for r in alerts] == [(1, 200.004)]


def test_switch_in_a_table_against_session_window(spark):
    rng = random.Random(9)
    data = [
        (i, rng.choice([1, 2, None]), 1, rng.choice(["US", "EU", "AP", None]), at("10:00") + timedelta(seconds=60 * rng.randrange(90)))
        for i in range(250)
    ]
    df = spark.createDataFrame(data, TX)
    native = (
        df.groupBy(F.session_window("event_time", "2 minutes").alias("s"), "user_id")
        .agg(F.count_distinct("region").alias("n")).filter("n > 1").select("s.start", "s.end", "user_id", "n")
    )
    assert rows(fraud.attribute_switch(df).drop("fraud_reason")) == rows(native)
    assert native.count() > 5


def test_backdating(spark):
    df = spark.createDataFrame([(i, at("10:00")) for i in (0, 1, 49, 50, 100)], "event_id int, event_time timestamp_ntz")
    moved = {r.event_id: r.event_time for r in backdate_every_nth(df).collect()}
    early = at("10:00") - timedelta(seconds=90)
    assert moved == {0: early, 1: at("10:00"), 49: at("10:00"), 50: early, 100: early}


@pytest.mark.parametrize("levels", [0, 1, 2, 3])
def test_max_before(spark, levels):
    rng = random.Random(levels)
    ids = rng.sample(range(200), 60)
    data = [(i, rng.choice([None, rng.randrange(1000)])) for i in ids]
    result = max_before(spark.createDataFrame(data, "id bigint, v int"), "id", "v", "m", width=5, levels=levels)
    expected = {i: max((v for j, v in data if j < i and v is not None), default=None) for i, _ in data}
    assert {r.id: r.m for r in result.collect()} == expected
    assert result.columns == ["id", "v", "m"]


def test_late_audit_against_a_replay(spark):
    rng = random.Random(5)
    size, delay, per_batch = timedelta(minutes=5), timedelta(minutes=1), 4
    start = at("10:00")
    events = [(i, start + timedelta(seconds=40 * i - rng.choice([0, 0, 0, 150, 600]))) for i in range(80)]
    expected, watermark, latest = {}, None, None
    for first in range(0, 80, per_batch):
        batch = events[first : first + per_batch]
        for number, time in batch:
            end = start + ((time - start) // size + 1) * size
            if watermark is not None and end <= watermark:
                expected[number] = "dropped"
            else:
                expected[number] = "late_kept" if watermark is not None and time < watermark else "on_time"
        latest = max([t for _, t in batch] + ([latest] if latest else []))
        watermark = latest - delay
    df = spark.createDataFrame(events, "event_id bigint, event_time timestamp_ntz")
    audit = late_event_audit(df, per_batch, "1 minute", "5 minutes")
    assert {r.event_id: r.status for r in audit.collect()} == expected
    assert set(expected.values()) == {"dropped", "late_kept", "on_time"}


def test_high_value_filter_reaches_the_scan(spark, small):
    from weirflow.sources.tables import read_table

    df = read_table(spark, small, "events").withColumnRenamed("value", "amount")
    plan = fraud.high_value(df.select("user_id", "amount"))._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThan(value,900.0)" in plan and "ReadSchema: struct<user_id:bigint,value:double>" in plan


def test_a_stream_does_not_claim_a_number_of_values(spark, tmp_path):
    from weirflow.operators.fraud import attribute_switch

    fields = "transaction_id long, user_id int, amount int, region string, event_time timestamp"
    stream = spark.readStream.schema(fields).json(str(tmp_path))
    assert "distinct_values" not in attribute_switch(stream).columns and "switched" in attribute_switch(stream).columns
    assert "distinct_values" in attribute_switch(stream, more_than=2).columns
