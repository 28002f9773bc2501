from collections import defaultdict
from datetime import timedelta

from helpers import at, order, rows
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from weirflow.functions.measures import row_count, total
from weirflow.functions.time import flat_span
from weirflow.operators.product_mix import (
    closed_only,
    product_session_fragments,
    product_slots,
    session_product_lists,
    session_product_mix,
    session_product_totals,
    totals_from_slots,
)
from weirflow.operators.sessions import session_agg, with_sessions
from weirflow.plans.reports import average_session_duration, session_kpis, session_spend, top_sessions

SCHEMA = "event_time timestamp_ntz, k string, v bigint"
MEASURES = (row_count("n"), total("v", "v"))
GAP = timedelta(minutes=15)
slow = settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))

# Times that often lie exactly one gap, or a microsecond more or less, apart.
times = st.tuples(st.integers(0, 12), st.sampled_from([-1, 0, 0, 0, 1, 300_000_000])).map(
    lambda p: at("08:00") + GAP * p[0] + timedelta(microseconds=p[1])
)
events_strategy = st.lists(
    st.tuples(st.one_of(st.none(), times), st.sampled_from(["a", "b", None]), st.integers(0, 9)), max_size=30
)


def brute_force(events):
    """Each event with the start and end of its session."""
    by_key = defaultdict(list)
    for event in events:
        if event[0] is not None:
            by_key[event[1]].append(event)
    out = []
    for group in by_key.values():
        group.sort(key=lambda e: e[0])
        sessions = []
        for event in group:
            if sessions and event[0] - sessions[-1][-1][0] <= GAP:
                sessions[-1].append(event)
            else:
                sessions.append([event])
        for session in sessions:
            out += [(session[0][0], session[-1][0] + GAP, *event) for event in session]
    return out


@slow
@given(events_strategy)
def test_sessions_against_brute_force(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    expected = brute_force(events)
    assert rows(with_sessions(df, ["k"], "15 minutes")) == sorted(expected, key=order)

    totals = defaultdict(lambda: [0, 0])
    for start, end, _, key, value in expected:
        totals[start, end, key][0] += 1
        totals[start, end, key][1] += value
    assert rows(session_agg(df, ["k"], MEASURES, "15 minutes")) == sorted(
        ((*key, *sums) for key, sums in totals.items()), key=order
    )


@slow
@given(events_strategy)
def test_sessions_against_session_window(spark, events):
    df = spark.createDataFrame(events, SCHEMA)
    native = (
        df.groupBy(F.session_window("event_time", "15 minutes").alias("s"), "k")
        .agg(*[m.start for m in MEASURES])
    )
    assert rows(session_agg(df, ["k"], MEASURES, "15 minutes")) == rows(flat_span(native, "s", "session"))


def test_gap_of_exactly_the_limit_merges(spark):
    clicks = ["10:01", "10:05", "10:20"]
    df = spark.createDataFrame([(at(c), "u", 1) for c in clicks], SCHEMA)
    assert rows(session_agg(df, ["k"], MEASURES, "15 minutes")) == [(at("10:01"), at("10:35"), "u", 3, 3)]

    later = df.filter(F.col("event_time") < at("10:20")).union(
        spark.createDataFrame([(at("10:20") + timedelta(microseconds=1), "u", 1)], SCHEMA)
    )
    assert rows(session_agg(later, ["k"], MEASURES, "15 minutes")) == sorted(
        [
            (at("10:01"), at("10:20"), "u", 2, 2),
            (at("10:20") + timedelta(microseconds=1), at("10:35") + timedelta(microseconds=1), "u", 1, 1),
        ],
        key=order,
    )


def test_busy_key_is_totalled_before_it_is_ordered(spark):
    """Only slots reach the window by key: the shuffle by key and slot comes first."""
    df = spark.range(1000).select(
        F.timestamp_seconds(F.col("id") * 60).cast("timestamp_ntz").alias("event_time"),
        F.lit("hot").alias("k"),
        F.col("id").alias("v"),
    )
    assert rows(session_agg(df, ["k"], MEASURES, "15 minutes"))[0][3:] == (1000, 499500)
    plan = session_agg(df, ["k"], MEASURES, "15 minutes")._jdf.queryExecution().executedPlan().toString()
    assert plan.index("Window") < plan.rindex("_slot") and "partial_count" in plan
    assert "MergingSessions" not in plan


SALES = "event_time timestamp_ntz, customer_id int, region string, product_id int, quantity int, total_amount bigint"


def sales(spark):
    return spark.createDataFrame(
        [
            (at("10:00"), 1, "East", 11, 1, 100),
            (at("10:10"), 1, "East", 12, 2, 300),
            (at("10:20"), 1, "East", 11, 1, 100),
            (at("10:20"), 1, "East", 13, 5, 200),
            (at("11:30"), 1, "East", 11, 1, 100),
            (at("10:00"), 2, "West", 12, 1, 150),
        ],
        SALES,
    )


def test_product_totals_follow_the_customer_session(spark):
    totals = session_product_totals(sales(spark), "15 minutes")
    assert rows(totals) == sorted(
        [
            (at("10:00"), at("10:35"), 1, 11, 2, 200),
            (at("10:00"), at("10:35"), 1, 12, 2, 300),
            (at("10:00"), at("10:35"), 1, 13, 5, 200),
            (at("11:30"), at("11:45"), 1, 11, 1, 100),
            (at("10:00"), at("10:15"), 2, 12, 1, 150),
        ],
        key=order,
    )
    # Product 11 is bought at 10:00 and 10:20, which is more than a gap apart for the product alone.
    assert product_session_fragments(sales(spark), "15 minutes").count() == 6


def test_a_session_that_ends_with_the_slots_is_still_open(spark):
    start = at("10:00")
    events = [(start, 1, "East", 11, 1, 100), (start + timedelta(seconds=30), 1, "East", 11, 1, 100)]
    first, both = (spark.createDataFrame(events[:n], SALES) for n in (1, 2))
    slots = product_slots(first, "30 seconds")
    assert closed_only(totals_from_slots(slots, "30 seconds"), slots, "30 seconds").count() == 0
    assert [r[:2] for r in rows(session_product_totals(both, "30 seconds"))] == [(start, start + timedelta(seconds=60))]


def test_totals_from_slots_agree(spark):
    slots = product_slots(sales(spark), "15 minutes")
    assert rows(totals_from_slots(slots, "15 minutes")) == rows(session_product_totals(sales(spark), "15 minutes"))


def test_mix_order_and_lists(spark):
    mix = session_product_mix(session_product_totals(sales(spark), "15 minutes"), 2)
    first = mix.filter("customer_id = 1 and session_start < timestamp_ntz'2025-08-16 11:00:00'")
    assert [(r.product_id, r.position) for r in first.orderBy("position").collect()] == [(12, 1), (13, 2)]

    named = mix.withColumn("product_name", F.concat(F.lit("p"), "product_id"))
    lists = {(r.session_start, r.customer_id): r.top_products for r in session_product_lists(named).collect()}
    assert [tuple(p) for p in lists[at("10:00"), 1]] == [(300, 2, "p12"), (200, 5, "p13")]


def test_kpis_spend_and_duration(spark):
    kpis = session_kpis(sales(spark), "15 minutes", keys=("customer_id", "region"))
    assert rows(kpis) == sorted(
        [
            (at("10:00"), at("10:35"), 1, "East", 4, 9, 700),
            (at("11:30"), at("11:45"), 1, "East", 1, 1, 100),
            (at("10:00"), at("10:15"), 2, "West", 1, 1, 150),
        ],
        key=order,
    )
    assert rows(average_session_duration(kpis)) == [("East", (35 + 15) * 60 / 2), ("West", 900.0)]
    spend = session_spend(sales(spark), "15 minutes")
    assert (at("10:00"), at("10:35"), 1, 175.0, 9) in rows(spend)


def test_top_sessions_within_region_or_interval(spark):
    kpis = session_kpis(sales(spark), "15 minutes", keys=("customer_id", "region"))
    assert [(r.region, r.session_revenue) for r in top_sessions(kpis, 1, sort=True).collect()] == [
        ("East", 700), ("West", 150),
    ]
    assert top_sessions(kpis, 1, within=("session_start", "session_end", "region")).count() == 3
