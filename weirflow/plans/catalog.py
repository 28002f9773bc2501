"""Queries over the stored tables, by name.

The stored orders are dated by the day over six years and the events over one month, so windows and gaps here
are in days and hours; the reports' own defaults are in seconds.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weirflow.functions.measures import total
from weirflow.functions.money import SCALE, in_units, steps
from weirflow.functions.payload import parse_csv_lines, parse_json_values, to_json_text, to_kafka_payload
from weirflow.functions.time import zoneless
from weirflow.operators import fraud
from weirflow.operators.enrich import add_product, add_region, price_report, price_sales
from weirflow.operators.late import backdate_every_nth, late_event_audit, late_event_counts
from weirflow.operators.product_mix import (
    product_session_fragments,
    product_slots,
    session_product_lists,
    session_product_mix,
    totals_from_slots,
)
from weirflow.plans import reports
from weirflow.session import configure, stored
from weirflow.sources.schemas import USER_ACTION, schema
from weirflow.sources.tables import (
    action_events,
    customer_lookup,
    product_lookup,
    read_table,
    region_steps,
    sales_events,
    transactions,
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

UNITS = (total("quantity", "product_units"),)
WINDOW, SLIDE_SIZE, SLIDE, GAP = "30 days", "28 days", "7 days", "30 days"
ACTION_GAP = "30 minutes"


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = lambda spark, root: build(configure(spark), root)
        return build

    return register


def sales(spark: SparkSession, root: str, how: str = "left") -> DataFrame:
    """Every line with its lookups. The region is joined to the orders, of which there are fewer than lines."""
    lines = regional_lines(spark, root, how)
    priced = price_sales(lines, product_lookup(spark, root), "product_name", "category", how=how)
    rest = [c for c in lines.columns if c != "region"]
    return priced.select(*rest, "region", "product_name", "category", "unit_price", "total_amount")


def order_lines(spark: SparkSession, root: str) -> DataFrame:
    return sales_events(read_table(spark, root, "lineitem"), read_table(spark, root, "orders"))


def regional_lines(spark: SparkSession, root: str, how: str = "left") -> DataFrame:
    """Order lines with the region of their order's customer."""
    orders = read_table(spark, root, "orders").withColumn("customer_id", F.col("o_custkey"))
    orders = add_region(orders, customer_lookup(spark, root), region_steps(spark, root), how)
    return sales_events(read_table(spark, root, "lineitem"), orders, None, "region")


def product_revenue(spark: SparkSession, root: str, size: str, slide: str | None = None) -> DataFrame:
    """Revenue and units per window, region and product. Units are summed first; the price follows from the product."""
    units = reports.product_units(regional_lines(spark, root), size, slide)
    return price_report(units, product_lookup(spark, root), "product_name", "category")


def priced_regional_lines(spark: SparkSession, root: str) -> DataFrame:
    """Order lines with region, price and category, for reports that do not name the product: their sums leave few rows to shuffle."""
    return price_sales(regional_lines(spark, root), product_lookup(spark, root), "category")


def dashboard(spark: SparkSession, root: str) -> DataFrame:
    return reports.sales_by_region_category(priced_regional_lines(spark, root), WINDOW)


def priced_lines(spark: SparkSession, root: str) -> DataFrame:
    return price_sales(order_lines(spark, root), product_lookup(spark, root))


def placed(df: DataFrame, root: str) -> DataFrame:
    """A report per customer with the customers' regions."""
    return add_region(df, customer_lookup(df.sparkSession, root), region_steps(df.sparkSession, root))


def named(df: DataFrame, root: str, *columns: str) -> DataFrame:
    """A report per product with columns of the products."""
    return add_product(df, product_lookup(df.sparkSession, root), *columns)


def kpis(spark: SparkSession, root: str) -> DataFrame:
    return placed(reports.session_kpis(priced_lines(spark, root), GAP), root)


def product_totals(spark: SparkSession, root: str) -> DataFrame:
    """Product totals per session. The lines are read once: their totals per slot are stored, and read twice."""
    slots = stored(product_slots(order_lines(spark, root), GAP, measures=UNITS), "product-slots")
    return price_report(totals_from_slots(slots, GAP, measures=UNITS), product_lookup(spark, root), "product_name", prefix="product_")


def product_mix(spark: SparkSession, root: str) -> DataFrame:
    return session_product_mix(product_totals(spark, root))


def actions(spark: SparkSession, root: str) -> DataFrame:
    return action_events(read_table(spark, root, "events"))


def card_transactions(spark: SparkSession, root: str) -> DataFrame:
    return transactions(read_table(spark, root, "events"))


@query("enrich_sales")
def enrich_sales_left(spark, root):
    return in_units(sales(spark, root), "unit_price", "total_amount")


@query("enrich_sales_inner")
def enrich_sales_inner(spark, root):
    return in_units(sales(spark, root, "inner"), "unit_price", "total_amount")


@query("tumbling_sales_by_region_category")
def tumbling_sales_by_region_category(spark, root):
    return in_units(dashboard(spark, root).orderBy("window_start", "region", "category"), "revenue")


@query("dashboard_first_rows")
def dashboard_first_rows(spark, root):
    """The 40 rows a console prints of the dashboard."""
    return in_units(dashboard(spark, root).orderBy("window_start", "region", "category").limit(40), "revenue")


@query("tumbling_count_by_action")
def tumbling_count_by_action(spark, root):
    return reports.action_counts(actions(spark, root), "1 hour")


@query("tumbling_count")
def tumbling_count(spark, root):
    return reports.event_counts(actions(spark, root), "1 hour")


@query("tumbling_total_by_region")
def tumbling_total_by_region(spark, root):
    return in_units(reports.region_totals(priced_regional_lines(spark, root), WINDOW, amount="total_amount"), "total_sales")


@query("tumbling_product_revenue")
def tumbling_product_revenue(spark, root):
    return in_units(product_revenue(spark, root, WINDOW), "revenue")


@query("sliding_product_revenue")
def sliding_product_revenue(spark, root):
    return in_units(product_revenue(spark, root, SLIDE_SIZE, SLIDE), "revenue")


@query("topn_products_tumbling")
def topn_products_tumbling(spark, root):
    best = reports.top_products(product_revenue(spark, root, WINDOW))
    return in_units(reports.ranking_order(best), "revenue")


@query("topn_products_sliding")
def topn_products_sliding(spark, root):
    best = reports.top_products(product_revenue(spark, root, SLIDE_SIZE, SLIDE))
    return in_units(reports.ranking_order(best, newest_first=True), "revenue")


@query("session_amount_by_user")
def session_amount_by_user(spark, root):
    return in_units(reports.user_session_amounts(actions(spark, root), ACTION_GAP, amount="steps"), "session_amount")


@query("session_kpis")
def session_kpis(spark, root):
    return in_units(kpis(spark, root), "session_revenue")


@query("session_spend_metrics")
def session_spend_metrics(spark, root):
    return in_units(placed(reports.session_spend(priced_lines(spark, root), GAP), root), "avg_spend")


@query("session_order_revenue")
def session_order_revenue(spark, root):
    """Sessions of order-amount events: one event per order."""
    orders = read_table(spark, root, "orders").select(
        F.col("o_orderdate").alias("event_time"),
        F.col("o_custkey").alias("customer_id"),
        steps("o_totalprice").alias("amount"),
        F.col("o_orderpriority").alias("region"),
    )
    return in_units(reports.order_sessions(orders, GAP), "session_revenue")


@query("top_sessions_by_region")
def top_sessions_by_region(spark, root):
    return in_units(reports.top_sessions(kpis(spark, root), sort=True), "session_revenue")


@query("top_sessions_exact_interval")
def top_sessions_exact_interval(spark, root):
    interval = ("session_start", "session_end", "region")
    best = reports.top_sessions(kpis(spark, root), within=interval, sort=True)
    return in_units(best, "session_revenue")


@query("avg_session_duration_by_region")
def avg_session_duration_by_region(spark, root):
    return reports.average_session_duration(placed(reports.customer_sessions(order_lines(spark, root), GAP), root))


@query("session_product_totals")
def session_product_totals_all(spark, root):
    return in_units(placed(product_totals(spark, root), root), "product_revenue")


@query("session_product_mix")
def session_product_mix_top5(spark, root):
    return in_units(placed(product_mix(spark, root), root), "product_revenue")


@query("session_product_mix_json")
def session_product_mix_json(spark, root):
    mix = product_mix(spark, root)
    units = (F.col("product_revenue") / SCALE).cast("decimal(18,2)")
    lists = placed(session_product_lists(mix.withColumn("product_revenue", units)), root)
    return to_json_text(lists, "top_products", "top_products_json")


@query("session_product_fragments")
def session_product_fragments(spark, root):
    fragments = product_session_fragments(priced_lines(spark, root), GAP)
    return in_units(placed(named(fragments, root, "product_name"), root), "product_revenue")


@query("fraud_high_value")
def fraud_high_value(spark, root):
    return fraud.high_value(card_transactions(spark, root), 200)


@query("fraud_burst")
def fraud_burst(spark, root):
    return fraud.burst_activity(card_transactions(spark, root), 2, "6 hours", reason="Burst Activity > 2 txns/6 h")


@query("fraud_attribute_switch")
def fraud_attribute_switch(spark, root):
    return fraud.attribute_switch(card_transactions(spark, root), gap=ACTION_GAP)


def alert_rules(tx: DataFrame) -> DataFrame:
    return fraud.fraud_alerts(
        fraud.high_value(tx, 200),
        fraud.burst_activity(tx, 2, "6 hours", reason="Burst Activity > 2 txns/6 h"),
        fraud.attribute_switch(tx, gap=ACTION_GAP),
    )


@query("fraud_alerts")
def fraud_alerts(spark, root):
    return alert_rules(card_transactions(spark, root))


def backdated(spark: SparkSession, root: str) -> DataFrame:
    return backdate_every_nth(actions(spark, root), 50, "90 minutes")


@query("late_events_backdated")
def late_events_backdated(spark, root):
    return backdated(spark, root).drop("steps")


@query("late_event_audit")
def late_event_status(spark, root):
    audit = late_event_audit(backdated(spark, root), 100, "30 minutes", "1 hour")
    return audit.select("event_id", "event_time", "batch_id", "window_end", "watermark", "status")


@query("late_event_counts")
def late_event_summary(spark, root):
    return late_event_counts(late_event_audit(backdated(spark, root), 100, "30 minutes", "1 hour"))


def event_lines(events: DataFrame) -> DataFrame:
    """The events, a table or a stream, as comma-separated lines. Every 97th has a time and an amount that cannot be read, every
    101st stops after the user."""
    user = F.col("user_id").cast("string")
    damaged = F.col("event_id") % 97 == 0
    time = F.when(damaged, "xx").otherwise(F.date_format("ts", "yyyy-MM-dd HH:mm:ss"))
    amount = F.when(damaged, "zz").otherwise(F.floor("value").cast("string"))
    line = F.concat_ws(",", user, time, "event_type", amount)
    return events.select(F.when(F.col("event_id") % 101 == 0, user).otherwise(line).alias("value"))


@query("parse_event_lines")
def parse_event_lines(spark, root):
    return zoneless(parse_csv_lines(event_lines(read_table(spark, root, "events")), USER_ACTION))


@query("parse_event_json")
def parse_event_json(spark, root):
    """The ``props`` of each event, parsed from their bytes as a Kafka value would be."""
    messages = read_table(spark, root, "events").select(F.col("props").cast("binary").alias("value"))
    return parse_json_values(messages, schema("k int"))


@query("kafka_payload")
def kafka_payload(spark, root):
    events = read_table(spark, root, "events").select("event_id", "user_id", "event_type")
    return to_kafka_payload(events, ["user_id", "event_id"])
