"""The reports: operators put together with their usual parameters.

Each takes enriched sales (or actions) as a batch table or a stream. A column that a lookup determines, such as
the region of a customer or the name of a product, is best added to the finished report. ``sort`` gives the
order the report is read in; a stream can be sorted in complete mode only.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions.measures import row_count, total, value_count
from weirflow.functions.time import epoch_seconds
from weirflow.operators.rank import by_sales, top_n
from weirflow.operators.sessions import session_agg
from weirflow.operators.windows import sliding_agg, sliding_from_panes, tumbling_agg

SALES = (total("total_amount", "revenue"), total("quantity", "units"))
PRODUCT_KEYS = ("region", "product_id")


def sales_by_region_category(
    sales: DataFrame, size: str = "10 seconds", watermark: str = "30 seconds", sort: bool = False
) -> DataFrame:
    """The sales dashboard: revenue and units per window, region and category."""
    table = tumbling_agg(sales, ["region", "category"], SALES, size, watermark)
    return table.orderBy("window_start", "region", "category") if sort else table


def product_revenue(
    sales: DataFrame, size: str = "1 minute", slide: str | None = None, watermark: str = "30 seconds"
) -> DataFrame:
    """Revenue and units per window, region and product id."""
    if slide is None:
        return tumbling_agg(sales, PRODUCT_KEYS, SALES, size, watermark)
    return sliding_agg(sales, PRODUCT_KEYS, SALES, size, slide, watermark)


def product_units(sales: DataFrame, size: str = "1 minute", slide: str | None = None, watermark: str = "30 seconds") -> DataFrame:
    """Units per window, region and product id, of sales that need no price yet. They are dealt out for the price's join."""
    if slide is None:
        return tumbling_agg(sales, PRODUCT_KEYS, SALES[1:], size, watermark)
    return sliding_agg(sales, PRODUCT_KEYS, SALES[1:], size, slide, watermark, by=["product_id"])


def product_revenue_from_panes(panes: DataFrame, size: str = "1 minute", slide: str = "10 seconds") -> DataFrame:
    """Sliding product revenue from a finished :func:`product_revenue` table with windows of one slide.

    A stream that keeps those totals holds each event in one window and not in ``size / slide`` of them.
    """
    return sliding_from_panes(panes, PRODUCT_KEYS, SALES, size, slide)


def top_products(revenue: DataFrame, n: int = 5) -> DataFrame:
    """The best-selling products of each window and region, from a finished :func:`product_revenue` table."""
    return top_n(revenue, ["window_start", "region"], by_sales(), n)


def ranking_order(best: DataFrame, newest_first: bool = False) -> DataFrame:
    """Top-N rows in reading order: by window, region and rank."""
    start = F.col("window_start")
    return best.orderBy(start.desc() if newest_first else start.asc(), "region", "rank")


def session_kpis(
    sales: DataFrame,
    gap: str = "30 seconds",
    watermark: str = "2 minutes",
    keys: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Events, units and revenue of each customer session."""
    measures = (row_count("events_count"), total("quantity", "units"), total("total_amount", "session_revenue"))
    kpis = session_agg(sales, keys, measures, gap, watermark)
    return kpis.withColumn("session_revenue", F.round("session_revenue", 2))


def session_spend(
    sales: DataFrame,
    gap: str = "30 seconds",
    watermark: str = "2 minutes",
    keys: Sequence[str] = ("customer_id",),
) -> DataFrame:
    """Average line amount and number of items of each customer session."""
    measures = (
        total("total_amount", "spend"),
        value_count("total_amount", "priced_lines"),
        total("quantity", "total_items"),
    )
    totals = session_agg(sales, keys, measures, gap, watermark)
    average = F.col("spend").cast("double") / F.col("priced_lines")
    return totals.select("session_start", "session_end", *keys, average.alias("avg_spend"), "total_items")


def top_sessions(kpis: DataFrame, n: int = 5, within: Sequence[str] = ("region",), sort: bool = False) -> DataFrame:
    """The sessions with the highest revenue.

    By default within each region. Within ``("session_start", "session_end", "region")`` only sessions over
    exactly the same interval compete.
    """
    best = top_n(kpis, within, by_sales("session_revenue"), n).select(
        "session_start", "session_end", "region", "customer_id", "rank", "session_revenue", "units", "events_count"
    )
    return best.orderBy("session_start", "region", "rank") if sort else best


def customer_sessions(events: DataFrame, gap: str = "30 seconds", watermark: str = "2 minutes") -> DataFrame:
    """Start, end and number of events of each customer session."""
    return session_agg(events, ["customer_id"], [row_count("events_count")], gap, watermark)


def average_session_duration(sessions: DataFrame) -> DataFrame:
    """Mean session length per region in seconds."""
    seconds = epoch_seconds(F.col("session_end")) - epoch_seconds(F.col("session_start"))
    return sessions.groupBy("region").agg(F.avg(seconds).alias("avg_session_s"))


def action_counts(actions: DataFrame, size: str = "5 minutes", watermark: str = "5 minutes") -> DataFrame:
    return tumbling_agg(actions, ["action"], [row_count("count")], size, watermark)


def event_counts(actions: DataFrame, size: str = "1 minute", watermark: str = "5 minutes") -> DataFrame:
    return tumbling_agg(actions, [], [row_count("count")], size, watermark)


def region_totals(
    sales: DataFrame, size: str = "15 minutes", watermark: str = "10 minutes", amount: str = "amount"
) -> DataFrame:
    return tumbling_agg(sales, ["region"], [total(amount, "total_sales")], size, watermark)


def user_session_amounts(
    actions: DataFrame, gap: str = "15 minutes", watermark: str = "30 minutes", amount: str = "amount"
) -> DataFrame:
    return session_agg(actions, ["user_id"], [total(amount, "session_amount")], gap, watermark)


def order_sessions(orders: DataFrame, gap: str = "30 seconds", watermark: str = "1 minute") -> DataFrame:
    """Sessions of order-amount events: number of events and revenue per customer and region."""
    measures = (row_count("event_count"), total("amount", "session_revenue"))
    return session_agg(orders, ["customer_id", "region"], measures, gap, watermark)
