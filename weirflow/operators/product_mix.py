"""What was bought inside each customer session.

``sales`` are priced sales events. Products go by their id; names and the customer's region can be added to
the result with :mod:`weirflow.operators.enrich`.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weirflow.functions.measures import Measure, total
from weirflow.functions.time import interval
from weirflow.operators.rank import by_sales, first_n
from weirflow.operators.sessions import join_slots, session_agg, slot_sessions, with_sessions
from weirflow.operators.windows import with_watermark

SESSION_KEYS = ("customer_id",)
TOTALS = (total("quantity", "product_units"), total("total_amount", "product_revenue"))


def session_product_totals(sales: DataFrame, gap: str = "30 seconds", keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """Units and revenue per product within each session of a batch table.

    Sessions are those of the customer: buying another product does not start a new one.
    """
    return (
        with_sessions(sales, keys, gap)
        .groupBy("session_start", "session_end", *keys, "product_id")
        .agg(*[m.start for m in TOTALS])
    )


def product_slots(
    sales: DataFrame,
    gap: str = "30 seconds",
    watermark: str = "2 minutes",
    keys: Sequence[str] = SESSION_KEYS,
    measures: Sequence[Measure] = TOTALS,
) -> DataFrame:
    """Product totals per customer and time slot of length ``gap``, of a table or of a stream in append mode.

    The slots are stored; :func:`totals_from_slots` turns the stored table into product totals per session.
    The state holds open slots only and no list that could grow with a busy customer.
    """
    return (
        with_watermark(sales, "event_time", watermark)
        .groupBy(F.window("event_time", gap).alias("w"), *keys, "product_id")
        .agg(
            F.min("event_time").alias("_first"),
            F.max("event_time").alias("_last"),
            *[m.start for m in measures],
        )
        .select(F.col("w.start").alias("_slot"), *keys, "product_id", "_first", "_last", *[m.name for m in measures])
    )


def totals_from_slots(
    slots: DataFrame,
    gap: str = "30 seconds",
    keys: Sequence[str] = SESSION_KEYS,
    measures: Sequence[Measure] = TOTALS,
    keep: Callable[[DataFrame, str], DataFrame] = lambda table, purpose: table,
) -> DataFrame:
    """Product totals per session from a stored table of :func:`product_slots`.

    ``keep(table, purpose)`` can store what stands between two steps, so the shuffle files of the first need not lie beside those of the next.
    """
    spans = slots.groupBy(*keys, "_slot").agg(F.min("_first").alias("_first"), F.max("_last").alias("_last"))
    sessions = keep(slot_sessions(spans, keys, gap), "sessions")
    lines = keep(join_slots(slots.drop("_first", "_last"), sessions, keys), "session-slots")
    return lines.groupBy("session_start", "session_end", *keys, "product_id").agg(*[m.merge for m in measures])


def closed_only(sessions: DataFrame, slots: DataFrame, gap: str = "30 seconds") -> DataFrame:
    """Sessions that ended before the stored slots do.

    One that ends just there may still grow: an event a whole gap after the last one belongs to its session.
    """
    closed_until = slots.agg(F.max("_slot") + interval(gap)).scalar()
    return sessions.filter(F.col("session_end") < closed_until)


def session_product_mix(totals: DataFrame, k: int = 5, keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """The ``k`` best-selling products of each session, one row each with its position.

    Equal revenue and units fall to the id, descending.
    """
    order = [*by_sales("product_revenue", "product_units"), F.col("product_id").desc()]
    return first_n(totals, ["session_start", "session_end", *keys], order, k)


def session_product_lists(mix: DataFrame, keys: Sequence[str] = SESSION_KEYS) -> DataFrame:
    """One row per session with its products as an array of structs (r, u, n), best first.

    ``mix`` is the output of :func:`session_product_mix` with product names, so an array has at most the k
    entries it was cut to.
    """
    item = F.struct(
        "position",
        F.col("product_revenue").alias("r"),
        F.col("product_units").alias("u"),
        F.col("product_name").alias("n"),
    )
    best_first = F.sort_array(F.collect_list(item))
    shown = F.transform(best_first, lambda x: F.struct(x["r"].alias("r"), x["u"].alias("u"), x["n"].alias("n")))
    return mix.groupBy("session_start", "session_end", *keys).agg(shown.alias("top_products"))


def product_session_fragments(
    sales: DataFrame,
    gap: str = "30 seconds",
    watermark: str | None = None,
    keys: Sequence[str] = SESSION_KEYS,
) -> DataFrame:
    """Sessions of each customer *and product*: a session here ends when that product is not bought again."""
    return session_agg(sales, [*keys, "product_id"], TOTALS, gap, watermark)
