"""The reports as streaming queries over the stored tables.

Each runs over what the tables hold, stops, and returns what its sink kept. Checkpoints and results live
below ``spark.checkpoint.dir``; nothing is gathered in the driver.
"""

from __future__ import annotations

from collections import defaultdict
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weirflow.functions.measures import highest, lowest, row_count, total
from weirflow.functions.money import in_units, steps
from weirflow.functions.payload import parse_csv_lines, parse_json_values
from weirflow.functions.time import event_clock, zoneless
from weirflow.operators.enrich import ROW, add_region, hot_keys_of, price_sales
from weirflow.operators.late import backdate_every_nth
from weirflow.operators.product_mix import closed_only, product_slots, session_product_mix, totals_from_slots
from weirflow.operators.rank import by_sales, top_n
from weirflow.operators.sessions import durations_by_window, session_agg
from weirflow.operators.windows import open_panes
from weirflow.plans import reports
from weirflow.plans.catalog import (
    ACTION_GAP,
    GAP,
    SLIDE,
    SLIDE_SIZE,
    WINDOW,
    alert_rules,
    event_lines,
    named,
    placed,
    query,
)
from weirflow.session import files_of, passing, remove, stored, stored_meanwhile, work_dir
from weirflow.sources.bucketed import bucketed
from weirflow.sources.schemas import ORDER_AMOUNT, USER_ACTION, USER_CLICK
from weirflow.sources.streams import json_folder
from weirflow.sources.tables import (
    action_events,
    customer_lookup,
    product_lookup,
    read_table,
    region_steps,
    sales_events,
    stream_table,
    transactions,
)
from weirflow.streaming.hot import HotKeys, enriched_writer
from weirflow.streaming.runner import run_stream, state_sizes
from weirflow.streaming.stores import (
    Shape,
    changes_writer,
    fan_out,
    leaderboard_writer,
    read_latest_changes,
    read_leaderboard,
    read_snapshot,
    snapshot_writer,
)


def hot_sale_keys(spark: SparkSession, root: str, *tables: str) -> dict[str, DataFrame]:
    """The hot keys of each join of the sales stream, as far as there are any in the tables."""
    names = {"l_orderkey": "l_orderkey", "l_partkey": "product_id", "o_custkey": "customer_id"}
    columns = {"lineitem": ["l_orderkey", "l_partkey"], "orders": ["o_custkey"]}
    # Each table is read once.
    found = [hot_keys_of(read_table(spark, root, table), columns[table]) for table in tables or columns]
    # At most 500 keys of each kind, by the default share of hot_keys.
    keys = defaultdict(list)
    for row in reduce(DataFrame.unionAll, found).collect():
        keys[names[row.name]].append((row.hot,))
    return {name: spark.createDataFrame(rows, f"{name} bigint") for name, rows in keys.items()}


def arriving_lines(spark: SparkSession, root: str, parts: int = 2) -> DataFrame:
    """The order lines as a stream of ``parts`` micro-batches, in the order of their orders' dates.

    The stored lines are in no order of time. Each part holds the lines of an equal stretch of time, in as many files as a
    micro-batch takes in, and its files are younger than those of the part before.
    """
    orders = read_table(spark, root, "orders")
    ends = orders.agg(F.min("o_orderdate"), F.max("o_orderdate")).first()
    dates = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_orderdate")
    if ends[0] is None:
        part = F.lit(0)
    else:
        length = max((ends[1] - ends[0]).total_seconds(), 1)
        since = (F.unix_micros(F.col("o_orderdate").cast("timestamp")) - F.unix_micros(F.lit(ends[0]).cast("timestamp"))) / 1e6
        part = F.least(F.floor(since * parts / length), F.lit(parts - 1))
    lines = read_table(spark, root, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity")
    dated = lines.join(dates, "l_orderkey", "left").withColumn("part", F.coalesce(part, F.lit(0))).drop("o_orderdate")
    files, folder = int(spark.conf.get("spark.sql.shuffle.partitions")), work_dir(spark, "lines")
    for i in range(parts):
        # Written as they come out of the join: lines of an order stay together, and neither a copy nor a second shuffle is kept.
        arrived = dated.where(F.col("part") == i).select(*lines.columns).coalesce(files)
        with passing(spark):
            arrived.write.mode("append").option("compression", "zstd").parquet(folder)
        fill_up(spark, folder, lines.schema, (i + 1) * files)
    return spark.readStream.schema(lines.schema).option("maxFilesPerTrigger", files).option("cleanSource", "delete").parquet(folder)


def fill_up(spark: SparkSession, folder: str, schema: T.StructType, wanted: int) -> None:
    """Add files without rows to a folder until it holds ``wanted`` of them, so a micro-batch of so many files takes in no rows that come later."""
    files, where = files_of(spark, folder)
    there = sum(s.isFile() and not s.getPath().getName().startswith(("_", ".")) for s in files.listStatus(where))
    if there < wanted:
        empty = work_dir(spark, "no-lines")
        spark.createDataFrame([], schema).coalesce(1).write.parquet(empty)
        source = next(s.getPath() for s in files.listStatus(files_of(spark, empty)[1]) if s.getPath().getName().startswith("part-"))
        for k in range(there, wanted):
            target = files_of(spark, f"{folder}/none-{k:06d}.parquet")[1]
            spark._jvm.org.apache.hadoop.fs.FileUtil.copy(files, source, files, target, False, spark._jsc.hadoopConfiguration())


def placed_orders(spark: SparkSession, root: str, how: str | None = None) -> DataFrame:
    """The orders as the static side of a stream of lines, in buckets of the order key.

    With ``how`` they know the region of their customer, so a micro-batch joins neither customers nor nations.
    """
    orders = read_table(spark, root, "orders")
    columns = ["o_orderkey", "o_orderdate", "o_custkey"]
    if how is not None:
        orders = add_region(orders.withColumn("customer_id", F.col("o_custkey")), customer_lookup(spark, root), region_steps(spark, root), how)
        columns.append("region")
    return bucketed(orders.select(*columns), "o_orderkey", "orders")


def line_stream(spark: SparkSession, root: str, hot: dict[str, DataFrame], how: str | None = None) -> DataFrame:
    """Order lines as a stream, joined with the orders as a static table; with ``how`` also with the region of their customer."""
    hot_orders = hot.get("l_orderkey")
    if hot and hot_orders is None:
        hot_orders = spark.createDataFrame([], "l_orderkey bigint")
    region = [] if how is None else ["region"]
    return sales_events(arriving_lines(spark, root), placed_orders(spark, root, how), hot_orders, *region)


def sales_stream(spark: SparkSession, root: str, how: str = "left", backdate: str | None = None) -> DataFrame:
    """The stream of order lines with the lookups; every 50th product's lines can be moved back in time."""
    hot = hot_sale_keys(spark, root, "lineitem")
    events = line_stream(spark, root, hot, how)
    if backdate is not None:
        events = backdate_every_nth(events, delay=backdate, sequence="product_id")
    names = ("product_name", "category")
    priced = price_sales(events, product_lookup(spark, root), *names, how=how, hot=hot.get("product_id"))
    return priced.select("event_time", "customer_id", "product_id", "quantity", "region", *names, "unit_price", "total_amount")


def priced_stream(spark: SparkSession, root: str) -> DataFrame:
    hot = hot_sale_keys(spark, root, "lineitem")
    return price_sales(line_stream(spark, root, hot), product_lookup(spark, root), hot=hot.get("product_id")).drop(ROW)


def action_stream(spark: SparkSession, root: str) -> DataFrame:
    return action_events(stream_table(spark, root, "events"))


def to_the_end(df: DataFrame, mode: str, sink: str, out: str, **options) -> None:
    """Run over what the source holds, with the checkpoint below ``out`` and the state on disk. No query here reads the metrics."""
    run_stream(df, mode, sink, checkpoint=f"{out}/checkpoint", available_now=True, rocksdb=True, count_state=False, **options)


def appended(df: DataFrame, purpose: str, out: str | None = None) -> DataFrame:
    """Run to the end in append mode and read the Parquet files back, from below ``out`` if a folder is given. The checkpoint goes."""
    out = out or work_dir(df.sparkSession, purpose)
    to_the_end(df, "append", "batch", out, on_batch=changes_writer(f"{out}/rows"))
    remove(df.sparkSession, f"{out}/checkpoint")
    return zoneless(df.sparkSession.read.schema(df.schema).parquet(f"{out}/rows/epoch_id=*"))


def snapshot(df: DataFrame, purpose: str, shape: Shape | None = None, view: str | None = None) -> DataFrame:
    """Run to the end in complete mode and read the last snapshot."""
    out = work_dir(df.sparkSession, purpose)
    to_the_end(df, "complete", "batch", out, on_batch=snapshot_writer(f"{out}/rows", shape, view))
    return zoneless(read_snapshot(df.sparkSession, f"{out}/rows"))


def latest(df: DataFrame, purpose: str, keys: list[str]) -> DataFrame:
    """Run to the end in update mode and keep the last row of each key."""
    out = work_dir(df.sparkSession, purpose)
    to_the_end(df, "update", "batch", out, on_batch=changes_writer(f"{out}/rows", keys=keys))
    return zoneless(read_latest_changes(df.sparkSession, f"{out}/rows", keys))


@query("stream_tumbling_complete")
def stream_tumbling_complete(spark, root):
    return snapshot(reports.action_counts(action_stream(spark, root), "1 hour", "30 minutes"), "counts")


@query("stream_tumbling_append")
def stream_tumbling_append(spark, root):
    return appended(reports.action_counts(action_stream(spark, root), "1 hour", "30 minutes"), "counts")


@query("stream_tumbling_update")
def stream_tumbling_update(spark, root):
    counts = reports.action_counts(action_stream(spark, root), "1 hour", "30 minutes")
    return latest(counts, "counts", ["window_start", "window_end", "action"])


@query("stream_session_append")
def stream_session_append(spark, root):
    sessions = reports.user_session_amounts(action_stream(spark, root), ACTION_GAP, "30 minutes", "steps")
    return in_units(appended(sessions, "sessions"), "session_amount")


@query("stream_sales_dashboard")
def stream_sales_dashboard(spark, root):
    """The dashboard in update mode: the watermark ends a window's state, the store keeps its last row."""
    table = reports.sales_by_region_category(sales_stream(spark, root), WINDOW, "30 days")
    last = latest(table, "dashboard", ["window_start", "window_end", "region", "category"])
    return in_units(last, "revenue").orderBy("window_start", "region", "category")


@query("stream_topn_tumbling")
def stream_topn_tumbling(spark, root):
    """Revenue is kept per window in update mode; the store of it is ranked when it is read."""
    revenue = reports.product_revenue(sales_stream(spark, root), WINDOW, watermark="30 days")
    last = latest(revenue, "topn", ["window_start", "window_end", "region", "product_id"])
    best = named(reports.top_products(last), root, "product_name", "category")
    return in_units(reports.ranking_order(best), "revenue")


@query("stream_topn_snapshot")
def stream_topn_snapshot(spark, root):
    """Revenue is kept per slide in complete mode; each snapshot is ranked, and read through its view."""
    revenue = reports.product_revenue(sales_stream(spark, root), SLIDE, watermark="30 days")

    def ranked(batch: DataFrame) -> DataFrame:
        best = reports.top_products(reports.product_revenue_from_panes(batch, SLIDE_SIZE, SLIDE))
        return named(best, root, "product_name", "category")

    snapshot(revenue, "topn", ranked, "topn_sliding_live")
    best = zoneless(spark.table("global_temp.topn_sliding_live"))
    return in_units(reports.ranking_order(best, newest_first=True), "revenue")


@query("stream_batch_rows")
def stream_batch_rows(spark, root):
    """The number of rows of each snapshot, as its writer reports them."""
    out, seen = work_dir(spark, "rows"), []
    write = snapshot_writer(f"{out}/rows", report=lambda *batch: seen.append(batch))
    to_the_end(reports.action_counts(action_stream(spark, root), "1 hour"), "complete", "batch", out, on_batch=write)
    return spark.createDataFrame(seen, "batch_id bigint, n_rows bigint")


@query("stream_late_counts")
def stream_late_counts(spark, root):
    """Hourly counts of events that arrive in four parts, some of them too late.

    The events come by their ids, every 50th moved back in time. After each part the query stops, and it resumes from
    its checkpoint when the next has come. What the watermark has passed is dropped.
    """
    out = work_dir(spark, "parts")
    events = backdate_every_nth(action_events(read_table(spark, root, "events")), 50, "90 minutes").drop("steps")
    parts = events.withColumn("part", F.floor(F.col("event_id") / late_part(spark, root)).cast("int"))
    stored_schema = events.schema
    for part in range(4):
        parts.filter(F.col("part") == part).drop("part").write.parquet(f"{out}/in/part{part}")
        arrived = event_clock(spark.readStream.schema(stored_schema).parquet(f"{out}/in/*"))
        to_the_end(
            reports.event_counts(arrived, "1 hour", "30 minutes"), "append", "parquet", out, path=f"{out}/rows"
        )
    fields = "window_start timestamp, window_end timestamp, count bigint"
    return zoneless(spark.read.schema(fields).parquet(f"{out}/rows"))


def late_part(spark: SparkSession, root: str) -> int:
    """Ids in each of four parts."""
    last = read_table(spark, root, "events").agg(F.max("event_id")).first()[0]
    return (last or 0) // 4 + 1


@query("stream_top_sessions")
def stream_top_sessions(spark, root):
    """Sessions are appended once the watermark has closed them, and ranked from the table of them."""
    closed = appended(reports.session_kpis(priced_stream(spark, root), GAP, "30 days"), "sessions")
    return in_units(reports.top_sessions(placed(closed, root), sort=True), "session_revenue")


@query("stream_avg_session_duration")
def stream_avg_session_duration(spark, root):
    """The mean over the sessions that are closed."""
    lines = line_stream(spark, root, hot_sale_keys(spark, root, "lineitem"))
    closed = appended(reports.customer_sessions(lines, GAP, "30 days"), "sessions")
    return reports.average_session_duration(placed(closed, root))


@query("stream_session_product_mix")
def stream_session_product_mix(spark, root):
    """Product slots are appended by the stream; the mix of the closed sessions is read from them."""
    out = work_dir(spark, "slots")
    slots = appended(product_slots(priced_stream(spark, root), GAP, "30 days"), "slots", out)
    # Step by step, so the shuffle files of one are gone before the next makes its own; the names, which are long, come last.
    with stored_meanwhile(spark) as keep:
        with stored_meanwhile(spark) as keep_parts:
            totals = keep(closed_only(totals_from_slots(slots, GAP, keep=keep_parts), slots, GAP), "totals")
        remove(spark, out)
        mix = keep(session_product_mix(totals), "mix")
        columns = placed(named(mix, root, "product_name"), root).columns
        mix = stored(placed(mix, root), "placed-mix")
    return in_units(named(mix, root, "product_name").select(*columns), "product_revenue")


@query("stream_fraud_alerts")
def stream_fraud_alerts(spark, root):
    alerts = alert_rules(transactions(stream_table(spark, root, "events")))
    return appended(alerts, "alerts")


@query("stream_late_enrichment")
def stream_late_enrichment(spark, root):
    """Sales with some event times moved back, joined with the lookups; sales without a match are left out."""
    return in_units(appended(sales_stream(spark, root, "inner", "90 seconds"), "late"), "unit_price", "total_amount")


@query("stream_line_sessions")
def stream_line_sessions(spark, root):
    """Text lines to session amounts; lines that cannot be read have no time and join no session."""
    lines = parse_csv_lines(event_lines(stream_table(spark, root, "events")), USER_ACTION)
    return appended(reports.user_session_amounts(lines, ACTION_GAP, "30 minutes"), "sessions")


@query("stream_line_counts")
def stream_line_counts(spark, root):
    lines = parse_csv_lines(event_lines(stream_table(spark, root, "events")), USER_CLICK)
    return appended(reports.action_counts(lines, "1 hour", "30 minutes"), "counts")


@query("stream_json_sessions")
def stream_json_sessions(spark, root):
    """JSON messages to sessions of order amounts."""
    order = F.struct(
        F.col("ts").alias("event_time"),
        F.col("user_id").alias("customer_id"),
        F.col("value").alias("amount"),
        F.col("event_type").alias("region"),
    )
    messages = stream_table(spark, root, "events").select(F.to_json(order).alias("value"))
    orders = parse_json_values(messages, ORDER_AMOUNT).withColumn("amount", steps("amount"))
    return in_units(appended(reports.order_sessions(orders, ACTION_GAP, "1 hour"), "sessions"), "session_revenue")


@query("stream_json_folder")
def stream_json_folder(spark, root):
    """A folder of JSON lines as a stream of clicks, counted by hour."""
    folder = work_dir(spark, "json")
    clicks = read_table(spark, root, "events").select("user_id", F.col("ts").alias("event_time"), F.col("event_type").alias("action"))
    clicks.write.json(folder)
    arrived = json_folder(spark, folder, USER_CLICK)
    return appended(reports.action_counts(arrived, "1 hour", "30 minutes"), "counts")


def keep_parts(events: DataFrame, parts: DataFrame, build, out: str) -> None:
    """Run ``build(stream)`` in append mode over the parts of a table: a run per part, each resuming from the checkpoint of those before.

    ``parts`` is ``events`` with a column ``part``. The parts come one after the other, whatever the times of their events.
    """
    spark = events.sparkSession
    for part in sorted(row.part for row in parts.select("part").distinct().collect()):
        parts.filter(F.col("part") == part).drop("part").write.parquet(f"{out}/in/part{part:04d}")
        arrived = event_clock(spark.readStream.schema(events.schema).parquet(f"{out}/in/*"))
        to_the_end(build(arrived), "append", "parquet", out, path=f"{out}/rows")


MERGE_GAP, MERGE_BLOCK, MERGE_DELAY = "12 hours", 15, "15 days"


@query("stream_session_merge")
def stream_session_merge(spark, root):
    """Sessions of events that come out of order: of each fifteen days those with even ids first, then the odd ones between them.

    The odd ones lengthen sessions, open new ones, or bridge two that were apart, in a later run than the one whose state holds them.
    ``first_part`` and ``last_part`` tell in which runs a session's events came.
    """
    out = work_dir(spark, "merge")
    events = action_events(read_table(spark, root, "events"))
    first = events.agg(F.min("event_time")).first()[0]
    if first is None:
        first = F.lit(None).cast("timestamp_ntz")
    days = F.datediff(F.col("event_time"), F.lit(first))
    part = (2 * F.floor(days / MERGE_BLOCK) + F.col("event_id") % 2).cast("long")
    events = events.withColumn("arrived", part)
    measures = (total("steps", "session_amount"), row_count("events"), lowest("arrived", "first_part"), highest("arrived", "last_part"))
    keep_parts(
        events, events.withColumn("part", F.col("arrived")),
        lambda arrived: session_agg(arrived, ["user_id"], measures, MERGE_GAP, MERGE_DELAY), out,
    )
    fields = "session_start timestamp, session_end timestamp, user_id long, session_amount long, events long, first_part long, last_part long"
    return in_units(zoneless(spark.read.schema(fields).parquet(f"{out}/rows")), "session_amount")


DURATION_WINDOW = "90 days"


def session_durations(spark: SparkSession, root: str) -> DataFrame:
    """The stream of mean session lengths per window and region: two stateful steps."""
    lines = line_stream(spark, root, hot_sale_keys(spark, root, "lineitem"), "left")
    return durations_by_window(lines, ["customer_id", "region"], ["region"], GAP, DURATION_WINDOW, "30 days")


@query("stream_session_duration_windows")
def stream_session_duration_windows(spark, root):
    """Closed sessions, grouped by the window they end in, both in one append-mode query with one checkpoint."""
    return appended(session_durations(spark, root), "durations")


@query("stream_state_sizes")
def stream_state_sizes(spark, root):
    """What the two stateful steps still hold when the stream has been read: sessions that may go on, and windows that may get more."""
    out = work_dir(spark, "durations")
    to_the_end(session_durations(spark, root), "append", "parquet", out, path=f"{out}/rows")
    return state_sizes(spark, f"{out}/checkpoint").select("operator_id", "state_rows")


@query("stream_two_outputs")
def stream_two_outputs(spark, root):
    """One read of the events feeds two stores: the hourly counts, and the busiest actions of each hour."""
    out = work_dir(spark, "outputs")
    busiest = lambda batch: top_n(batch, ["window_start"], [F.col("count").desc()], 1)
    write = fan_out(snapshot_writer(f"{out}/counts"), snapshot_writer(f"{out}/busiest", busiest))
    to_the_end(reports.action_counts(action_stream(spark, root), "1 hour"), "complete", "batch", out, on_batch=write)
    first = read_snapshot(spark, f"{out}/busiest").select("window_start", "action", F.lit(True).alias("busiest"))
    counts = read_snapshot(spark, f"{out}/counts").join(first, ["window_start", "action"], "left")
    columns = ("window_start", "window_end", "action", "count")
    return zoneless(counts.select(*columns, F.coalesce("busiest", F.lit(False)).alias("busiest")))


@query("stream_topn_leaderboard")
def stream_topn_leaderboard(spark, root):
    """Sliding Top-N in update mode: each batch ranks the windows it touched anew, and closes those the watermark has passed.

    The state holds totals per slide, and the store forms the windows from them.
    """
    out = work_dir(spark, "leaderboard")
    revenue = open_panes(sales_stream(spark, root), reports.PRODUCT_KEYS, reports.SALES, SLIDE_SIZE, SLIDE, "30 days")
    sliding = (SLIDE_SIZE, SLIDE, reports.SALES)
    write = leaderboard_writer(f"{out}/store", ["product_id"], by_sales(), 5, "30 days", within=["region"], sliding=sliding)
    to_the_end(revenue, "update", "batch", out, on_batch=write)
    best = named(zoneless(read_leaderboard(spark, f"{out}/store")), root, "product_name", "category")
    return in_units(reports.ranking_order(best, newest_first=True), "revenue")


@query("stream_hot_enrichment")
def stream_hot_enrichment(spark, root):
    """Order lines joined with the orders batch by batch, hot orders found as they come; the result is what further streams read."""
    out = work_dir(spark, "enrichment")
    orders = placed_orders(spark, root).withColumnRenamed("o_orderkey", "l_orderkey")
    write = enriched_writer(f"{out}/rows", HotKeys(f"{out}/hot", "l_orderkey"), lambda batch: orders, "inner")
    to_the_end(arriving_lines(spark, root), "append", "batch", out, on_batch=write)
    return spark.read.parquet(f"{out}/rows").drop("epoch_id")
