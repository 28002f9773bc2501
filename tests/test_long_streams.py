"""What a stream needs that runs for long: stores of bounded size, hot keys that come and go, several outputs, and a look at its state."""

import pytest
from helpers import rows
from pyspark.sql import functions as F

from weirflow.functions.measures import row_count, total
from weirflow.operators.enrich import ROW, join_hot, join_lookup, rows_of
from weirflow.operators.rank import by_sales, top_n
from weirflow.operators.sessions import durations_by_window
from weirflow.operators.windows import open_panes, sliding_agg, tumbling_agg
from weirflow.plans import reports
from weirflow.plans.catalog import QUERIES
from weirflow.plans.streams import action_stream
from weirflow.sources.bucketed import bucketed
from weirflow.sources.tables import action_events, read_table
from weirflow.streaming.hot import HotKeys
from weirflow.streaming.runner import progress_writer, read_state, recent_metrics, run_stream, state_sizes, state_stores
from weirflow.streaming.stores import (
    changes_writer,
    fan_out,
    leaderboard_writer,
    read_latest_changes,
    read_leaderboard,
    read_snapshot,
    snapshot_writer,
)


def folders(path):
    return sorted(p.name for p in path.iterdir() if p.is_dir())


def test_a_store_of_changes_stays_small(spark, tmp_path):
    kept, plain = changes_writer(str(tmp_path / "kept"), keys=["k"], every=4), changes_writer(str(tmp_path / "plain"))
    most = 0
    for epoch in range(21):
        batch = spark.range(epoch % 5 + 1).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(epoch).alias("v")).coalesce(1)
        for write in (kept, plain):
            write(batch, epoch)
        most = max(most, len(folders(tmp_path / "kept")))
    assert most <= 13 and len(folders(tmp_path / "plain")) == 21
    want = rows(read_latest_changes(spark, str(tmp_path / "plain"), ["k"]))
    assert rows(read_latest_changes(spark, str(tmp_path / "kept"), ["k"])) == want
    # A batch that is written again, after its base was made or before, changes nothing.
    kept(spark.range(20 % 5 + 1).select(F.when(F.col("id") > 0, F.col("id")).alias("k"), F.lit(20).alias("v")), 20)
    assert rows(read_latest_changes(spark, str(tmp_path / "kept"), ["k"])) == want


def test_readers_of_an_older_base_are_not_disturbed(spark, tmp_path):
    write = changes_writer(str(tmp_path / "c"), keys=["id"], every=2)
    for epoch in range(4):
        write(spark.range(3).withColumn("v", F.lit(epoch)).coalesce(1), epoch)
    reading = read_latest_changes(spark, str(tmp_path / "c"), ["id"])
    for epoch in (4, 5):
        write(spark.range(3).withColumn("v", F.lit(epoch)).coalesce(1), epoch)
    write(spark.range(3).withColumn("v", F.lit(3)).coalesce(1), 3)
    assert {r.v for r in reading.collect()} == {3}
    assert {r.v for r in read_latest_changes(spark, str(tmp_path / "c"), ["id"]).collect()} == {5}


def test_two_stores_read_the_source_once(spark, small, tmp_path):
    counts = reports.action_counts(action_stream(spark, small), "1 day")
    write = fan_out(snapshot_writer(str(tmp_path / "a")), snapshot_writer(str(tmp_path / "b"), lambda b: b.groupBy("action").agg(F.sum("count").alias("n"))))
    query = run_stream(counts, "complete", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True)
    events = read_table(spark, small, "events").count()
    assert sum(p.numInputRows for p in query.recentProgress) == events
    assert read_snapshot(spark, str(tmp_path / "a")).agg(F.sum("count")).first()[0] == events
    assert read_snapshot(spark, str(tmp_path / "b")).agg(F.sum("n")).first()[0] == events


def test_a_store_that_fails_stops_the_batch(spark, tmp_path):
    def broken(batch, epoch):
        raise RuntimeError("store is away")

    with pytest.raises(RuntimeError):
        fan_out(changes_writer(str(tmp_path / "a")), broken)(spark.range(3), 0)
    fan_out(changes_writer(str(tmp_path / "a")), changes_writer(str(tmp_path / "b")))(spark.range(3), 0)
    assert spark.read.parquet(str(tmp_path / "a")).count() == 3


def windows(spark, batch):
    fields = "window_start timestamp, window_end timestamp, region string, product_id long, revenue long, units long"
    made = spark.createDataFrame(batch, "s long, e long, region string, product_id long, revenue long, units long")
    made = made.withColumns({"window_start": F.timestamp_seconds("s"), "window_end": F.timestamp_seconds("e")})
    return made.selectExpr(*[f.split()[0] for f in fields.split(", ")])


def test_a_leaderboard_holds_open_windows_only(spark, tmp_path):
    path = str(tmp_path / "board")
    write = leaderboard_writer(path, ["product_id"], by_sales(), 2, "60 seconds", within=["region"])
    totals, held = {}, []
    for epoch in range(10):
        start = 100 * epoch
        batch = [(start, start + 100, region, p, 10 * p + epoch, 1) for region in ("e", None) for p in range(5)]
        # The window before gets more, of one product.
        batch += [(start - 100, start, "e", 0, 1000, 9)] * (epoch > 0)
        for b in batch:
            totals[b[:4]] = b
        for _ in range(1 + (epoch == 4)):
            write(windows(spark, batch), epoch)
        held.append(spark.read.parquet(f"{path}/totals-{epoch:012d}").count())
    want = top_n(windows(spark, list(totals.values())), ["window_start", "window_end", "region"], by_sales(), 2)
    assert rows(read_leaderboard(spark, path)) == rows(want)
    assert max(held) <= 30 and len(folders(tmp_path / "board")) <= 4 * 5 + 1
    write(windows(spark, []), 10)
    assert rows(read_leaderboard(spark, path)) == rows(want)


def test_a_sliding_leaderboard_holds_each_event_once(spark, tmp_path):
    """Events out of order, some too late for a few of their windows or for all: the same ranks as with a state row per window."""
    times = [(0, 25, 31, 44), (70, 12, 33, 59), (95, 41, 38, 62), (180, 65, 71, 99), (200, 101, 119, 150), (201, 155, 99, 161)]
    for part, seconds in enumerate(times):
        made = [(s, p, r, 7 * s + p) for s in seconds for p in range(3) for r in ("e", None)]
        batch = spark.createDataFrame(made, "s long, product_id long, region string, v long").withColumn("event_time", F.timestamp_seconds(F.col("s") + 1_000_000))
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    keys, sums, size, slide, delay = ["region", "product_id"], (total("v", "revenue"), row_count("units")), "40 seconds", "10 seconds", "15 seconds"

    def ranked(name, df, sliding):
        write = leaderboard_writer(str(tmp_path / name), ["product_id"], by_sales(), 2, delay, within=["region"], sliding=sliding)
        out = str(tmp_path / f"{name}-cp")
        query = run_stream(df, "update", "batch", checkpoint=out, on_batch=write, available_now=True)
        most = max(r.state_rows for r in recent_metrics(query).collect())
        return rows(read_leaderboard(spark, str(tmp_path / name))), most

    want, copies = ranked("copied", sliding_agg(stream, keys, sums, size, slide, delay), None)
    got, panes = ranked("panes", open_panes(stream, keys, sums, size, slide, delay), (size, slide, sums))
    whole = top_n(sliding_agg(spark.read.parquet(str(tmp_path / "in")), keys, sums, size, slide), ["window_start", "region"], by_sales(), 2)
    assert got == want and got != rows(whole)
    assert panes < copies


def test_state_of_the_leaderboard_stream_is_bounded(spark, small, tmp_path):
    events = action_events(read_table(spark, small, "events"))
    for part in range(6):
        lo, hi = f"2024-01-{1 + 5 * part:02d}", f"2024-01-{6 + 5 * part:02d}" if part < 5 else "2024-03-01"
        events.where(f"event_time >= '{lo}' and event_time < '{hi}'").coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(events.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    counts = tumbling_agg(stream, ["user_id"], [row_count("n")], "1 hour", "2 hours")
    write = leaderboard_writer(str(tmp_path / "board"), ["user_id"], [F.col("n").desc()], 1, "2 hours")
    query = run_stream(counts, "update", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True)
    whole = tumbling_agg(events, ["user_id"], [row_count("n")], "1 hour")
    want = top_n(whole, ["window_start"], [F.col("n").desc()], 1)
    got = read_leaderboard(spark, str(tmp_path / "board"))
    assert got.count() == want.count() and got.agg(F.sum("n")).first() == want.agg(F.sum("n")).first()
    batches = recent_metrics(query).where("input_rows > 0").count()
    last = recent_metrics(query).orderBy(F.desc("batch_id")).first().state_rows
    assert batches == 6 and last < whole.count() / 20
    held = spark.read.parquet(max(str(p) for p in (tmp_path / "board").glob("totals-*"))).count()
    assert held < whole.count() / 3


def test_a_key_that_turns_hot_later_is_spread(spark, tmp_path):
    hot = HotKeys(str(tmp_path / "hot"), "k", share=0.05)
    even = spark.range(4000).select((F.col("id") % 1000).alias("k"), F.col("id").alias(ROW))
    late = spark.range(4000).select(F.when(F.col("id") < 3000, 77).when(F.col("id") < 3100, None).otherwise(F.col("id") % 1000).alias("k"), F.col("id").alias(ROW))
    assert hot.update(even, 0).count() == 0
    for _ in range(2):
        assert [r.k for r in hot.update(late, 1).collect()] == [77]
    # It stays hot while it holds more than its share of all rows.
    assert [r.k for r in hot.update(even, 2).collect()] == [77]
    for epoch in range(3, 8):
        hot.update(even, epoch)
    assert len(folders(tmp_path / "hot")) <= 10

    lookup = bucketed(spark.range(1000).select(F.col("id").alias("k"), (F.col("id") * 2).alias("v")), "k", "lookup", 16)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        keys = spark.createDataFrame([(77,)], "k bigint")
        joined = join_hot(late, lookup, "k", "left", rows_of(lookup, "k", keys))
        assert joined.count() == 4000 and joined.where("v = 154").count() >= 3000 and joined.where("k is null and v is null").count() == 100
        sizes = [r["count"] for r in joined.groupBy(F.spark_partition_id()).count().collect()]
        assert max(sizes) < 2 * 4000 / 16
        plain = [r["count"] for r in late.join(lookup, "k", "left").groupBy(F.spark_partition_id()).count().collect()]
        assert max(plain) > 2900
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == 1 and "Bucketed: true" in plan
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        for name in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled"):
            spark.conf.unset(name)


@pytest.mark.parametrize("kind", ["bigint", "int", "string"])
@pytest.mark.parametrize("how", ["left", "inner"])
def test_joins_with_hot_keys_equal_plain_ones(spark, kind, how):
    events = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (None, "d"), (9, "e"), (-5, "f")], "k bigint, x string").withColumn("k", F.col("k").cast(kind))
    lookup = spark.createDataFrame([(1, "one"), (2, None), (3, "three"), (-5, "five")] + [(-i, "made up") for i in range(10, 60)], "k bigint, v string")
    lookup = lookup.withColumn("k", F.col("k").cast(kind))
    hot = spark.createDataFrame([(1,), (8,)], "k bigint").withColumn("k", F.col("k").cast(kind))
    assert rows(join_lookup(events, lookup, "k", how, hot)) == rows(join_lookup(events, lookup, "k", how))


def test_progress_costs_no_job_per_batch(spark, tmp_path):
    writer = progress_writer(spark, str(tmp_path / "p"), every=3)
    report = '{"batchId": %d, "numInputRows": 5, "stateOperators": []}'

    class Event:
        def __init__(self, i):
            self.progress = type("P", (), {"id": "q", "json": report % i})

    for i in range(7):
        writer.onQueryProgress(Event(i))
    assert len(list((tmp_path / "p").glob("*.parquet"))) == 2
    writer.onQueryTerminated(None)
    writer.flush()
    assert sorted(r.batch_id for r in spark.read.parquet(str(tmp_path / "p")).collect()) == list(range(7))


def test_state_is_read_from_the_checkpoint(spark, small, tmp_path):
    counts = reports.action_counts(action_stream(spark, small), "1 hour", "30 minutes")
    query = run_stream(counts, "append", "parquet", checkpoint=str(tmp_path / "cp"), path=str(tmp_path / "out"), available_now=True, rocksdb=True)
    last = recent_metrics(query).orderBy(F.desc("batch_id")).first()
    sizes = state_sizes(spark, str(tmp_path / "cp")).collect()
    assert [s.state_rows for s in sizes] == [last.state_rows] and sizes[0].operator == last.operator and sizes[0].fullest <= last.state_rows
    assert state_stores(spark, str(tmp_path / "cp")).first().last_batch >= 1
    assert read_state(spark, str(tmp_path / "cp"), batch=0).count() > last.state_rows


def test_state_that_is_not_counted_by_the_batch(spark, small, tmp_path):
    found = []
    for counted in (True, False):
        counts = reports.action_counts(action_stream(spark, small), "1 hour", "30 minutes")
        run = {"checkpoint": str(tmp_path / f"cp{counted}"), "path": str(tmp_path / f"out{counted}"), "count_state": counted}
        query = run_stream(counts, "append", "parquet", available_now=True, rocksdb=True, **run)
        held = recent_metrics(query).orderBy(F.desc("batch_id")).first().state_rows
        sizes = state_sizes(spark, run["checkpoint"]).first()
        assert sizes.state_rows > 0 and (held == sizes.state_rows) == counted
        found.append((sorted(spark.read.parquet(run["path"]).collect()), sizes))
    assert found[0] == found[1]


def test_the_registered_streams_do_not_count_their_state(spark, small, monkeypatch):
    from weirflow.plans import streams

    counted = []
    monkeypatch.setattr(streams, "run_stream", lambda *a, **b: (counted.append(b.get("count_state", True)), run_stream(*a, **b))[1])
    assert QUERIES["stream_session_product_mix"](spark, small).count() > 0
    assert counted == [False]


def test_durations_of_a_table(spark):
    events = spark.createDataFrame([("a", "e", "2025-01-01 10:00"), ("a", "e", "2025-01-01 10:05"), ("b", "e", "2025-01-01 10:58"), ("c", "w", "2025-01-02 00:00")], "u string, region string, t string")
    got = durations_by_window(events.withColumn("event_time", F.col("t").cast("timestamp")), ["u", "region"], ["region"], "10 minutes", "1 hour", "1 hour")
    # A session belongs to the window it ends in.
    assert [(r.window_start.hour, r.region, r.n_sessions, r.avg_session_s) for r in got.orderBy("window_start").collect()] == [
        (10, "e", 1, 900.0), (11, "e", 1, 600.0), (0, "w", 1, 600.0),
    ]
