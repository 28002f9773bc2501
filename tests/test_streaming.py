"""Streams over small files, one micro-batch per file."""

import itertools
import time

import pytest
from helpers import at, rows, write_lines
from pyspark.errors import AnalysisException
from pyspark.sql import functions as F

from weirflow.functions.payload import parse_csv_lines
from weirflow.functions.time import zoneless
from weirflow.operators.enrich import enrich_sales
from weirflow.operators.product_mix import product_session_fragments
from weirflow.plans import reports
from weirflow.plans.catalog import sales
from weirflow.plans.streams import sales_stream, stream_table
from weirflow.session import work_dir
from weirflow.sources.schemas import CUSTOMER, PRODUCT, RAW_SALE, USER_ACTION
from weirflow.sources.streams import (
    json_folder,
    kafka_options,
    kafka_sink_options,
    read_stream,
    socket_options,
    text_folder,
)
from weirflow.sources.tables import action_events, read_table
from weirflow.streaming.runner import check_sink, progress_writer, run_stream, stop_all, recent_metrics
from weirflow.streaming.stores import changes_writer, jdbc_writer, read_latest_changes, read_snapshot, snapshot_writer

LATE_FILES = [
    ["10:01:00", "10:02:00"],
    ["10:06:00"],
    ["10:09:30"],
    ["10:01:30"],
    ["10:20:00"],
    ["10:02:30"],
    ["10:40:00"],
]


def late_lines(folder):
    for number, _ in arriving(folder):
        pass


def arriving(folder):
    """Put the files into the folder one by one."""
    for number, times in enumerate(LATE_FILES):
        write_lines(folder, number, *[f"u,2025-08-16 {t},click,1" for t in times])
        yield number, times


def counts_stream(spark, folder):
    actions = parse_csv_lines(text_folder(spark, str(folder), 1), USER_ACTION)
    return reports.event_counts(actions, "5 minutes", "5 minutes")


def test_append_drops_what_comes_too_late(spark, tmp_path):
    # Each run takes in one file, lets the watermark act, and stops; the next resumes from the checkpoint.
    dropped, read = 0, 0
    for _ in arriving(tmp_path / "in"):
        query = run_stream(
            counts_stream(spark, tmp_path / "in"), "append", "parquet", checkpoint=str(tmp_path / "cp"),
            path=str(tmp_path / "out"), available_now=True,
        )
        metrics = recent_metrics(query)
        totals = metrics.agg(F.sum("rows_dropped"), F.sum("input_rows")).first()
        dropped, read = dropped + totals[0], read + totals[1]
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [
        (at("10:00"), at("10:05"), 3), (at("10:05"), at("10:10"), 2), (at("10:20"), at("10:25"), 1),
    ]
    assert (dropped, read) == (1, 8)
    # The window of 10:40 is still held.
    assert metrics.orderBy(F.desc("batch_id")).first().state_rows == 1


def test_update_emits_each_change(spark, tmp_path):
    for _ in arriving(tmp_path / "in"):
        run_stream(
            counts_stream(spark, tmp_path / "in"), "update", "batch", checkpoint=str(tmp_path / "cp"),
            on_batch=changes_writer(str(tmp_path / "out")), available_now=True,
        )
    changes = spark.read.parquet(str(tmp_path / "out"))
    assert [(r.window_start, r["count"]) for r in changes.orderBy("epoch_id").collect()] == [
        (at("10:00"), 2), (at("10:05"), 1), (at("10:05"), 2), (at("10:00"), 3), (at("10:20"), 1), (at("10:40"), 1),
    ]
    latest = read_latest_changes(spark, str(tmp_path / "out"), ["window_start", "window_end"])
    assert rows(latest) == [
        (at("10:00"), at("10:05"), 3), (at("10:05"), at("10:10"), 2), (at("10:20"), at("10:25"), 1),
        (at("10:40"), at("10:45"), 1),
    ]


def test_complete_drops_nothing(spark, tmp_path):
    late_lines(tmp_path / "in")
    seen = []
    write = snapshot_writer(str(tmp_path / "out"), view="counts_live", report=lambda *batch: seen.append(batch))
    run_stream(
        counts_stream(spark, tmp_path / "in").orderBy("window_start"), "complete", "batch",
        checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True,
    )
    expected = [
        (at("10:00"), at("10:05"), 4), (at("10:05"), at("10:10"), 2), (at("10:20"), at("10:25"), 1),
        (at("10:40"), at("10:45"), 1),
    ]
    assert rows(read_snapshot(spark, str(tmp_path / "out"))) == expected
    assert rows(spark.sql("select * from global_temp.counts_live")) == expected
    assert [count for _, count in seen] == [1, 2, 2, 2, 3, 3, 4]
    with pytest.raises(AnalysisException):
        spark.sql("select * from counts_live").collect()


def session_lines(folder):
    write_lines(folder, 0, "u1,2025-08-16 10:01:00,buy,50", "u1,2025-08-16 10:03:00,buy,30")
    write_lines(folder, 1, "u1,2025-08-16 10:25:00,buy,70")
    write_lines(folder, 2, "u1,2025-08-16 10:14:00,buy,5")
    write_lines(folder, 3, "u2,2025-08-16 12:00:00,buy,10")


def test_late_event_joins_two_sessions(spark, tmp_path):
    session_lines(tmp_path / "in")
    actions = parse_csv_lines(text_folder(spark, str(tmp_path / "in"), 1), USER_ACTION)
    history = []

    def keep(batch, epoch):
        history.append(rows(batch))

    run_stream(
        reports.user_session_amounts(actions), "complete", "batch", checkpoint=str(tmp_path / "cp"),
        on_batch=keep, available_now=True,
    )
    assert [r[3] for r in history[1]] == [80, 70]
    assert history[2] == [(at("10:01"), at("10:40"), "u1", 155)]

    run_stream(
        reports.user_session_amounts(actions), "append", "parquet", checkpoint=str(tmp_path / "cp2"),
        path=str(tmp_path / "out"), available_now=True,
    )
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(at("10:01"), at("10:40"), "u1", 155)]


def test_two_runs_on_one_checkpoint_equal_one(spark, tmp_path):
    session_lines(tmp_path / "in")
    first = tmp_path / "first"
    for name in ("000.txt", "001.txt"):
        first.mkdir(exist_ok=True)
        (first / name).write_text((tmp_path / "in" / name).read_text())

    def run(folder):
        actions = parse_csv_lines(text_folder(spark, str(folder)), USER_ACTION)
        run_stream(
            reports.user_session_amounts(actions), "append", "parquet", checkpoint=str(tmp_path / "cp"),
            path=str(tmp_path / "out"), available_now=True,
        )

    run(first)
    assert spark.read.schema("session_amount bigint").parquet(str(tmp_path / "out")).count() == 0
    for name in ("002.txt", "003.txt"):
        (first / name).write_text((tmp_path / "in" / name).read_text())
    run(first)
    run(first)
    assert rows(spark.read.parquet(str(tmp_path / "out"))) == [(at("10:01"), at("10:40"), "u1", 155)]


def test_rocksdb_state_gives_the_same(spark, tmp_path):
    late_lines(tmp_path / "in")
    before = spark.conf.get("spark.sql.shuffle.partitions")
    run_stream(
        counts_stream(spark, tmp_path / "in"), "append", "parquet", checkpoint=str(tmp_path / "cp"),
        path=str(tmp_path / "out"), available_now=True, rocksdb=True, state_partitions=2,
    )
    assert spark.read.parquet(str(tmp_path / "out")).count() == 3
    assert spark.conf.get("spark.sql.shuffle.partitions") == before
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass").endswith("HDFSBackedStateStoreProvider")


def test_every_batch_is_in_the_progress_table(spark, tmp_path):
    late_lines(tmp_path / "in")
    listener = progress_writer(spark, str(tmp_path / "progress"))
    spark.streams.addListener(listener)
    try:
        run_stream(
            counts_stream(spark, tmp_path / "in"), "append", "parquet", checkpoint=str(tmp_path / "cp"),
            path=str(tmp_path / "out"), available_now=True,
        )
        spark.sparkContext._jsc.sc().listenerBus().waitUntilEmpty(30_000)
        deadline = time.monotonic() + 20
        total = None
        while total != 8 and time.monotonic() < deadline:
            time.sleep(0.5)
            if (tmp_path / "progress").exists():
                total = spark.read.parquet(str(tmp_path / "progress")).agg(F.sum("input_rows")).first()[0]
    finally:
        spark.streams.removeListener(listener)
    assert total == 8


def test_memory_sink_answers_sql(spark, small):
    counts = reports.action_counts(action_events(stream_table(spark, small, "events")), "1 day")
    run_stream(counts, "complete", "memory", name="agg_live", available_now=True)
    batch = reports.action_counts(action_events(read_table(spark, small, "events")), "1 day")
    assert rows(zoneless(spark.sql("select * from agg_live"))) == rows(batch)


def test_console_sink(spark, tmp_path):
    late_lines(tmp_path / "in")
    query = run_stream(
        counts_stream(spark, tmp_path / "in"), "complete", "console", available_now=True,
        options={"truncate": "false", "numRows": "50"},
    )
    assert query.exception() is None
    assert sum(p.numInputRows for p in query.recentProgress) == 8


def test_stateless_enrichment_of_a_json_folder(spark, tmp_path):
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.json").write_text(
        '{"event_time":"2025-08-16T10:00:00","customer_id":1,"product_id":11,"quantity":2}\n'
        '{"event_time":"2025-08-16T10:01:00","customer_id":5,"product_id":55,"quantity":1}\n'
    )
    customers = spark.createDataFrame([(1, "Ann", "East", "f")], CUSTOMER)
    products = spark.createDataFrame([(11, "pen", "office", "desk", 1.5)], PRODUCT)
    events = json_folder(spark, str(tmp_path / "in"), RAW_SALE, 1)
    hot = spark.createDataFrame([(1,), (5,)], "customer_id int")
    for how, hot_customers, expected in (("left", None, 2), ("left", hot, 2), ("inner", None, 1), ("inner", hot, 1)):
        name = f"{how}-{hot_customers is None}"
        run_stream(
            enrich_sales(events, customers, products, how=how, hot_customers=hot_customers), "append", "parquet",
            checkpoint=str(tmp_path / f"cp-{name}"), path=str(tmp_path / f"out-{name}"), available_now=True,
        )
        assert spark.read.parquet(str(tmp_path / f"out-{name}")).count() == expected


def test_several_queries_and_stop_all(spark, tmp_path):
    late_lines(tmp_path / "in")
    for name in ("one", "two"):
        run_stream(counts_stream(spark, tmp_path / "in"), "complete", "memory", name=name, trigger="1 second")
    assert stop_all(spark) == 2
    assert spark.streams.active == []


@pytest.mark.parametrize(
    ("mode", "sink", "checkpoint", "name", "path", "on_batch"),
    [
        ("all", "console", None, None, None, None),
        ("append", "files", None, None, None, None),
        ("complete", "parquet", "cp", None, "out", None),
        ("append", "parquet", None, None, "out", None),
        ("append", "parquet", "cp", None, None, None),
        ("append", "kafka", None, None, None, None),
        ("append", "memory", None, None, None, None),
        ("update", "memory", None, "n", None, None),
        ("append", "batch", "cp", None, None, None),
        ("append", "batch", None, None, None, print),
    ],
)
def test_impossible_sinks_are_refused(mode, sink, checkpoint, name, path, on_batch):
    with pytest.raises(ValueError):
        check_sink(mode, sink, checkpoint, name, path, on_batch)


def test_spark_refuses_the_rest(spark, small, tmp_path):
    actions = action_events(stream_table(spark, small, "events"))
    numbers = itertools.count()

    def refused(df, mode):
        with pytest.raises(AnalysisException):
            run_stream(
                df, mode, "batch", checkpoint=str(tmp_path / f"cp{next(numbers)}"), on_batch=print, available_now=True
            )

    counts = reports.action_counts(actions)
    refused(reports.user_session_amounts(actions), "update")
    refused(counts.orderBy("window_start"), "append")
    refused(reports.top_n(counts, ["action"], [F.col("count").desc()], 1), "complete")
    refused(actions, "complete")
    refused(counts.groupBy("window_start").count(), "complete")
    refused(actions.withWatermark("event_time", "1 hour").groupBy("user_id").agg(F.count_distinct("action")), "complete")


def test_work_folders_come_from_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir")
    first, second = work_dir(spark, "a"), work_dir(spark, "a")
    assert first.startswith(root) and first != second


def test_snapshot_is_the_latest_and_readers_are_not_disturbed(spark, tmp_path):
    write = snapshot_writer(str(tmp_path / "s"))
    for epoch in (0, 1, 2, 2):
        write(spark.range(epoch + 1), epoch)
    reading = read_snapshot(spark, str(tmp_path / "s"))
    for epoch in (3, 4, 5):
        write(spark.range(epoch + 1), epoch)
    assert reading.count() == 3 and reading.columns == ["id"]
    assert read_snapshot(spark, str(tmp_path / "s")).count() == 6
    for epoch in range(6, 12):
        write(spark.range(epoch + 1), epoch)
    assert len(list((tmp_path / "s").glob("snapshot-*"))) == 4


def test_an_empty_snapshot_is_the_latest_too(spark, tmp_path):
    write = snapshot_writer(str(tmp_path / "s"))
    write(spark.range(5), 0)
    write(spark.range(0), 1)
    assert read_snapshot(spark, str(tmp_path / "s")).count() == 0


def test_state_ends_with_the_watermark_in_update_mode(spark, tmp_path):
    held = []
    for _ in arriving(tmp_path / "in"):
        query = run_stream(
            counts_stream(spark, tmp_path / "in"), "update", "batch", checkpoint=str(tmp_path / "cp"),
            on_batch=changes_writer(str(tmp_path / "out")), available_now=True, rocksdb=True,
        )
        held.append(recent_metrics(query).orderBy(F.desc("batch_id")).first().state_rows)
    assert max(held) == 2 and held[-1] == 1


def test_retried_batch_is_written_once(spark, tmp_path):
    write = changes_writer(str(tmp_path / "c"))
    for epoch in (0, 1, 1):
        write(spark.range(3), epoch)
    assert spark.read.parquet(str(tmp_path / "c")).count() == 6


def test_source_and_sink_options():
    assert kafka_options("h:9092", "t", offsets_per_batch=10, kafka__security__protocol="SSL") == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "t",
        "startingOffsets": "latest",
        "maxOffsetsPerTrigger": "10",
        "kafka.security.protocol": "SSL",
    }
    assert kafka_sink_options("h:9092", "t") == {"kafka.bootstrap.servers": "h:9092", "topic": "t"}
    assert socket_options("localhost", 9999) == {"host": "localhost", "port": "9999"}


def test_unknown_source_is_reported(spark):
    with pytest.raises(Exception, match="no-such-source"):
        read_stream(spark, "no-such-source", {})


def test_jdbc_writer_appends_with_the_batch_number(spark):
    calls = []

    class Recorder:
        def withColumn(self, name, column):
            calls.append(name)
            return self

        @property
        def write(self):
            return self

        def jdbc(self, *args):
            calls.append(args)

    jdbc_writer("jdbc:x", "alerts", {"user": "u"})(Recorder(), 4)
    assert calls == ["epoch_id", ("jdbc:x", "alerts", "append", {"user": "u"})]


@pytest.mark.parametrize(
    "report",
    [
        lambda s: reports.sales_by_region_category(s, "30 days"),
        lambda s: reports.product_revenue(s, "30 days"),
        lambda s: reports.product_revenue(s, "28 days", "7 days"),
        lambda s: reports.region_totals(s, "30 days", amount="total_amount"),
        lambda s: reports.session_kpis(s, "30 days"),
        lambda s: reports.session_spend(s, "30 days"),
        lambda s: product_session_fragments(s, "30 days", "1 day"),
    ],
)
def test_complete_stream_equals_batch(spark, small, report):
    out = work_dir(spark, "parity")
    write = snapshot_writer(f"{out}/rows")
    run_stream(
        report(sales_stream(spark, small)), "complete", "batch", checkpoint=f"{out}/checkpoint", on_batch=write,
        available_now=True,
    )
    assert rows(zoneless(read_snapshot(spark, f"{out}/rows"))) == rows(report(sales(spark, small)))
