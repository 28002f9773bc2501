"""What a stream leaves on the disk: no shuffle files of a batch that is stored, no copy that nobody reads any more."""

import datetime
import os

import pytest
from helpers import rows
from pyspark.sql import functions as F

from weirflow.functions.measures import row_count, total
from weirflow.operators.rank import by_sales, top_n
from weirflow.operators.windows import open_panes, tumbling_agg
from weirflow.plans.catalog import QUERIES
from weirflow.plans.streams import arriving_lines
from weirflow.session import stored
from weirflow.streaming import stores
from weirflow.streaming.runner import run_stream
from weirflow.streaming.stores import changes_writer, fan_out, leaderboard_writer, read_leaderboard, read_snapshot, snapshot_writer


def shuffles(spark):
    """Numbers of the shuffles that have files on the disk."""
    folders = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()
    found = [f for top in folders for _, _, names in os.walk(top.getPath()) for f in names]
    return {int(f.split("_")[1]) for f in found if f.startswith("shuffle_")}


def made_since(spark, before):
    """Shuffles of this test; others may go meanwhile."""
    return shuffles(spark) - before


def folders_of(spark, purpose):
    root = spark.conf.get("spark.checkpoint.dir")
    return {name for name in os.listdir(root) if name.startswith(f"{purpose}-")}


@pytest.fixture
def sales(spark, tmp_path):
    for part in range(3):
        made = [(100 * part + s, p, r, 7 * s + p) for s in range(0, 90, 9) for p in range(4) for r in ("e", None)]
        batch = spark.createDataFrame(made, "s long, product_id long, region string, v long").withColumn("event_time", F.timestamp_seconds("s"))
        batch.coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    return spark.readStream.schema(batch.schema).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))


KEYS, SUMS = ["region", "product_id"], (total("v", "revenue"), row_count("units"))


def test_a_stored_batch_leaves_no_shuffle_files(spark, sales, tmp_path):
    counts, before, seen = tumbling_agg(sales, KEYS, SUMS, "10 seconds", "1 minute"), shuffles(spark), []
    keep = changes_writer(str(tmp_path / "rows"))

    def write(batch, epoch):
        seen.append(len(made_since(spark, before)))
        keep(batch.repartition(2), epoch)

    run_stream(counts, "update", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True)
    assert len(seen) >= 3 and not any(seen) and not made_since(spark, before)
    assert spark.read.parquet(str(tmp_path / "rows")).agg(F.sum("units")).first()[0] == 240


def test_stored_tables_leave_no_shuffle_files(spark):
    before = shuffles(spark)
    kept = stored(spark.range(100).groupBy((F.col("id") % 7).alias("k")).count(), "kept")
    assert not made_since(spark, before) and kept.count() == 7


def test_a_leaderboard_ranks_without_the_shuffle_files_of_its_batch(spark, sales, tmp_path, monkeypatch):
    size, slide, delay, path = "40 seconds", "10 seconds", "15 seconds", str(tmp_path / "board")
    before, seen = shuffles(spark), []
    monkeypatch.setattr(stores, "top_n", lambda *a, **b: (seen.append(len(made_since(spark, before))), top_n(*a, **b))[1])
    write = leaderboard_writer(path, ["product_id"], by_sales(), 2, delay, within=["region"], sliding=(size, slide, SUMS))
    panes = open_panes(sales, KEYS, SUMS, size, slide, delay)
    run_stream(panes, "update", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True, rocksdb=True)
    assert len(seen) >= 3 and not any(seen) and not made_since(spark, before)
    names = {n.rpartition("-")[0] for n in os.listdir(path)}
    assert "totals" in names and not names & {"changes", "ranked"}
    assert read_leaderboard(spark, path).count() > 0


def test_old_totals_take_part_in_windows_that_are_touched(spark, tmp_path):
    """A late event's window is ranked with what came before, a window that nothing came for keeps its ranks."""
    path, sliding = str(tmp_path / "board"), ("40 seconds", "10 seconds", SUMS)
    write = leaderboard_writer(path, ["product_id"], by_sales(), 1, "1 hour", within=["region"], sliding=sliding)

    def panes(*made):
        made = spark.createDataFrame(list(made), "s long, product_id long, revenue long")
        start = F.timestamp_seconds(F.col("s") - F.col("s") % 10)
        return made.select(
            start.alias("window_start"), (start + F.expr("INTERVAL 10 SECONDS")).alias("window_end"), F.lit("e").alias("region"),
            "product_id", "revenue", F.lit(1).cast("long").alias("units"), F.timestamp_seconds("s").alias("newest"),
        )

    for epoch, batch in enumerate([[(0, 1, 10), (100, 1, 10), (130, 2, 15)], [(110, 2, 9), (200, 3, 1)], [], [(105, 2, 2)]]):
        write(panes(*batch), epoch)
    best = {(r.window_start.timestamp(), r.product_id, r.revenue) for r in read_leaderboard(spark, path).collect()}
    want = {(s, 1, 10) for s in (-30, -20, -10, 0)} | {(s, 3, 1) for s in (170, 180, 190, 200)}
    want |= {(70, 1, 10), (80, 2, 11), (90, 2, 11), (100, 2, 26), (110, 2, 24), (120, 2, 15), (130, 2, 15)}
    assert best == want


def test_a_shaped_snapshot_is_made_without_the_shuffle_files_of_its_batch(spark, sales, tmp_path):
    before, seen = shuffles(spark), []

    def shape(batch):
        seen.append(len(made_since(spark, before)))
        return batch.groupBy("product_id").agg(F.sum("units").alias("units"))

    counts, path = tumbling_agg(sales, KEYS, SUMS, "10 seconds", "1 minute"), str(tmp_path / "rows")
    write = snapshot_writer(path, shape)
    run_stream(counts, "complete", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True)
    assert len(seen) >= 3 and not any(seen) and not made_since(spark, before)
    assert not [n for n in os.listdir(path) if n.startswith("taken")]
    assert rows(read_snapshot(spark, path)) == [(p, 60) for p in range(4)]


def test_several_stores_share_a_batch_that_one_of_them_shapes(spark, sales, tmp_path):
    counts = tumbling_agg(sales, KEYS, SUMS, "10 seconds", "1 minute")
    shaped, plain = (snapshot_writer(str(tmp_path / name), shape) for name, shape in (("a", lambda b: b.agg(F.sum("units").alias("n"))), ("b", None)))
    run_stream(counts, "complete", "batch", checkpoint=str(tmp_path / "cp"), on_batch=fan_out(shaped, plain), available_now=True)
    assert read_snapshot(spark, str(tmp_path / "a")).first().n == 240
    assert read_snapshot(spark, str(tmp_path / "b")).agg(F.sum("units")).first()[0] == 240


@pytest.mark.parametrize("days", [(0, 1, 60, 61, 62, 63, 64, 100), (0, 100, 100, 100), (5, None), (None, None), ()])
def test_lines_arrive_in_two_parts_however_few_there_are(spark, tmp_path, days):
    first = datetime.datetime(2024, 1, 1)
    orders = [(k, None if d is None else first + datetime.timedelta(days=d)) for k, d in enumerate(days)]
    spark.createDataFrame(orders, "o_orderkey long, o_orderdate timestamp_ntz").write.parquet(str(tmp_path / "orders.parquet"))
    lines = [(k, 1, 7, 2.0) for k in range(len(days))] + [(99, 1, 7, 2.0), (None, 1, 7, 2.0)]
    lines = spark.createDataFrame(lines, "l_orderkey long, l_linenumber int, l_partkey long, l_quantity double")
    lines.write.parquet(str(tmp_path / "lineitem.parquet"))
    copies, before = folders_of(spark, "lines-by-date"), shuffles(spark)
    stream = arriving_lines(spark, str(tmp_path))
    # That of the first and the last date may be there.
    assert folders_of(spark, "lines-by-date") == copies and len(made_since(spark, before)) <= 1
    write = changes_writer(str(tmp_path / "rows"))
    run_stream(stream, "append", "batch", checkpoint=str(tmp_path / "cp"), on_batch=write, available_now=True)
    came = {}
    for r in spark.read.parquet(str(tmp_path / "rows")).collect():
        came.setdefault(r.epoch_id, []).append(r.l_orderkey)
    # Lines without a date come last; if there is no date at all, all lines come at once.
    known = [d for d in days if d is not None]
    dates = {k: None if d is None else d > (min(known) + max(known)) / 2 for k, d in enumerate(days)}
    late = [k for k in [None, *range(len(days)), 99] if known and dates.get(k) in (None, True)]
    early = [k for k in [None, *range(len(days)), 99] if k not in late]
    key = lambda k: -1 if k is None else k
    assert (sorted(came.get(0, []), key=key), sorted(came.get(1, []), key=key)) == (sorted(early, key=key), late)


def test_the_mix_keeps_its_last_step_only(spark, small):
    kinds = ("slots", "sessions", "session-slots", "totals", "mix", "lines-by-date")
    before, held = shuffles(spark), {kind: folders_of(spark, kind) for kind in kinds}
    mix = QUERIES["stream_session_product_mix"](spark, small)
    # Those of the hot keys, the dates and the end of the slots are of a row each.
    assert {kind: folders_of(spark, kind) for kind in kinds} == held and len(made_since(spark, before)) <= 3
    assert mix.columns == ["customer_id", "product_id", "session_start", "session_end", "product_units", "product_revenue", "position", "product_name", "region"]
    assert mix.count() > 0
