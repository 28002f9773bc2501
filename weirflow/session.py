"""Session settings and the shared work folder."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession


def configure(spark: SparkSession) -> SparkSession:
    """Set the three SQL settings the operators rely on; everything else stays as the cluster has it."""
    # Day-long windows align to midnight of the session time zone.
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    # An aggregation that follows a join on the same key would otherwise keep adaptive execution from
    # splitting the partition of a hot key.
    spark.conf.set("spark.sql.adaptive.forceOptimizeSkewedJoin", "true")
    # A side none of whose partitions is above the size adaptive execution aims at is hashed, so the rows it is joined with,
    # as windows or product slots with a lookup, need not be sorted.
    aimed_at = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold", aimed_at)
    return spark


def local_session(cpus: int | str = "*", name: str = "weirflow", **options: str) -> SparkSession:
    """A single-machine session for tests and the bench."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in options.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def work_dir(spark: SparkSession, purpose: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``, the folder all executors share.

    A machine-local folder is used only where that setting is absent and the session runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="weirflow-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


@contextmanager
def settings_of(spark: SparkSession, settings: dict[str, str]) -> Iterator[None]:
    """Settings of the session that hold for a while."""
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def passing(spark: SparkSession):
    """What is written meanwhile leaves no shuffle files behind: they go as soon as a write has ended, not when the driver happens
    to collect its garbage."""
    return settings_of(spark, {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true"})


def drop_shuffles(batch: DataFrame) -> None:
    """Drop the shuffle files that a micro-batch was computed from, once it has been written: its query holds its plan for two batches more."""
    cleaner, plan = batch.sparkSession.sparkContext._jsc.sc().cleaner(), batch._jdf.queryExecution().logical()
    if cleaner.isEmpty() or batch.storageLevel.useMemory or plan.getClass().getSimpleName() != "LogicalRDD":
        return  # a cached batch may be computed again; one of a query without state is planned by what writes it, see passing()
    ahead, seen = [plan.rdd()], set()
    while ahead:
        rdd = ahead.pop()
        if rdd.id() in seen:
            continue
        seen.add(rdd.id())
        needed = rdd.dependencies()
        for k in range(needed.size()):
            dependency = needed.apply(k)
            if dependency.getClass().getSimpleName() == "ShuffleDependency":
                cleaner.get().doCleanupShuffle(dependency.shuffleId(), True)
            ahead.append(dependency.rdd())


def files_of(spark: SparkSession, path: str):
    """The file system of a path, as the session knows it, and the path."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder that this library wrote."""
    files, where = files_of(spark, path)
    files.delete(where, True)


def stored(df: DataFrame, purpose: str, path: str | None = None) -> DataFrame:
    """``df`` written once to a work folder and read from there, for results that are used more than once."""
    path = path or work_dir(df.sparkSession, purpose)
    with passing(df.sparkSession):
        df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def stored_meanwhile(spark: SparkSession) -> Iterator[Callable[[DataFrame, str], DataFrame]]:
    """A function like :func:`stored` whose folders go in the end, for what stands between the steps of a result that is stored itself."""
    made: list[str] = []

    def keep(df: DataFrame, purpose: str) -> DataFrame:
        made.append(work_dir(spark, purpose))
        return stored(df, purpose, made[-1])

    try:
        yield keep
    finally:
        for path in made:
            remove(spark, path)
