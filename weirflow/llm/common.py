"""What the operators share: tables, written intermediate results, and Arrow helpers for tasks."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from weirflow.session import stored as saved  # noqa: F401  (a lost executor costs no more than reading it again)

#: Text handled at once in a task, in bytes. Numpy's arrays over it take up to a hundred times as much.
CHUNK = 1 << 18
#: Workers stay alive between tasks; with this they give back arrays of a megabyte and more as soon as these are freed.
RETURN_MEMORY = {"ARROW_DEFAULT_MEMORY_POOL": "system", "MALLOC_MMAP_THRESHOLD_": "1048576", "MALLOC_TRIM_THRESHOLD_": "1048576"}
#: A batch of rows between the JVM and Python, in bytes.
BATCH = 8 << 20


def table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def ship(spark: SparkSession) -> SparkSession:
    """Let Python workers started by this session import this package from where the driver has it.

    Batches handed to them hold ``BATCH`` bytes at most, unless the session has a limit of its own: a task holds a batch in the
    JVM and in Python at once, besides what it computes.
    """
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key) == "67108864b":
        spark.conf.set(key, str(BATCH))
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    workers = spark.sparkContext.environment
    known = workers.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        workers["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)
    for name, value in RETURN_MEMORY.items():
        workers.setdefault(name, value)
    return spark


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 of each text; null counts as empty."""
    return [x or b"" for x in column.cast(pa.binary()).to_pylist()]


def chunks(column: pa.Array, limit: int = CHUNK) -> Iterator[list[bytes]]:
    """The texts of a batch in order, about ``limit`` bytes at a time; only those are held besides the batch."""
    sizes = pc.fill_null(pc.binary_length(column), 0).to_pylist()
    for run in runs(sizes, limit):
        yield as_bytes(column.slice(run.start, run.stop - run.start))


def runs(sizes: Iterable[int], limit: int = CHUNK) -> Iterator[slice]:
    """Consecutive rows whose sizes add up to about ``limit``; a larger row stands alone."""
    start = total = at = 0
    for at, size in enumerate(sizes, 1):
        total += size
        if total >= limit:
            yield slice(start, at)
            start, total = at, 0
    if start < at:
        yield slice(start, at)


def batch(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
