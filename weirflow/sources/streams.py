"""Stream readers for sources other than the stored tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def json_folder(spark: SparkSession, path: str, schema: T.StructType, files_per_batch: int | None = None) -> DataFrame:
    """A folder that receives JSON-lines files."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(path)


def text_folder(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """A folder that receives text files, one ``value`` row per line."""
    reader = spark.readStream
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.text(path)


def socket_options(host: str, port: int) -> dict[str, str]:
    return {"host": host, "port": str(port)}


def kafka_options(
    servers: str,
    topic: str,
    starting_offsets: str = "latest",
    offsets_per_batch: int | None = None,
    **extra: str,
) -> dict[str, str]:
    """Options of a Kafka reader. ``extra`` takes further options with ``__`` for the dots."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if offsets_per_batch:
        options["maxOffsetsPerTrigger"] = str(offsets_per_batch)
    options.update({key.replace("__", "."): value for key, value in extra.items()})
    return options


def kafka_sink_options(servers: str, topic: str) -> dict[str, str]:
    return {"kafka.bootstrap.servers": servers, "topic": topic}


def read_stream(spark: SparkSession, source: str, options: dict[str, str]) -> DataFrame:
    """Any streaming source Spark has on its class path: ``socket``, ``kafka`` and so on."""
    return spark.readStream.format(source).options(**options).load()
