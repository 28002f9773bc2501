"""Text payloads to typed columns and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def typed_field(text: Column, data_type: T.DataType) -> Column:
    """Cast that yields null for text which does not fit, so a bad line cannot stop a stream."""
    if isinstance(data_type, T.StringType):
        return text
    if isinstance(data_type, T.TimestampType):
        return F.try_to_timestamp(text)
    return text.try_cast(data_type)


def parse_csv_lines(lines: DataFrame, schema: T.StructType, column: str = "value", sep: str = ",") -> DataFrame:
    """One delimited line per row to the columns of ``schema``, matched by position."""
    # Spark reads the separator of split as a regular expression; \Q..\E quotes it.
    parts = F.split(F.col(column).cast("string"), rf"\Q{sep}\E")
    return lines.select(
        *[typed_field(F.get(parts, F.lit(i)), f.dataType).alias(f.name) for i, f in enumerate(schema)]
    )


def parse_json_values(messages: DataFrame, schema: T.StructType, column: str = "value") -> DataFrame:
    """JSON text (or the bytes of it) to the columns of ``schema``; text that is not JSON gives nulls."""
    return messages.select(F.from_json(F.col(column).cast("string"), schema).alias("j")).select("j.*")


def to_json_text(df: DataFrame, column: str, name: str | None = None) -> DataFrame:
    """Serialise a nested column, for stores that hold flat columns only."""
    rest = [c for c in df.columns if c != column]
    return df.select(*rest, F.to_json(column).alias(name or column))


def to_kafka_payload(df: DataFrame, key_columns: list[str], sep: str = "|") -> DataFrame:
    """The two columns a Kafka sink writes: the key columns as text, and the row as JSON."""
    key = F.concat_ws(sep, *[F.col(c).cast("string") for c in key_columns])
    return df.select(key.alias("key"), F.to_json(F.struct(*df.columns)).alias("value"))
