from datetime import timedelta

from helpers import at, order, rows
from pyspark.sql import functions as F

from weirflow.functions.payload import parse_csv_lines, parse_json_values, to_json_text, to_kafka_payload
from weirflow.plans.reports import user_session_amounts
from weirflow.sources.schemas import ORDER_AMOUNT, USER_ACTION, USER_CLICK

# A visitor past midnight with a pause of just the gap, one with a pause a second longer, and one with a single event.
LINES = [
    "ada,2025-08-15 23:52:00,view,4",
    "ada,2025-08-16 00:07:00,order,120",
    "ben,2025-08-16 07:30:00,order,15",
    "ben,2025-08-16 07:45:01,order,25",
    "ben,2025-08-16 09:10:30,view,1",
    "cyd,2025-08-16 07:31:00,view,2",
]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def test_lines_to_sessions(spark):
    events = parse_csv_lines(lines(spark, LINES), USER_ACTION)
    assert events.schema == USER_ACTION
    assert rows(user_session_amounts(events)) == sorted(
        [
            (at("00:00") - timedelta(minutes=8), at("00:22"), "ada", 124),
            (at("07:30"), at("07:45"), "ben", 15),
            (at("07:45:01"), at("08:00:01"), "ben", 25),
            (at("09:10:30"), at("09:25:30"), "ben", 1),
            (at("07:31"), at("07:46"), "cyd", 2),
        ],
        key=order,
    )


def test_bad_lines_give_nulls(spark):
    events = parse_csv_lines(lines(spark, ["bad,xx,zz,yy", "short", ""]), USER_ACTION)
    assert rows(events) == sorted(
        [("bad", None, "zz", None), ("short", None, None, None), ("", None, None, None)], key=order
    )
    assert user_session_amounts(events).count() == 0


def test_three_columns_and_other_separators(spark):
    clicks = parse_csv_lines(lines(spark, LINES[:1]), USER_CLICK)
    assert rows(clicks) == [("ada", at("00:00") - timedelta(minutes=8), "view")]
    piped = parse_csv_lines(lines(spark, ["u1|2025-08-16 10:01:00|buy"]), USER_CLICK, sep="|")
    assert rows(piped) == [("u1", at("10:01"), "buy")]


def test_json_values_as_bytes(spark):
    values = [
        '{"event_time":"2025-08-16T10:01:00","customer_id":7,"amount":12.5,"region":"East"}',
        '{"customer_id":8}',
        "not json",
    ]
    messages = lines(spark, values).select(F.col("value").cast("binary").alias("value"))
    parsed = parse_json_values(messages, ORDER_AMOUNT)
    assert parsed.schema == ORDER_AMOUNT
    assert rows(parsed) == sorted(
        [(at("10:01"), 7, 12.5, "East"), (None, 8, None, None), (None, None, None, None)], key=order
    )


def test_kafka_payload(spark):
    df = spark.createDataFrame([(1, "a", 2.5)], "id int, name string, amount double")
    assert rows(to_kafka_payload(df, ["id", "name"])) == [("1|a", '{"id":1,"name":"a","amount":2.5}')]
    assert to_kafka_payload(df, ["id"]).dtypes == [("key", "string"), ("value", "string")]


def test_nested_column_to_json_text(spark):
    df = spark.sql("select 1 as id, array(named_struct('r', 2.5D, 'u', 3)) as items")
    assert rows(to_json_text(df, "items", "items_json")) == [(1, '[{"r":2.5,"u":3}]')]
