"""Declared schemas of the event streams and lookups. Nothing is inferred at run time."""

from pyspark.sql import types as T

_TYPES = {
    "timestamp": T.TimestampType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "string": T.StringType(),
}


def schema(fields: str) -> T.StructType:
    """``"name type, key type!"``; the mark means not null. Unlike a DDL string it needs no running session."""
    built = T.StructType()
    for field in fields.split(","):
        name, kind = field.split()
        built.add(name, _TYPES[kind.rstrip("!")], nullable=not kind.endswith("!"))
    return built


RAW_SALE = schema("event_time timestamp, customer_id int, product_id int, quantity int")

ENRICHED_SALE = schema(
    "event_time timestamp, customer_id int, region string, product_id int, product_name string, "
    "category string, quantity int, unit_price double, total_amount double"
)

CUSTOMER = schema("customer_id int!, customer_name string, region string, gender string")

PRODUCT = schema("product_id int!, product_name string, category string, subcategory string, base_price double")

USER_ACTION = schema("user_id string, event_time timestamp, action string, amount int")

USER_CLICK = schema("user_id string, event_time timestamp, action string")

ORDER_AMOUNT = schema("event_time timestamp, customer_id int, amount double, region string")

TRANSACTION = schema("transaction_id bigint, user_id int, amount int, region string, event_time timestamp")
