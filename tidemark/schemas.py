"""Explicit schemas. Nothing in this package infers a schema."""

from pyspark.sql import types as T

MONEY = T.DecimalType(19, 2)
AMOUNT = T.DecimalType(12, 2)


_TYPES = {
    "string": T.StringType(),
    "binary": T.BinaryType(),
    "boolean": T.BooleanType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "money": MONEY,
    "amount": AMOUNT,
    "labels": T.MapType(T.StringType(), T.StringType()),
}


def table(spec: str) -> T.StructType:
    """A schema from ``name kind, ...``; works before any session exists."""
    pairs = (column.split() for column in spec.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


PURCHASE = table("customer_id string, product string, amount money, occurred_at timestamp")

ORDER_EVENT = table(
    "customer_id string, source_partition int, sequence bigint, fee money, occurred_at timestamp"
)

FEE_REPORT = table(
    "customer_id string, window_start timestamp, window_end timestamp, "
    "total_fee money, event_count bigint"
)

CART_ACTIVITY = table(
    "arrival bigint, customer_id string, amount money, probe boolean, t_ms bigint"
)

# The JSON payloads. The order payload has no partition: that comes from the record.
PURCHASE_WIRE = table("customerId string, product string, amount money, occurredAt timestamp")
ORDER_WIRE = table("customerId string, sequence bigint, fee money, occurredAt timestamp")

# The columns a message-log source delivers.
RECORD = table(
    "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
)

CUSTOMER_SPEND = table("customer_id string, amount money, updated_at timestamp")

AUDIT = table(
    "source_partition int, sequence_number bigint, customer_id string, "
    "fee money, occurred_at timestamp"
)

# Column order is part of the contract of this append table.
SINK_EVENT = table(
    "event_id string, occurred_at timestamp, customer_id string, symbol string, amount amount"
)

WORKLOAD_EVENT = table(
    "user_id bigint, order_id bigint, event_time timestamp, symbol string, amount amount"
)

CASE_EVENT = table(
    "event_id string, user_id bigint, order_id bigint, event_time timestamp, "
    "ingested_at timestamp, symbol string, version int, amount amount"
)

METRIC = table("metric string, labels labels, ts timestamp, value double")
