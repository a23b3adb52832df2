"""Message payloads: JSON in the value, the partition from the record itself."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.functions import money

_CORRUPT = "_corrupt"

# Fields without which a payload is no event.
PURCHASE_REQUIRED = ("customer_id", "product", "amount", "occurred_at")
ORDER_REQUIRED = ("customer_id", "sequence", "fee", "occurred_at")


def _parsed(value: Column, schema: T.StructType, strict: bool) -> Column:
    text = value.cast("string")
    if strict:
        return F.from_json(text, schema, {"mode": "FAILFAST"})
    lenient = T.StructType([*schema.fields, T.StructField(_CORRUPT, T.StringType())])
    return F.from_json(text, lenient, {"columnNameOfCorruptRecord": _CORRUPT})


def decode_purchases(records: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Purchases from message values; a bad value fails the job when strict.

    The payload is an array's only element, taken out: conditions on its fields cannot be moved below that, where each
    would parse the value again.
    """
    body = records.select(*keep, F.explode(F.array(_parsed(F.col("value"), schemas.PURCHASE_WIRE, strict))).alias("b"))
    columns = [
        F.col("b.customerId").alias("customer_id"),
        F.col("b.product").alias("product"),
        F.col("b.amount").alias("amount"),
        F.col("b.occurredAt").alias("occurred_at"),
    ]
    if not strict:
        columns.append(F.col(f"b.{_CORRUPT}").alias("corrupt"))
    return body.select(*keep, *columns)


def decode_orders(records: DataFrame, strict: bool = True, keep: tuple[str, ...] = ()) -> DataFrame:
    """Order events; ``source_partition`` is the record's, never the payload's.

    A quoted fee and a bare number both decode.
    """
    body = records.select(*keep, "partition", _parsed(F.col("value"), schemas.ORDER_WIRE, strict).alias("b"))
    columns = [
        F.col("b.customerId").alias("customer_id"),
        F.col("partition").cast("int").alias("source_partition"),
        F.col("b.sequence").alias("sequence"),
        F.col("b.fee").alias("fee"),
        F.col("b.occurredAt").alias("occurred_at"),
    ]
    if not strict:
        columns.append(F.col(f"b.{_CORRUPT}").alias("corrupt"))
    return body.select(*keep, *columns)


def incomplete(name: str = "corrupt", *required: str) -> Column:
    """Marks lenient rows to quarantine: undecodable, or a required value missing."""
    bad = F.col(name).isNotNull()
    for column in required:
        bad = bad | F.col(column).isNull()
    return bad


def _instant(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'")


def encode_orders(orders: DataFrame, topic: str = "billing-orders") -> DataFrame:
    """Order events as records; needs ``offset`` and, optionally, ``arrived_at``."""
    body = F.to_json(
        F.struct(
            F.col("customer_id").alias("customerId"),
            "sequence",
            money(F.col("fee")).cast("string").alias("fee"),
            _instant(F.col("occurred_at")).alias("occurredAt"),
        )
    )
    arrived = F.col("arrived_at") if "arrived_at" in orders.columns else F.col("occurred_at")
    return orders.select(
        F.encode("customer_id", "utf-8").alias("key"),
        F.encode(body, "utf-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.col("source_partition").cast("int").alias("partition"),
        F.col("offset").cast("bigint").alias("offset"),
        arrived.cast("timestamp").alias("timestamp"),
    )


def encode_purchases(purchases: DataFrame, topic: str = "purchase-events", partitions: int = 4) -> DataFrame:
    """Purchases as records; ``arrival`` becomes the offset."""
    body = F.to_json(
        F.struct(
            F.col("customer_id").alias("customerId"),
            "product",
            F.col("amount").alias("amount"),
            _instant(F.col("occurred_at")).alias("occurredAt"),
        )
    )
    return purchases.select(
        F.encode("customer_id", "utf-8").alias("key"),
        F.encode(body, "utf-8").alias("value"),
        F.lit(topic).alias("topic"),
        F.pmod(F.hash("customer_id"), F.lit(partitions)).cast("int").alias("partition"),
        F.col("arrival").cast("bigint").alias("offset"),
        F.col("occurred_at").cast("timestamp").alias("timestamp"),
    )
