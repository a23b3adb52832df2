"""The given tables seen as the domain's inputs.

customer = user, fee = value, event time = ts, source partition = id % 16,
sequence = rank in the partition. The events lie in time order, so arrival
order is shifted by a fixed rule to create disorder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import amount, money
from tidemark.sources.fixtures import PARTITIONS, symbol_of

ARRIVALS_PER_BATCH = 50
SHIFT = "pmod(event_id * 7919, 197)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table; its zone-less times are read as instants in UTC.

    The declared type is what makes them instants: a cast after the scan would
    keep time filters from being pushed into it.
    """
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    found = spark.read.parquet(path).schema
    instants = [
        T.StructField(f.name, T.TimestampType() if isinstance(f.dataType, T.TimestampNTZType) else f.dataType)
        for f in found.fields
    ]
    return spark.read.schema(T.StructType(instants)).parquet(path)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events")


def fee_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order events with arrival position, arrival batch, offset and a recorded clock."""
    e = events(spark, sf_dir)
    spot = F.expr(f"event_id + {SHIFT}")
    return e.select(
        "event_id",
        F.format_string("user-%d", "user_id").alias("customer_id"),
        (F.col("event_id") % PARTITIONS).cast("int").alias("source_partition"),
        F.expr(f"event_id div {PARTITIONS} + 1").alias("sequence"),
        money(F.col("value")).alias("fee"),
        F.col("ts").alias("occurred_at"),
        F.expr(f"(event_id + {SHIFT}) * 197 + {SHIFT}").alias("arrival"),
        F.expr(f"(event_id + {SHIFT}) div {ARRIVALS_PER_BATCH}").alias("arrival_batch"),
        F.expr(f"event_id div {PARTITIONS}").alias("offset"),
        (F.lit("2024-02-01 00:00:00").cast("timestamp") + F.make_dt_interval(secs=spot.cast("decimal(18,6)"))).alias("arrived_at"),
    )


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as raw purchases: untidy names, some blank, some without an amount."""
    o = table(spark, sf_dir, "orders")
    key = F.col("o_orderkey")
    return o.select(
        key.alias("arrival"),
        F.when(key % 11 == 0, F.lit(" \t "))
        .otherwise(F.concat(F.lit("  CUST-"), (F.col("o_custkey")).cast("string"), F.lit(" \t")))
        .alias("customer_id"),
        F.when(key % 13 == 0, F.lit("")).otherwise(F.concat(F.lit(" "), "o_orderpriority", F.lit("\n"))).alias("product"),
        F.when(key % 7 == 0, F.lit(0)).otherwise(money(F.col("o_totalprice"))).cast("decimal(19,2)").alias("amount"),
        F.col("o_orderdate").alias("occurred_at"),
    )


def workload(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as the search workload."""
    li = table(spark, sf_dir, "lineitem")
    return li.select(
        F.col("l_suppkey").alias("user_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_shipdate").alias("event_time"),
        symbol_of(F.col("l_partkey")).alias("symbol"),
        amount(F.col("l_extendedprice")).alias("amount"),
    )


def fact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as versioned fact rows: every third event corrects an earlier identity."""
    e = events(spark, sf_dir)
    i = F.col("event_id")
    return e.select(
        F.concat(F.lit("order-"), F.expr("case when event_id % 3 = 2 then event_id - 1 else event_id end").cast("string")).alias("event_id"),
        "user_id",
        i.alias("order_id"),
        F.col("ts").alias("event_time"),
        (F.col("ts") + F.when(i % 7 == 0, F.expr("interval 2 days")).otherwise(F.expr("interval 0 days"))).alias("ingested_at"),
        symbol_of(i).alias("symbol"),
        F.when(i % 3 == 2, 2).otherwise(1).alias("version"),
        amount(F.col("value")).alias("amount"),
    )


def cart_activity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases write to carts, views probe them."""
    e = events(spark, sf_dir).where("event_type in ('purchase', 'view')")
    return e.select(
        F.col("event_id").alias("arrival"),
        F.format_string("user-%d", "user_id").alias("customer_id"),
        money(F.col("value")).alias("amount"),
        (F.col("event_type") == "view").alias("probe"),
        F.unix_millis("ts").alias("t_ms"),
    )


def metric_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as samples of four metrics, one series per instance (user % 4)."""
    e = events(spark, sf_dir)
    i = F.col("event_id")
    samples = F.array(
        F.struct(F.lit("up").alias("metric"), F.when(F.col("event_type") == "error", 0.0).otherwise(1.0).alias("value")),
        F.struct(F.lit("records_in").alias("metric"), F.pmod(i, F.lit(500)).cast("double").alias("value")),
        F.struct(F.lit("busy_ms").alias("metric"), (F.pmod(F.expr("event_id div 100"), F.lit(2)) * 500 + F.col("value") * 10).alias("value")),
        F.struct(F.lit("watermark_ms").alias("metric"), (F.unix_millis("ts") - 30000).cast("double").alias("value")),
    )
    return e.select(
        F.explode(samples).alias("s"),
        F.create_map(F.lit("instance"), F.concat(F.lit("i-"), (F.col("user_id") % 4).cast("string"))).alias("labels"),
        "ts",
    ).select("s.metric", "labels", "ts", "s.value")


def logins(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as logins with derived places, devices and cards."""
    e = events(spark, sf_dir)
    i = F.col("event_id")
    return e.select(
        "event_id",
        "user_id",
        "event_type",
        "ts",
        money(F.col("value")).alias("amount"),
        (F.pmod(i * 37, F.lit(121)) - 60).cast("double").alias("lat"),
        (F.pmod(i * 53, F.lit(301)) - 150).cast("double").alias("lon"),
        (F.col("user_id") % 20).alias("device"),
        F.pmod(i * 31, F.lit(11)).alias("card"),
    )
