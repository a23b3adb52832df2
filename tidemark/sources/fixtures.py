"""Deterministic generators. Each takes a frame of ``id`` and derives its rows,
so ``spark.range(n)`` and the ids of a table both work."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import amount, money

# The symbols, in order.
SYMBOLS = ("BTC", "ETH", "SOL", "XRP")

PARTITIONS = 16
BILLING_DAY = "2026-07-30"
PHASES = ("initial", "correction", "advance", "too_late")


def symbol_of(index: Column) -> Column:
    return F.element_at(F.array(*[F.lit(s) for s in SYMBOLS]), (index % len(SYMBOLS) + 1).cast("int"))


def _at(day: str, clock: str) -> Column:
    return F.lit(f"{day} {clock}").cast("timestamp")


def workload_rows(ids: DataFrame) -> DataFrame:
    """Uniform search workload over one month."""
    i = F.col("id")
    return ids.select(
        (i % 1000).alias("user_id"),
        (i + 1).alias("order_id"),
        (_at("2026-08-01", "00:00:00") + F.make_dt_interval(days=(i % 28).cast("int"))).alias("event_time"),
        symbol_of(i).alias("symbol"),
        _cents(i).alias("amount"),
    )


def _cents(i: Column) -> Column:
    return amount((i % 10000).cast("decimal(12,2)") / F.lit(100).cast("decimal(5,0)"))


def case_rows(ids: DataFrame, prefix: str, event_day: str, ingested_day: str, user: Column | None = None) -> DataFrame:
    """Event rows with a chosen user distribution (uniform over 1000 by default)."""
    i = F.col("id")
    minute = F.make_dt_interval(mins=(i % 60).cast("int"))
    return ids.select(
        F.concat(F.lit(f"{prefix}-"), i.cast("string")).alias("event_id"),
        (i % 1000 if user is None else user).cast("bigint").alias("user_id"),
        (i + 1).alias("order_id"),
        (_at(event_day, "00:00:00") + minute).alias("event_time"),
        (_at(ingested_day, "01:00:00") + minute).alias("ingested_at"),
        symbol_of(i).alias("symbol"),
        F.lit(1).alias("version"),
        _cents(i).alias("amount"),
    )


def hot_user(hot_below: int) -> Column:
    """User 0 for the first ids, uniform over 1000 after them."""
    return F.when(F.col("id") < hot_below, F.lit(0)).otherwise(F.col("id") % 1000)


def zipf_key(ids: DataFrame, keys: int, resolution: int = 2**32, step: int = 2654435761) -> DataFrame:
    """Add ``rank`` in 1..keys with about 1/rank frequency (inverse of ln).

    The uniform value is a multiplicative hash of the id with ``resolution`` steps; ids repeat after 2^31.
    """
    u = F.pmod(F.pmod(F.col("id"), F.lit(2**31)) * F.lit(step), F.lit(resolution)) / F.lit(float(resolution))
    return ids.withColumn("rank", F.floor(F.pow(F.lit(float(keys)), u)).cast("bigint"))


def _orders(df: DataFrame, p: Column, sequence: Column, fee: Column, clock: str) -> DataFrame:
    return df.select(
        F.format_string("customer-%02d", p).alias("customer_id"),
        p.cast("int").alias("source_partition"),
        sequence.cast("bigint").alias("sequence"),
        money(fee).alias("fee"),
        _at(BILLING_DAY, clock).alias("occurred_at"),
        (sequence - 1).cast("bigint").alias("offset"),
    )


def billing_phase(spark: SparkSession, phase: str) -> DataFrame:
    """One phase of the staged billing scenario over 16 source partitions."""
    every, p = spark.range(PARTITIONS), F.col("id")
    first, rest = every.where("id = 0"), every.where("id > 0")
    one = F.lit(1)
    if phase == "initial":
        return (
            _orders(every, p, one, p + 1, "12:00:10")
            .unionByName(_orders(first, p, F.lit(2), F.lit(14), "12:04:40"))
            .unionByName(_orders(first, p, F.lit(3), one, "12:06:00"))
            .unionByName(_orders(rest, p, F.lit(2), one, "12:06:00"))
        )
    if phase == "correction":
        return _orders(first, p, F.lit(4), F.lit(3), "12:03:00")
    if phase == "advance":
        return _orders(every, p, F.when(p == 0, 5).otherwise(3), one, "12:08:00")
    if phase == "too_late":
        return _orders(first, p, F.lit(6), F.lit(9), "12:02:00")
    raise ValueError(f"unknown phase {phase}")
