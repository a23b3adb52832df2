"""Operators on Spark's own watermark: for one source partition or equal progress.

With uneven partitions Spark's watermark runs ahead of the slowest one; use
``tidemark.streaming.billing`` there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.functions import money
from tidemark.operators.windows import windowed_fees

BOUND = "30 seconds"
# Bound plus allowed lateness: state lives until its window can no longer change.
BOUND_AND_LATENESS = "150 seconds"


def closed_windows(orders: DataFrame, bound: str = BOUND, size: str = "5 minutes") -> DataFrame:
    """For append mode: each window once, when the watermark passes its end."""
    return windowed_fees(orders.withWatermark("occurred_at", bound), size)


def corrected_windows(orders: DataFrame, size: str = "5 minutes", bound: str = BOUND_AND_LATENESS) -> DataFrame:
    """For update mode: complete totals again after every accepted late record."""
    return windowed_fees(orders.withWatermark("occurred_at", bound), size)


def first_only(orders: DataFrame, bound: str, *keys: str) -> DataFrame:
    """Drop repeats of a key that arrive within the bound of each other."""
    return orders.withWatermark("occurred_at", bound).dropDuplicatesWithinWatermark(list(keys))


def interval_join(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, within: str, bound: str) -> DataFrame:
    """Pairs of two streams with ``right_ts`` in ``[left_ts, left_ts + within]``.

    Both watermarks and the time condition let Spark drop join state.
    """
    a = left.withWatermark(left_ts, bound).alias("a")
    b = right.withWatermark(right_ts, bound).alias("b")
    close = (F.col(f"b.{right_ts}") >= F.col(f"a.{left_ts}")) & (
        F.col(f"b.{right_ts}") <= F.col(f"a.{left_ts}") + F.expr(f"interval {within}")
    )
    return a.join(b, (F.col(f"a.{key}") == F.col(f"b.{key}")) & close)


def session_fees(orders: DataFrame, gap: str, bound: str) -> DataFrame:
    return (
        orders.withWatermark("occurred_at", bound)
        .groupBy("customer_id", F.session_window("occurred_at", gap).alias("w"))
        .agg(money(F.sum("fee")).alias("total_fee"), F.count(F.lit(1)).alias("event_count"))
        .select("customer_id", F.col("w.start").alias("session_start"), F.col("w.end").alias("session_end"), "total_fee", "event_count")
    )


def saved_windows(spark: SparkSession, checkpoint: str) -> DataFrame:
    """Open window state of a stopped windowed query as mergeable partials.

    A planned change of code or parallelism reads the state as a table, and the
    new query's output is merged onto it with ``fee_merge``.
    """
    state = spark.read.format("statestore").load(checkpoint)
    return state.select(
        F.col("key.customer_id").alias("customer_id"),
        F.col("key.window.start").alias("window_start"),
        F.col("key.window.end").alias("window_end"),
        F.col("value.sum").alias("total_fee"),
        F.col("value.count").alias("event_count"),
    )


def to_console(stream: DataFrame, checkpoint: str, mode: str = "append") -> StreamingQuery:
    """Print each micro-batch to the driver's output."""
    return (
        stream.writeStream.format("console")
        .outputMode(mode)
        .option("truncate", False)
        .option("checkpointLocation", checkpoint)
        .start()
    )


def use_state_store(spark: SparkSession, kind: str) -> None:
    """Choose where keyed state lives: ``memory`` or ``rocksdb``. Results do not differ."""
    providers = {
        "memory": "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider",
        "rocksdb": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    }
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", providers[kind])


def tag_revision(reports: DataFrame, revision: str) -> DataFrame:
    """Attach a revision label and the partition that produced each row."""
    return reports.withColumns({"revision": F.lit(revision), "window_partition": F.spark_partition_id()})
