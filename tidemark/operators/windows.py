"""Event-time windows as batch aggregations."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import from_micros, micros, money

FIVE_MINUTES = "5 minutes"


def fee_partials(df: DataFrame, *keys: str) -> DataFrame:
    """Mergeable (sum, count) partials."""
    return df.groupBy(*keys).agg(
        F.coalesce(F.sum("fee"), F.lit(0)).alias("total_fee"), F.count(F.lit(1)).alias("event_count")
    )


def fee_merge(partials: DataFrame, *keys: str) -> DataFrame:
    """Merge partials of any origin into totals."""
    return partials.groupBy(*keys).agg(
        money(F.coalesce(F.sum("total_fee"), F.lit(0))).alias("total_fee"),
        F.coalesce(F.sum("event_count"), F.lit(0)).cast("bigint").alias("event_count"),
    )


def windowed_fees(df: DataFrame, size: str = FIVE_MINUTES, slide: str | None = None) -> DataFrame:
    """Fee reports per customer and clock-aligned ``[start, end)`` window.

    Works on batches and on streams; on a stream the caller sets the watermark.
    """
    window = F.window("occurred_at", size, slide) if slide else F.window("occurred_at", size)
    return (
        df.groupBy("customer_id", window.alias("w"))
        .agg(money(F.sum("fee")).alias("total_fee"), F.count(F.lit(1)).alias("event_count"))
        .select(
            "customer_id",
            F.col("w.start").alias("window_start"),
            F.col("w.end").alias("window_end"),
            "total_fee",
            "event_count",
        )
    )


def sessions(
    df: DataFrame,
    keys: Sequence[str],
    ts: str,
    gap_us: int,
    sums: dict[str, Column],
) -> DataFrame:
    """Activity separated by more than ``gap_us``, with counts or sums per session.

    Rows are first reduced to panes of one gap: two rows in a pane are always in
    one session. A key then has at most span/gap panes however many rows it has,
    and only panes are put in order.
    """
    keys = list(keys)
    us = micros(F.col(ts))
    panes = (
        df.select(*keys, us.alias("_us"), *[e.alias(n) for n, e in sums.items()])
        .groupBy(*keys, (F.col("_us") - F.pmod("_us", F.lit(gap_us))).alias("_pane"))
        .agg(F.min("_us").alias("_first"), F.max("_us").alias("_last"), *[F.sum(n).alias(n) for n in sums])
    )
    by_pane = Window.partitionBy(*keys).orderBy("_pane")
    opened = panes.withColumn(
        "_open",
        F.when(
            F.coalesce(F.col("_first") - F.lag("_last").over(by_pane) > gap_us, F.lit(True)), F.col("_first")
        ),
    ).withColumn("_start", F.last("_open", ignorenulls=True).over(by_pane))
    return (
        opened.groupBy(*keys, "_start")
        .agg(F.max("_last").alias("_last"), *[F.sum(n).alias(n) for n in sums])
        .select(
            *keys,
            from_micros(F.col("_start")).alias("session_start"),
            from_micros(F.col("_last") + gap_us).alias("session_end"),
            *sums,
        )
    )
