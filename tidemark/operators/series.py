"""Metric series over time: rates, increases, held conditions.

Input rows are (metric, labels, ts, value); a series is a metric with its labels.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import from_micros, micros
from tidemark.operators.scan import AUTO, Running, chunk_width, running, trailing


def series(df: DataFrame, metric: str, *labels: str) -> DataFrame:
    """One metric as (labels..., ts, us, value), one row per series and time."""
    picked = df.where(F.col("metric") == metric).select(
        *[F.col("labels")[n].alias(n) for n in labels], "ts", micros(F.col("ts")).alias("us"), "value"
    )
    return picked.groupBy(*labels, "ts", "us").agg(F.max("value").alias("value"))


def latest_value(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.max_by("value", "us").alias("value"))


def _growth(before: Column, after: Column) -> Column:
    """A fall means the counter began again at zero."""
    return F.when(after < before, after).otherwise(after - before).cast("decimal(28,6)")


def counter_totals(df: DataFrame, keys: Sequence[str], width: int | str | None = AUTO) -> DataFrame:
    """Add ``total``: growth since a series' first sample, resets taken into account.

    Chunks of a series are grown on their own, then joined end to end from one
    summary row per chunk; the samples are shuffled once.
    """
    keys = list(keys)
    if width == AUTO:
        width = chunk_width(df, "us")
    inside = Window.partitionBy(*keys, "_chunk").orderBy("us")
    start = F.lit(0).cast("bigint") if width is None else F.col("us") - F.pmod("us", F.lit(width))
    chunked = df.withColumn("_chunk", start)
    so_far = inside.rowsBetween(Window.unboundedPreceding, 0)
    grown = chunked.withColumn("_step", _growth(F.lag("value").over(inside), F.col("value"))).withColumn(
        "_local", F.coalesce(F.sum("_step").over(so_far), F.lit(0)).cast("decimal(28,6)")
    )
    if width is None:
        return grown.select(*df.columns, F.col("_local").alias("total"))
    ends = grown.groupBy(*keys, "_chunk").agg(
        F.min_by("value", "us").alias("_first"), F.max_by("value", "us").alias("_last"), F.max("_local").alias("_grown")
    )
    in_order = Window.partitionBy(*keys).orderBy("_chunk")
    linked = ends.withColumn(
        "_link",
        F.coalesce(_growth(F.lag("_last").over(in_order), F.col("_first")), F.lit(0))
        + F.coalesce(F.lag("_grown").over(in_order), F.lit(0)),
    )
    starts = linked.select(*keys, "_chunk", F.sum("_link").over(in_order).alias("_start"))
    # A series may lack a label: null keys meet null keys.
    same = reduce(and_, [F.col(f"g.{k}").eqNullSafe(F.col(f"s.{k}")) for k in (*keys, "_chunk")])
    joined = grown.alias("g").join(starts.alias("s"), same).select("g.*", "_start")
    return joined.withColumn("total", (F.col("_start") + F.col("_local")).cast("decimal(28,6)")).select(*df.columns, "total")


def counter_increase(df: DataFrame, keys: Sequence[str], span_us: int) -> DataFrame:
    """Growth inside the trailing ``(t - span, t]`` at each sample, and its rate.

    ``increase`` is the growth from the first to the last sample inside the
    span, resets taken into account; ``rate`` divides it by the time between
    the two (null with a single sample). Nothing is extrapolated to the edges.

    The first sample of a span is found by one running value in reverse time:
    the earliest sample after ``t - span``.
    """
    keys = list(keys)
    width = chunk_width(df, "us")
    total = counter_totals(df, keys, width).withColumnRenamed("total", "_total")
    marks = total.select(
        *keys, (-F.col("us")).alias("_back"), F.struct(F.col("us").alias("us"), F.col("_total").alias("total")).alias("_mark")
    )
    asked = total.withColumn("_back", F.lit(span_us) - F.col("us"))
    first = running(
        asked.unionByName(marks, allowMissingColumns=True),
        keys,
        "_back",
        [Running("_first", "last", F.col("_mark"), -1)],
        width,
        peers=True,
    ).where(F.col("_mark").isNull())
    grown = F.col("_total") - F.col("_first.total")
    seconds = (F.col("us") - F.col("_first.us")) / F.lit(1e6)
    return first.select(
        *df.columns,
        grown.cast("double").alias("increase"),
        F.when(seconds > 0, grown.cast("double") / seconds).alias("rate"),
    )


def trailing_average(df: DataFrame, keys: Sequence[str], span_us: int, include_current: bool = True,
                     width: int | str | None = AUTO) -> DataFrame:
    """Average over the trailing span at each sample; null where the span is empty."""
    summed = trailing(
        df,
        keys,
        "us",
        span_us,
        {"_sum": F.col("value").cast("decimal(28,6)"), "_n": F.lit(1)},
        width,
        include_current=include_current,
    )
    mean = F.when(F.col("_n") > 0, F.col("_sum").cast("double") / F.col("_n"))
    return summed.withColumn("average", mean).drop("_sum", "_n")


def held(df: DataFrame, keys: Sequence[str], condition: Column, for_us: int, width: int | str | None = AUTO) -> DataFrame:
    """Stretches of consecutive samples that meet a condition for at least ``for_us``."""
    keys = list(keys)
    broken = F.when(~F.coalesce(condition, F.lit(False)), F.col("us"))
    marked = running(
        df.withColumn("_broken", broken), keys, "us", [Running("_since", "max", F.col("_broken"))], width
    )
    return (
        marked.where(F.col("_broken").isNull())
        .groupBy(*keys, "_since")
        .agg(F.min("us").alias("_from"), F.max("us").alias("_to"), F.count(F.lit(1)).alias("samples"))
        .where(F.col("_to") - F.col("_from") >= for_us)
        .select(
            *keys,
            from_micros(F.col("_from")).alias("active_from"),
            from_micros(F.col("_from") + for_us).alias("fires_at"),
            from_micros(F.col("_to")).alias("active_to"),
            "samples",
        )
    )
