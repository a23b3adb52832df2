"""Joins: small dimensions, point-in-time values, intervals, visibility."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import micros
from tidemark.operators.scan import AUTO, Chunks, Running, plan_chunks, running

BROADCAST_ROWS = 100_000


def small_or_plain(dim: DataFrame, max_rows: int = BROADCAST_ROWS) -> DataFrame:
    """Mark a dimension for broadcast only after counting that it is small.

    The count stops after ``max_rows``. A larger dimension is returned as it is
    and joins by shuffle, where adaptive execution splits skewed keys.
    """
    if dim.limit(max_rows + 1).count() <= max_rows:
        return F.broadcast(dim)
    return dim


def enrich(facts: DataFrame, dim: DataFrame, on: Sequence[str], how: str = "left", max_rows: int = BROADCAST_ROWS) -> DataFrame:
    return facts.join(small_or_plain(dim, max_rows), list(on), how)


def visible_rows(facts: DataFrame, grants: DataFrame, on: Sequence[str]) -> DataFrame:
    """Only rows the caller has been granted; grants never duplicate rows."""
    return facts.join(grants, list(on), "left_semi")


def unmatched(facts: DataFrame, dim: DataFrame, on: Sequence[str]) -> DataFrame:
    """Rows without a dimension row."""
    return facts.join(dim, list(on), "left_anti")


def as_of(facts: DataFrame, rates: DataFrame, keys: Sequence[str], ts: str, value: str,
          width: Chunks | int | str | None = AUTO) -> DataFrame:
    """Add the value valid at each fact's time: the latest rate at or before it.

    Facts and rates are put on one time line per key and the last rate is
    carried forward, in time chunks, so a key that holds much of the table is
    spread over many tasks. A rate valid at the very time of a fact counts.
    """
    keys = list(keys)
    if width == AUTO:
        both = facts.select(*keys, ts).unionByName(rates.select(*keys, ts))
        width = plan_chunks(both, keys, micros(F.col(ts)))
    line = facts.withColumns({"_us": micros(F.col(ts)), "_rate": F.lit(None).cast(rates.schema[value].dataType)}).unionByName(
        rates.groupBy(*keys, micros(F.col(ts)).alias("_us")).agg(F.max(value).alias("_rate")).withColumn("_israte", F.lit(True)),
        allowMissingColumns=True,
    )
    carried = running(line, keys, "_us", [Running(value, "last", F.col("_rate"))], width, peers=True)
    return carried.where("_israte is null").drop("_us", "_rate", "_israte")


def within_interval(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str,
                    before_us: int, after_us: int) -> DataFrame:
    """Pairs with ``right_ts`` in ``[left_ts - before, left_ts + after]``.

    Both sides are cut into time buckets as long as the interval, so the join
    key is (keys, bucket) and a busy key is spread over its buckets; a left row
    looks into the two buckets its interval can touch.
    """
    keys = list(keys)
    span = before_us + after_us + 1
    lus, rus = micros(F.col(left_ts)), micros(F.col(right_ts))
    low = lus - before_us - F.pmod(lus - before_us, F.lit(span))
    lefts = left.withColumn("_lus", lus).withColumn("_bucket", F.explode(F.array(low, low + span)))
    rights = right.withColumn("_rus", rus).withColumn(
        "_bucket", rus - F.pmod(rus, F.lit(span))
    )
    joined = lefts.join(rights, [*keys, "_bucket"])
    return joined.where(F.col("_rus").between(F.col("_lus") - before_us, F.col("_lus") + after_us)).drop(
        "_lus", "_rus", "_bucket"
    )
