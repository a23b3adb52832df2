"""Selective reads of the fact table.

Every search names its columns and adds the month bounds that follow from its
time range, so the scan prunes both month folders and row groups.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TimeLike = dt.datetime | str


def _time(value: TimeLike) -> dt.datetime:
    return dt.datetime.fromisoformat(value) if isinstance(value, str) else value


def in_range(df: DataFrame, start: TimeLike, end: TimeLike, ts: str = "event_time", month: str = "event_month") -> Column:
    """``[start, end)`` on event time, plus the months it can touch."""
    lo, hi = _time(start), _time(end)
    within = (F.col(ts) >= F.lit(lo.isoformat(" ")).cast(df.schema[ts].dataType)) & (
        F.col(ts) < F.lit(hi.isoformat(" ")).cast(df.schema[ts].dataType)
    )
    if month in df.columns:
        last = hi - dt.timedelta(microseconds=1)
        within = within & F.col(month).between(lo.year * 100 + lo.month, last.year * 100 + last.month)
    return within


def user_range(df: DataFrame, user_id: int, start: TimeLike, end: TimeLike) -> DataFrame:
    return df.where((F.col("user_id") == user_id) & in_range(df, start, end))


def order_lookup(df: DataFrame, order_id: int) -> DataFrame:
    return df.where(F.col("order_id") == order_id)


def symbol_range(df: DataFrame, symbol: str, start: TimeLike, end: TimeLike) -> DataFrame:
    return df.where((F.col("symbol") == symbol) & in_range(df, start, end))


def date_range(df: DataFrame, start: TimeLike, end: TimeLike) -> DataFrame:
    return df.where(in_range(df, start, end))


def counted(df: DataFrame, name: str = "rows") -> DataFrame:
    return df.agg(F.count(F.lit(1)).alias(name))


def keyset_page(df: DataFrame, after: tuple, columns: Sequence[str], limit: int,
                order: Sequence[str] = ("event_time", "order_id")) -> DataFrame:
    """The next page after a position, without OFFSET.

    The plain bound on the leading column is implied by the row comparison; it
    is stated because it can be pushed into the scan.
    """
    types = [df.schema[c].dataType for c in order]
    at = [F.lit(v).cast(t) for v, t in zip(after, types)]
    beyond = F.struct(*order) > F.struct(*[a.alias(c) for a, c in zip(at, order)])
    return df.where((F.col(order[0]) >= at[0]) & beyond).select(*columns).orderBy(*order).limit(limit)


def key_counts(df: DataFrame, key: str) -> DataFrame:
    """Rows per key and their share of the table."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    total = per_key.agg(F.sum("rows")).scalar()
    return per_key.withColumn("share", F.col("rows") / total)


def heaviest_keys(df: DataFrame, key: str, n: int) -> DataFrame:
    """A top-n report; equal counts are ordered by key."""
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    return per_key.orderBy(F.col("rows").desc(), key).limit(n)
