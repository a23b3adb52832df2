"""Running values per key that do not need a whole key in one task.

``sum(x) over (partition by key order by pos)`` sends every row of a key to one
task, so a key holding a third of a table makes one task read a third of the
table. ``running`` cuts each key into chunks of ``width`` order positions:

1. one total per (key, chunk), with map-side combine;
2. a window over those totals gives what each chunk starts from;
3. that start is added as one extra first row of the chunk, and an ordinary
   window runs inside (key, chunk).

The rows are shuffled once, by (key, chunk), and a key has at most span/width
totals. What is cut follows from the table unless the caller gives a width
(``plan_chunks``): only keys with more rows than one task should order, into
chunks that are narrow where rows are dense. A table that is small as a whole
takes the plain window.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from tidemark.session import keep

# What one task may be given to put in order, unless the session sets another number.
ROWS_PER_CHUNK = 1_000_000
ROWS_SETTING = "tidemark.rowsPerChunk"
# Slices of as many order positions, for orders that number the rows.
PER_ROWS = None
AUTO = "auto"
HOUR_US = 3_600_000_000
DAY_US = 24 * HOUR_US

_CHUNK, _CARRY, _HOT = "_chunk", "_carry", "_hot"
# The one chunk of a key that is not cut.
_WHOLE = -(1 << 61)
# Up to here the list of hot keys is sent to every task.
BROADCAST_KEYS = 100_000


@dataclass(frozen=True)
class Running:
    """One running value.

    how:  sum | max | min | last (last non-null value in order)
    upto: 0 includes the current position, -1 stops just before it
    """

    name: str
    how: str
    value: Column
    upto: int = 0


def rows_per_chunk(spark: SparkSession) -> int:
    return int(spark.conf.get(ROWS_SETTING, str(ROWS_PER_CHUNK)))


def chunk_width(df: DataFrame, order: str | Column, slice_width: int | None = HOUR_US, rows: int | None = None) -> int | None:
    """A chunk width that keeps the densest stretch of the table near ``rows`` rows.

    Rows are counted per slice of the order column, over all keys: no key can
    have more in a chunk than the table has. None means the whole table is small.
    """
    rows = rows or rows_per_chunk(df.sparkSession)
    slice_width = slice_width or rows
    at = F.col(order) if isinstance(order, str) else order
    per_slice = df.groupBy((at - F.pmod(at, F.lit(slice_width))).alias("_slice")).agg(F.count(F.lit(1)).alias("_n"))
    total, densest = per_slice.agg(F.sum("_n"), F.max("_n")).first()
    if total is None or total <= rows:
        return None
    if densest <= rows:
        return slice_width * (rows // densest)
    return max(1, slice_width * rows // densest)


@dataclass(frozen=True)
class Chunks:
    """How to cut: the width, and the stored list of keys worth cutting."""

    width: int
    hot: DataFrame


def plan_chunks(df: DataFrame, keys: Sequence[str], order: str | Column, slice_width: int | None = HOUR_US) -> Chunks | int | None:
    """Find the chunk width and the hot keys of a table, in two narrow passes.

    A hot key has more rows than a chunk may have, so there are few of them.
    """
    most = rows_per_chunk(df.sparkSession)
    width = chunk_width(df, order, slice_width, most)
    if width is None or not keys:
        return width
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most)
    return Chunks(width, keep(counts.select(*[F.col(k).alias(f"{_HOT}_{k}") for k in keys]), "hot-keys"))


def _mark_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> DataFrame:
    listed = F.broadcast(hot) if hot.count() <= BROADCAST_KEYS else hot
    same = reduce(and_, [F.col(k).eqNullSafe(F.col(f"{_HOT}_{k}")) for k in keys])
    return df.join(listed.withColumn(_HOT, F.lit(True)), same, "left").select(*df.columns, _HOT)


def _total(how: str, name: str, position: Column) -> Column:
    value = F.col(name)
    if how == "last":
        return F.max_by(value, F.when(value.isNotNull(), position))
    return {"sum": F.sum, "max": F.max, "min": F.min}[how](value)


def _over(how: str, name: str) -> Column:
    if how == "last":
        return F.last(name, ignorenulls=True)
    return {"sum": F.sum, "max": F.max, "min": F.min}[how](name)


def _windowed(rows, partition, order, values, inputs, ties, peers) -> DataFrame:
    inside = Window.partitionBy(*partition).orderBy(order, *ties)
    frame = inside.rangeBetween if peers else inside.rowsBetween
    return rows.select(
        "*",
        *[_over(v.how, inputs[v.name]).over(frame(Window.unboundedPreceding, v.upto)).alias(v.name) for v in values],
    )


def running(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    values: Sequence[Running],
    width: Chunks | int | str | None = AUTO,
    ties: Sequence[str] = (),
    peers: bool = False,
    slice_width: int | None = HOUR_US,
) -> DataFrame:
    """Add running values per key in the order of ``order`` (a bigint).

    ``ties`` break equal positions. With ``peers`` rows at one position are
    treated as simultaneous (a RANGE frame) and ``ties`` must be empty.
    ``width`` is found with ``plan_chunks`` by default. A number cuts every key;
    None takes the plain window and is for a caller who has counted that a key
    fits into one chunk.
    """
    if peers and ties:
        raise ValueError("simultaneous rows cannot have a tie order")
    keys = list(keys)
    inputs = {v.name: f"_in_{v.name}" for v in values}
    if width == AUTO:
        width = plan_chunks(df, keys, order, slice_width)
    if width is None:
        work = df.select("*", *[v.value.alias(inputs[v.name]) for v in values])
        return _windowed(work, keys or [F.lit(0)], order, values, inputs, ties, peers).drop(*inputs.values())
    marked, step = df, width
    if isinstance(width, Chunks):
        marked, step = _mark_hot(df, keys, width.hot), width.width
    chunk = F.col(order) - F.pmod(F.col(order), F.lit(step))
    if isinstance(width, Chunks):
        chunk = F.when(F.col(_HOT), chunk).otherwise(F.lit(_WHOLE))
    work = marked.select(
        *df.columns,
        chunk.alias(_CHUNK),
        *[v.value.alias(inputs[v.name]) for v in values],
    )
    # Sums of sums are wider than the plain path's; the result gets its type, whatever the size of the table.
    sums = {
        v.name: T.DecimalType(min(38, kind.precision + 10), kind.scale)
        for v in values
        if v.how == "sum" and isinstance(kind := work.schema[inputs[v.name]].dataType, T.DecimalType)
    }

    position = F.struct(order, *ties) if ties else F.col(order)
    cut = work.where(F.col(_CHUNK) != _WHOLE) if isinstance(width, Chunks) else work
    totals = cut.groupBy(*keys, _CHUNK).agg(
        *[_total(v.how, inputs[v.name], position).alias(inputs[v.name]) for v in values]
    )
    before = Window.partitionBy(*(keys or [F.lit(0)])).orderBy(_CHUNK).rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        *keys,
        _CHUNK,
        (F.col(_CHUNK) - 1).alias(order),
        F.lit(True).alias(_CARRY),
        *[_over(v.how, inputs[v.name]).over(before).alias(inputs[v.name]) for v in values],
    ).where(reduce(or_, [F.col(c).isNotNull() for c in inputs.values()]))

    rows = work.withColumn(_CARRY, F.lit(False)).unionByName(starts, allowMissingColumns=True)
    out = _windowed(rows, [*keys, _CHUNK], order, values, inputs, ties, peers)
    out = out.where(~F.col(_CARRY)).drop(_CHUNK, _CARRY, *inputs.values())
    return out.withColumns({name: F.col(name).cast(kind) for name, kind in sums.items()}) if sums else out


def trailing(
    df: DataFrame,
    keys: Sequence[str],
    order: str,
    span: int,
    sums: dict[str, Column],
    width: Chunks | int | str | None = AUTO,
    include_current: bool = True,
) -> DataFrame:
    """Add trailing sums over ``(pos - span, pos]``, or ``[pos - span, pos)``
    when ``include_current`` is false.

    A sliding frame costs rows x frame size; here every row enters once with
    its value and leaves once with the negated value, so the cost is one running
    sum over twice the rows. Values must be exact types (integers or decimals).
    Rows at one position are simultaneous.
    """
    keys = list(keys)
    if any(name in df.columns for name in sums):
        raise ValueError("a trailing sum would shadow an input column")
    if width == AUTO:
        width = plan_chunks(df, keys, order)
    entering = df.select("*", *[e.alias(f"_step_{n}") for n, e in sums.items()])
    kinds = {n: entering.schema[f"_step_{n}"].dataType for n in sums}
    leaving = entering.select(
        *keys,
        (F.col(order) + span).alias(order),
        *[(-F.col(f"_step_{n}")).alias(f"_step_{n}") for n in sums],
        F.lit(True).alias("_leaves"),
    )
    stepped = running(
        entering.unionByName(leaving, allowMissingColumns=True),
        keys,
        order,
        [Running(f"_run_{n}", "sum", F.col(f"_step_{n}"), 0 if include_current else -1) for n in sums],
        width,
        peers=True,
    ).where("_leaves is null")
    return stepped.select(
        *df.columns,
        *[
            F.coalesce(F.col(f"_run_{n}"), F.lit(0))
            .cast(T.DecimalType(38, k.scale) if isinstance(k, T.DecimalType) else T.LongType())
            .alias(n)
            for n, k in kinds.items()
        ],
    )
