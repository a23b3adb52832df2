"""Ordered patterns by automata whose transitions compose, so a long sequence is folded in parts.

A row is a function from states to states. Functions compose associatively: rows of a chunk become one function, chunks
of a sequence become one, level by level, and no task ever orders more than a chunk of rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.scan import Running, rows_per_chunk, running

MOST_STEPS = 14  # a function's states are 4 bits each of a long
MOST_ROWS = 50_000  # functions that one aggregate puts in order


def _field(packed: Column, state: Column | int) -> Column:
    at = F.lit(state * 4) if isinstance(state, int) else state * 4
    return F.call_function("shiftright", packed, at.cast("int")).bitwiseAND(F.lit(15))


def in_order(steps: Sequence[Column]) -> Column:
    """The function of one row: from k steps reached to k + 1, where the row is the next step."""
    if not 0 < len(steps) <= MOST_STEPS:
        raise ValueError(f"one to {MOST_STEPS} steps")
    parts = [F.when(F.coalesce(step, F.lit(False)), F.lit(k + 1)).otherwise(F.lit(k)) for k, step in enumerate([*steps, F.lit(False)])]
    packed = F.lit(0).cast("long")
    for k, part in enumerate(parts):
        packed = packed.bitwiseOR(F.call_function("shiftleft", part.cast("long"), F.lit(4 * k)))
    return packed


def then(first: Column, second: Column, states: int) -> Column:
    """The function that does ``first`` and then ``second``."""
    packed = F.lit(0).cast("long")
    for k in range(states):
        packed = packed.bitwiseOR(F.call_function("shiftleft", _field(second, _field(first, k)).cast("long"), F.lit(4 * k)))
    return packed


def reached(rows: DataFrame, keys: Sequence[str], order: str, tie: str, steps: Sequence[Column]) -> DataFrame:
    """(keys, reached): how many of ``steps`` each sequence of rows takes in their order, others in between not minded.

    Rows count by ``order`` and then ``tie``, which together tell rows of a sequence apart. Rows that are no step are left
    out first; a sequence without a step has no row here.
    """
    keys, states = list(keys), len(steps) + 1
    most = min(MOST_ROWS, rows_per_chunk(rows.sparkSession))
    stepping = rows.where(F.coalesce(*[F.when(s, True) for s in steps], F.lit(False)))
    found = stepping.select(*keys, order, tie, in_order(steps).alias("_f"))
    found = running(found, keys, order, [Running("_place", "sum", F.lit(1))], ties=[tie])
    parts = found.select(*keys, (F.col("_place") - 1).alias("_place"), "_f")
    length = parts.agg(F.max("_place")).first()[0]
    while length is not None:
        chunk = F.floor(F.col("_place") / most).cast("long")
        listed = F.array_sort(F.collect_list(F.struct("_place", "_f")))
        same = F.lit(sum(k << (4 * k) for k in range(states))).cast("long")
        folded = F.aggregate("_list", same, lambda done, x: then(done, x["_f"], states))
        parts = parts.groupBy(*keys, chunk.alias("_chunk")).agg(listed.alias("_list")).select(*keys, F.col("_chunk").alias("_place"), folded.alias("_f"))
        length //= most
        if not length:
            break
    return parts.select(*keys, _field(F.col("_f"), 0).cast("int").alias("reached"))
