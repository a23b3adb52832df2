"""Helpers shared by the operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def lower_ascii(text: Column) -> Column:
    """Lower-case A-Z alone, whatever the locale."""
    return F.translate(text, UPPER, LOWER)


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of an id's decimal text, modulo ``parts``; null for a null id."""
    return F.crc32(doc_id.cast("string").cast("binary")) % parts


def held_out(doc_id: Column, parts: int) -> Column:
    """True for remainder 2; rows without an id are neither held out nor learned from."""
    return F.coalesce(remainder(doc_id, parts) == 2, F.lit(False))


def learnable(doc_id: Column, parts: int) -> Column:
    return F.coalesce(remainder(doc_id, parts) != 2, F.lit(False))


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_or_plain(stored: DataFrame, most: int = 1_000_000) -> DataFrame:
    """A stored table of a few narrow columns, marked for broadcast when its rows are counted and few."""
    return F.broadcast(stored) if stored.count() <= most else stored


def _bytes_of(column: Column, kind: T.DataType) -> Column:
    """About how much memory a value takes."""
    if isinstance(kind, T.StringType | T.BinaryType):
        return F.coalesce(F.octet_length(column), F.lit(0)) + 16
    if isinstance(kind, T.ArrayType):
        element = kind.elementType
        width = 16 + 8 * len(element.fields) if isinstance(element, T.StructType) else 8
        return F.greatest(F.size(column), F.lit(0)) * width + 24
    return F.lit(8)


def table_within(stored: DataFrame, mb: int) -> DataFrame:
    """A stored table of numbers, strings and flat arrays of numbers, marked for broadcast when its values take at most ``mb`` MB."""
    total = sum((_bytes_of(F.col(f.name), f.dataType) for f in stored.schema.fields), F.lit(16))
    size = stored.agg(F.sum(total.cast("long"))).first()[0] or 0
    return F.broadcast(stored) if size <= mb << 20 else stored


def unused(taken: list[str], name: str) -> str:
    """``name``, with so many underscores that no column is called so, whatever the case."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name = f"_{name}"
    return name
