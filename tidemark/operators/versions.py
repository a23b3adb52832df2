"""Latest version per key: versioned tables, corrections, change capture."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def latest_by(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key: the greatest ``order``; later order columns break ties.

    An aggregate rather than a ranked window: each task keeps one row per key
    before the shuffle, so a key with many versions is not gathered anywhere.
    """
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)


def without_deleted(df: DataFrame, keys: Sequence[str], order: Sequence[str], deleted: str) -> DataFrame:
    """Latest version per key, leaving out keys whose latest version is a tombstone.

    Also materialises an ordered change log (insert, update, delete).
    """
    return latest_by(df, keys, order).where(~F.col(deleted)).drop(deleted)


def first_seen(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """De-duplicate: keep the earliest arrival of each key."""
    keys = list(keys)
    rest = [c for c in df.columns if c not in keys]
    picked = df.groupBy(*keys).agg(F.min_by(F.struct(*rest), F.struct(*order)).alias("_row"))
    return picked.select(*keys, "_row.*").select(*df.columns)
