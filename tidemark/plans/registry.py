"""Register a query under a name, with its checking SQL where there is one."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

Build = Callable[[SparkSession, str], DataFrame]


@dataclass(frozen=True)
class Entry:
    build: Build
    sql: str | None


ENTRIES: dict[str, Entry] = {}


def presented(df: DataFrame) -> DataFrame:
    """Result form that any engine prints alike: zone-less times, plain numbers.

    Money stays decimal up to here; only the finished value is widened.
    """
    columns = []
    for field in df.schema.fields:
        column = F.col(f"`{field.name}`")
        if isinstance(field.dataType, T.TimestampType):
            column = column.cast("timestamp_ntz").alias(field.name)
        elif isinstance(field.dataType, T.DecimalType):
            column = column.cast("double").alias(field.name)
        columns.append(column)
    return df.select(*columns)


def query(name: str, sql: str | None = None) -> Callable[[Build], Build]:
    def register(build: Build) -> Build:
        if name in ENTRIES:
            raise ValueError(f"{name} is registered twice")

        @wraps(build)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return presented(build(spark, sf_dir))

        ENTRIES[name] = Entry(run, sql)
        return build

    return register
