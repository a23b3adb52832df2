"""Batch and stream readers. All of them take explicit schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tidemark import schemas
from tidemark.settings import JobSettings


def broker_stream(spark: SparkSession, settings: JobSettings, max_per_trigger: int | None = None) -> DataFrame:
    """Records of a broker topic from the earliest offset.

    Needs the Spark Kafka package on the class path. Offsets live in the
    query's checkpoint; the group id only names the reader to the broker.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", settings.bootstrap_servers)
        .option("subscribe", settings.topic)
        .option("kafka.group.id", settings.group_id)
        .option("startingOffsets", "earliest")
    )
    if max_per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", max_per_trigger)
    return reader.load().select(*schemas.RECORD.names)


def record_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """The same columns from parquet files that land in a folder."""
    reader = spark.readStream.schema(schemas.RECORD)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def table_stream(spark: SparkSession, path: str, schema: T.StructType, max_files: int | None = None) -> DataFrame:
    """A finite folder replayed as a stream; the checkpoint is the cursor."""
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def json_lines(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Bulk load of one JSON object per line; a bad line fails the load."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def typed_csv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
