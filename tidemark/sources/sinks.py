"""Writers: append tables, keyed change logs, ordered exports, JDBC."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import amount, to_millis
from tidemark.operators.versions import latest_by
from tidemark.settings import JobSettings

# Exports keep milliseconds, as the tables do.
CSV_TIME = "yyyy-MM-dd HH:mm:ss.SSS"


def append_typed(df: DataFrame, path: str, schema: T.StructType) -> None:
    """Append in the declared column order and types; times keep milliseconds.

    Nothing removes duplicates: writing the same rows again stores them again.
    """
    columns = []
    for field in schema.fields:
        value = F.col(field.name).cast(field.dataType)
        columns.append((to_millis(value) if isinstance(field.dataType, T.TimestampType) else value).alias(field.name))
    df.select(*columns).write.mode("append").parquet(path)


def sink_rows(ids: DataFrame) -> DataFrame:
    """The append table's demonstration rows for a frame of ``id``."""
    odd = F.col("id") % 2
    return ids.select(
        F.format_string("event-%d", "id").alias("event_id"),
        F.timestamp_seconds(F.unix_seconds(F.lit("2026-08-01 00:00:00").cast("timestamp")) + F.col("id")).alias("occurred_at"),
        F.when(odd == 0, "customer-a").otherwise("customer-b").alias("customer_id"),
        F.when(odd == 0, "BTC").otherwise("ETH").alias("symbol"),
        amount((F.col("id") + 1) / F.lit(100).cast("decimal(5,0)")).alias("amount"),
    )


FOLDED = -1  # below every batch id


@dataclass(frozen=True)
class KeyedLog:
    """An upsert table on plain files.

    Each micro-batch overwrites its own ``batch_id`` folder, so a replayed batch
    replaces itself. Readers take the latest batch per key. ``compact`` folds the
    log into one row per key under ``FOLDED``, an id that no batch has; the last
    batch, which may yet be replayed, keeps its own folder.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        (
            rows.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in self.schema.fields])
            .write.mode("overwrite")
            .parquet(f"{self.path}/batch_id={int(batch_id)}")
        )

    def history(self, spark: SparkSession) -> DataFrame:
        declared = T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])
        return spark.read.schema(declared).option("basePath", self.path).parquet(self.path)

    def view(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """One row per key: the last written. ``before`` hides later batches."""
        rows = self.history(spark)
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        return latest_by(rows, self.keys, ["batch_id"]).drop("batch_id")

    def compact(self, spark: SparkSession, path: str) -> KeyedLog:
        """Write the current view to a new folder and return that log."""
        rows = self.history(spark)
        top = rows.agg(F.max("batch_id")).first()[0]
        folded = KeyedLog(path, self.schema, self.keys)
        folded.write(self.view(spark, before=top), FOLDED)
        if top is not None and top != FOLDED:
            folded.write(rows.where(F.col("batch_id") == top), top)
        return folded


def export_csv(df: DataFrame, path: str, columns: Sequence[str], cutoff: Column, order: Sequence[str], files: int | None = None) -> None:
    """A repeatable CSV export: fixed columns, fixed cutoff, total order, header.

    The part files in name order are one sorted sequence; no single task
    writes the whole export.
    """
    chosen = df.where(cutoff).select(*columns)
    ranged = chosen.repartitionByRange(files, *order) if files else chosen.repartitionByRange(*order)
    ranged.sortWithinPartitions(*order).write.option("header", True).option("timestampFormat", CSV_TIME).csv(path)


def jdbc_writer(settings: JobSettings, table: str, batch_size: int) -> Callable[[DataFrame, int], None]:
    """A foreachBatch writer that appends to a staging table over JDBC.

    The database merges staging rows by key and batch id. Needs a JDBC driver
    on the class path.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        (
            batch.withColumn("batch_id", F.lit(batch_id))
            .write.format("jdbc")
            .option("url", settings.jdbc_url)
            .option("user", settings.jdbc_username)
            .option("password", settings.jdbc_password)
            .option("dbtable", table)
            .option("batchsize", batch_size)
            .mode("append")
            .save()
        )

    return write


def reset_table(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Truncate: leave an empty table of the same schema."""
    spark.createDataFrame([], schema).write.mode("overwrite").parquet(path)
