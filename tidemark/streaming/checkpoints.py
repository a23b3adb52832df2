"""A stream's own logs as tables: what it planned, what it committed, and whether that only ever moves forward."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def batch_log(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(batch_id, watermark_ms, offsets, committed) of every batch in a checkpoint's offset and commit logs.

    ``offsets`` holds each source's end offset as its JSON text. A batch that was planned and not committed will run
    again. A checkpoint without a log, or none at all, gives no rows.
    """

    def files(log: str) -> DataFrame:
        number = F.regexp_extract(F.col("_metadata.file_name"), r"^(\d+)$", 1)
        found = spark.read.option("pathGlobFilter", "[0-9]*").text(f"{checkpoint}/{log}", wholetext=True)
        return found.select(number.cast("long").alias("batch_id"), F.split("value", "\n").alias("lines"))

    jvm = spark._jvm.org.apache.hadoop.fs
    place = jvm.Path(checkpoint)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    has = {log: system.exists(jvm.Path(f"{checkpoint}/{log}")) and len(system.listStatus(jvm.Path(f"{checkpoint}/{log}"))) > 0 for log in ("offsets", "commits")}
    schema = "batch_id bigint, watermark_ms bigint, offsets array<string>, committed boolean"
    if not has["offsets"]:
        return spark.createDataFrame([], schema)
    planned = files("offsets").select(
        "batch_id",
        F.get_json_object(F.get("lines", 1), "$.batchWatermarkMs").cast("long").alias("watermark_ms"),
        F.slice("lines", 3, F.greatest(F.size("lines") - 2, F.lit(0))).alias("offsets"),
    )
    if not has["commits"]:
        return planned.withColumn("committed", F.lit(False))
    done = files("commits").select("batch_id", F.lit(True).alias("committed"))
    return planned.join(done, "batch_id", "left").withColumn("committed", F.coalesce("committed", F.lit(False)))


def committed_offsets(arrivals: DataFrame, log: DataFrame) -> DataFrame:
    """(source_partition, committed_offset): the last record offset of each partition in a committed batch.

    ``arrivals`` are the stored records with ``source_partition``, ``offset`` and ``arrival_batch``.
    """
    done = log.where("committed").agg(F.max("batch_id").alias("last"))
    kept = arrivals.join(F.broadcast(done), F.col("arrival_batch") <= F.col("last"))  # ``done`` is one row
    return kept.groupBy("source_partition").agg(F.max("offset").alias("committed_offset"))


def offsets_moved(before: DataFrame, after: DataFrame) -> DataFrame:
    """Two observations of ``committed_offsets`` side by side; a partition that vanished has regressed."""
    old = before.withColumnRenamed("committed_offset", "before_offset")
    new = after.withColumnRenamed("committed_offset", "after_offset")
    lost = F.col("before_offset").isNotNull() & F.col("after_offset").isNull()
    return old.join(new, "source_partition", "full").select(
        "source_partition",
        "before_offset",
        "after_offset",
        (lost | (F.col("after_offset") < F.col("before_offset"))).alias("regressed"),
        (F.col("after_offset") > F.col("before_offset")).alias("advanced"),
    )
