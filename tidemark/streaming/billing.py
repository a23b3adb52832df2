"""The billing stream: classified micro-batches into keyed change logs.

Spark's watermark is one maximum over a whole source and drops late rows
without a trace. This job judges each record on the ledger instead: the least
over partitions, with idleness, and the rejected rows kept. State is a table of
one row per source partition and the reports already written, so a job resumes
or changes its parallelism by reading tables.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import from_micros, micros, money
from tidemark.operators import ledger as lg
from tidemark.operators.purchases import missing_fields, require_fields
from tidemark.sources.keyed_table import KeyedTable
from tidemark.sources.wire import ORDER_REQUIRED, decode_orders

ARRIVAL = schemas.table(
    "customer_id string, source_partition int, sequence bigint, fee money, "
    "occurred_at timestamp, offset bigint, arrived_at timestamp"
)
PROGRESS = schemas.table(
    "source_partition int, seen_us bigint, last_heard_us bigint, started_us bigint, now_us bigint, wm_us bigint"
)
QUARANTINE = schemas.table("source_partition int, offset bigint, value binary, arrived_at timestamp, reason string")


@dataclass(frozen=True)
class BillingStream:
    """``process`` is a foreachBatch function; every write replaces its own batch.

    A record that does not decode, or lacks a required field, fails the job when ``strict`` and goes to ``quarantine``
    with the reason otherwise.
    """

    root: str
    partitions: int = 16
    size_us: int = lg.SIZE_US
    bound_us: int = lg.BOUND_US
    lateness_us: int = lg.LATENESS_US
    idle_us: int | None = lg.IDLE_US
    strict: bool = True
    buckets: int = 4

    def _by_sequence(self, name: str) -> KeyedTable:
        # A million sequence numbers of a partition at a time: a batch leaves older ones alone.
        keys = ("source_partition", "sequence_number")
        return KeyedTable(f"{self.root}/{name}", schemas.AUDIT, keys, self.buckets, period="sequence_number div 1000000")

    @cached_property
    def audit(self) -> KeyedTable:
        return self._by_sequence("billing_event_audit")

    @cached_property
    def rejected(self) -> KeyedTable:
        return self._by_sequence("billing_too_late_events")

    @cached_property
    def reports(self) -> KeyedTable:
        keys = ("customer_id", "window_start", "window_end")
        return KeyedTable(f"{self.root}/fee_reports", schemas.FEE_REPORT, keys, self.buckets, period="date_format(window_start, 'yyyyMMdd')")

    @cached_property
    def quarantine(self) -> KeyedTable:
        keys = ("source_partition", "offset")
        return KeyedTable(f"{self.root}/quarantine", QUARANTINE, keys, self.buckets, period="offset div 1000000")

    def arrivals(self, spark: SparkSession) -> DataFrame:
        declared = T.StructType([*ARRIVAL.fields, T.StructField("arrival_batch", T.LongType())])
        return spark.read.schema(declared).option("basePath", f"{self.root}/arrivals").parquet(f"{self.root}/arrivals")

    def _progress(self, spark: SparkSession, batch_id: int) -> DataFrame:
        return spark.read.schema(PROGRESS).parquet(f"{self.root}/progress/batch_id={batch_id}")

    def watermark_after(self, spark: SparkSession, batch_id: int) -> int | None:
        """One number; null until every active partition has shown an event."""
        return self._progress(spark, batch_id).agg(F.max("wm_us")).first()[0]

    def _decoded(self, batch: DataFrame, batch_id: int) -> DataFrame:
        rows = decode_orders(batch, self.strict, keep=("offset", "timestamp", "value")).withColumnRenamed("timestamp", "arrived_at")
        if self.strict:
            return require_fields(rows, *ORDER_REQUIRED)
        missing = F.concat_ws(",", missing_fields(*ORDER_REQUIRED))
        judged = rows.withColumn("reason", F.when(F.col("corrupt").isNotNull(), "undecodable").when(missing != "", F.concat(F.lit("without "), missing)))
        self.quarantine.write(judged.where("reason is not null"), batch_id)
        return judged.where("reason is null")

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        decoded = self._decoded(batch, batch_id)
        place = f"{self.root}/arrivals/arrival_batch={batch_id}"
        decoded.select(*ARRIVAL.names).write.mode("overwrite").parquet(place)
        # From here on the stored batch is the input: the source is read once.
        rows = spark.read.schema(ARRIVAL).parquet(place).withColumn("arrival_batch", F.lit(batch_id).cast("bigint"))

        first = batch_id == 0
        before = None if first else self._progress(spark, batch_id - 1)
        wm_before = None if first else self.watermark_after(spark, batch_id - 1)
        lg.advance(before, lg.ledger_of(rows, "arrived_at"), self.partitions, self.bound_us, self.idle_us).coalesce(1).write.mode(
            "overwrite"
        ).parquet(f"{self.root}/progress/batch_id={batch_id}")

        judged = lg.classify_at(rows, F.lit(wm_before).cast("bigint"), self.size_us, self.lateness_us)
        named = judged.withColumnRenamed("sequence", "sequence_number")
        # A sequence sent twice in one batch is one audit row: the later offset.
        self.audit.write(_last_offset(named), batch_id)
        self.rejected.write(_last_offset(lg.too_late(named)), batch_id)
        self.reports.write(self._complete_totals(judged, batch_id), batch_id)

    def _complete_totals(self, judged: DataFrame, batch_id: int) -> DataFrame:
        """Totals to date of the windows this batch touched."""
        added = lg.reports(judged).select(
            "customer_id",
            from_micros(F.col("window_start_us")).alias("window_start"),
            from_micros(F.col("window_end_us")).alias("window_end"),
            "total_fee",
            "event_count",
        )
        if batch_id == 0:
            return added
        # Only the days and buckets of these windows are read.
        keys = list(self.reports.keys)
        held = self.reports.lookup(added, before=batch_id).select(*keys, F.col("total_fee").alias("_fee"), F.col("event_count").alias("_n")).alias("h")
        same = [F.col(f"n.{k}").eqNullSafe(F.col(f"h.{k}")) for k in keys]
        return added.alias("n").join(held, same, "left").select(
            *[f"n.{k}" for k in keys],
            money(F.col("total_fee") + F.coalesce("_fee", F.lit(0))).alias("total_fee"),
            (F.col("event_count") + F.coalesce("_n", F.lit(0))).alias("event_count"),
        )

    def start(self, records: DataFrame, checkpoint: str, available_now: bool = False, every: str = "5 seconds") -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return (
            records.writeStream.queryName("five-minute-billing")
            .option("checkpointLocation", checkpoint)
            .trigger(**trigger)
            .foreachBatch(self.process)
            .start()
        )

    def fee_reports(self, spark: SparkSession, batch_id: int) -> DataFrame:
        """Reports readers may see after a batch: fired windows, with their status."""
        wm = self.watermark_after(spark, batch_id)
        end = micros(F.col("window_end"))
        now = F.lit(wm).cast("bigint")
        return (
            self.reports.view(spark)
            .withColumn(
                "status",
                F.when(end + self.lateness_us <= now, "final").when(end <= now, "provisional").otherwise("open"),
            )
            .where("status <> 'open'")
        )


def _last_offset(rows: DataFrame) -> DataFrame:
    kept = rows.groupBy("source_partition", "sequence_number").agg(
        F.max_by(F.struct("customer_id", "fee", "occurred_at"), "offset").alias("r")
    )
    return kept.select("source_partition", "sequence_number", "r.*")
