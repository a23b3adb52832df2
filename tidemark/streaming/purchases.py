"""The purchase stream: spend per customer in Spark's keyed state, upserted into a table."""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.functions import money
from tidemark.operators.purchases import normalize_purchase, require_fields, valid_purchase
from tidemark.sources.keyed_table import KeyedTable
from tidemark.sources.wire import PURCHASE_REQUIRED, decode_purchases
from tidemark.streaming.processors import running_spend_stream, state_store


@dataclass(frozen=True)
class SpendStream:
    """The state holds every customer's total; a batch upserts the customers it touched and reads no earlier output."""

    root: str
    buckets: int = 16

    @cached_property
    def spend(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/customer_spend", schemas.CUSTOMER_SPEND, ("customer_id",), self.buckets)

    def cleaned(self, records: DataFrame) -> DataFrame:
        """Purchases to count; a record without a required field fails the job."""
        rows = decode_purchases(records, keep=("offset",)).withColumnRenamed("offset", "arrival")
        return normalize_purchase(valid_purchase(require_fields(rows, *PURCHASE_REQUIRED)))

    def totals(self, records: DataFrame) -> DataFrame:
        """For update mode: the complete total of every customer that a batch touches."""
        last = F.max(F.struct("arrival", "occurred_at"))
        summed = self.cleaned(records).groupBy("customer_id").agg(money(F.sum("amount")).alias("amount"), last.alias("last"))
        return summed.select("customer_id", "amount", F.col("last.occurred_at").alias("updated_at"))

    def start(self, records: DataFrame, checkpoint: str, available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
        writer = self.totals(records).writeStream.queryName("customer-spend").outputMode("update")
        return _started(writer.foreachBatch(self.spend.write), checkpoint, available_now, every)

    def start_running(self, records: DataFrame, checkpoint: str, available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
        """Append each purchase with its customer's amount so far to ``running``, once each."""
        with state_store(records.sparkSession):
            rows = running_spend_stream(self.cleaned(records))
            writer = rows.writeStream.queryName("running-spend").outputMode("append").format("parquet")
            return _started(writer.option("path", f"{self.root}/running"), checkpoint, available_now, every)

    def running(self, spark: SparkSession) -> DataFrame:
        return spark.read.parquet(f"{self.root}/running")

    def customer_spend(self, spark: SparkSession) -> DataFrame:
        return self.spend.view(spark)


def _started(writer, checkpoint: str, available_now: bool, every: str) -> StreamingQuery:
    trigger = {"availableNow": True} if available_now else {"processingTime": every}
    return writer.option("checkpointLocation", checkpoint).trigger(**trigger).start()
