"""Records judged by the rules valid at their event time, while rules themselves arrive on the stream.

A rule version holds from its time until the next version of its key. A version that arrives after records of its time
makes the job judge these again and upsert them, so the result is that of all rules known so far.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark import schemas
from tidemark.operators.enrich import as_of, small_or_plain
from tidemark.session import keep
from tidemark.sources.keyed_table import KeyedTable

# Rules have a weight and no id, records an id and no weight.
ARRIVING = schemas.table("id bigint, key string, at timestamp, weight double")
RULE = schemas.table("key string, at timestamp, weight double")
RECORD = schemas.table("id bigint, key string, at timestamp")
JUDGED = schemas.table("id bigint, key string, at timestamp, weight double, rule_at timestamp")
_DAY = "date_format(at, 'yyyyMMdd')"


@dataclass(frozen=True)
class RuledStream:
    """``process`` is a foreachBatch function over records and rules in one stream; its tables replay by batch."""

    root: str
    buckets: int = 4

    @cached_property
    def rules(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/rules", RULE, ("key", "at"), self.buckets)

    @cached_property
    def records(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/records", RECORD, ("id", "at"), self.buckets, period=_DAY)

    @cached_property
    def judged(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/judged", JUDGED, ("id", "at"), self.buckets, period=_DAY)

    def process(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        rows = keep(batch.select(*ARRIVING.names), "ruled-batch")
        # Two versions of one key and time: the heavier one holds.
        arrived = rows.where("id is null and at is not null").groupBy("key", "at").agg(F.max("weight").alias("weight"))
        fresh = rows.where("id is not null").select(*RECORD.names).dropDuplicates(["id", "at"])
        self.rules.write(arrived, batch_id)
        self.records.write(fresh, batch_id)
        rules = keep(self.rules.view(spark), "rules-known")
        dated = fresh.where("at is not null").withColumn("_fresh", F.lit(True))
        earlier = self._earlier(spark, arrived, batch_id)
        whole = dated if earlier is None else keep(dated.unionByName(earlier.withColumn("_fresh", F.lit(False))), "ruled-records")
        # An earlier record is judged again if the version that holds at its time is one that just arrived.
        new = arrived.select("key", "at", F.lit(True).alias("new"))
        versions = rules.join(new, ["key", "at"], "left").select("key", "at", F.struct("weight", F.col("at").alias("rule_at"), "new").alias("rule"))
        found = as_of(whole, versions, ["key"], "at", "rule").where("_fresh or rule.new").select("id", "key", "at", "rule.weight", "rule.rule_at")
        undated = fresh.where("at is null").select("id", "key", "at", F.lit(None).cast("double").alias("weight"), F.lit(None).cast("timestamp").alias("rule_at"))
        self.judged.write(found.unionByName(undated), batch_id)

    def _earlier(self, spark: SparkSession, arrived: DataFrame, batch_id: int) -> DataFrame | None:
        """Earlier records of keys that versions just arrived for; days before the first of these versions are not read."""
        first = arrived.agg(F.date_format(F.min("at"), "yyyyMMdd")).first()[0]
        if first is None or batch_id == 0:
            return None
        keys = arrived.groupBy("key").agg(F.min("at").alias("first"))
        earlier = self.records.since(spark, first, before=batch_id).join(small_or_plain(keys), "key")
        return earlier.where(F.col("at") >= F.col("first")).select(*RECORD.names)

    def start(self, arriving: DataFrame, checkpoint: str, available_now: bool = False, every: str = "10 seconds") -> StreamingQuery:
        trigger = {"availableNow": True} if available_now else {"processingTime": every}
        return arriving.writeStream.queryName("ruled-records").option("checkpointLocation", checkpoint).trigger(**trigger).foreachBatch(self.process).start()
