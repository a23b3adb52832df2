"""An upsert table: hash buckets of base and delta files, named by a manifest.

A part of the table is a bucket, or a bucket of a period where keys belong to one. A batch writes one delta file for each
part it touches and enters them in the manifest in one step; a replayed batch
replaces its own entries. Looking up the keys of a batch reads the parts of these keys alone. Folding merges a part's
files into one base file and swaps them in the manifest, so a job that runs meanwhile meets the folded files with its next
batch, and needs no restart.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.versions import latest_by
from tidemark.sources.manifest import Live, Manifest, Version

BASE = -1  # the batch of folded files in the manifest; their rows keep the batches that wrote them


@dataclass(frozen=True)
class KeyedTable:
    """``period`` is an SQL expression over the keys, such as the day of a window: later batches leave old periods alone.

    ``fold_after``: delta files of a part after which the writer folds it; null leaves folding to others.
    """

    path: str
    schema: T.StructType
    keys: Sequence[str]
    buckets: int = 16
    period: str | None = None
    fold_after: int | None = 8

    def manifest(self, spark: SparkSession) -> Manifest:
        return Manifest(spark, self.path)

    def part(self) -> Column:
        bucket = F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        return bucket if self.period is None else F.concat_ws(".", F.coalesce(F.expr(self.period).cast("string"), F.lit("none")), bucket)

    def _stored(self) -> T.StructType:
        return T.StructType([*self.schema.fields, T.StructField("batch_id", T.LongType())])

    def _read(self, spark: SparkSession, files: Sequence[Live]) -> DataFrame:
        if not files:
            return spark.createDataFrame([], self._stored())
        return spark.read.schema(self._stored()).parquet(*[f.path for f in files])

    def _put(self, rows: DataFrame, batch: int, name: str) -> list[Live]:
        """Write rows that carry their ``batch_id``: one file for each part among them."""
        folder = f"files/{name}-{uuid.uuid4().hex[:12]}"
        # A number of its own keeps adaptive execution from writing the files of all parts in one task.
        tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        placed = rows.withColumn("part", self.part()).repartition(tasks, "part")
        placed.write.partitionBy("part").parquet(f"{self.path}/{folder}")
        found = self.manifest(rows.sparkSession).folder.files_below(folder)
        parts = [(p, size, p.rsplit("/", 2)[-2]) for p, size, _ in found if p.endswith(".parquet")]
        return [Live(p, part.removeprefix("part="), batch, size) for p, size, part in parts]

    def write(self, rows: DataFrame, batch_id: int) -> None:
        """Upsert rows, at most one for each key; the same ``batch_id`` again replaces what it wrote."""
        spark, batch_id = rows.sparkSession, int(batch_id)
        typed = rows.select(*[F.col(f"`{f.name}`").cast(f.dataType).alias(f.name) for f in self.schema.fields])
        made = self._put(typed.withColumn("batch_id", F.lit(batch_id).cast("long")), batch_id, f"batch-{batch_id}")

        def entered(now: Version) -> Version:
            last = batch_id if now.last_batch is None else max(now.last_batch, batch_id)
            return Version(last_batch=last, files=(*[f for f in now.files if f.batch != batch_id], *made))

        now = self.manifest(spark).commit(entered)
        if self.fold_after is not None:
            count: dict[str, int] = {}
            for f in now.files:
                if f.batch not in (BASE, now.last_batch):
                    count[f.part] = count.get(f.part, 0) + 1
            full = [p for p, n in count.items() if n >= self.fold_after]
            if full:
                self.fold(spark, full)

    def fold(self, spark: SparkSession, parts: Sequence[str] | None = None) -> bool:
        """Merge the files of parts; false if another job folded some of them first.

        The last batch may yet be replayed and keeps its files.
        """
        manifest = self.manifest(spark)
        before = manifest.latest()
        old = [f for f in before.of(parts) if f.batch != before.last_batch]
        many = {f.part for f in old if f.batch != BASE}
        old = [f for f in old if f.part in many]
        if not old:
            return False
        made = self._put(latest_by(self._read(spark, old), self.keys, ["batch_id"]), BASE, "base")
        gone = {f.path for f in old}

        def swapped(now: Version) -> Version | None:
            if not gone <= {f.path for f in now.files}:
                return None
            return replace(now, files=(*[f for f in now.files if f.path not in gone], *made))

        after = manifest.commit(swapped)
        return {f.path for f in made} <= {f.path for f in after.files}

    def history(self, spark: SparkSession) -> DataFrame:
        """Every stored row with the batch that wrote it: all since its part was folded, the latest from before."""
        return self._read(spark, self.manifest(spark).latest().files)

    def view(self, spark: SparkSession, before: int | None = None) -> DataFrame:
        """One row per key: the last written. ``before`` hides later batches."""
        return self._latest(self.history(spark), before)

    def lookup(self, keyed: DataFrame, before: int | None = None) -> DataFrame:
        """The view, of the parts that the keys of ``keyed`` fall into; other parts are not read.

        The names of these parts pass through the driver: at most one for each of the table's files.
        """
        spark = keyed.sparkSession
        touched = {r[0] for r in keyed.select(self.part().alias("p")).distinct().collect()}
        return self._latest(self._read(spark, self.manifest(spark).latest().of(touched)), before)

    def since(self, spark: SparkSession, period: str, before: int | None = None) -> DataFrame:
        """The view of the periods from ``period`` on, by the order of their names; earlier ones are not read."""
        files = [f for f in self.manifest(spark).latest().files if f.part.rsplit(".", 1)[0] >= period]
        return self._latest(self._read(spark, files), before)

    def _latest(self, rows: DataFrame, before: int | None) -> DataFrame:
        if before is not None:
            rows = rows.where(F.col("batch_id") < before)
        return latest_by(rows, self.keys, ["batch_id"]).drop("batch_id")

    def repeated(self, spark: SparkSession) -> DataFrame:
        """(keys, batch_id, times) of keys that one batch stored more than once: none, if upserts and replays work."""
        return self.history(spark).groupBy(*self.keys, "batch_id").agg(F.count("*").alias("times")).where("times > 1")
