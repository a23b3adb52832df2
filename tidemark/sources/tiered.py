"""A fact table by month whose tiers are a matter of its manifest: moving a month touches no data file."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import month_key
from tidemark.operators.layout import write_layout
from tidemark.sources.manifest import Live, Manifest, Version


@dataclass(frozen=True)
class TieredTable:
    """Files of ``schema`` (with an ``event_time``) in sort order with Bloom filters, each of one month and one tier."""

    path: str
    schema: T.StructType
    sort: Sequence[str]

    def manifest(self, spark: SparkSession) -> Manifest:
        return Manifest(spark, self.path)

    def append(self, rows: DataFrame, batch_id: int, files: int | None = None) -> None:
        """Add rows to the hot tier; the same ``batch_id`` again replaces what it added."""
        spark, folder = rows.sparkSession, f"files/append-{uuid.uuid4().hex[:12]}"
        write_layout(rows.select(*self.schema.names), f"{self.path}/{folder}", self.sort, files=files)
        found = self.manifest(spark).folder.files_below(folder)
        made = tuple(Live(p, p.rsplit("/", 2)[-2].removeprefix("event_month="), batch_id, size) for p, size, _ in found if p.endswith(".parquet"))
        self.manifest(spark).commit(lambda now: Version(last_batch=batch_id, files=(*[f for f in now.files if f.batch != batch_id], *made)))

    def retier(self, spark: SparkSession, first_hot_month: int) -> None:
        """Months before ``first_hot_month`` are cold from now on, all others hot."""

        def labelled(now: Version) -> Version | None:
            files = tuple(replace(f, tier="hot" if f.part.isdigit() and int(f.part) >= first_hot_month else "cold") for f in now.files)
            return None if files == now.files else replace(now, files=files)

        self.manifest(spark).commit(labelled)

    def read(self, spark: SparkSession, tier: str | None = None) -> DataFrame:
        """Rows of a tier, or of all; other tiers' files are not opened."""
        paths = [f.path for f in self.manifest(spark).latest().files if tier is None or f.tier == tier]
        rows = spark.read.schema(self.schema).parquet(*paths) if paths else spark.createDataFrame([], self.schema)
        return rows.withColumn("event_month", month_key(F.col("event_time")))
