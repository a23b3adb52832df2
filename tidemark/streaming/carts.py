"""Expiring carts in micro-batches: carts left by earlier batches seed the next one, in plain columns.

``tidemark.streaming.processors.cart_stream`` keeps them in Spark's state instead; this form suits batches in which one
customer has more rows than a task should hold.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.carts import cart_snapshots, carts_left
from tidemark.session import keep
from tidemark.sources.keyed_table import KeyedTable

CART = schemas.table("customer_id string, total money, count int, touched_ms bigint")
SNAPSHOT = schemas.table(
    "arrival bigint, customer_id string, probe boolean, total money, count int, fresh boolean, touched_ms bigint"
)


@dataclass(frozen=True)
class CartStream:
    """A foreachBatch job: carts left by earlier batches seed the next one."""

    root: str
    ttl_ms: int
    refresh: str = "write"

    @cached_property
    def carts(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/carts", CART, ("customer_id",))

    @cached_property
    def snapshots(self) -> KeyedTable:
        return KeyedTable(f"{self.root}/snapshots", SNAPSHOT, ("arrival",), period="arrival div 1000000")

    def process(self, activity: DataFrame, batch_id: int) -> None:
        spark = activity.sparkSession
        seeds = None
        if batch_id > 0:
            oldest = activity.agg(F.min("t_ms")).first()[0]
            seeds = self.carts.lookup(activity, before=batch_id)
            if oldest is not None:
                # Carts already expired for every row of this batch cannot matter.
                seeds = seeds.where(F.col("touched_ms") > oldest - self.ttl_ms)
        found = keep(cart_snapshots(activity, self.ttl_ms, self.refresh, seeds=seeds), "cart-batch")
        self.snapshots.write(found, batch_id)
        self.carts.write(carts_left(found), batch_id)
