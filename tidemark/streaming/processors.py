"""Keyed state of one's own on a stream: what a key keeps, what it emits, when it is forgotten.

State needs the RocksDB store (``state_store``). A key's rows of one micro-batch are put in order in memory, so a
trigger's size (files or offsets) bounds what a task holds; long histories belong to the batch forms in ``operators``.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from contextlib import contextmanager
from decimal import Decimal

from pyspark import cloudpickle
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tidemark.streaming.native import use_state_store

# Tasks get the processors by value, so executors need no copy of the repository.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

RUNNING = "arrival bigint, customer_id string, product string, amount decimal(19,2), occurred_us bigint"
CUSTOMER_GROUPS = 1024  # of running spend: a call of the processor handles one
RUNNING_NAMES = [c.split()[0] for c in RUNNING.split(", ")]
SNAPSHOT = "arrival bigint, customer_id string, probe boolean, total decimal(19,2), count int, fresh boolean, touched_ms bigint"


@contextmanager
def state_store(spark: SparkSession, kind: str = "rocksdb") -> Iterator[None]:
    """Streams started inside keep their state in this store; the session's own choice comes back afterwards."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    use_state_store(spark, kind)
    try:
        yield
    finally:
        spark.conf.set(name, before)


class RunningSpend(StatefulProcessor):
    """Per customer one total; every purchase emits it as it then stands.

    A call costs milliseconds whatever it is for, so customers come in groups, a call for each; the state has an entry for
    each customer, and a batch reads and writes those of its own customers alone.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._spent = handle.getMapState("spent", "customer_id string", "total decimal(19,2)")

    def handleInputRows(self, key, rows, timerValues) -> Iterator:
        import pandas as pd

        frame = pd.concat(rows, ignore_index=True).sort_values("arrival", kind="stable")
        totals: dict[str | None, Decimal] = {}
        labels, amounts = frame["product"].tolist(), frame["amount"].tolist()
        for i, customer in enumerate(frame["customer_id"].tolist()):
            customer = customer if isinstance(customer, str) else None
            total = totals.get(customer)
            if total is None:
                held = self._spent.getValue((customer,))
                total = held[0] if held else None
            if total is not None:
                labels[i], amounts[i] = "running-total", total + amounts[i]
            totals[customer] = amounts[i]
        for customer, total in totals.items():
            self._spent.updateValue((customer,), (total,))
        yield frame[["arrival", "customer_id", "occurred_us"]].assign(product=labels, amount=amounts)[RUNNING_NAMES]

    def close(self) -> None: ...


def running_spend_stream(purchases: DataFrame) -> DataFrame:
    """One row per cleaned purchase: the customer's amount so far, batches of the stream continuing each other.

    The first row of a customer passes unchanged; later rows carry the label ``running-total`` in place of a product.
    Inside a micro-batch rows count by ascending ``arrival``.
    """
    group = F.pmod(F.xxhash64("customer_id"), F.lit(CUSTOMER_GROUPS)).alias("customers")
    # Times pass through as numbers, so that they stay as they are.
    rows = purchases.select("arrival", "customer_id", "product", "amount", F.unix_micros("occurred_at").alias("occurred_us"), group)
    summed = rows.groupBy("customers").transformWithStateInPandas(RunningSpend(), RUNNING, "Append", "None")
    return summed.select("arrival", "customer_id", "product", "amount", F.timestamp_micros("occurred_us").alias("occurred_at"))


class ExpiringCart(StatefulProcessor):
    """Per customer one cart with an event-time timer that forgets it; each touch moves the timer."""

    def __init__(self, ttl_ms: int, refresh: str):
        self._ttl, self._reads_touch = ttl_ms, refresh == "read_write"

    def init(self, handle: StatefulProcessorHandle) -> None:
        self._handle = handle
        self._cart = handle.getValueState("cart", "total decimal(19,2), count int, touched_ms bigint")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        cart = self._cart.get() if self._cart.exists() else None
        before = cart[2] if cart else None
        total, count, touched = cart or (Decimal(0), 0, None)
        for r in sorted(rows, key=lambda r: r.arrival):
            live = touched is not None and r.t_ms - touched < self._ttl
            if not live:
                total, count = Decimal(0), 0
            fresh = not (live and count > 0)
            if not r.probe:
                total, count = total + r.amount, count + 1
            if not r.probe or self._reads_touch:
                touched = r.t_ms if touched is None else max(touched, r.t_ms)
            yield Row(arrival=r.arrival, customer_id=key[0], probe=r.probe, total=total, count=count, fresh=fresh, touched_ms=touched)
        if touched is not None:
            self._cart.update((total, count, touched))
        if touched != before:
            if before is not None:
                self._handle.deleteTimer(before + self._ttl)
            self._handle.registerTimer(touched + self._ttl)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        self._cart.clear()
        yield from ()

    def close(self) -> None: ...


def cart_stream(activity: DataFrame, ttl_ms: int, refresh: str = "write", bound: str = "1 minute") -> DataFrame:
    """One snapshot per activity as ``operators.carts.cart_snapshots`` gives, with the carts in keyed state.

    A timer at the end of a cart's life drops it once the watermark has passed, and no row after that could still meet
    it. Rows later than ``bound`` behind the newest are dropped by Spark's watermark.
    """
    if refresh not in ("write", "read_write"):
        raise ValueError(f"unknown refresh {refresh}")
    timed = activity.withColumn("at", F.timestamp_millis("t_ms")).withWatermark("at", bound)
    return timed.groupBy("customer_id").transformWithState(ExpiringCart(ttl_ms, refresh), SNAPSHOT, "Append", "EventTime")


def cart_state(spark: SparkSession, checkpoint: str) -> DataFrame:
    """The carts that a stopped or running stream holds: (customer_id, total, count, touched_ms)."""
    held = spark.read.format("statestore").option("stateVarName", "cart").load(checkpoint)
    return held.select("key.customer_id", "value.total", "value.count", "value.touched_ms")
