"""Carts that expire: keyed totals with a time to live, in batch form."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.operators.scan import AUTO, PER_ROWS, Chunks, Running, plan_chunks, running

_BEFORE = -(1 << 60)


def cart_snapshots(
    activity: DataFrame,
    ttl_ms: int,
    refresh: str = "write",
    stale_visible: bool = False,
    seeds: DataFrame | None = None,
    width: Chunks | int | str | None = AUTO,
) -> DataFrame:
    """One snapshot (total, count, fresh) per activity, in arrival order per customer.

    A purchase adds to the cart, a probe only reads it. The cart is gone once
    ``ttl_ms`` have passed since the last write, or since the last activity of
    any kind with ``refresh='read_write'``. ``stale_visible`` still shows
    expired carts, so nothing ever resets.

    ``seeds`` are carts left by earlier input (customer_id, total, count,
    touched_ms); each stands before its customer's first activity.

    The cart total is the customer's running total minus that total at the
    cart's start, so both steps are running values and no cart has to fit in a task.
    """
    if refresh not in ("write", "read_write"):
        raise ValueError(f"unknown refresh {refresh}")
    if width == AUTO:
        width = plan_chunks(activity, ["customer_id"], "arrival", PER_ROWS)
    wrote = ~F.col("probe")
    touched = wrote if refresh == "write" else F.lit(True)
    spent = F.when(wrote, F.col("amount")).otherwise(F.lit(0).cast("decimal(19,2)"))
    bought = F.when(wrote, F.coalesce("_held", F.lit(1))).otherwise(0)

    activity = activity.withColumn("_held", F.lit(None).cast("int"))
    if seeds is not None:
        carried = seeds.select(
            F.lit(_BEFORE).alias("arrival"),
            "customer_id",
            F.col("total").alias("amount"),
            F.lit(False).alias("probe"),
            F.col("touched_ms").alias("t_ms"),
            F.col("count").alias("_held"),
        )
        activity = activity.unionByName(carried, allowMissingColumns=True)

    first = running(
        activity,
        ["customer_id"],
        "arrival",
        [
            Running("_touched_ms", "max", F.when(touched, F.col("t_ms")), -1),
            Running("_sum", "sum", spent),
            Running("_cnt", "sum", bought),
        ],
        width,
    )
    alive = F.col("_touched_ms").isNotNull()
    if not stale_visible:
        alive = alive & (F.col("t_ms") - F.col("_touched_ms") < ttl_ms)
    marked = (
        first.withColumn("_live", alive)
        .withColumns({"_sum0": F.col("_sum") - spent, "_cnt0": F.col("_cnt") - bought})
    )
    starts = F.when(touched & ~F.col("_live"), F.struct("_sum0", "_cnt0"))
    second = running(marked, ["customer_id"], "arrival", [Running("_base", "last", starts)], width)

    held = F.coalesce(F.col("_cnt0") - F.col("_base._cnt0"), F.lit(0))
    fresh = ~(F.col("_live") & (held > 0))
    empty = F.col("probe") & fresh
    touch_now = F.when(touched, F.col("t_ms"))
    return second.where(F.col("_held").isNull()).select(
        "arrival",
        "customer_id",
        "probe",
        money(F.when(empty, F.lit(0)).otherwise(F.col("_sum") - F.col("_base._sum0"))).alias("total"),
        F.when(empty, 0).otherwise(F.col("_cnt") - F.col("_base._cnt0")).cast("int").alias("count"),
        fresh.alias("fresh"),
        F.greatest("_touched_ms", touch_now).alias("touched_ms"),
    )


def carts_left(snapshots: DataFrame) -> DataFrame:
    """The cart each customer is left with: what a later run starts from."""
    return (
        snapshots.groupBy("customer_id")
        .agg(
            F.max_by("total", "arrival").alias("total"),
            F.max_by("count", "arrival").alias("count"),
            F.max("touched_ms").alias("touched_ms"),
        )
        .where("count > 0")
    )
