"""Expiring carts."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators.carts import cart_snapshots, carts_left
from tidemark.plans.inputs_sql import CARTS
from tidemark.plans.registry import query
from tidemark.sources import tables

TTL_MS = 24 * 3_600_000


def cart_sql(touch: str, ttl: int | None = TTL_MS, source: str = CARTS) -> str:
    alive = "pt IS NOT NULL" if ttl is None else f"pt IS NOT NULL AND t_ms - pt < {ttl}"
    return f"""WITH {source},
  a1 AS (SELECT *, max(CASE WHEN {touch} THEN t_ms END) OVER (PARTITION BY customer_id ORDER BY arrival
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS pt FROM activity),
  a2 AS (SELECT *, coalesce({alive}, false) AS live FROM a1),
  a3 AS (SELECT *, sum(CASE WHEN {touch} AND NOT live THEN 1 ELSE 0 END) OVER (PARTITION BY customer_id ORDER BY arrival ROWS UNBOUNDED PRECEDING) AS island FROM a2),
  a4 AS (SELECT *, sum(CASE WHEN probe THEN 0 ELSE amount END) OVER w AS s, sum(CASE WHEN probe THEN 0 ELSE 1 END) OVER w AS n
    FROM a3 WINDOW w AS (PARTITION BY customer_id, island ORDER BY arrival ROWS UNBOUNDED PRECEDING)),
  a5 AS (SELECT *, NOT (live AND n - (CASE WHEN probe THEN 0 ELSE 1 END) > 0) AS fresh FROM a4)
  SELECT arrival, customer_id, CAST(CASE WHEN probe AND fresh THEN 0 ELSE s END AS DOUBLE) AS total,
    CAST(CASE WHEN probe AND fresh THEN 0 ELSE n END AS INTEGER) AS count, fresh FROM a5"""


def _carts(spark, sf, **how):
    return _shown(cart_snapshots(tables.cart_activity(spark, sf), TTL_MS, **how))


def _shown(snapshots):
    return snapshots.select("arrival", "customer_id", "total", "count", "fresh")


@query("cart_write_ttl", cart_sql("NOT probe"))
def cart_write_ttl(spark, sf):
    return _carts(spark, sf)


@query("cart_readwrite_ttl", cart_sql("true"))
def cart_readwrite_ttl(spark, sf):
    return _carts(spark, sf, refresh="read_write")


@query("cart_stale_visible", cart_sql("NOT probe", ttl=None))
def cart_stale_visible(spark, sf):
    return _carts(spark, sf, stale_visible=True)


@query("cart_probe", f"SELECT c.* FROM ({cart_sql('NOT probe')}) c JOIN events e ON e.event_id = c.arrival WHERE e.event_type = 'view'")
def cart_probe(spark, sf):
    """Probes only: they read a cart and never start or extend one."""
    return _shown(cart_snapshots(tables.cart_activity(spark, sf), TTL_MS).where("probe"))


@query("cart_isolated", cart_sql("NOT probe", source=CARTS.replace("'user-' || user_id", "'user-' || user_id || '/' || event_id % 2")))
def cart_isolated(spark, sf):
    """Every customer split into two accounts: neither touches the other's clock."""
    side = F.concat(F.lit("/"), (F.col("arrival") % 2).cast("string"))
    split = tables.cart_activity(spark, sf).withColumn("customer_id", F.concat("customer_id", side))
    return _shown(cart_snapshots(split, TTL_MS))


@query("cart_resumed", cart_sql("NOT probe"))
def cart_resumed(spark, sf):
    """The same carts computed in two runs, the second seeded by the first's state."""
    activity = tables.cart_activity(spark, sf)
    half = activity.agg(F.expr("max(arrival) div 2")).scalar()
    first = cart_snapshots(activity.where(F.col("arrival") <= half), TTL_MS)
    second = cart_snapshots(activity.where(F.col("arrival") > half), TTL_MS, seeds=carts_left(first))
    return _shown(first.unionByName(second))
