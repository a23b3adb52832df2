"""Joins and subqueries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.operators import enrich, ledger
from tidemark.operators.scan import HOUR_US
from tidemark.plans.inputs_sql import FEE_EVENTS
from tidemark.plans.registry import query
from tidemark.sources import fixtures, tables

LATENESS = 2 * HOUR_US


def judged(spark, sf, idle_us=None):
    """Arrivals with their class, and the watermark ledger behind it."""
    arrivals = tables.fee_events(spark, sf)
    wms = ledger.stored_watermarks(arrivals, fixtures.PARTITIONS, HOUR_US, idle_us, "arrived_at")
    return ledger.classify(arrivals, wms, HOUR_US, LATENESS), wms


RECONCILED = """CAST(a.fee AS DOUBLE) AS source_fee, a.n AS source_count, CAST(coalesce(l.fee, 0) AS DOUBLE) AS too_late_fee,
    coalesce(l.n, 0) AS too_late_count, CAST(coalesce(r.fee, 0) AS DOUBLE) AS reported_fee, CAST(coalesce(r.n, 0) AS BIGINT) AS reported_count,
    CAST(a.fee - coalesce(l.fee, 0) - coalesce(r.fee, 0) AS DOUBLE) AS fee_delta,
    CAST(a.n - coalesce(l.n, 0) - coalesce(r.n, 0) AS BIGINT) AS count_delta"""


@query("scalar_subqueries", f"""WITH {FEE_EVENTS} SELECT (SELECT count(*) FROM fee_events) AS events,
  (SELECT count(DISTINCT customer_id) FROM fee_events) AS customers,
  (SELECT CAST(max(fee) AS DOUBLE) FROM fee_events) AS largest_fee""")
def scalar_subqueries(spark, sf):
    return spark.sql(
        """SELECT (SELECT count(*) FROM {fees}) AS events,
        (SELECT count(DISTINCT customer_id) FROM {fees}) AS customers,
        (SELECT max(fee) FROM {fees}) AS largest_fee""",
        fees=tables.fee_events(spark, sf),
    )


@query("enrich_broadcast", """SELECT c_custkey, n_name, CAST(CAST(c_acctbal AS DECIMAL(19,2)) AS DOUBLE) AS balance,
  CAST(CAST(c_acctbal AS DECIMAL(19,2)) * (n_regionkey + 1) AS DOUBLE) AS weighted
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""")
def enrich_broadcast(spark, sf):
    customers = tables.table(spark, sf, "customer").select(
        "c_custkey", F.col("c_nationkey").alias("n_nationkey"), money(F.col("c_acctbal")).alias("balance")
    )
    rules = tables.table(spark, sf, "nation").select("n_nationkey", "n_name", (F.col("n_regionkey") + 1).alias("weight"))
    return enrich.enrich(customers, rules, ["n_nationkey"]).select(
        "c_custkey", "n_name", "balance", (F.col("balance") * F.col("weight")).alias("weighted")
    )


@query("join_streams", """SELECT c.event_id AS click_id, p.event_id AS purchase_id, c.user_id
  FROM events c JOIN events p ON c.user_id = p.user_id AND p.ts BETWEEN c.ts AND c.ts + INTERVAL 6 HOUR
  WHERE c.event_type = 'click' AND p.event_type = 'purchase'""")
def join_streams(spark, sf):
    e = tables.events(spark, sf)
    clicks = e.where("event_type = 'click'").select("user_id", F.col("event_id").alias("click_id"), F.col("ts").alias("clicked_at"))
    bought = e.where("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("bought_at"))
    return enrich.within_interval(clicks, bought, ["user_id"], "clicked_at", "bought_at", 0, 6 * HOUR_US).select(
        "click_id", "purchase_id", "user_id"
    )


@query("enrich_rate_asof", """WITH t AS (SELECT event_id, user_id % 4 AS currency, ts, CAST(value AS DECIMAL(19,2)) AS amount
    FROM events WHERE event_type = 'purchase'),
  r AS (SELECT user_id % 4 AS currency, ts, max(CAST(value AS DECIMAL(19,2))) AS rate FROM events WHERE event_type = 'view' GROUP BY ALL)
  SELECT t.event_id, t.currency, t.ts, CAST(t.amount AS DOUBLE) AS amount, CAST(r.rate AS DOUBLE) AS rate
  FROM t ASOF LEFT JOIN r ON t.currency = r.currency AND t.ts >= r.ts""")
def enrich_rate_asof(spark, sf):
    e = tables.events(spark, sf).select(
        "event_id", "event_type", (F.col("user_id") % 4).alias("currency"), "ts", money(F.col("value")).alias("amount")
    )
    facts = e.where("event_type = 'purchase'").drop("event_type")
    rates = e.where("event_type = 'view'").select("currency", "ts", F.col("amount").alias("rate"))
    return enrich.as_of(facts, rates, ["currency"], "ts", "rate")


@query("dimension_join", """SELECT c_mktsegment, n_name, count(*) AS orders, CAST(sum(CAST(o_totalprice AS DECIMAL(19,2))) AS DOUBLE) AS amount
  FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey GROUP BY ALL""")
def dimension_join(spark, sf):
    orders = tables.table(spark, sf, "orders")
    customer = tables.table(spark, sf, "customer")
    nation = tables.table(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # Reduced to one row per customer before it meets the dimensions.
    spent = orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(
        F.count(F.lit(1)).alias("n"), F.sum(money(F.col("o_totalprice"))).alias("a")
    )
    named = enrich.enrich(spent.join(customer, "c_custkey"), nation, ["c_nationkey"], "inner")
    return named.groupBy("c_mktsegment", "n_name").agg(F.sum("n").alias("orders"), F.sum("a").alias("amount"))


@query("referential_check", """SELECT event_id, user_id FROM events
  WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = user_id AND c_mktsegment = 'BUILDING')""")
def referential_check(spark, sf):
    e = tables.events(spark, sf).select("event_id", "user_id")
    known = tables.table(spark, sf, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("user_id"))
    return enrich.unmatched(e, known, ["user_id"])
