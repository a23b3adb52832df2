"""Projections, filters and searches."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import event_millis, month_key
from tidemark.operators import enrich, search
from tidemark.operators.purchases import missing_fields, normalize_purchase, valid_purchase
from tidemark.plans.inputs_sql import FACTS, FEE_EVENTS, PURCHASES, WORKLOAD
from tidemark.plans.registry import query
from tidemark.sources import tables
from tidemark.streaming.native import tag_revision
from tidemark.operators.windows import windowed_fees

YEAR = ("1997-01-01 00:00:00", "1998-01-01 00:00:00")
_IN_YEAR = "event_time >= TIMESTAMP '1997-01-01' AND event_time < TIMESTAMP '1998-01-01'"


@query("src_bounded", f"WITH {FEE_EVENTS} SELECT customer_id, source_partition, sequence, CAST(fee AS DOUBLE) AS fee, occurred_at FROM fee_events")
def src_bounded(spark, sf):
    return tables.fee_events(spark, sf).select("customer_id", "source_partition", "sequence", "fee", "occurred_at")


@query("valid_purchase", f"""WITH {PURCHASES} SELECT p.arrival, p.customer_id, p.product, CAST(p.amount AS DOUBLE) AS amount, p.occurred_at
    FROM purchases p JOIN valid v USING (arrival)""")
def valid(spark, sf):
    return valid_purchase(tables.purchases(spark, sf))


@query("normalize_purchase", f"WITH {PURCHASES} SELECT arrival, customer_id, product, CAST(amount AS DOUBLE) AS amount, occurred_at FROM valid")
def normalize(spark, sf):
    return normalize_purchase(valid_purchase(tables.purchases(spark, sf)))


@query("double_value", "SELECT event_id, CAST(CAST(value AS DECIMAL(19,2)) * 2 AS DOUBLE) AS value FROM events")
def double_value(spark, sf):
    return tables.events(spark, sf).select("event_id", (F.col("value").cast("decimal(19,2)") * 2).alias("value"))


@query("tag_revision", f"""WITH {FEE_EVENTS} SELECT customer_id, time_bucket(INTERVAL 1 HOUR, occurred_at) AS window_start,
    time_bucket(INTERVAL 1 HOUR, occurred_at) + INTERVAL 1 HOUR AS window_end, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count,
    'v2' AS revision, true AS placed
  FROM fee_events GROUP BY ALL""")
def revision(spark, sf):
    tagged = tag_revision(windowed_fees(tables.fee_events(spark, sf), "1 hour"), "v2")
    return tagged.withColumn("placed", F.col("window_partition") >= 0).drop("window_partition")


@query("require_fields", """SELECT event_id, concat_ws(',', CASE WHEN event_id % 17 = 0 THEN 'customer_id' END,
    CASE WHEN event_id % 19 = 0 THEN 'fee' END) AS missing
  FROM events WHERE event_id % 17 = 0 OR event_id % 19 = 0""")
def require_fields(spark, sf):
    holes = tables.fee_events(spark, sf).withColumns(
        {
            "customer_id": F.when(F.col("event_id") % 17 != 0, F.col("customer_id")),
            "fee": F.when(F.col("event_id") % 19 != 0, F.col("fee")),
        }
    )
    return (
        holes.withColumn("_missing", missing_fields("customer_id", "fee", "occurred_at"))
        .where(F.size("_missing") > 0)
        .select("event_id", F.concat_ws(",", "_missing").alias("missing"))
    )


@query("search_user_range", f"WITH {WORKLOAD} SELECT count(*) AS rows FROM workload WHERE user_id = 42 AND {_IN_YEAR}")
def search_user_range(spark, sf):
    return search.counted(search.user_range(tables.workload(spark, sf), 42, *YEAR))


@query("search_order", f"WITH {WORKLOAD} SELECT count(*) AS rows FROM workload WHERE order_id = 4243")
def search_order(spark, sf):
    return search.counted(search.order_lookup(tables.workload(spark, sf), 4243))


@query("search_symbol_range", f"WITH {WORKLOAD} SELECT count(*) AS rows FROM workload WHERE symbol = 'BTC' AND {_IN_YEAR}")
def search_symbol_range(spark, sf):
    return search.counted(search.symbol_range(tables.workload(spark, sf), "BTC", *YEAR))


@query("search_date_range", f"WITH {WORKLOAD} SELECT count(*) AS rows FROM workload WHERE {_IN_YEAR}")
def search_date_range(spark, sf):
    return search.counted(search.date_range(tables.workload(spark, sf), *YEAR))


@query("late_arrivals", f"WITH {FACTS} SELECT order_id, event_time, ingested_at FROM facts WHERE event_time < ingested_at")
def late_arrivals(spark, sf):
    facts = tables.fact_events(spark, sf)
    return facts.where("event_time < ingested_at").select("order_id", "event_time", "ingested_at")


@query("ordered_identities", f"WITH {FACTS} SELECT event_id, event_time, symbol, CAST(amount AS DOUBLE) AS amount FROM facts ORDER BY event_time, event_id")
def ordered_identities(spark, sf):
    return tables.fact_events(spark, sf).select("event_id", "event_time", "symbol", "amount").orderBy("event_time", "event_id")


@query("tenant_rows", """SELECT o_orderkey, o_custkey, o_totalprice FROM orders
  WHERE o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)""")
def tenant_rows(spark, sf):
    orders = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    grants = tables.table(spark, sf, "customer").where("c_nationkey = 3").select(F.col("c_custkey").alias("o_custkey"))
    return enrich.visible_rows(orders, grants, ["o_custkey"])


@query("tenant_denied", """SELECT count(*) AS rows FROM orders o JOIN customer c ON o_custkey = c_custkey
  WHERE c_nationkey <> 3 AND o_custkey IN (SELECT c_custkey FROM customer WHERE c_nationkey = 3)""")
def tenant_denied(spark, sf):
    """The negative case: no visible row belongs to a customer without a grant."""
    orders = tables.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    customer = tables.table(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    seen = enrich.visible_rows(orders, customer.where("c_nationkey = 3"), ["o_custkey"])
    return search.counted(seen.join(customer.where("c_nationkey <> 3"), "o_custkey"))


@query("assign_event_time", "SELECT event_id, (epoch_us(ts) // 1000) AS event_ms FROM events")
def assign_event_time(spark, sf):
    return tables.events(spark, sf).select("event_id", event_millis(F.col("ts")).alias("event_ms"))


@query("month_key", f"WITH {WORKLOAD} SELECT CAST(strftime(event_time, '%Y%m') AS INTEGER) AS event_month, count(*) AS rows FROM workload GROUP BY 1")
def months(spark, sf):
    return tables.workload(spark, sf).groupBy(month_key(F.col("event_time")).alias("event_month")).agg(F.count(F.lit(1)).alias("rows"))


@query("sort_export", f"WITH {FACTS} SELECT event_id, order_id, event_time, CAST(amount AS DOUBLE) AS amount FROM facts WHERE event_time < TIMESTAMP '2024-01-20' ORDER BY event_id, order_id")
def sort_export(spark, sf):
    """String order: order-10 comes before order-2."""
    facts = tables.fact_events(spark, sf)
    return facts.where("event_time < timestamp'2024-01-20'").select("event_id", "order_id", "event_time", "amount").orderBy("event_id", "order_id")


@query("last_one", "SELECT event_id, ts, event_type FROM events ORDER BY ts DESC, event_id DESC LIMIT 1")
def last_one(spark, sf):
    return tables.events(spark, sf).select("event_id", "ts", "event_type").orderBy(F.col("ts").desc(), F.col("event_id").desc()).limit(1)


@query("keyset_page", f"""WITH {FACTS} SELECT event_time, order_id, symbol FROM facts
  WHERE (event_time, order_id) > (TIMESTAMP '2024-01-10 12:00:00', 100) ORDER BY event_time, order_id LIMIT 100""")
def keyset_page(spark, sf):
    return search.keyset_page(
        tables.fact_events(spark, sf), ("2024-01-10 12:00:00", 100), ["event_time", "order_id", "symbol"], 100
    )


@query("top_hot_keys", f"WITH {WORKLOAD} SELECT user_id, count(*) AS rows FROM workload GROUP BY 1 ORDER BY rows DESC, user_id LIMIT 20")
def top_hot_keys(spark, sf):
    return search.heaviest_keys(tables.workload(spark, sf), "user_id", 20)
