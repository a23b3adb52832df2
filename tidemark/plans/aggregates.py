"""Aggregations and running values."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import search
from tidemark.operators.purchases import current_spend, normalize_purchase, running_spend, valid_purchase
from tidemark.operators.quality import duplicate_keys
from tidemark.operators.quantiles import exact_percentiles
from tidemark.operators.versions import latest_by
from tidemark.operators.windows import fee_merge, fee_partials, windowed_fees
from tidemark.plans.inputs_sql import FACTS, FEE_EVENTS, PURCHASES, WORKLOAD
from tidemark.plans.registry import query
from tidemark.sources import tables


def clean_purchases(spark, sf):
    return normalize_purchase(valid_purchase(tables.purchases(spark, sf)))


@query("fee_agg", f"WITH {FEE_EVENTS} SELECT customer_id, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count FROM fee_events GROUP BY 1")
def fee_agg(spark, sf):
    fees = tables.fee_events(spark, sf)
    return fee_merge(fee_partials(fees, "customer_id"), "customer_id")


@query("fee_agg_merge", f"WITH {FEE_EVENTS} SELECT customer_id, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count FROM fee_events GROUP BY 1")
def fee_agg_merge(spark, sf):
    """Partials per source partition, merged later: any split gives the same totals."""
    per_source = fee_partials(tables.fee_events(spark, sf), "customer_id", "source_partition")
    return fee_merge(per_source, "customer_id")


@query("running_spend", f"""WITH {PURCHASES} SELECT arrival, customer_id,
    CASE WHEN row_number() OVER w = 1 THEN product ELSE 'running-total' END AS product,
    CAST(sum(amount) OVER w AS DOUBLE) AS amount, occurred_at
  FROM valid WINDOW w AS (PARTITION BY customer_id ORDER BY arrival ROWS UNBOUNDED PRECEDING)""")
def running(spark, sf):
    return running_spend(clean_purchases(spark, sf))


@query("current_spend", f"""WITH {PURCHASES} SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS amount,
    arg_max(occurred_at, arrival) AS updated_at FROM valid GROUP BY 1""")
def current(spark, sf):
    return current_spend(clean_purchases(spark, sf))


@query("count_rows", "SELECT count(*) AS rows, count(*) FILTER (WHERE event_type = 'purchase') AS purchases FROM events")
def count_rows(spark, sf):
    return tables.events(spark, sf).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(F.col("event_type") == "purchase", 1)).alias("purchases")
    )


@query("report_summary", f"""WITH {FEE_EVENTS} SELECT count(*) AS reports, CAST(sum(fee) AS DOUBLE) AS total_fee, CAST(sum(n) AS BIGINT) AS events
  FROM (SELECT customer_id, sum(fee) AS fee, count(*) AS n FROM fee_events
    WHERE time_bucket(INTERVAL 1 DAY, occurred_at) = TIMESTAMP '2024-01-10' GROUP BY 1)""")
def report_summary(spark, sf):
    one = tables.fee_events(spark, sf).where("occurred_at >= timestamp'2024-01-10' and occurred_at < timestamp'2024-01-11'")
    return windowed_fees(one, "1 day").agg(
        F.count(F.lit(1)).alias("reports"), F.sum("total_fee").alias("total_fee"), F.sum("event_count").alias("events")
    )


@query("duplicate_keys", f"""WITH {FACTS}
  SELECT 'facts' AS name, count(*) - count(DISTINCT event_id) AS duplicates FROM facts
  UNION ALL SELECT 'orders', count(*) - count(DISTINCT o_orderkey) FROM orders
  UNION ALL SELECT 'lineitem', count(*) - count(DISTINCT (l_orderkey, l_linenumber)) FROM lineitem""")
def duplicates(spark, sf):
    checks = {
        "facts": duplicate_keys(tables.fact_events(spark, sf), "event_id"),
        "orders": duplicate_keys(tables.table(spark, sf, "orders"), "o_orderkey"),
        "lineitem": duplicate_keys(tables.table(spark, sf, "lineitem"), "l_orderkey", "l_linenumber"),
    }
    named = [df.select(F.lit(name).alias("name"), "duplicates") for name, df in checks.items()]
    return named[0].unionByName(named[1]).unionByName(named[2])


@query("sum_or_zero", f"""WITH {FEE_EVENTS} SELECT CAST(coalesce(sum(fee), 0) AS DOUBLE) AS total_fee, count(*) AS event_count
  FROM fee_events WHERE fee < 0""")
def sum_or_zero(spark, sf):
    none = tables.fee_events(spark, sf).where("fee < 0")
    return fee_merge(fee_partials(none))


@query("latest_by_version", f"""WITH {FACTS} SELECT event_id, order_id, version, CAST(amount AS DOUBLE) AS amount, event_time FROM facts
  QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, order_id DESC) = 1""")
def latest_by_version(spark, sf):
    facts = tables.fact_events(spark, sf).select("event_id", "order_id", "version", "amount", "event_time")
    return latest_by(facts, ["event_id"], ["version", "order_id"])


@query("argmax_read", f"""WITH {FACTS} SELECT event_id, CAST(arg_max(amount, version) AS DOUBLE) AS amount, count(*) AS versions
  FROM facts GROUP BY 1""")
def argmax_read(spark, sf):
    return tables.fact_events(spark, sf).groupBy("event_id").agg(
        F.max_by("amount", "version").alias("amount"), F.count(F.lit(1)).alias("versions")
    )


@query("latency_stats", """SELECT event_type, count(*) AS n, min(value) AS min, max(value) AS max,
    list_sort(list(value))[count(*) // 2 + 1] AS upper_median
  FROM events GROUP BY 1""")
def latency_stats(spark, sf):
    return exact_percentiles(tables.events(spark, sf), ["event_type"], "value", {"upper_median": 0.5}, method="upper")


@query("latency_tail", """SELECT event_type, count(*) AS n, round(quantile_cont(value, 0.5), 6) AS p50,
    round(quantile_cont(value, 0.95), 6) AS p95, round(quantile_cont(value, 0.99), 6) AS p99
  FROM events GROUP BY 1""")
def latency_tail(spark, sf):
    tail = exact_percentiles(tables.events(spark, sf), ["event_type"], "value", {"p50": 0.5, "p95": 0.95, "p99": 0.99})
    return tail.select("event_type", "n", *[F.round(p, 6).alias(p) for p in ("p50", "p95", "p99")])


@query("hot_key_counts", f"""WITH {WORKLOAD} SELECT user_id, count(*) AS rows, count(*) / (SELECT count(*) FROM workload) AS share
  FROM workload GROUP BY 1""")
def hot_key_counts(spark, sf):
    return search.key_counts(tables.workload(spark, sf), "user_id")
