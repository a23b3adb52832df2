"""Sources and sinks in batch form."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import amount
from tidemark.plans.inputs_sql import FACTS, FEE_EVENTS, PURCHASES
from tidemark.plans.registry import query
from tidemark.session import new_folder
from tidemark.sources import fixtures, readers, sinks, tables, wire

_SINK = """SELECT 'event-' || event_id AS event_id, date_trunc('millisecond', ts) AS occurred_at, 'user-' || user_id AS customer_id,
    ['BTC','ETH','SOL','XRP'][CAST(event_id % 4 AS INTEGER) + 1] AS symbol, CAST(CAST(value AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM events"""


def sink_events(spark, sf):
    e = tables.events(spark, sf)
    return e.select(
        F.format_string("event-%d", "event_id").alias("event_id"),
        F.col("ts").alias("occurred_at"),
        F.format_string("user-%d", "user_id").alias("customer_id"),
        fixtures.symbol_of(F.col("event_id")).alias("symbol"),
        amount(F.col("value")).alias("amount"),
    )


@query("append_typed", _SINK)
def append_typed(spark, sf):
    path = new_folder(spark, "append")
    sinks.append_typed(sink_events(spark, sf), path, schemas.SINK_EVENT)
    return spark.read.schema(schemas.SINK_EVENT).parquet(path)


@query("append_replay", "SELECT count(*) * 2 AS rows, count(DISTINCT event_id) AS identities FROM events")
def append_replay(spark, sf):
    """Appending twice stores twice: duplicates stay visible."""
    path = new_folder(spark, "append-replay")
    for _ in range(2):
        sinks.append_typed(sink_events(spark, sf), path, schemas.SINK_EVENT)
    per = spark.read.schema(schemas.SINK_EVENT).parquet(path).groupBy("event_id").agg(F.count(F.lit(1)).alias("n"))
    return per.agg(F.sum("n").alias("rows"), F.count(F.lit(1)).alias("identities"))


@query("fixture_sink_rows", """SELECT 'event-' || event_id AS event_id, TIMESTAMP '2026-08-01' + to_seconds(event_id) AS occurred_at,
  CASE WHEN event_id % 2 = 0 THEN 'customer-a' ELSE 'customer-b' END AS customer_id, CASE WHEN event_id % 2 = 0 THEN 'BTC' ELSE 'ETH' END AS symbol,
  CAST(CAST(CAST(event_id + 1 AS DECIMAL(18,0)) / 100 AS DECIMAL(12,2)) AS DOUBLE) AS amount FROM events""")
def fixture_sink_rows(spark, sf):
    return sinks.sink_rows(tables.events(spark, sf).select(F.col("event_id").alias("id")))


@query("load_jsonlines", f"WITH {FACTS} SELECT event_id, user_id, order_id, event_time, ingested_at, symbol, version, CAST(amount AS DOUBLE) AS amount FROM facts")
def load_jsonlines(spark, sf):
    path = new_folder(spark, "jsonlines")
    stamp = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'"
    facts = tables.fact_events(spark, sf)
    facts.withColumns({c: F.date_format(c, stamp) for c in ("event_time", "ingested_at")}).write.json(path)
    return readers.json_lines(spark, path, schemas.CASE_EVENT)


@query("export_csv", f"WITH {FACTS} SELECT event_id, order_id, date_trunc('millisecond', event_time) AS event_time, CAST(amount AS DOUBLE) AS amount FROM facts WHERE event_time < TIMESTAMP '2024-01-20'")
def export_csv(spark, sf):
    path = new_folder(spark, "csv")
    facts = tables.fact_events(spark, sf)
    columns = ["event_id", "order_id", "event_time", "amount"]
    cutoff = F.col("event_time") < F.lit("2024-01-20").cast("timestamp")
    sinks.export_csv(facts, path, columns, cutoff, ["event_id", "order_id"])
    return readers.typed_csv(spark, path, facts.select(*columns).schema)


@query("decode_purchase", f"WITH {PURCHASES} SELECT arrival, customer_id, product, CAST(amount AS DOUBLE) AS amount, occurred_at FROM purchases")
def decode_purchase(spark, sf):
    records = wire.encode_purchases(tables.purchases(spark, sf))
    return wire.decode_purchases(records, keep=("offset",)).withColumnRenamed("offset", "arrival")


@query("decode_order", f"WITH {FEE_EVENTS} SELECT customer_id, source_partition, sequence, CAST(fee AS DOUBLE) AS fee, occurred_at FROM fee_events")
def decode_order(spark, sf):
    return wire.decode_orders(wire.encode_orders(tables.fee_events(spark, sf)))


@query("decode_quarantine", f"""WITH {FEE_EVENTS} SELECT source_partition, "offset", CASE WHEN event_id % 50 = 7 THEN 'undecodable' ELSE 'incomplete' END AS fault
  FROM fee_events WHERE event_id % 50 = 7 OR event_id % 50 = 9""")
def decode_quarantine(spark, sf):
    """Lenient decoding keeps bad payloads apart instead of failing."""
    records = wire.encode_orders(tables.fee_events(spark, sf).withColumn(
        "sequence", F.when(F.col("event_id") % 50 != 9, F.col("sequence"))
    ).withColumn("offset", F.col("event_id")))
    broken = records.withColumn(
        "value",
        F.when(F.col("offset") % 50 == 7, F.encode(F.lit("{\"customerId\": \"x\", \"fee\": \"many\"}"), "utf-8")).otherwise(F.col("value")),
    )
    decoded = wire.decode_orders(broken, strict=False, keep=("offset",))
    bad = decoded.where(wire.incomplete("corrupt", "customer_id", "sequence", "fee", "occurred_at"))
    return bad.select(
        "source_partition",
        F.expr("offset div 16").alias("offset"),
        F.when(F.col("corrupt").isNotNull(), "undecodable").otherwise("incomplete").alias("fault"),
    )
