"""Reconciliation and data quality."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.quantiles import exact_percentiles
from tidemark.plans.inputs_sql import FACTS, FEE_EVENTS, JUDGED
from tidemark.plans.joins import judged
from tidemark.plans.registry import query
from tidemark.session import new_folder
from tidemark.sources import fixtures, readers, sinks, tables


_GAPPY = "SELECT *, lag(sequence) OVER (PARTITION BY source_partition ORDER BY sequence) AS prev FROM fee_events WHERE event_id % 97 <> 5 AND event_id % 89 <> 3"


@query("sequence_gaps", f"""WITH {FEE_EVENTS}, g AS ({_GAPPY})
  SELECT source_partition, prev + 1 AS gap_start, sequence - 1 AS gap_end, sequence - prev - 1 AS missing FROM g WHERE sequence - prev > 1""")
def sequence_gaps(spark, sf):
    some = tables.fee_events(spark, sf).where("event_id % 97 <> 5 and event_id % 89 <> 3")
    return quality.sequence_gaps(some)


_SHAKEN = "SELECT *, occurred_at - CASE WHEN event_id % 23 = 0 THEN INTERVAL 12 HOUR ELSE INTERVAL 0 HOUR END AS happened FROM fee_events"


@query("sequence_disorder", f"""WITH {FEE_EVENTS}, s AS ({_SHAKEN}),
  p AS (SELECT *, lag(happened) OVER (PARTITION BY source_partition ORDER BY sequence) AS previous_at FROM s)
  SELECT source_partition, sequence, happened AS occurred_at, previous_at FROM p WHERE happened < previous_at""")
def sequence_disorder(spark, sf):
    fees = tables.fee_events(spark, sf).select(
        "source_partition",
        "sequence",
        (F.col("occurred_at") - F.when(F.col("event_id") % 23 == 0, F.expr("interval 12 hours")).otherwise(F.expr("interval 0 hours"))).alias("occurred_at"),
    )
    return quality.sequence_disorder(fees)


@query("arrival_disorder", f"""WITH {FEE_EVENTS}, d AS (SELECT source_partition, max(epoch_us(occurred_at)) OVER (PARTITION BY source_partition
    ORDER BY arrival ROWS UNBOUNDED PRECEDING) - epoch_us(occurred_at) AS behind_us FROM fee_events)
  SELECT source_partition, count(*) AS n, CAST(min(behind_us) AS DOUBLE) AS min, CAST(max(behind_us) AS DOUBLE) AS max,
    round(quantile_cont(CAST(behind_us AS DOUBLE), 0.5), 3) AS p50, round(quantile_cont(CAST(behind_us AS DOUBLE), 0.99), 3) AS p99
  FROM d GROUP BY 1""")
def arrival_disorder(spark, sf):
    behind = quality.arrival_disorder(tables.fee_events(spark, sf), ["source_partition"], "arrival")
    spread = exact_percentiles(behind, ["source_partition"], "behind_us", {"p50": 0.5, "p99": 0.99})
    return spread.select("source_partition", "n", "min", "max", *[F.round(p, 3).alias(p) for p in ("p50", "p99")])


GATE_REASONS = ("customer missing", "fee not positive", "time out of range", "currency unknown", "reading went back", "customer unknown", "duplicate")
_GATES: dict[tuple[str, str], tuple[str, dict[str, int]]] = {}


def gated(spark, sf):
    """Events with derived faults: no or an unknown customer, seconds for microseconds, repeats, negative fees, another
    currency, a meter reading below the one before it."""
    i = F.col("event_id")
    dirty = tables.fee_events(spark, sf).select(
        "arrival",
        "event_id",
        F.when(i % 17 != 0, F.col("customer_id")).alias("customer_id"),
        "source_partition",
        (F.col("sequence") - F.when(i % 29 == 0, 1).otherwise(0)).alias("sequence"),
        F.when(i % 31 == 0, -F.col("fee")).otherwise(F.col("fee")).alias("fee"),
        F.when(i % 37 == 0, F.timestamp_seconds((F.unix_seconds("occurred_at") / 1000).cast("bigint")))
        .otherwise(F.col("occurred_at"))
        .alias("occurred_at"),
        F.when(i % 43 == 0, "XXX").otherwise("EUR").alias("currency"),
        (F.expr("event_id div 3") - F.when(i % 53 == 0, 50).otherwise(0)).alias("reading"),
    )
    known = tables.events(spark, sf).where("user_id % 19 <> 0").select(F.format_string("user-%d", "user_id").alias("customer_id"))
    dirty = quality.goes_back(dirty, ["source_partition"], "event_id", "reading", "went_back")
    dirty = quality.unknown_to(dirty, known, ["customer_id"], "stranger")
    span = F.col("occurred_at").between(F.lit("2023-01-01").cast("timestamp"), F.lit("2025-01-01").cast("timestamp"))
    rules = [F.col("customer_id").isNull(), F.col("fee") <= 0, ~span, ~F.col("currency").isin("EUR", "USD"), F.col("went_back"), F.col("customer_id").isNotNull() & F.col("stranger")]
    return quality.gate(dirty, dict(zip(GATE_REASONS, rules, strict=False)), duplicates_of=["source_partition", "sequence"], order="arrival")


def gate_run(spark, sf) -> tuple[str, dict[str, int]]:
    """One pass over the events: valid and quarantined rows stored apart, with the counts observed on the way."""
    at = (spark.sparkContext.applicationId, sf)
    if at not in _GATES:
        path = new_folder(spark, "gate")
        _GATES[at] = path, quality.split_and_count(gated(spark, sf), path, GATE_REASONS)
    return _GATES[at]


_GATED = f"""{FEE_EVENTS},
  dirty AS (SELECT arrival, event_id, CASE WHEN event_id % 17 <> 0 THEN customer_id END AS customer_id, source_partition,
      sequence - (CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END) AS sequence,
      CASE WHEN event_id % 31 = 0 THEN -fee ELSE fee END AS fee, event_id % 37 = 0 AS bad_time, event_id % 43 = 0 AS bad_currency,
      event_id // 3 - (CASE WHEN event_id % 53 = 0 THEN 50 ELSE 0 END) AS reading FROM fee_events),
  faults AS (SELECT *, min(arrival) OVER (PARTITION BY source_partition, sequence) < arrival AS repeated,
      coalesce(reading < lag(reading) OVER (PARTITION BY source_partition ORDER BY event_id), false) AS went_back,
      customer_id NOT IN (SELECT 'user-' || user_id FROM events WHERE user_id % 19 <> 0) AS stranger FROM dirty),
  gated AS (SELECT *, concat_ws(',', CASE WHEN customer_id IS NULL THEN 'customer missing' END, CASE WHEN fee <= 0 THEN 'fee not positive' END,
      CASE WHEN bad_time THEN 'time out of range' END, CASE WHEN bad_currency THEN 'currency unknown' END, CASE WHEN went_back THEN 'reading went back' END,
      CASE WHEN stranger THEN 'customer unknown' END, CASE WHEN repeated THEN 'duplicate' END) AS reasons FROM faults)"""


@query("quality_gate", f"WITH {_GATED} SELECT event_id, reasons FROM gated WHERE reasons <> ''")
def quality_gate(spark, sf):
    rows = spark.read.parquet(gate_run(spark, sf)[0]).where("valid = 0")
    return rows.select("event_id", F.concat_ws(",", "reasons").alias("reasons"))


@query("quality_valid", f"WITH {_GATED} SELECT event_id, source_partition, sequence, CAST(fee AS DOUBLE) AS fee FROM gated WHERE reasons = ''")
def quality_valid(spark, sf):
    return spark.read.parquet(gate_run(spark, sf)[0]).where("valid = 1").select("event_id", "source_partition", "sequence", "fee")


@query("quality_counts", f"""WITH {_GATED} SELECT reason, count(*) AS rows FROM (
    SELECT unnest(string_split(CASE WHEN reasons = '' THEN 'valid' ELSE reasons END, ',')) AS reason FROM gated) GROUP BY 1""")
def quality_counts(spark, sf):
    """The counts observed while the rows were written: no second look at them."""
    counts = gate_run(spark, sf)[1]
    return spark.createDataFrame([(n, counts[n]) for n in ("valid", *GATE_REASONS) if counts[n]], "reason string, rows bigint")


EXPORT = ("event_id", "order_id", "event_time", "amount")


@query("stable_export", f"""WITH {FACTS}, d AS (SELECT CAST(event_time AS DATE) AS bucket, CAST('0x' || substr(md5(concat_ws('|', event_id, CAST(order_id AS VARCHAR), CAST(amount AS VARCHAR))), 1, 15) AS BIGINT) AS h
    FROM facts WHERE event_time < TIMESTAMP '2024-01-20')
  SELECT strftime(bucket, '%Y-%m-%d') AS bucket, count(*) AS rows, CAST(sum(CAST(h AS DECIMAL(38,0))) AS VARCHAR) AS digest, true AS stable FROM d GROUP BY bucket""")
def stable_export(spark, sf):
    """Export before a cutoff, add rows after the cutoff, export again: same content."""
    facts = tables.fact_events(spark, sf)
    store = new_folder(spark, "export-store")
    cutoff = F.col("event_time") < F.lit("2024-01-20").cast("timestamp")
    digests = []
    batches = facts.where("event_time < timestamp'2024-01-25'"), facts.where("event_time >= timestamp'2024-01-25'")
    for rows in batches:
        rows.write.mode("append").parquet(store)
        out = new_folder(spark, "export-csv")
        sinks.export_csv(spark.read.parquet(store), out, EXPORT, cutoff, ["event_id", "order_id"])
        exported = readers.typed_csv(spark, out, facts.select(*EXPORT).schema)
        digests.append(
            quality.content_digest(exported, ["event_id", "order_id", "amount"], F.date_format("event_time", "yyyy-MM-dd"))
        )
    first, second = digests[0], digests[1].select("bucket", F.col("rows").alias("_rows"), F.col("digest").alias("_digest"))
    both = first.join(second, "bucket", "full")
    return both.select(
        "bucket",
        "rows",
        F.col("digest").cast("string").alias("digest"),
        ((F.col("rows") == F.col("_rows")) & (F.col("digest") == F.col("_digest"))).alias("stable"),
    )


@query("partition_coverage", f"""WITH {FEE_EVENTS} SELECT CAST(p AS INTEGER) AS source_partition, count(event_id) AS rows FROM (SELECT unnest(range(16)) AS p)
  LEFT JOIN fee_events ON source_partition = p GROUP BY 1""")
def partition_coverage(spark, sf):
    return quality.partition_coverage(tables.fee_events(spark, sf), fixtures.PARTITIONS)


@query("report_delay", f"""WITH {JUDGED},
  spoken AS (SELECT arrival_batch, max(epoch_us(arrived_at)) AS emitted_us FROM fee_events GROUP BY 1),
  changed AS (SELECT DISTINCT customer_id, window_start_us, window_end_us, arrival_batch FROM classified WHERE class = 'corrected'),
  d AS (SELECT (emitted_us - window_end_us) / 1e6 AS delay FROM changed JOIN spoken USING (arrival_batch))
  SELECT count(*) AS n, min(delay) AS min, max(delay) AS max, round(quantile_cont(delay, 0.5), 6) AS p50, round(quantile_cont(delay, 0.95), 6) AS p95,
    (SELECT count(*) FROM d WHERE delay > 2500000) AS over_objective FROM d""")
def report_delay(spark, sf):
    """Delay from a window's end to each corrected report, against an objective."""
    rows, _ = judged(spark, sf)
    spoken = tables.fee_events(spark, sf).groupBy("arrival_batch").agg(F.unix_micros(F.max("arrived_at")).alias("emitted_us"))
    changed = rows.where("class = 'corrected'").select("customer_id", "window_start_us", "window_end_us", "arrival_batch").distinct()
    delays = changed.join(spoken, "arrival_batch").select(
        ((F.col("emitted_us") - F.col("window_end_us")) / F.lit(1e6)).alias("delay")
    )
    over = delays.agg(F.count(F.when(F.col("delay") > 2_500_000, 1))).scalar()
    spread = exact_percentiles(delays, [], "delay", {"p50": 0.5, "p95": 0.95})
    return spread.select("n", "min", "max", F.round("p50", 6).alias("p50"), F.round("p95", 6).alias("p95"), over.alias("over_objective"))


@query("classify_orders", f"""WITH {JUDGED},
  sent AS (SELECT *, sequence - (CASE WHEN event_id % 29 = 0 THEN 1 ELSE 0 END) AS sent_as FROM classified WHERE event_id % 97 <> 5),
  labelled AS (SELECT CASE WHEN event_id % 41 = 0 THEN 'malformed'
      WHEN row_number() OVER (PARTITION BY source_partition, sent_as ORDER BY arrival) > 1 THEN 'duplicate'
      WHEN class = 'too_late' THEN 'too late' WHEN class = 'corrected' THEN 'corrected' ELSE 'accepted' END AS label FROM sent),
  steps AS (SELECT sent_as - lag(sent_as) OVER (PARTITION BY source_partition ORDER BY sent_as) - 1 AS missing FROM (SELECT DISTINCT source_partition, sent_as FROM sent))
  SELECT label, count(*) AS orders FROM labelled GROUP BY 1
  UNION ALL SELECT 'missing', CAST(coalesce(sum(missing), 0) AS BIGINT) FROM steps WHERE missing > 0""")
def classify_orders(spark, sf):
    """Every order in one of six classes; missing ones are counted from the gaps."""
    rows, _ = judged(spark, sf)
    sent = rows.where("event_id % 97 <> 5").withColumn(
        "sequence", F.col("sequence") - F.when(F.col("event_id") % 29 == 0, 1).otherwise(0)
    )
    marked = quality.gate(
        sent, {"malformed": F.col("event_id") % 41 == 0}, duplicates_of=["source_partition", "sequence"], order="arrival"
    )
    label = (
        F.when(F.array_contains("reasons", "malformed"), "malformed")
        .when(F.array_contains("reasons", "duplicate"), "duplicate")
        .when(F.col("class") == "too_late", "too late")
        .when(F.col("class") == "corrected", "corrected")
        .otherwise("accepted")
    )
    counts = marked.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("orders"))
    gaps = quality.sequence_gaps(sent).agg(F.coalesce(F.sum("missing"), F.lit(0)).alias("orders"))
    return counts.unionByName(gaps.select(F.lit("missing").alias("label"), "orders"))

