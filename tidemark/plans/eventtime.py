"""Event time: windows, watermarks, lateness."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import from_micros, micros, money
from tidemark.operators import ledger
from tidemark.operators.scan import HOUR_US, Running, running
from tidemark.operators.versions import first_seen
from tidemark.operators.windows import sessions, windowed_fees
from tidemark.plans.inputs_sql import FEE_EVENTS, HOUR, JUDGED, watermarks
from tidemark.plans.joins import LATENESS, judged
from tidemark.plans.registry import query
from tidemark.sources import fixtures, tables

# The recorded clock moves one second per arrival, so 15 s of silence is about
# as long as 15 arrivals from other partitions.
IDLE_US = 15_000_000


@query("tumble_fee", f"""WITH {FEE_EVENTS} SELECT customer_id, time_bucket(INTERVAL 5 MINUTE, occurred_at) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, occurred_at) + INTERVAL 5 MINUTE AS window_end,
    CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count
  FROM fee_events GROUP BY ALL""")
def tumble_fee(spark, sf):
    return windowed_fees(tables.fee_events(spark, sf))


@query("window_bounds", f"""WITH {FEE_EVENTS} SELECT event_id, time_bucket(INTERVAL 5 MINUTE, occurred_at) AS window_start,
    time_bucket(INTERVAL 5 MINUTE, occurred_at) + INTERVAL 5 MINUTE AS window_end FROM fee_events""")
def window_bounds(spark, sf):
    w = F.window("occurred_at", "5 minutes")
    return tables.fee_events(spark, sf).select("event_id", w.start.alias("window_start"), w.end.alias("window_end"))


@query("bounded_end", f"""WITH {FEE_EVENTS} SELECT time_bucket(INTERVAL 1 HOUR, occurred_at) AS window_start, count(DISTINCT customer_id) AS reports,
    count(*) AS events FROM fee_events GROUP BY 1""")
def bounded_end(spark, sf):
    """A bounded read closes every window, the last one included."""
    reports = windowed_fees(tables.fee_events(spark, sf), "1 hour")
    return reports.groupBy("window_start").agg(F.count(F.lit(1)).alias("reports"), F.sum("event_count").alias("events"))


@query("watermark_bounded", f"""WITH {FEE_EVENTS} SELECT event_id, max(epoch_us(occurred_at) // 1000) OVER (PARTITION BY source_partition ORDER BY arrival
    ROWS UNBOUNDED PRECEDING) - 30000 - 1 AS watermark_ms FROM fee_events""")
def watermark_bounded(spark, sf):
    """The bounded-disorder watermark of a partition after each of its records."""
    seen = running(
        tables.fee_events(spark, sf),
        ["source_partition"],
        "arrival",
        [Running("_ms", "max", F.unix_millis("occurred_at"))],
        slice_width=1_000_000,
    )
    return seen.select("event_id", ledger.watermark_millis(F.col("_ms"), 30_000).alias("watermark_ms"))


@query("watermark_monotonic", f"""WITH {FEE_EVENTS} SELECT event_id, max(epoch_us(occurred_at) // 1000) OVER (PARTITION BY source_partition ORDER BY sequence
    ROWS UNBOUNDED PRECEDING) - 1 AS watermark_ms FROM fee_events""")
def watermark_monotonic(spark, sf):
    """Per-partition times that never fall need no bound."""
    seen = running(
        tables.fee_events(spark, sf),
        ["source_partition"],
        "sequence",
        [Running("_ms", "max", F.unix_millis("occurred_at"))],
        slice_width=1_000_000,
    )
    return seen.select("event_id", ledger.watermark_millis(F.col("_ms"), 0).alias("watermark_ms"))


@query("arrival_watermark", f"""WITH {FEE_EVENTS},\n{watermarks()} SELECT event_id, arrival_batch, wm_before_us AS watermark_us
  FROM fee_events LEFT JOIN wm USING (arrival_batch)""")
def arrival_watermark(spark, sf):
    rows, _ = judged(spark, sf)
    return rows.select("event_id", "arrival_batch", F.col("wm_before_us").alias("watermark_us"))


@query("min_across_partitions", f"WITH {FEE_EVENTS},\n{watermarks()} SELECT arrival_batch, wm_us, wm_before_us FROM wm")
def min_across_partitions(spark, sf):
    _, wms = judged(spark, sf)
    return wms


@query("idle_partitions", f"WITH {FEE_EVENTS},\n{watermarks(idle=IDLE_US)} SELECT arrival_batch, wm_us, wm_before_us FROM wm")
def idle_partitions(spark, sf):
    _, wms = judged(spark, sf, idle_us=IDLE_US)
    return wms


@query("watermark_marker", f"""WITH {FEE_EVENTS},
  markers AS (SELECT source_partition AS p, max(epoch_us(occurred_at)) AS m FROM fee_events WHERE sequence % 10 = 0 GROUP BY 1),
  low AS (SELECT CASE WHEN count(*) = 16 THEN min(m) END AS upto FROM markers)
  SELECT customer_id, make_timestamp(s) AS window_start, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count
  FROM (SELECT *, epoch_us(occurred_at) - epoch_us(occurred_at) % {HOUR} AS s FROM fee_events), low
  WHERE s + {HOUR} <= upto GROUP BY ALL""")
def watermark_marker(spark, sf):
    """Completeness markers from upstream close windows: every tenth record is one."""
    arrivals = tables.fee_events(spark, sf)
    wms = ledger.stored_watermarks(arrivals.where("sequence % 10 = 0"), fixtures.PARTITIONS, bound_us=0)
    upto = wms.agg(F.max("wm_us")).scalar()
    reports = windowed_fees(arrivals, "1 hour")
    return reports.where(micros(F.col("window_end")) <= upto).select("customer_id", "window_start", "total_fee", "event_count")


@query("lateness_class", f"WITH {JUDGED} SELECT event_id, class FROM classified")
def lateness_class(spark, sf):
    rows, _ = judged(spark, sf)
    return rows.select("event_id", "class")


@query("too_late_side", f"""WITH {JUDGED} SELECT customer_id, source_partition, sequence, CAST(fee AS DOUBLE) AS fee, occurred_at
  FROM classified WHERE class = 'too_late'""")
def too_late_side(spark, sf):
    rows, _ = judged(spark, sf)
    return ledger.too_late(rows).select("customer_id", "source_partition", "sequence", "fee", "occurred_at")


_REPORTS = """SELECT customer_id, make_timestamp(window_start_us) AS window_start, make_timestamp(window_end_us) AS window_end,
    CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count"""


@query("allowed_lateness", f"WITH {JUDGED} {_REPORTS} FROM classified WHERE class <> 'too_late' GROUP BY customer_id, window_start_us, window_end_us")
def allowed_lateness(spark, sf):
    rows, _ = judged(spark, sf)
    return _timed(ledger.reports(rows))


def _timed(reports):
    return reports.select(
        "customer_id",
        from_micros(F.col("window_start_us")).alias("window_start"),
        from_micros(F.col("window_end_us")).alias("window_end"),
        *[c for c in reports.columns if c in ("total_fee", "event_count", "status")],
    )


@query("first_fire", f"""WITH {JUDGED}, now AS (SELECT max(wm_us) AS w FROM wm), totals AS ({_REPORTS}, window_end_us
    FROM classified WHERE class <> 'too_late' GROUP BY customer_id, window_start_us, window_end_us)
  SELECT customer_id, window_start, window_end, total_fee, event_count,
    CASE WHEN window_end_us + {2 * HOUR} <= w THEN 'final' WHEN window_end_us <= w THEN 'provisional' ELSE 'open' END AS status
  FROM totals, now""")
def first_fire(spark, sf):
    """Readers see provisional and final reports; open ones have not fired."""
    rows, wms = judged(spark, sf)
    return _timed(ledger.with_status(ledger.reports(rows), wms, LATENESS))


@query("window_cleanup", f"""WITH {JUDGED}, now AS (SELECT max(wm_us) AS w FROM wm)
  SELECT count(DISTINCT (customer_id, window_start_us)) AS windows_held FROM classified, now
  WHERE class <> 'too_late' AND window_end_us + {2 * HOUR} > w""")
def window_cleanup(spark, sf):
    """How many windows still need state after the last batch."""
    rows, wms = judged(spark, sf)
    held = ledger.with_status(ledger.reports(rows), wms, LATENESS).where("status <> 'final'")
    return held.agg(F.count(F.lit(1)).alias("windows_held"))


@query("correction_emit", f"""WITH {JUDGED},
  fires AS (SELECT window_end_us, min(w.arrival_batch) AS fire_batch FROM (SELECT DISTINCT window_end_us FROM classified WHERE class <> 'too_late') c
    JOIN wm w ON w.wm_us >= c.window_end_us GROUP BY 1),
  changes AS (SELECT customer_id, window_start_us, window_end_us, greatest(arrival_batch, fire_batch) AS emit_batch, fire_batch,
      sum(fee) AS f, count(*) AS n
    FROM classified JOIN fires USING (window_end_us) WHERE class <> 'too_late' GROUP BY ALL)
  SELECT customer_id, make_timestamp(window_start_us) AS window_start, make_timestamp(window_end_us) AS window_end, emit_batch,
    CASE WHEN emit_batch = fire_batch THEN 'first' ELSE 'correction' END AS kind,
    CAST(sum(f) OVER w AS DOUBLE) AS total_fee, CAST(sum(n) OVER w AS BIGINT) AS event_count
  FROM changes WINDOW w AS (PARTITION BY customer_id, window_start_us ORDER BY emit_batch)""")
def correction_emit(spark, sf):
    rows, wms = judged(spark, sf)
    return ledger.emissions(rows, wms)


@query("slide_window", f"""WITH {FEE_EVENTS}, spread AS (SELECT *, time_bucket(INTERVAL 1 MINUTE, occurred_at) - to_minutes(k) AS window_start
    FROM fee_events, (SELECT unnest(range(5)) AS k))
  SELECT customer_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count
  FROM spread GROUP BY ALL""")
def slide_window(spark, sf):
    return windowed_fees(tables.fee_events(spark, sf), "5 minutes", "1 minute")


def session_sql(gap_us: int, source: str, key: str, ts: str, aggs: str) -> str:
    """Sessions by gap in SQL: a row more than the gap after the last one opens a session."""
    return f"""marked AS (SELECT *, CASE WHEN epoch_us({ts}) - lag(epoch_us({ts})) OVER w > {gap_us} THEN 1 ELSE 0 END AS opens
    FROM {source} WINDOW w AS (PARTITION BY {key} ORDER BY {ts})),
  numbered AS (SELECT *, sum(opens) OVER (PARTITION BY {key} ORDER BY {ts} ROWS UNBOUNDED PRECEDING) AS sess FROM marked),
  sessions AS (SELECT {key}, min({ts}) AS session_start, make_timestamp(max(epoch_us({ts})) + {gap_us}) AS session_end, {aggs}
    FROM numbered GROUP BY {key}, sess)"""


@query("session_window", f"""WITH {FEE_EVENTS}, {session_sql(6 * HOUR, 'fee_events', 'customer_id', 'occurred_at',
    'CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count')} SELECT * FROM sessions""")
def session_window(spark, sf):
    found = sessions(
        tables.fee_events(spark, sf),
        ["customer_id"],
        "occurred_at",
        6 * HOUR_US,
        {"total_fee": F.col("fee"), "event_count": F.lit(1)},
    )
    return found.withColumn("total_fee", money(F.col("total_fee")))


@query("global_window", f"""WITH {FEE_EVENTS} SELECT customer_id, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count, max(occurred_at) AS last_at
  FROM fee_events GROUP BY 1""")
def global_window(spark, sf):
    """One window per key that only its own trigger closes."""
    return tables.fee_events(spark, sf).groupBy("customer_id").agg(
        money(F.sum("fee")).alias("total_fee"), F.count(F.lit(1)).alias("event_count"), F.max("occurred_at").alias("last_at")
    )


@query("dedup_stream", f"""WITH {FEE_EVENTS}, sent AS (SELECT *, sequence - (CASE WHEN sequence % 5 = 0 THEN 1 ELSE 0 END) AS sent_as FROM fee_events)
  SELECT source_partition, sent_as AS sequence, arg_min(event_id, arrival) AS event_id FROM sent GROUP BY 1, 2""")
def dedup_stream(spark, sf):
    """Every fifth sequence repeats the one before it; the first arrival stays."""
    sent = tables.fee_events(spark, sf).withColumn(
        "sequence", F.col("sequence") - F.when(F.col("sequence") % 5 == 0, 1).otherwise(0)
    )
    kept = first_seen(sent.select("source_partition", "sequence", "event_id", "arrival"), ["source_partition", "sequence"], ["arrival"])
    return kept.select("source_partition", "sequence", "event_id")
