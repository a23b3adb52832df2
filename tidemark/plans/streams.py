"""Structured Streaming jobs run to completion over the given tables.

Each stage lands files in a folder and runs the query until they are consumed;
the next stage resumes from the checkpoint.
"""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import money
from tidemark.operators import digests, quality
from tidemark.operators.scan import HOUR_US
from tidemark.operators.windows import fee_merge, windowed_fees
from tidemark.plans.inputs_sql import CLASSIFIED, FEE_EVENTS, HOUR, PURCHASES, watermarks
from tidemark.plans.joins import RECONCILED
from tidemark.plans.registry import query
from tidemark.plans.state import TTL_MS, cart_sql
from tidemark.session import keep, new_folder
from tidemark.sources import readers, sinks, tables, wire
from tidemark.streaming import native
from tidemark.streaming.billing import BillingStream
from tidemark.streaming.checkpoints import batch_log, committed_offsets, offsets_moved
from tidemark.streaming.processors import cart_stream as cart_stream_rows
from tidemark.streaming.processors import state_store
from tidemark.streaming.progress import ProgressTable
from tidemark.streaming.rules import ARRIVING, RuledStream
from tidemark.streaming.purchases import SpendStream

STAGES = 4
LANDED_ROWS = 50_000  # of a landed file, at least, where a batch has several
_DONE: dict[tuple[str, str, str], object] = {}


def _once(spark, sf, name, run):
    """Several queries read the tables of one run."""
    at = (spark.sparkContext.applicationId, sf, name)
    if at not in _DONE:
        _DONE[at] = run()
    return _DONE[at]


def staged_fees(spark, sf, stages: int = STAGES):
    """Fee events cut into equal stretches of arrival."""
    fees = tables.fee_events(spark, sf)
    batches = fees.agg(F.max("arrival_batch") + 1).scalar()
    return fees.withColumn("stage", F.floor(F.col("arrival_batch") * stages / batches).cast("int"))


def billing_job(kind: type[BillingStream], root: str) -> BillingStream:
    return kind(root, bound_us=HOUR_US, size_us=HOUR_US, lateness_us=2 * HOUR_US, idle_us=None)


def land_and_run(spark, job: BillingStream, rows) -> None:
    wire.encode_orders(rows).write.mode("append").parquet(f"{job.root}/landing")
    run_landed(spark, job)


def run_landed(spark, job: BillingStream) -> None:
    records = readers.record_stream(spark, f"{job.root}/landing")
    job.start(records, f"{job.root}/checkpoint", available_now=True).awaitTermination()


def billing_run(spark, sf) -> BillingStream:
    def run():
        job = billing_job(BillingStream, new_folder(spark, "billing"))
        for stage in range(STAGES):
            land_and_run(spark, job, staged_fees(spark, sf).where(F.col("stage") == stage))
        return job

    return _once(spark, sf, "billing", run)


def _staged_sql(stages: int) -> str:
    return FEE_EVENTS.replace("fee_events AS", "unstaged AS", 1) + f""",
fee_events AS (SELECT * REPLACE (CAST(floor(arrival_batch * {stages} / (SELECT max(arrival_batch) + 1 FROM unstaged)) AS BIGINT) AS arrival_batch) FROM unstaged)"""


_STAGED = _staged_sql(STAGES)
_JUDGED = f"{_STAGED},\n{watermarks()},\n{CLASSIFIED}"


@query("src_order_stream", f"WITH {FEE_EVENTS} SELECT customer_id, source_partition, \"offset\", sequence, CAST(fee AS DOUBLE) AS fee, occurred_at FROM fee_events")
def src_order_stream(spark, sf):
    """Everything the stream read, once each, with partition and offset."""
    arrivals = billing_run(spark, sf).arrivals(spark)
    return arrivals.select("customer_id", "source_partition", "offset", "sequence", "fee", "occurred_at")


@query("upsert_reports", f"""WITH {_JUDGED}, now AS (SELECT max(wm_us) AS w FROM wm)
  SELECT customer_id, make_timestamp(window_start_us) AS window_start, make_timestamp(window_end_us) AS window_end, CAST(sum(fee) AS DOUBLE) AS total_fee,
    count(*) AS event_count, CASE WHEN window_end_us + {2 * HOUR} <= w THEN 'final' ELSE 'provisional' END AS status
  FROM classified, now WHERE class <> 'too_late' AND window_end_us <= w GROUP BY customer_id, window_start_us, window_end_us, w""")
def upsert_reports(spark, sf):
    return billing_run(spark, sf).fee_reports(spark, STAGES - 1)


@query("upsert_audit", f"WITH {FEE_EVENTS} SELECT source_partition, sequence AS sequence_number, customer_id, CAST(fee AS DOUBLE) AS fee, occurred_at FROM fee_events")
def upsert_audit(spark, sf):
    return billing_run(spark, sf).audit.view(spark)


@query("upsert_too_late", f"""WITH {_JUDGED} SELECT source_partition, sequence AS sequence_number, customer_id, CAST(fee AS DOUBLE) AS fee, occurred_at
  FROM classified WHERE class = 'too_late'""")
def upsert_too_late(spark, sf):
    return billing_run(spark, sf).rejected.view(spark)


def _reconciled_sql(keys: str = "") -> str:
    by, using = (f" GROUP BY {keys}", f"USING ({keys})") if keys else ("", "ON true")
    named = f"{keys.replace('window_start_us', 'make_timestamp(window_start_us) AS window_start')}, " if keys else ""
    part = lambda rows: f"SELECT {keys + ', ' if keys else ''}sum(fee) AS fee, count(*) AS n FROM classified{rows}{by}"
    return f"""WITH {_JUDGED},
  a AS ({part('')}), l AS ({part(" WHERE class = 'too_late'")}), r AS ({part(" WHERE class <> 'too_late'")})
  SELECT {named}{RECONCILED} FROM a LEFT JOIN l {using} LEFT JOIN r {using}"""


def _reconciled(spark, sf, *keys):
    """What landed against what the job wrote: records, too-late table and reports, each read from its own files."""
    job = billing_run(spark, sf)
    hour = lambda df: df.withColumn("window_start", F.window("occurred_at", "1 hour").start)
    landed = wire.decode_orders(spark.read.schema(schemas.RECORD).parquet(f"{job.root}/landing"))
    return quality.reconcile(hour(landed), hour(job.rejected.view(spark)), job.reports.view(spark), list(keys))


@query("reconcile", _reconciled_sql())
def reconcile(spark, sf):
    return _reconciled(spark, sf)


@query("reconcile_window", _reconciled_sql("window_start_us"))
def reconcile_window(spark, sf):
    return _reconciled(spark, sf, "window_start")


@query("reconcile_scope", _reconciled_sql("window_start_us, customer_id"))
def reconcile_scope(spark, sf):
    """By window and customer; ``reconcile_rows`` goes on to partition and sequence."""
    return _reconciled(spark, sf, "window_start", "customer_id")


_FAULTS = "CASE WHEN event_id % 211 = 7 THEN 'missing' WHEN event_id % 223 = 9 THEN 'repeated' WHEN event_id % 227 = 11 THEN 'altered' END"


@query("reconcile_rows", f"""WITH {FEE_EVENTS}, f AS (SELECT *, {_FAULTS} AS fault FROM fee_events)
  SELECT source_partition, sequence, fault, CAST(1 AS BIGINT) AS left_rows, CAST(CASE fault WHEN 'missing' THEN 0 WHEN 'repeated' THEN 2 ELSE 1 END AS BIGINT) AS right_rows
  FROM f WHERE fault IS NOT NULL""")
def reconcile_rows(spark, sf):
    """The audit table with some rows lost, doubled and changed against what landed: every such row by name.

    Digests of window, customer and partition are compared first; only what differs is compared row by row.
    """
    job = billing_run(spark, sf)
    columns = ["source_partition", "sequence", "customer_id", "fee", "occurred_at", "window_start"]
    hour = lambda df: df.withColumn("window_start", F.window("occurred_at", "1 hour").start)
    landed = hour(wire.decode_orders(spark.read.schema(schemas.RECORD).parquet(f"{job.root}/landing"))).select(*columns)
    audit = hour(job.audit.view(spark).withColumnRenamed("sequence_number", "sequence")).select(*columns)
    fault = F.expr(_FAULTS.replace("event_id", "((sequence - 1) * 16 + source_partition)"))
    broken = audit.withColumn("fault", fault).where("fault is null or fault <> 'missing'")
    broken = broken.withColumn("fee", F.when(F.col("fault") == "altered", F.col("fee") + 1).otherwise(F.col("fee")).cast("decimal(19,2)"))
    broken = broken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.when(F.col("fault") == "repeated", 2).otherwise(1)))).select(*columns)
    return digests.differing_rows(landed, broken, [["window_start"], ["customer_id"], ["source_partition"]], ["source_partition", "sequence"], ["fee", "occurred_at"])


@query("stream_watermarks", f"WITH {_STAGED},\n{watermarks()} SELECT arrival_batch, wm_us FROM wm")
def stream_watermarks(spark, sf):
    """The streaming ledger reaches the same watermarks as the batch ledger."""
    root = billing_run(spark, sf).root
    progress = spark.read.option("basePath", f"{root}/progress").parquet(f"{root}/progress")
    return progress.groupBy(F.col("batch_id").cast("bigint").alias("arrival_batch")).agg(F.max("wm_us").alias("wm_us"))


def landed_in_sixths(spark, sf, landing: str) -> int:
    """Land purchases in six stretches of arrival, one after the other, each of equally many files; how many these are.

    A trigger of so many files is then one stretch. Stretches are cut at quantiles, so gaps between arrivals do not matter.
    """
    raw = tables.purchases(spark, sf)
    bounds = raw.approxQuantile("arrival", [i / 6 for i in range(1, 6)], 0.001) or [0.0] * 5
    arrival = F.col("arrival")
    edges = [None, *[F.lit(int(b)) for b in bounds], None]
    stretches = [arrival.isNotNull() if low is None else arrival >= low for low in edges[:-1]]
    stretches = [s if high is None else s & (arrival < high) for s, high in zip(stretches, edges[1:], strict=True)]
    # With so many rows a file, none of a stretch's files can stay without rows.
    files = max(1, min(raw.agg(*[F.count_if(s) for s in stretches]).first()) // LANDED_ROWS)
    for stretch in stretches:
        wire.encode_purchases(raw.where(stretch).repartition(files)).write.mode("append").parquet(landing)
    return files


def spend_run(spark, sf) -> tuple[SpendStream, int]:
    """Purchases land in six stretches and are read one stretch a batch, by both queries of the job at once; the files of a stretch."""

    def run():
        root = new_folder(spark, "spend")
        job = SpendStream(root, buckets=4)
        files = landed_in_sixths(spark, sf, f"{root}/landing")
        started = []
        for start, checkpoint in ((job.start, "totals"), (job.start_running, "rows")):
            stream = readers.record_stream(spark, f"{root}/landing", max_files=files)
            started.append(start(stream, f"{root}/checkpoint-{checkpoint}", available_now=True))
        for query_ in started:
            query_.awaitTermination()
        return job, files

    return _once(spark, sf, "spend", run)


_SPEND = f"""WITH {PURCHASES} SELECT customer_id, CAST(sum(amount) AS DOUBLE) AS amount, arg_max(occurred_at, arrival) AS updated_at FROM valid GROUP BY 1"""
_RUNNING = f"""WITH {PURCHASES} SELECT arrival, customer_id, CASE WHEN row_number() OVER w = 1 THEN product ELSE 'running-total' END AS product,
  CAST(sum(amount) OVER w AS DOUBLE) AS amount, occurred_at FROM valid WINDOW w AS (PARTITION BY customer_id ORDER BY arrival ROWS UNBOUNDED PRECEDING)"""


@query("upsert_spend", _SPEND)
def upsert_spend(spark, sf):
    """Totals kept in the stream's state over six batches, upserted batch by batch."""
    job, _ = spend_run(spark, sf)
    return job.customer_spend(spark)


@query("running_spend_stream", _RUNNING)
def running_spend_stream(spark, sf):
    """One row per purchase from a state of one's own, the arrivals split over six batches."""
    job, _ = spend_run(spark, sf)
    return job.running(spark)


@query("src_purchase_stream", f"WITH {PURCHASES} SELECT arrival, customer_id, product, CAST(amount AS DOUBLE) AS amount, occurred_at FROM valid")
def src_purchase_stream(spark, sf):
    """What the stream read: every landed purchase once, decoded and cleaned."""
    (job, files), root = spend_run(spark, sf), new_folder(spark, "purchases")
    rows = job.cleaned(readers.record_stream(spark, f"{job.root}/landing", max_files=2 * files))
    _run_to_end(rows, f"{root}/checkpoint", "append", "parquet", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out").select("arrival", "customer_id", "product", "amount", "occurred_at")


def _cart_rows(spark, sf, refresh: str):
    root = new_folder(spark, "cart-stream")
    rows = tables.cart_activity(spark, sf)
    quarter = rows.agg(F.expr("max(arrival) div 4 + 1")).scalar()
    for part in range(4):
        rows.where(F.floor(F.col("arrival") / quarter) == part).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    with state_store(spark):
        carts = cart_stream_rows(readers.table_stream(spark, f"{root}/landing", rows.schema, max_files=1), TTL_MS, refresh)
        _run_to_end(carts, f"{root}/checkpoint", "append", "parquet", path=f"{root}/out")
    shown = spark.read.parquet(f"{root}/out").select("arrival", "customer_id", "total", "count", "fresh")
    return shown.withColumn("refresh", F.lit(refresh))


@query("cart_stream", f"SELECT *, 'write' AS refresh FROM ({cart_sql('NOT probe')}) UNION ALL SELECT *, 'read_write' AS refresh FROM ({cart_sql('true')})")
def cart_stream(spark, sf):
    """Expiring carts on keyed state with event-time timers, four batches, for both ways of refreshing."""
    return _cart_rows(spark, sf, "write").unionByName(_cart_rows(spark, sf, "read_write"))


_RULES = """rules AS (SELECT event_type AS key, ts AS at, max(CAST(user_id % 7 + 1 AS DOUBLE)) AS weight FROM events WHERE event_id % 101 = 3 GROUP BY ALL)"""


@query("enrich_rules_stream", f"""WITH {_RULES} SELECT e.event_id, e.event_type, r.weight, r.at AS rule_at, CAST(CAST(e.value AS DECIMAL(19,2)) AS DOUBLE) * r.weight AS weighted
  FROM events e ASOF LEFT JOIN rules r ON e.event_type = r.key AND e.ts >= r.at""")
def enrich_rules_stream(spark, sf):
    """Events weighed by the rule of their type that held at their time; every second rule arrives two batches late."""
    root = new_folder(spark, "rules")
    job, events = RuledStream(root), tables.events(spark, sf)
    quarter = events.agg(F.expr("max(event_id) div 4 + 1")).scalar()
    stage = F.floor(F.col("event_id") / quarter)
    records = events.select(F.col("event_id").alias("id"), F.col("event_type").alias("key"), F.col("ts").alias("at"), F.lit(None).cast("double").alias("weight"), stage.alias("stage"))
    late = stage + F.when(F.expr("event_id div 101") % 2 == 1, 2).otherwise(0)
    rules = events.where("event_id % 101 = 3").select(
        F.lit(None).cast("bigint").alias("id"), F.col("event_type").alias("key"), F.col("ts").alias("at"), (F.col("user_id") % 7 + 1).cast("double").alias("weight"), late.alias("stage")
    )
    arriving = keep(records.unionByName(rules), "arriving")
    landed = {r["stage"]: r["count"] for r in arriving.groupBy("stage").count().collect()}
    for batch in range(6):
        # The late versions are far fewer than records, so each batch has files of its own number and a run of its own.
        files = max(1, landed.get(batch, 0) // LANDED_ROWS)
        arriving.where(F.col("stage") == batch).drop("stage").repartition(files).write.mode("append").parquet(f"{root}/landing")
        stream = readers.table_stream(spark, f"{root}/landing", ARRIVING)
        job.start(stream, f"{root}/checkpoint", available_now=True).awaitTermination()
    amounts = events.select(F.col("event_id").alias("id"), money(F.col("value")).cast("double").alias("amount"))
    found = job.judged.view(spark).join(amounts, "id")
    return found.select(F.col("id").alias("event_id"), F.col("key").alias("event_type"), "weight", "rule_at", (F.col("amount") * F.col("weight")).alias("weighted"))


@query("src_replay", f"WITH {FEE_EVENTS} SELECT event_id, customer_id, CAST(fee AS DOUBLE) AS fee FROM fee_events")
def src_replay(spark, sf):
    """A finite source replayed in two runs: the checkpoint remembers the position."""
    root = new_folder(spark, "replay")
    rows = staged_fees(spark, sf).select("event_id", "customer_id", "fee", "stage")
    for stage in (F.col("stage") < 2, F.col("stage") >= 2):
        rows.where(stage).drop("stage").write.mode("append").parquet(f"{root}/landing")
        stream = readers.table_stream(spark, f"{root}/landing", rows.drop("stage").schema)
        _run_to_end(stream, f"{root}/checkpoint", "append", "parquet", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out")


_CLOSED = f"""WITH {FEE_EVENTS}, now AS (SELECT date_trunc('millisecond', max(occurred_at)) - INTERVAL 30 SECOND AS w FROM fee_events),
  r AS (SELECT customer_id, time_bucket(INTERVAL 5 MINUTE, occurred_at) AS window_start, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count
    FROM fee_events GROUP BY ALL)
  SELECT customer_id, window_start, window_start + INTERVAL 5 MINUTE AS window_end, total_fee, event_count FROM r, now WHERE window_start + INTERVAL 5 MINUTE <= w"""


class FailsAfterWriting(BillingStream):
    """Fault injection: the second batch fails after its writes, before its commit."""

    def process(self, batch, batch_id):
        super().process(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("injected failure")


def crash_run(spark, sf):
    """A job whose second batch fails after its writes and is resumed; with the committed offsets at the failure."""

    def run():
        root = new_folder(spark, "crash")
        job = billing_job(BillingStream, root)
        rows = staged_fees(spark, sf, 2)
        land_and_run(spark, job, rows.where("stage = 0"))
        try:
            land_and_run(spark, billing_job(FailsAfterWriting, root), rows.where("stage = 1"))
            raise AssertionError("the injected failure did not happen")
        except StreamingQueryException:
            failed = keep(committed_offsets(job.arrivals(spark), batch_log(spark, f"{root}/checkpoint")), "offsets-at-failure")
            run_landed(spark, job)
        return job, failed

    return _once(spark, sf, "crash", run)


@query("resume_after_failure", f"""WITH {_staged_sql(2)},\n{watermarks()},\n{CLASSIFIED}
  SELECT count(*) AS audited, count(*) - count(DISTINCT (source_partition, sequence)) AS duplicates, count(*) FILTER (WHERE class = 'too_late') AS rejected,
    count(*) FILTER (WHERE class <> 'too_late') AS reported, CAST(sum(fee) FILTER (WHERE class <> 'too_late') AS DOUBLE) AS reported_fee
  FROM classified""")
def resume_after_failure(spark, sf):
    """Crash after the writes of a batch, then resume: nothing lost, nothing doubled.

    Duplicates are counted among the stored rows of each batch, not in the view, which would hide them.
    """
    job, _ = crash_run(spark, sf)
    totals = job.reports.view(spark).agg(F.sum("event_count").alias("n"), F.sum("total_fee").alias("fee"))
    return job.audit.view(spark).agg(F.count(F.lit(1)).alias("audited")).select(
        "audited",
        job.audit.repeated(spark).agg(F.coalesce(F.sum(F.col("times") - 1), F.lit(0))).scalar().alias("duplicates"),
        job.rejected.view(spark).agg(F.count(F.lit(1))).scalar().alias("rejected"),
        totals.select("n").scalar().alias("reported"),
        totals.select("fee").scalar().alias("reported_fee"),
    )


@query("resume_sinks", f"""WITH {_staged_sql(2)},\n{watermarks()},\n{CLASSIFIED}, stored AS (
    SELECT 'audit' AS name, source_partition || '/' || sequence AS key FROM classified
    UNION ALL SELECT 'rejected', source_partition || '/' || sequence FROM classified WHERE class = 'too_late'
    UNION ALL SELECT 'reports', r.key FROM (SELECT DISTINCT arrival_batch, customer_id || '/' || window_start_us AS key FROM classified WHERE class <> 'too_late') r)
  SELECT name, count(*) AS stored_rows, CAST(0 AS BIGINT) AS repeated_rows, count(DISTINCT key) AS keys FROM stored GROUP BY 1""")
def resume_sinks(spark, sf):
    """All three tables after a crash and replay: every stored row by batch, repeats inside a batch, and keys of the view."""
    job, _ = crash_run(spark, sf)
    out = None
    for name, table in (("audit", job.audit), ("rejected", job.rejected), ("reports", job.reports)):
        repeats = table.repeated(spark).agg(F.coalesce(F.sum(F.col("times") - 1), F.lit(0))).scalar()
        stored = table.history(spark).agg(F.count(F.lit(1)).alias("stored_rows"))
        keys = table.view(spark).agg(F.count(F.lit(1))).scalar()
        row = stored.select(F.lit(name).alias("name"), "stored_rows", repeats.alias("repeated_rows"), keys.alias("keys"))
        out = row if out is None else out.unionByName(row)
    return out


@query("offset_progress", f"""WITH {_staged_sql(2)},
  b AS (SELECT source_partition, max("offset") AS before_offset FROM fee_events WHERE arrival_batch = 0 GROUP BY 1),
  a AS (SELECT source_partition, max("offset") AS after_offset FROM fee_events GROUP BY 1)
  SELECT source_partition, before_offset, after_offset, after_offset < before_offset AS regressed, after_offset > before_offset AS advanced
  FROM a LEFT JOIN b USING (source_partition)""")
def offset_progress(spark, sf):
    """Committed offsets at a failure and after the recovery, by the stream's own offset and commit logs."""
    job, failed = crash_run(spark, sf)
    return offsets_moved(failed, committed_offsets(job.arrivals(spark), batch_log(spark, f"{job.root}/checkpoint")))


_HOURLY = f"""WITH {FEE_EVENTS} SELECT customer_id, time_bucket(INTERVAL 1 HOUR, occurred_at) AS window_start,
    time_bucket(INTERVAL 1 HOUR, occurred_at) + INTERVAL 1 HOUR AS window_end, CAST(sum(fee) AS DOUBLE) AS total_fee, count(*) AS event_count, 'v2' AS revision
  FROM fee_events GROUP BY ALL"""


@query("bootstrap_state", _HOURLY)
def bootstrap_state(spark, sf):
    """Stop revision v1 mid-way, read its window state as a table, go on as v2."""
    keys = ("customer_id", "window_start", "window_end")
    root = new_folder(spark, "upgrade")
    rows = staged_fees(spark, sf, 2).select("customer_id", "fee", "occurred_at", "stage")
    rows.where("stage = 0").drop("stage").write.parquet(f"{root}/landing")
    stream = readers.table_stream(spark, f"{root}/landing", rows.drop("stage").schema)
    # v1 writes its reports to a keyed log: windows that have left its state are taken from there, open ones from the state.
    v1 = native.corrected_windows(stream, "1 hour", "1 hour")
    log = sinks.KeyedLog(f"{root}/reports", v1.schema, keys)
    _run_to_end(v1, f"{root}/checkpoint", "update", log.write)
    open_windows = native.saved_windows(spark, f"{root}/checkpoint")
    closed = log.view(spark).alias("l").join(open_windows.alias("o"), [F.col(f"l.{k}").eqNullSafe(F.col(f"o.{k}")) for k in keys], "left_anti")
    saved = open_windows.unionByName(closed.select(*open_windows.columns))
    rest = windowed_fees(rows.where("stage = 1"), "1 hour")
    return fee_merge(saved.unionByName(rest), *keys).withColumn("revision", F.lit("v2"))


def _run_to_end(frame, checkpoint: str, mode: str, sink, **options: str):
    """``sink`` is a format, or a function of a batch and its id."""
    writer = frame.writeStream.foreachBatch(sink) if callable(sink) else frame.writeStream.format(sink)
    query_ = (
        writer.outputMode(mode)
        .options(**options)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query_.awaitTermination()
    return query_


def _closed(spark, sf, name: str):
    root = new_folder(spark, name)
    rows = tables.fee_events(spark, sf).select("customer_id", "fee", "occurred_at")
    rows.write.parquet(f"{root}/landing")
    stream = readers.table_stream(spark, f"{root}/landing", rows.schema)
    _run_to_end(native.closed_windows(stream), f"{root}/checkpoint", "append", "parquet", path=f"{root}/out")
    return spark.read.parquet(f"{root}/out")


@query("close_on_watermark", _CLOSED)
def close_on_watermark(spark, sf):
    """Append mode: a window appears once, when the watermark has passed its end."""
    return _closed(spark, sf, "closed")


@query("state_store_choice", _CLOSED)
def state_store_choice(spark, sf):
    """The same windows with their state in RocksDB."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    native.use_state_store(spark, "rocksdb")
    try:
        return _closed(spark, sf, "rocksdb")
    finally:
        spark.conf.set(name, before)


@query("progress_to_metrics", "SELECT 'input_rows' AS metric, CAST(count(*) AS DOUBLE) AS value FROM events")
def progress_to_metrics(spark, sf):
    """Every progress report of a run as metric rows, stored by a listener: the rows it read, summed."""
    root = new_folder(spark, "progress")
    rows = tables.fee_events(spark, sf).select("customer_id", "fee", "occurred_at")
    rows.repartition(3).write.parquet(f"{root}/landing")
    stream = readers.table_stream(spark, f"{root}/landing", rows.schema, max_files=1)
    with ProgressTable(spark, f"{root}/metrics") as reports:
        _run_to_end(native.closed_windows(stream), f"{root}/checkpoint", "append", "noop")
    return reports.table().where("metric = 'input_rows'").groupBy("metric").agg(F.sum("value").alias("value"))
