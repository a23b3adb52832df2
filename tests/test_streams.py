import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import ledger as lg
from tidemark.operators.quality import duplicate_keys, partition_coverage, reconcile
from tidemark.operators.windows import fee_merge
from tidemark.session import new_folder
from tidemark.sources import fixtures, readers, wire
from tidemark.streaming import native
from tidemark.streaming.billing import BillingStream
from tidemark.streaming.checkpoints import batch_log, committed_offsets, offsets_moved
from tidemark.streaming.progress import ProgressTable
from tidemark.streaming.purchases import SpendStream

FEES = "customer_id string, source_partition int, sequence bigint, fee decimal(19,2), occurred_at timestamp"


def land(root, rows, landing="landing"):
    rows.coalesce(1).write.mode("append").parquet(f"{root}/{landing}")


def run(spark, root, job, landing="landing"):
    stream = readers.record_stream(spark, f"{root}/{landing}")
    job.start(stream, f"{root}/checkpoint", available_now=True).awaitTermination()


def noon(df):
    return df.where("window_start = timestamp'2026-07-30 12:00:00'")


def totals(df):
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum("total_fee").alias("fee"), F.sum("event_count").alias("events")).first()
    return r.n, str(r.fee), r.events


def test_staged_billing(spark):
    root = new_folder(spark, "staged")
    job = BillingStream(root, idle_us=None)
    after = {}
    for i, phase in enumerate(fixtures.PHASES):
        land(root, wire.encode_orders(fixtures.billing_phase(spark, phase)))
        run(spark, root, job)
        after[phase] = totals(noon(job.fee_reports(spark, i)))
    assert after["initial"] == (16, "150.00", 17)
    assert after["correction"] == after["advance"] == after["too_late"] == (16, "153.00", 18)
    corrected = noon(job.fee_reports(spark, 3)).where("customer_id = 'customer-00'").first()
    assert (str(corrected.total_fee), corrected.event_count, corrected.status) == ("18.00", 3, "final")

    audit, rejected, reports = job.audit.view(spark), job.rejected.view(spark), noon(job.reports.view(spark))
    in_noon = lambda df: df.where("occurred_at < timestamp'2026-07-30 12:05:00'")
    r = reconcile(in_noon(audit), in_noon(rejected), reports).first()
    assert (str(r.source_fee), r.source_count, str(r.too_late_fee), r.too_late_count) == ("162.00", 19, "9.00", 1)
    assert (str(r.reported_fee), r.reported_count, str(r.fee_delta), r.count_delta) == ("153.00", 18, "0.00", 0)
    assert partition_coverage(audit, 16).where("rows = 0").count() == 0

    before = totals(job.reports.view(spark))
    assert job.reports.fold(spark) and totals(job.reports.view(spark)) == before


def crash_orders(spark, at, money):
    rows = [
        ("alice", 0, 104, money("10.00"), at("12:00:40"), 0),
        ("alice", 1, 201, money("4.00"), at("12:02:10"), 0),
        ("alice", 0, 105, money("7.50"), at("12:03:00"), 1),
        ("alice", 0, 106, money("5.00"), at("12:04:50"), 2),
    ]
    return spark.createDataFrame(rows, FEES + ", offset bigint")


class Crash(BillingStream):
    """Fails once after its writes, before the batch is committed."""

    def process(self, batch, batch_id):
        super().process(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("injected failure")


def test_resume_after_failure(spark, at, money):
    orders, root = crash_orders(spark, at, money), new_folder(spark, "crash")
    job = BillingStream(root, partitions=2, bound_us=1_000_000, idle_us=None)
    land(root, wire.encode_orders(orders.where("sequence <> 106")))
    run(spark, root, job)
    state = job.reports.view(spark).first()
    assert (str(state.total_fee), state.event_count) == ("21.50", 3)
    land(root, wire.encode_orders(orders.where("sequence = 106")))
    with pytest.raises(PySparkException):
        run(spark, root, Crash(root, partitions=2, bound_us=1_000_000, idle_us=None))
    run(spark, root, job)
    final = job.reports.view(spark).collect()
    assert [(str(r.total_fee), r.event_count) for r in final] == [("26.50", 4)]
    for table in (job.audit, job.rejected, job.reports):
        assert duplicate_keys(table.view(spark), *table.keys).first().duplicates == 0
        assert table.repeated(spark).count() == 0
    assert job.audit.view(spark).count() == 4


def test_a_sequence_sent_twice_shows_in_reconciliation(spark, at, money):
    orders, root = crash_orders(spark, at, money), new_folder(spark, "twice")
    twice = orders.unionByName(orders.where("sequence = 105").withColumn("offset", F.lit(9).cast("bigint")))
    job = BillingStream(root, partitions=2, idle_us=None)
    land(root, wire.encode_orders(twice))
    run(spark, root, job)
    r = reconcile(job.audit.view(spark), job.rejected.view(spark), job.reports.view(spark)).first()
    assert (str(r.fee_delta), r.count_delta) == ("-7.50", -1)


def native_run(spark, root, frame, mode, build, table):
    stream = readers.table_stream(spark, f"{root}/landing", frame.schema)
    query = build(stream).writeStream.outputMode(mode).option("checkpointLocation", f"{root}/checkpoint").trigger(availableNow=True)
    out = []

    def keep(batch, batch_id):
        out.extend(batch.collect())

    query.foreachBatch(keep).start().awaitTermination()
    return out


@pytest.mark.parametrize("store", ["memory", "rocksdb"])
def test_native_windows_close_once_and_stores_agree(spark, at, money, store):
    lab = spark.createDataFrame(
        [
            ("alice", 0, 104, money("10.00"), at("12:00:40")),
            ("alice", 0, 106, money("5.00"), at("12:04:50")),
            ("alice", 0, 105, money("7.50"), at("12:03:00")),
            ("bob", 1, 201, money("4.00"), at("12:02:10")),
            ("alice", 0, 107, money("3.00"), at("12:05:31")),
        ],
        FEES,
    )
    root = new_folder(spark, f"native-{store}")
    land(root, lab)
    native.use_state_store(spark, store)
    try:
        rows = native_run(spark, root, lab, "append", native.closed_windows, "x")
    finally:
        native.use_state_store(spark, "memory")
    assert sorted((r.customer_id, str(r.total_fee), r.event_count) for r in rows) == [("alice", "22.50", 3), ("bob", "4.00", 1)]


def test_native_correction_and_progress_table(spark):
    root, said = new_folder(spark, "update"), []
    with ProgressTable(spark, new_folder(spark, "progress"), every=2) as reports:
        for phase in fixtures.PHASES:
            rows = fixtures.billing_phase(spark, phase).drop("offset")
            land(root, rows)
            said.append(native_run(spark, root, rows, "update", native.corrected_windows, "x"))
    corrected = [r for r in said[1] if r.customer_id == "customer-00"]
    assert [(str(r.total_fee), r.event_count) for r in corrected] == [("18.00", 3)]
    assert not [r for r in said[3] if r.window_start.minute == 0]
    seen = reports.table()
    assert seen.where("metric = 'late_rows_dropped'").agg(F.max("value")).first()[0] == 1.0
    assert seen.where("metric = 'input_rows'").agg(F.sum("value")).first()[0] == sum(fixtures.billing_phase(spark, p).count() for p in fixtures.PHASES)


def test_session_windows_on_a_stream(spark, at, money):
    rows = spark.createDataFrame(
        [(c, 0, i, money(f), at(t)) for i, (c, f, t) in enumerate([("a", "1", "12:00:00"), ("a", "2", "12:01:59"), ("a", "4", "12:04:00"), ("b", "8", "12:01:00"), ("z", "0", "13:00:00")])], FEES
    )
    root = new_folder(spark, "sessions")
    land(root, rows)
    found = native_run(spark, root, rows, "append", lambda s: native.session_fees(s, "2 minutes", "10 seconds"), "x")
    assert sorted((r.customer_id, str(r.total_fee), r.event_count, r.session_end.minute) for r in found) == [("a", "3.00", 2, 3), ("a", "4.00", 1, 6), ("b", "8.00", 1, 3)]


def test_saved_state_moves_to_a_new_revision(spark, at, money):
    """State of revision v1 as a table, merged with v2's output at another parallelism."""
    orders = crash_orders(spark, at, money).drop("offset")
    root = new_folder(spark, "upgrade")
    land(root, orders.where("sequence <> 106"))
    native_run(spark, root, orders, "update", native.corrected_windows, "x")
    saved = native.saved_windows(spark, f"{root}/checkpoint").where("total_fee is not null")
    before = saved.collect()
    assert [(str(r.total_fee), r.event_count) for r in before] == [("21.50", 3)]
    rest = native.windowed_fees(orders.where("sequence = 106").repartition(2))
    keys = ("customer_id", "window_start", "window_end")
    merged = native.tag_revision(fee_merge(saved.unionByName(rest), *keys), "v2").first()
    assert (str(merged.total_fee), merged.event_count, merged.revision) == ("26.50", 4, "v2")


def test_spend_stream_rows_and_table(spark, at, money):
    day = "2026-01-01"
    first = [(1, " Alice ", "Book", money("12.50"), at("00:00:00", day)), (2, "bob", "Note", money("0"), at("00:03:00", day))]
    second = [(3, "alice", "Course", money("20.00"), at("00:01:00", day)), (4, "bob", "Note", money("8.00"), at("00:02:00", day))]
    schema = "arrival bigint, customer_id string, product string, amount decimal(19,2), occurred_at timestamp"
    root = new_folder(spark, "spend")
    job = SpendStream(root)
    for rows in (first, second):
        land(root, wire.encode_purchases(spark.createDataFrame(rows, schema)))
        run(spark, root, job)
    assert sorted((r.customer_id, str(r.amount)) for r in job.customer_spend(spark).collect()) == [("alice", "32.50"), ("bob", "8.00")]
    records = readers.record_stream(spark, f"{root}/landing", max_files=1)
    job.start_running(records, f"{root}/checkpoint-rows", available_now=True).awaitTermination()
    out = job.running(spark).orderBy("arrival").collect()
    assert [(r.customer_id, r["product"], str(r.amount)) for r in out] == [("alice", "Book", "12.50"), ("alice", "running-total", "32.50"), ("bob", "Note", "8.00")]


def test_native_join_and_dedup(spark, at, money):
    rows = spark.createDataFrame(
        [("a", 0, 1, money("1"), at("12:00:00")), ("a", 0, 1, money("1"), at("12:00:05")), ("a", 0, 2, money("2"), at("12:03:00"))], FEES
    )
    root = new_folder(spark, "dedup")
    land(root, rows)
    kept = native_run(spark, root, rows, "append", lambda s: native.first_only(s, "1 minute", "source_partition", "sequence"), "x")
    assert sorted(r.sequence for r in kept) == [1, 2]

    def pairs(stream):
        left = stream.where("sequence = 1").select("customer_id", F.col("occurred_at").alias("l_at"))
        right = stream.where("sequence = 2").select("customer_id", F.col("occurred_at").alias("r_at"))
        return native.interval_join(left, right, "customer_id", "l_at", "r_at", "2 minutes 57 seconds", "10 seconds").select("l_at", "r_at")

    root = new_folder(spark, "joined")
    land(root, rows)
    assert [r.l_at.second for r in native_run(spark, root, rows, "append", pairs, "x")] == [5]


def test_ledger_constants():
    assert (lg.SIZE_US, lg.BOUND_US, lg.LATENESS_US, lg.IDLE_US) == (300_000_000, 30_000_000, 120_000_000, 3_000_000)


def test_console_sink_prints_and_stops(spark):
    root = new_folder(spark, "console")
    rows = fixtures.billing_phase(spark, "correction").drop("offset")
    land(root, rows)
    query = native.to_console(readers.table_stream(spark, f"{root}/landing", rows.schema), f"{root}/checkpoint")
    try:
        query.processAllAvailable()
        assert query.lastProgress["numInputRows"] == 1
    finally:
        query.stop()


def bad_records(spark, at, money):
    good = wire.encode_orders(crash_orders(spark, at, money))
    bodies = ["{oops", '{"customerId":"zoe","fee":"1.00","occurredAt":"2026-07-30T12:01:00.000000Z"}', '{"sequence":7,"occurredAt":"2026-07-30T12:01:00.000000Z"}']
    rows = [(None, bytearray(b.encode()), "t", 5, 100 + i, at("12:01:00")) for i, b in enumerate(bodies)]
    return good.unionByName(spark.createDataFrame(rows, good.schema))


def test_incomplete_records_go_to_quarantine(spark, at, money):
    root = new_folder(spark, "lenient")
    job = BillingStream(root, idle_us=None, strict=False)
    land(root, bad_records(spark, at, money))
    run(spark, root, job)
    held = {r.offset: (r.reason, bytes(r.value)[:5]) for r in job.quarantine.view(spark).collect()}
    assert held == {100: ("undecodable", b"{oops"), 101: ("without sequence", b'{"cus'), 102: ("without customer_id,fee", b'{"seq')}
    assert job.audit.view(spark).count() == 4 and job.reports.view(spark).where("customer_id is null").count() == 0


@pytest.mark.parametrize("which", [100, 101, 102])
def test_incomplete_records_fail_a_strict_job(spark, at, money, which):
    root = new_folder(spark, "strict")
    land(root, bad_records(spark, at, money).where((F.col("offset") < 100) | (F.col("offset") == which)))
    with pytest.raises(PySparkException):
        run(spark, root, BillingStream(root, idle_us=None))


def test_a_purchase_without_a_customer_fails_the_job(spark):
    root = new_folder(spark, "strict-purchases")
    body = bytearray(b'{"product":"Book","amount":1.00,"occurredAt":"2026-01-01T00:00:00.000000Z"}')
    land(root, spark.createDataFrame([(None, body, "t", 0, 1, None)], schemas.RECORD))
    with pytest.raises(PySparkException):
        run(spark, root, SpendStream(root))


def test_logs_show_a_reset_checkpoint(spark, at, money):
    orders, root = crash_orders(spark, at, money), new_folder(spark, "reset")
    job = BillingStream(root, partitions=2, idle_us=None)
    for part in (F.col("offset") == 0, F.col("offset") > 0):
        land(root, wire.encode_orders(orders.where(part)))
        run(spark, root, job)
    log = batch_log(spark, f"{root}/checkpoint")
    assert [(r.batch_id, r.committed) for r in log.orderBy("batch_id").collect()] == [(0, True), (1, True)]
    assert all("logOffset" in r.offsets[0] for r in log.collect())
    held = [(r.source_partition, r.committed_offset) for r in committed_offsets(job.arrivals(spark), log).collect()]
    assert sorted(held) == [(0, 2), (1, 0)]
    before = spark.createDataFrame(held, "source_partition int, committed_offset bigint")
    assert batch_log(spark, f"{root}/none").count() == 0
    # The job starts again from nothing: its first batch stands in for all that was committed.
    again = BillingStream(new_folder(spark, "reset-again"), partitions=2, idle_us=None)
    land(again.root, wire.encode_orders(orders.where("offset = 0")))
    run(spark, again.root, again)
    moved = offsets_moved(before, committed_offsets(again.arrivals(spark), batch_log(spark, f"{again.root}/checkpoint")))
    assert {r.source_partition: (r.regressed, r.advanced) for r in moved.collect()} == {0: (True, False), 1: (False, False)}
