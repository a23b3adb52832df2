import itertools

import pytest
from pyspark.sql import functions as F

from tidemark.functions import from_micros
from tidemark.operators import ledger as lg
from tidemark.operators.windows import fee_merge, fee_partials, sessions, windowed_fees
from tidemark.sources import fixtures

ORDERS = "customer_id string, source_partition int, sequence bigint, fee decimal(19,2), occurred_at timestamp"


@pytest.fixture
def lab(spark, at, money):
    rows = [
        ("alice", 0, 104, money("10.00"), at("12:00:40")),
        ("alice", 0, 106, money("5.00"), at("12:04:50")),
        ("alice", 0, 105, money("7.50"), at("12:03:00")),
        ("bob", 1, 201, money("4.00"), at("12:02:10")),
        ("alice", 0, 107, money("3.00"), at("12:05:31")),
    ]
    return spark.createDataFrame(rows, ORDERS)


def summary(df):
    return sorted((r.customer_id, r.window_start.strftime("%H:%M"), str(r.total_fee), r.event_count) for r in df.collect())


LAB = [("alice", "12:00", "22.50", 3), ("alice", "12:05", "3.00", 1), ("bob", "12:00", "4.00", 1)]


def test_bounded_lab(lab):
    assert summary(windowed_fees(lab)) == LAB


def test_any_arrival_order_and_any_split_give_the_same_sums(spark, lab):
    rows = lab.collect()
    for order in list(itertools.permutations(rows))[::40]:
        assert summary(windowed_fees(spark.createDataFrame(list(order), ORDERS))) == LAB
    parts = fee_merge(fee_partials(lab, "customer_id", "source_partition", "sequence"), "customer_id")
    assert {r.customer_id: str(r.total_fee) for r in parts.collect()} == {"alice": "25.50", "bob": "4.00"}


def test_window_boundaries(spark, at, money):
    edge = spark.createDataFrame(
        [("a", 0, 1, money("1"), at("12:04:59.999")), ("a", 0, 2, money("1"), at("12:05:00.000"))], ORDERS
    )
    assert [x[1] for x in summary(windowed_fees(edge))] == ["12:00", "12:05"]


def test_watermark_value(spark, at):
    seen = spark.createDataFrame([(at("12:04:50"),), (at("12:03:00"),)], "t timestamp")
    mark = seen.agg(lg.watermark_millis(F.max(F.unix_millis("t")), 30_000).alias("w")).select(F.timestamp_millis("w").alias("w"))
    assert mark.first().w.strftime("%H:%M:%S.%f")[:12] == "12:04:19.999"


def staged(spark):
    frames = [
        fixtures.billing_phase(spark, phase).withColumn("arrival_batch", F.lit(i).cast("bigint"))
        for i, phase in enumerate(fixtures.PHASES)
    ]
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def test_four_phases_on_the_ledger(spark):
    arrivals = staged(spark)
    wms = lg.watermarks(lg.ledger_of(arrivals), 16)
    rows = lg.classify(arrivals, wms)
    got = {
        (r.s, r["class"]): (str(r.fee), r.n)
        for r in rows.groupBy(F.date_format(from_micros(F.col("window_start_us")), "HH:mm").alias("s"), "class")
        .agg(F.sum("fee").alias("fee"), F.count(F.lit(1)).alias("n")).collect()
    }
    assert got == {
        ("12:00", "on_time"): ("150.00", 17),
        ("12:00", "corrected"): ("3.00", 1),
        ("12:00", "too_late"): ("9.00", 1),
        ("12:05", "on_time"): ("32.00", 32),
    }


def test_emissions_repeat_the_complete_total(spark):
    arrivals = staged(spark)
    wms = lg.watermarks(lg.ledger_of(arrivals), 16)
    said = lg.emissions(lg.classify(arrivals, wms), wms).where("customer_id = 'customer-00' and hour(window_start) = 12 and minute(window_start) = 0")
    assert [(r.emit_batch, r.kind, str(r.total_fee), r.event_count) for r in said.orderBy("emit_batch").collect()] == [
        (0, "first", "15.00", 2),
        (1, "correction", "18.00", 3),
    ]


def test_status(spark):
    arrivals = staged(spark)
    wms = lg.watermarks(lg.ledger_of(arrivals), 16)
    status = lg.with_status(lg.reports(lg.classify(arrivals, wms)), wms)
    got = {(r.m, r.status): r.n for r in status.groupBy(F.minute(from_micros(F.col("window_start_us"))).alias("m"), "status").agg(F.count(F.lit(1)).alias("n")).collect()}
    assert got == {(0, "final"): 16, (5, "open"): 16}


IDLE = [
    # batch, partition, event second, clock second
    (0, 0, 300, 0), (0, 1, 290, 0),
    (1, 0, 600, 2), (2, 0, 1300, 5), (3, 1, 300, 6), (4, 0, 1310, 60),
]


def idle_ledger(spark):
    rows = [(b, p, t * 1_000_000, c * 1_000_000) for b, p, t, c in IDLE]
    return spark.createDataFrame(rows, "arrival_batch bigint, source_partition int, max_us bigint, heard_us bigint")


def test_idle_partition_stops_holding_back_and_never_moves_back(spark):
    marks = lg.watermarks(idle_ledger(spark), 2, idle_us=lg.IDLE_US).orderBy("arrival_batch")
    assert [r.wm_us // 1_000_000 for r in marks.collect()] == [260, 260, 1270, 1270, 1280]
    held = lg.watermarks(idle_ledger(spark), 2).orderBy("arrival_batch")
    assert [r.wm_us // 1_000_000 for r in held.collect()] == [260, 260, 260, 270, 270]


def test_unseen_partition_blocks_until_it_is_idle(spark):
    ledger = idle_ledger(spark)
    blocked = lg.watermarks(ledger, 3).collect()
    assert all(r.wm_us is None for r in blocked)
    freed = lg.watermarks(ledger, 3, idle_us=lg.IDLE_US).orderBy("arrival_batch").collect()
    assert [r.wm_us and r.wm_us // 1_000_000 for r in freed] == [None, None, 1270, 1270, 1280]


@pytest.mark.parametrize("idle", [None, lg.IDLE_US])
@pytest.mark.parametrize("partitions", [2, 3])
def test_streaming_progress_equals_the_batch_ledger(spark, idle, partitions):
    ledger = idle_ledger(spark)
    want = {r.arrival_batch: r.wm_us for r in lg.watermarks(ledger, partitions, idle_us=idle).collect()}
    progress = None
    for batch in sorted(want):
        step = lg.advance(progress, ledger.where(F.col("arrival_batch") == batch), partitions, idle_us=idle).collect()
        progress = spark.createDataFrame(step, "source_partition int, seen_us bigint, last_heard_us bigint, started_us bigint, now_us bigint, wm_us bigint")
        assert {r.wm_us for r in step} == {want[batch]}


def test_sessions_match_the_built_in_window(spark, lab):
    mine = sessions(lab, ["customer_id"], "occurred_at", 60_000_000, {"n": F.lit(1)})
    built_in = lab.groupBy("customer_id", F.session_window("occurred_at", "1 minute").alias("w")).agg(F.count(F.lit(1)).alias("n"))
    flat = built_in.select("customer_id", F.col("w.start"), F.col("w.end"), "n")
    assert sorted(map(tuple, mine.collect())) == sorted(map(tuple, flat.collect()))


def test_session_gap_is_inclusive(spark):
    df = spark.createDataFrame([("a", 0), ("a", 60), ("a", 121)], "k string, s int").withColumn("ts", F.timestamp_seconds("s"))
    got = sessions(df, ["k"], "ts", 60_000_000, {"n": F.lit(1)})
    assert sorted(r.n for r in got.collect()) == [1, 2]
