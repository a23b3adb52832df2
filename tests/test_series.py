import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators import series

KEYS = ["task"]


def frame(spark, rows):
    return spark.createDataFrame([(t, s * 1_000_000, float(v)) for t, s, v in rows], "task string, us bigint, value double")


def test_counter_with_a_reset(spark):
    c = frame(spark, [("a", 0, 100), ("a", 30, 160), ("a", 60, 10), ("a", 90, 40), ("b", 0, 5)])
    got = {(r.task, r.us // 1_000_000): (r.increase, r.rate) for r in series.counter_increase(c, KEYS, 60_000_000).collect()}
    # (t - 60, t]: at 60 the span starts after 0, so growth counts from the sample at 30.
    assert got[("a", 60)] == pytest.approx((10.0, 10 / 30))
    assert got[("a", 90)] == pytest.approx((30.0, 1.0))
    assert got[("a", 30)] == pytest.approx((60.0, 2.0))
    assert got[("b", 0)] == (0.0, None)


def test_down_for_a_minute(spark):
    up = frame(spark, [("short", s, 0 if 30 <= s <= 60 else 1) for s in range(0, 200, 15)] + [("long", s, 0 if 30 <= s <= 120 else 1) for s in range(0, 200, 15)])
    got = series.held(up, KEYS, F.col("value") == 0, 60_000_000, width=45_000_000).collect()
    assert [(r.task, r.samples, r.fires_at.second + 60 * r.fires_at.minute) for r in got] == [("long", 7, 90)]


@pytest.mark.parametrize("minutes,alerts", [(9, 0), (11, 1)])
def test_busy_average_must_hold_ten_minutes(spark, minutes, alerts):
    span = 600_000_000
    busy = frame(spark, [("t", s, 900 if 600 <= s < 1200 + minutes * 60 else 900 if s < 600 else 0) for s in range(0, 2400, 30)])
    average = series.trailing_average(busy, KEYS, 60_000_000)
    steady = average.where("us >= 1200 * 1000000")
    held = series.held(steady, KEYS, F.col("average") > 800, span).count()
    assert held == alerts


def test_trailing_average_excludes_now(spark):
    g = frame(spark, [("t", 0, 1), ("t", 10, 3), ("t", 20, 100)])
    got = series.trailing_average(g, KEYS, 60_000_000, include_current=False).orderBy("us").collect()
    assert [r.average for r in got] == [None, 1.0, 2.0]


def test_series_reads_labels(spark):
    df = spark.sql("select 'up' metric, map('instance', 'x') labels, timestamp'2026-01-01' ts, 1.0D value")
    assert series.series(df, "up", "instance").first().instance == "x"
    assert series.latest_value(series.series(df, "up", "instance"), ["instance"]).first().value == 1.0


@pytest.mark.parametrize("width", [1, 50, 10_000])
def test_counter_totals_do_not_depend_on_the_chunk_width(spark, width):
    rnd = random.Random(width)
    rows, value = [], 0
    for s in range(300):
        value = 0 if rnd.random() < 0.05 else value + rnd.randrange(5)
        rows.append(("ab"[s % 2], s, value))
    got = series.counter_totals(frame(spark, rows), KEYS, width * 1_000_000)
    want, last = {}, {}
    for t, s, v in rows:
        prev, total = last.get(t, (v, 0))
        total += v if v < prev else v - prev
        last[t] = (v, total)
        want[(t, s)] = total
    assert {(r.task, r.us // 1_000_000): int(r.total) for r in got.collect()} == want
