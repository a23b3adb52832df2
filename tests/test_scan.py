"""Chunked running values equal plain windows, whatever the chunk width."""

import random

import pytest
from pyspark.sql import functions as F

from tidemark.operators.behaviour import partners_before
from tidemark.operators.quantiles import exact_percentiles
from tidemark.operators import scan
from tidemark.operators.scan import Running, chunk_width, running, trailing


def rows(seed, n=400, hot=0.4):
    rnd = random.Random(seed)
    out = []
    for i in range(n):
        key = "hot" if rnd.random() < hot else f"k{rnd.randrange(8)}"
        out.append((key, rnd.randrange(-300, 900), i, rnd.randrange(100), rnd.choice([None, rnd.randrange(50)])))
    return out


@pytest.fixture(params=[1, 2])
def frame(spark, request):
    return spark.createDataFrame(rows(request.param), "key string, pos bigint, id bigint, v int, maybe int")


@pytest.mark.parametrize("width", [1, 7, 100, 10_000])
def test_running_matches_a_plain_window(spark, frame, width):
    got = running(
        frame,
        ["key"],
        "pos",
        [
            Running("total", "sum", F.col("v").cast("decimal(19,2)")),
            Running("prev", "last", F.col("maybe"), -1),
            Running("most", "max", F.col("maybe")),
            Running("least", "min", F.col("v"), -1),
        ],
        width,
        ties=["id"],
    )
    frame.createOrReplaceTempView("t")
    over = "over (partition by key order by pos, id rows between unbounded preceding and"
    want = spark.sql(
        f"""select id, sum(v) {over} current row) total2, last(maybe, true) {over} 1 preceding) prev2,
        max(maybe) {over} current row) most2, min(v) {over} 1 preceding) least2 from t"""
    )
    joined = got.join(want, "id")
    assert joined.count() == frame.count()
    assert joined.where(
        "not (total <=> total2 and prev <=> prev2 and most <=> most2 and least <=> least2)"
    ).count() == 0


def test_running_without_keys_and_with_peers(spark, frame):
    got = running(frame, [], "pos", [Running("before", "sum", F.col("v"), -1)], 50, peers=True)
    frame.createOrReplaceTempView("t")
    want = spark.sql("select id, sum(v) over (order by pos range between unbounded preceding and 1 preceding) b from t")
    assert got.join(want, "id").where("not (before <=> b)").count() == 0


@pytest.mark.parametrize("include", [True, False])
def test_trailing_matches_a_range_frame(spark, frame, include):
    got = trailing(frame, ["key"], "pos", 60, {"s": F.col("v"), "n": F.lit(1)}, width=100, include_current=include)
    frame.createOrReplaceTempView("t")
    bounds = "59 preceding and current row" if include else "60 preceding and 1 preceding"
    want = spark.sql(
        f"select id, coalesce(sum(v) over w, 0) s2, count(1) over w n2 from t window w as (partition by key order by pos range between {bounds})"
    )
    joined = got.join(want, "id")
    assert joined.count() == frame.count()
    assert joined.where("s <> s2 or n <> n2").count() == 0


@pytest.mark.parametrize("accuracy", [20, 100_000])
def test_percentiles_are_exact_even_with_a_coarse_sketch(spark, frame, accuracy):
    points = {"p0": 0.0, "p10": 0.1, "p50": 0.5, "p99": 0.99, "p100": 1.0}
    got = exact_percentiles(frame, ["key"], "v", points, accuracy=accuracy)
    frame.createOrReplaceTempView("t")
    want = spark.sql(f"select key, percentile(v, array({','.join(map(str, points.values()))})) q from t group by key")
    for row in got.join(want, "key").collect():
        assert [row[p] for p in points] == pytest.approx(row.q)


def test_upper_median(spark):
    values = spark.createDataFrame([(float(v),) for v in (5, 1, 4, 2)], "v double")
    assert exact_percentiles(values, [], "v", {"m": 0.5}, method="upper").first().m == 4.0


def test_partners_before_matches_brute_force(spark):
    rnd = random.Random(5)
    seen = [(rnd.choice("ab"), rnd.randrange(6), rnd.randrange(200)) for _ in range(150)]
    df = spark.createDataFrame(seen, "k string, p int, s int").withColumn("ts", F.timestamp_seconds("s"))
    got = {(r.k, r.s): r.partners_before for r in partners_before(df, "k", "p", "ts", 20_000_000)
           .withColumn("s", F.unix_seconds("ts")).collect()}
    want = {(k, s): len({q for (j, q, t) in seen if j == k and s - 20 <= t < s}) for (k, _, s) in seen}
    assert got == want


def test_no_step_of_a_running_value_gathers_a_key(spark, frame):
    """The rows are shuffled by (key, chunk); only totals are shuffled by key."""
    got = running(frame, ["key"], "pos", [Running("total", "sum", F.col("v"))], 100, ties=["id"])
    plan = got._jdf.queryExecution().executedPlan().toString()
    by_rows = [l for l in plan.splitlines() if "Exchange hashpartitioning" in l]
    assert sum("_chunk" in l for l in by_rows) == 2 and len(by_rows) == 3


def test_chunk_width_follows_the_densest_slice(spark):
    even = spark.range(1000).withColumnRenamed("id", "pos")
    assert chunk_width(even, "pos", slice_width=10, rows=1000) is None
    assert chunk_width(even, "pos", slice_width=10, rows=100) == 100
    assert chunk_width(even, "pos", slice_width=100, rows=10) == 10
    dense = even.unionAll(spark.range(500).select(F.lit(5).cast("bigint").alias("pos")))
    assert chunk_width(dense, "pos", slice_width=10, rows=51) == 1


@pytest.mark.parametrize("rows", [20, 100])
def test_only_hot_keys_are_cut_and_nothing_changes(spark, frame, rows, monkeypatch):
    monkeypatch.setattr(scan, "ROWS_PER_CHUNK", rows)
    with_null = frame.withColumn("key", F.when(F.col("key") != "k1", F.col("key")))
    plan = scan.plan_chunks(with_null, ["key"], "pos", slice_width=50)
    assert plan.hot.count() == (9 if rows == 20 else 1) and plan.hot.where("_hot_key = 'hot'").count() == 1
    values = [Running("total", "sum", F.col("v")), Running("prev", "last", F.col("maybe"), -1)]
    want = running(with_null, ["key"], "pos", values, None, ties=["id"])
    got = running(with_null, ["key"], "pos", values, plan, ties=["id"])
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))
    near = trailing(with_null, ["key"], "pos", 60, {"s": F.col("v")}, width=plan)
    assert sorted(map(str, near.collect())) == sorted(map(str, trailing(with_null, ["key"], "pos", 60, {"s": F.col("v")}, width=None).collect()))
