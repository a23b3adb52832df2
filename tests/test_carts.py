import pytest
from pyspark.sql import functions as F

from tidemark.operators.carts import cart_snapshots, carts_left
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming.carts import CartStream

SCHEMA = "arrival bigint, customer_id string, amount decimal(19,2), probe boolean, t_ms bigint"


def activity(spark, money, steps):
    rows = [(i, c, money(a) if a is not None else None, a is None, t) for i, (c, a, t) in enumerate(steps, 1)]
    return spark.createDataFrame(rows, SCHEMA)


def seen(df):
    return [(f"{r.total:.2f}", r["count"], r.fresh) for r in df.orderBy("arrival").collect()]


CASES = {
    "kept open": ((9000, {}), [("z", "2.20", 0), ("z", "7.05", 3100), ("z", "1.00", 8200)], [("2.20", 1, True), ("9.25", 2, False), ("10.25", 3, False)]),
    "lapsed": ((70, {}), [("z", "6", 5), ("z", "1.5", 90), ("z", "1", 120)], [("6.00", 1, True), ("1.50", 1, True), ("2.50", 2, False)]),
    "lapses at the limit": ((70, {}), [("z", "6", 5), ("z", "2", 75), ("z", "4", 144)], [("6.00", 1, True), ("2.00", 1, True), ("6.00", 2, False)]),
    "reads leave the clock alone": (
        (240, {}),
        [("z", "8", 0), ("z", None, 239), ("z", None, 240), ("z", "1", 250)],
        [("8.00", 1, True), ("8.00", 1, False), ("0.00", 0, True), ("1.00", 1, True)],
    ),
    "reads wind the clock": (
        (240, {"refresh": "read_write"}),
        [("z", "8", 0), ("z", None, 239), ("z", None, 400), ("z", "1", 600)],
        [("8.00", 1, True), ("8.00", 1, False), ("8.00", 1, False), ("9.00", 2, False)],
    ),
    "read before any write": ((60, {}), [("z", None, 3), ("z", None, 9), ("z", "5.5", 11)], [("0.00", 0, True), ("0.00", 0, True), ("5.50", 1, True)]),
    "customers apart": (
        (100, {}),
        [("y", "3", 0), ("z", "9", 60), ("y", "2", 110), ("z", "1", 130), ("y", None, 209)],
        [("3.00", 1, True), ("9.00", 1, True), ("2.00", 1, True), ("10.00", 2, False), ("2.00", 1, False)],
    ),
    "lapsed but shown": ((70, {"stale_visible": True}), [("z", "6", 5), ("z", "1.5", 190)], [("6.00", 1, True), ("7.50", 2, False)]),
}


@pytest.mark.parametrize("width", [1, 2, 1000])
@pytest.mark.parametrize("case", CASES)
def test_cases(spark, money, case, width):
    (ttl, how), steps, want = CASES[case]
    assert seen(cart_snapshots(activity(spark, money, steps), ttl, width=width, **how)) == want


@pytest.mark.parametrize("refresh", ["write", "read_write"])
@pytest.mark.parametrize("cut", [1, 2])
def test_a_seeded_run_continues_the_first(spark, money, refresh, cut):
    steps = [("a", "10", 0), ("a", None, 100), ("a", "3", 450), ("b", "1", 460), ("a", "2", 500), ("a", None, 900)]
    whole = activity(spark, money, steps)
    want = seen(cart_snapshots(whole, 400, refresh))
    first = cart_snapshots(whole.where(F.col("arrival") <= cut), 400, refresh)
    second = cart_snapshots(whole.where(F.col("arrival") > cut), 400, refresh, seeds=carts_left(first))
    assert seen(first.unionByName(second)) == want


def test_stream_of_batches_equals_one_batch_and_replay_changes_nothing(spark):
    whole = tables.cart_activity(spark, "/root/testdata/sf0.001")
    ttl = 24 * 3_600_000
    want = seen(cart_snapshots(whole, ttl))
    job = CartStream(new_folder(spark, "carts"), ttl)
    for batch in (0, 1, 1, 2):
        job.process(whole.where(F.col("arrival") % 1000 >= batch * 333).where(
            (F.col("arrival") < (batch + 1) * 333) | F.lit(batch == 2)), batch)
    assert seen(job.snapshots.view(spark)) == want
