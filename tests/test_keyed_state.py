"""Keyed state on streams: running rows, expiring carts with timers, and what a batch reads."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators.carts import cart_snapshots
from tidemark.session import new_folder
from tidemark.sources import readers, wire
from tidemark.streaming.processors import cart_state, cart_stream, state_store
from tidemark.streaming.purchases import SpendStream

ACTIVITY = "arrival bigint, customer_id string, amount decimal(19,2), probe boolean, t_ms bigint"


def batches(spark, money, steps):
    """Each list of (customer, amount or null, time) lands as one file."""
    root, n = new_folder(spark, "activity"), 0
    frames = []
    for some in steps:
        rows = [(n + i, c, money(a) if a is not None else None, a is None, t) for i, (c, a, t) in enumerate(some)]
        n += len(rows)
        frames.append(spark.createDataFrame(rows, ACTIVITY))
        frames[-1].coalesce(1).write.mode("append").parquet(f"{root}/landing")
    whole = frames[0]
    for more in frames[1:]:
        whole = whole.unionByName(more)
    return root, whole


def run_carts(spark, root, ttl, refresh):
    with state_store(spark):
        stream = readers.table_stream(spark, f"{root}/landing", spark.createDataFrame([], ACTIVITY).schema, max_files=1)
        out = cart_stream(stream, ttl, refresh, "10 milliseconds")
        query = out.writeStream.format("parquet").option("path", f"{root}/out-{refresh}").option("checkpointLocation", f"{root}/ck-{refresh}")
        query.outputMode("append").trigger(availableNow=True).start().awaitTermination()
        held = {r.customer_id: (str(r.total), r["count"], r.touched_ms) for r in cart_state(spark, f"{root}/ck-{refresh}").collect()}
    return spark.read.parquet(f"{root}/out-{refresh}"), held


def shown(df):
    return [(r.arrival, r.customer_id, str(r.total), r["count"], r.fresh) for r in df.orderBy("arrival").collect()]


@pytest.mark.parametrize("refresh", ["write", "read_write"])
def test_carts_expire_by_timer_and_equal_the_batch(spark, money, refresh):
    steps = [
        [("a", "10", 1000), ("b", "2", 1000), ("a", None, 1300)],
        [("a", "5", 1350), ("b", None, 1390), ("c", None, 1391)],
        [("a", None, 1600), ("c", "7", 1700), ("b", "1", 1701)],
        [("d", "3", 90_000)],  # long after every other cart's life
    ]
    root, whole = batches(spark, money, steps)
    out, held = run_carts(spark, root, 400, refresh)
    assert shown(out) == shown(cart_snapshots(whole, 400, refresh))
    # Timers have dropped a, b and c; only the cart whose life is not over is still in the store.
    assert held == {"d": ("3.00", 1, 90_000)}


def test_a_touch_moves_the_timer(spark, money):
    """The first timer would be due in the third batch; the write in the second has replaced it."""
    steps = [[("a", "1", 1000)], [("a", "1", 1300), ("z", "1", 1300)], [("z", "1", 1500)], [("a", "1", 1650)]]
    root, whole = batches(spark, money, steps)
    out, held = run_carts(spark, root, 400, "write")
    assert shown(out) == shown(cart_snapshots(whole, 400)) and shown(out)[-1][2:] == ("3.00", 3, False)
    assert set(held) == {"a", "z"}


def test_unknown_refresh(spark):
    with pytest.raises(ValueError, match="unknown refresh"):
        cart_stream(spark.createDataFrame([], ACTIVITY), 1, "sometimes")


def bytes_read(spark):
    stages = spark.sparkContext._jsc.sc().statusStore().stageList(None, False, False, spark.sparkContext._gateway.new_array(spark._jvm.double, 0), None)
    return sum(stages.apply(i).inputBytes() for i in range(stages.size()))


def test_bytes_read_per_batch_do_not_grow(spark, money, at):
    """Thirty batches over the same customers: a batch reads its own records and, now and then, folds a bounded part."""
    root = new_folder(spark, "thirty")
    schema = "arrival bigint, customer_id string, product string, amount decimal(19,2), occurred_at timestamp"
    for batch in range(30):
        rows = [(batch * 50 + i, f"c{i}", "p", money("1.00"), at("12:00:00")) for i in range(50)]
        wire.encode_purchases(spark.createDataFrame(rows, schema)).coalesce(1).write.mode("append").parquet(f"{root}/landing")
    job, read = SpendStream(root, buckets=2), []
    real = job.spend.write

    def counted(batch, batch_id):
        start = bytes_read(spark)
        real(batch, batch_id)
        read.append(bytes_read(spark) - start)

    object.__setattr__(job.spend, "write", counted)
    job.start(readers.record_stream(spark, f"{root}/landing", max_files=1), f"{root}/checkpoint", available_now=True).awaitTermination()
    assert len(read) == 30 and sum(read[20:30]) <= 1.2 * sum(read[10:20])
    assert {str(r.amount) for r in job.customer_spend(spark).collect()} == {"30.00"}
    assert job.customer_spend(spark).agg(F.count("*")).first()[0] == 50
