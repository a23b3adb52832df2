import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.functions import WHITESPACE, is_blank, strip
from tidemark.operators.purchases import (
    current_spend,
    normalize_purchase,
    require_fields,
    running_spend,
    valid_purchase,
)
from tidemark.settings import JobSettings
from tidemark.sources import wire


@pytest.fixture
def purchases(spark, at, money):
    day = "2026-03-17"
    rows = [
        (1, "mira", "Kettle", money("31.40"), at("09:05:00", day)),
        (2, "mira", " ", money("4.00"), at("09:07:00", day)),
        (3, "Odo ", "Lamp", money("7.15"), at("09:11:00", day)),
        (4, " MIRA", "Chair", money("58.35"), at("09:19:00", day)),
        (5, "odo", "Refund", money("-3.00"), at("09:23:00", day)),
    ]
    return spark.createDataFrame(
        rows, "arrival bigint, customer_id string, product string, amount decimal(19,2), occurred_at timestamp"
    )


def test_running_spend_emits_one_row_per_input(purchases):
    out = running_spend(normalize_purchase(valid_purchase(purchases))).orderBy("arrival").collect()
    assert [(r.customer_id, r["product"], str(r.amount), r.occurred_at.minute) for r in out] == [
        ("mira", "Kettle", "31.40", 5),
        ("odo", "Lamp", "7.15", 11),
        ("mira", "running-total", "89.75", 19),
    ]


def test_current_spend_takes_the_last_arrival_time(purchases, at):
    spend = {r.customer_id: r for r in current_spend(normalize_purchase(valid_purchase(purchases))).collect()}
    assert str(spend["mira"].amount) == "89.75" and spend["mira"].updated_at.minute == 19


def test_blank_and_unpaid_are_rejected(spark, money):
    rows = [(" ", "p", money("1")), ("c", " \t", money("1")), ("c", "p", money("0")), ("c", "p", money("-1")), ("c", "p", money("1"))]
    df = spark.createDataFrame(rows, "customer_id string, product string, amount decimal(19,2)")
    assert valid_purchase(df).count() == 1


def test_strip_follows_the_jvm(spark):
    nbsp = " "
    df = spark.createDataFrame([(WHITESPACE + nbsp + " Alice " + WHITESPACE,)], "s string")
    assert df.select(strip(F.col("s"))).first()[0] == nbsp + " Alice"
    blanks = spark.createDataFrame([(WHITESPACE,), (nbsp,), ("",)], "s string")
    assert [r[0] for r in blanks.select(is_blank(F.col("s"))).collect()] == [True, False, True]
    every = spark.range(0x3100).select(F.char("id").alias("c"), "id")
    jvm = spark.range(1, 0x3100).select(
        F.decode(F.expr("unhex(lpad(hex(id), 8, '0'))"), "utf-32").alias("c"), "id"
    ).where("id < 55296 and regexp_like(c, '^\\\\p{javaWhitespace}$')")
    assert {chr(r.id) for r in jvm.collect()} == set(WHITESPACE)
    assert every.count() == 0x3100


def test_required_fields(spark):
    df = spark.createDataFrame([("a", 1), (None, 2)], "customer_id string, fee int")
    assert require_fields(df.limit(1), "customer_id").count() == 1
    with pytest.raises(PySparkException):
        require_fields(df, "customer_id").collect()


def test_order_partition_comes_from_the_record(spark, at):
    body = b'{"customerId":"shop-208","sequence":61,"fee":"3.75","occurredAt":"2026-02-11T08:41:27Z","partition":9}'
    record = spark.createDataFrame([(b"k", body, "sales", 4, 1730, at("08:41:30", "2026-02-11"))], schemas.RECORD)
    row = wire.decode_orders(record, keep=("offset",)).first()
    assert (row.source_partition, row.offset, row.customer_id, row.sequence, str(row.fee)) == (4, 1730, "shop-208", 61, "3.75")
    assert row.occurred_at.second == 27


def test_strict_decoding_fails_and_lenient_keeps_the_bad_row(spark, at):
    bodies = [b'{"customerId":"a","fee":1.5,"sequence":1,"occurredAt":"2026-07-30T12:00:10Z"}', b"not json"]
    records = spark.createDataFrame([(b"k", b, "t", 0, i, at("12:00:00")) for i, b in enumerate(bodies)], schemas.RECORD)
    with pytest.raises(Exception, match="(?i)malformed"):
        wire.decode_orders(records).collect()
    bad = wire.decode_orders(records, strict=False).where(wire.incomplete("corrupt", "customer_id", "fee", "sequence"))
    assert [r.corrupt for r in bad.collect()] == ["not json"]


def test_settings_come_from_the_environment():
    given = JobSettings.from_environment({"TIDEMARK_KAFKA_BOOTSTRAP": "broker:19092", "TIDEMARK_KAFKA_TOPIC": "orders", "TIDEMARK_JDBC_URL": "jdbc:mysql://db/x"})
    assert (given.bootstrap_servers, given.topic, given.jdbc_url) == ("broker:19092", "orders", "jdbc:mysql://db/x")
    assert JobSettings.from_environment({}).bootstrap_servers == "kafka:9092"
