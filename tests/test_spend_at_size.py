"""The purchase streams over stretches of several files, and groups of several customers."""

import datetime as dt

from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators.purchases import normalize_purchase, running_spend, valid_purchase
from tidemark.plans import streams
from tidemark.session import new_folder
from tidemark.sources import tables
from tidemark.streaming import processors
from tidemark.streaming.purchases import SpendStream

ORDERS = "o_orderkey bigint, o_custkey bigint, o_totalprice double, o_orderdate timestamp, o_orderpriority string"


def orders(spark, keys):
    day = dt.datetime(2026, 1, 1, tzinfo=dt.UTC)
    rows = [(k, k % 9, float(k % 50 + 1), day + dt.timedelta(minutes=i), f"{k % 5}-P") for i, k in enumerate(keys)]
    folder = new_folder(spark, "orders")
    spark.createDataFrame(rows, ORDERS).repartition(3).write.parquet(f"{folder}/orders.parquet")
    return folder


def test_streams_over_stretches_of_several_files(spark, monkeypatch):
    monkeypatch.setattr(streams, "LANDED_ROWS", 20)
    monkeypatch.setattr(processors, "CUSTOMER_GROUPS", 2)
    # Most arrivals lie in one stretch of the keys.
    sf = orders(spark, [*range(1, 400), *range(100_000, 100_010)])
    job, files = streams.spend_run(spark, sf)
    assert files > 1
    landed = spark.read.schema(schemas.RECORD).parquet(f"{job.root}/landing").select("offset", "_metadata.file_path", "_metadata.file_modification_time")
    by_file = landed.groupBy("file_path", "file_modification_time").agg(F.min("offset").alias("low"), F.max("offset").alias("high")).orderBy("file_modification_time").collect()
    assert len(by_file) == 6 * files and landed.count() == 409
    stretches = [by_file[i : i + files] for i in range(0, len(by_file), files)]
    for now, after in zip(stretches, stretches[1:], strict=False):
        assert max(f.high for f in now) < min(f.low for f in after)
    raw = normalize_purchase(valid_purchase(tables.purchases(spark, sf)))
    assert sorted(job.running(spark).collect()) == sorted(running_spend(raw).select(*job.running(spark).columns).collect())
    spent = {r.customer_id: r.amount for r in raw.groupBy("customer_id").agg(F.sum("amount").alias("amount")).collect()}
    assert {r.customer_id: r.amount for r in job.customer_spend(spark).collect()} == spent
    assert len(spent) > 2  # a group holds several customers


def test_few_purchases_land_in_six_files(spark):
    sf, landing = orders(spark, [5, 9]), new_folder(spark, "landing")
    assert streams.landed_in_sixths(spark, sf, landing) == 1
    assert sorted(r[0] for r in spark.read.schema(schemas.RECORD).parquet(landing).select("offset").collect()) == [5, 9]
    nothing, landing = orders(spark, []), new_folder(spark, "landing")
    assert streams.landed_in_sixths(spark, nothing, landing) == 1
    assert spark.read.schema(schemas.RECORD).parquet(landing).count() == 0


def test_a_payload_is_parsed_once(spark):
    rows = spark.createDataFrame([], schemas.RECORD)
    rows.write.parquet(folder := new_folder(spark, "records"))
    cleaned = SpendStream(folder).cleaned(spark.read.schema(schemas.RECORD).parquet(folder))
    assert cleaned._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1
