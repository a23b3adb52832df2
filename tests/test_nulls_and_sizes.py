"""Results must not depend on the size of a table, nor lose groups whose key is null."""

from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import row_digest
from tidemark.operators.quality import gate
from tidemark.operators.quantiles import exact_percentiles
from tidemark.operators.scan import Running, running
from tidemark.operators.series import counter_totals
from tidemark.session import new_folder
from tidemark.sources.fixtures import zipf_key
from tidemark.sources.sinks import KeyedLog


def test_series_without_a_label_survive_cutting(spark):
    rows = [("up", None if i % 2 else "a", i * 10, Decimal(i % 7)) for i in range(20)]
    df = spark.createDataFrame(rows, "metric string, task string, us bigint, value decimal(18,6)")
    plain, cut = (sorted(map(str, counter_totals(df, ["metric", "task"], w).collect())) for w in (None, 30))
    assert plain == cut and len(cut) == 20


def test_sums_have_one_type_and_room(spark):
    df = spark.createDataFrame([(1, i, Decimal(10) ** 29) for i in range(4)], "k int, at bigint, v decimal(38,2)")
    small = spark.createDataFrame([(1, i, Decimal(i)) for i in range(9)], "k int, at bigint, v decimal(19,2)")
    for frame in (df, small):
        plain, cut = (running(frame, ["k"], "at", [Running("total", "sum", F.col("v"))], w) for w in (None, 2))
        assert plain.schema["total"].dataType == cut.schema["total"].dataType
        assert [r.total for r in plain.orderBy("at").collect()] == [r.total for r in cut.orderBy("at").collect()]


def test_null_and_empty_groups_keep_their_percentiles(spark):
    df = spark.createDataFrame([(None, 1.0), (None, 3.0), ("a", 2.0), ("b", None)], "k string, v double")
    got = {r.k: (r.n, r.p50) for r in exact_percentiles(df, ["k"], "v", {"p50": 0.5}).collect()}
    assert got == {None: (2, 2.0), "a": (1, 2.0), "b": (0, None)}


def test_a_replay_after_compaction_keeps_all_rows(spark):
    schema = spark.createDataFrame([], "k string, v int").schema
    log = KeyedLog(new_folder(spark, "log"), schema, ["k"])
    log.write(spark.createDataFrame([("a", 1), ("b", 1)], schema), 0)
    last = spark.createDataFrame([("c", 2), ("a", 2)], schema)
    log.write(last, 1)
    folded = log.compact(spark, new_folder(spark, "folded"))
    folded.write(last, 1)
    again = folded.compact(spark, new_folder(spark, "folded"))
    for one in (folded, again):
        assert sorted((r.k, r.v) for r in one.view(spark).collect()) == [("a", 2), ("b", 1), ("c", 2)]


def test_zipf_reaches_many_keys(spark):
    ranks = zipf_key(spark.range(200_000), 1_000_000)
    assert ranks.select("rank").distinct().count() > 50_000 and ranks.agg(F.max("rank")).first()[0] <= 1_000_000


def test_digests_tell_nulls_and_separators_apart(spark):
    rows = [("a", None), (None, "a"), ("a|", ""), ("a", "|"), ("\\N", None), (None, "\\N"), ("", "a")]
    df = spark.createDataFrame(rows, "x string, y string")
    assert df.select(row_digest(F.col("x"), F.col("y"))).distinct().count() == len(rows)


def test_incomplete_keys_are_not_duplicates(spark):
    df = spark.createDataFrame([(1, None), (2, None), (3, "a"), (4, "a")], "at int, k string")
    got = {r.at: r.reasons for r in gate(df, {}, ["k"], "at").collect()}
    assert got == {1: [], 2: [], 3: [], 4: ["duplicate"]}
