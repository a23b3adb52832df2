import pytest
from pyspark.sql import functions as F

from tidemark import schemas
from tidemark.operators import enrich, layout, search
from tidemark.operators.quality import content_digest, duplicate_keys, gate, quality_counts, quarantine, sequence_gaps
from tidemark.operators.scan import Running, running
from tidemark.operators.versions import latest_by, without_deleted
from tidemark.session import new_folder, shared_root
from tidemark.sources import fixtures, readers, sinks, tables

AUGUST = ("2026-08-01", "2026-09-01")


@pytest.fixture(scope="module")
def layouts(spark):
    rows = fixtures.workload_rows(spark.range(10_000))
    paths = {}
    for name, sort in (("user", layout.USER_FIRST), ("symbol", layout.SYMBOL_FIRST)):
        paths[name] = new_folder(spark, f"test-{name}")
        layout.write_layout(rows, paths[name], sort, files=4)
    return paths


@pytest.mark.parametrize("kind", ["user", "symbol"])
def test_four_searches(spark, layouts, kind):
    df = spark.read.parquet(layouts[kind])
    found = (
        search.user_range(df, 42, *AUGUST),
        search.order_lookup(df, 4243),
        search.symbol_range(df, "BTC", *AUGUST),
        search.date_range(df, *AUGUST),
    )
    assert [search.counted(f).first().rows for f in found] == [10, 1, 2500, 10_000]


def test_searches_prune_and_push_down(spark, layouts):
    df = spark.read.parquet(layouts["user"])
    query = search.counted(search.user_range(df, 42, "2026-07-01", "2026-08-01"))
    plan = query._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(event_month" in plan and "EqualTo(user_id,42)" in plan
    assert layout.scan_metrics(query) in ([], [{"rows": 0, "files": 0, "bytes": 0}])
    hit = layout.scan_metrics(search.counted(search.order_lookup(df, 4243)))
    assert hit[0]["rows"] < 10_000
    absent = layout.scan_metrics(search.counted(search.order_lookup(df, 10_000_000)))
    assert absent[0]["rows"] == 0


def test_skew(spark):
    rows = fixtures.case_rows(spark.range(10_000), "skew", "2026-08-05", "2026-08-05", fixtures.hot_user(8000))
    for counts in (search.key_counts(rows, "user_id"), layout.salted_counts(rows, "user_id")):
        got = {r.user_id: r.rows for r in counts.where("user_id in (0, 999)").collect()}
        assert got == {0: 8002, 999: 2}


def test_late_and_versions(spark, money):
    late = fixtures.case_rows(spark.range(1), "late", "2026-08-01", "2026-08-03")
    assert late.where("event_time < ingested_at").count() == 1
    v1 = fixtures.case_rows(spark.range(1), "order", "2026-08-01", "2026-08-02").withColumn("amount", F.lit(money("10.00")))
    v2 = v1.withColumns({"version": F.lit(2), "amount": F.lit(money("12.00"))})
    raw = v1.unionByName(v2)
    latest = latest_by(raw, ["event_id"], ["version"]).collect()
    assert raw.count() == 2 and [str(r.amount) for r in latest] == ["12.00"]
    deleted = raw.withColumn("gone", F.col("version") == 2)
    assert without_deleted(deleted, ["event_id"], ["version"], "gone").count() == 0


def test_backfill_and_reset(spark):
    path = new_folder(spark, "test-backfill")
    sinks.append_typed(fixtures.case_rows(spark.range(2_000), "live", "2026-08-20", "2026-08-20"), path, schemas.CASE_EVENT)
    sinks.append_typed(fixtures.case_rows(spark.range(25_000), "backfill", "2026-08-01", "2026-08-21"), path, schemas.CASE_EVENT)
    assert spark.read.parquet(path).count() == 27_000
    sinks.reset_table(spark, path, schemas.CASE_EVENT)
    assert spark.read.schema(schemas.CASE_EVENT).parquet(path).count() == 0


def test_append_contract_and_replay(spark):
    path = new_folder(spark, "test-append")
    rows = sinks.sink_rows(spark.range(5))
    sinks.append_typed(rows, path, schemas.SINK_EVENT)
    stored = spark.read.parquet(path)
    assert stored.columns == ["event_id", "occurred_at", "customer_id", "symbol", "amount"]
    assert [(r.event_id, r.customer_id, r.symbol, str(r.amount)) for r in stored.orderBy("event_id").collect()][:2] == [
        ("event-0", "customer-a", "BTC", "0.01"),
        ("event-1", "customer-b", "ETH", "0.02"),
    ]
    sinks.append_typed(rows, path, schemas.SINK_EVENT)
    again = spark.read.parquet(path)
    assert again.count() == 10 and duplicate_keys(again, "event_id").first().duplicates == 5


def test_export_is_ordered_and_stable(spark):
    path = new_folder(spark, "test-store")
    sinks.append_typed(fixtures.case_rows(spark.range(10_000), "export", "2026-08-01", "2026-08-01"), path, schemas.CASE_EVENT)
    sinks.append_typed(fixtures.case_rows(spark.range(100), "future", "2026-08-03", "2026-08-03"), path, schemas.CASE_EVENT)
    columns, texts = ["event_id", "event_time", "amount"], []
    for _ in range(2):
        out = new_folder(spark, "test-csv")
        cutoff = F.col("event_time") < F.lit("2026-08-02").cast("timestamp")
        sinks.export_csv(spark.read.parquet(path), out, columns, cutoff, ["event_id"], files=3)
        parts = sorted(r.path for r in spark.read.format("binaryFile").load(f"{out}/*.csv").select("path").collect())
        lines = [r.value for p in parts for r in spark.read.text(p).collect() if not r.value.startswith("event_id,")]
        assert lines == sorted(lines, key=lambda line: line.split(",")[0]) and len(lines) == 10_000
        texts.append(lines)
        digest = content_digest(readers.typed_csv(spark, out, spark.read.parquet(path).select(*columns).schema), columns, F.lit(0))
        texts.append(tuple(digest.first()))
        sinks.append_typed(fixtures.case_rows(spark.range(100), "post", "2026-08-03", "2026-08-04"), path, schemas.CASE_EVENT)
    assert texts[0] == texts[2] and texts[1] == texts[3]


def test_gate_and_gaps(spark):
    df = spark.createDataFrame([(1, "a", 1), (2, "a", 1), (3, None, 5), (4, "b", 7)], "arrival bigint, k string, sequence bigint")
    gated = gate(df, {"no key": F.col("k").isNull()}, duplicates_of=["k", "sequence"], order="arrival")
    assert {r.arrival: r.reasons for r in quarantine(gated).collect()} == {2: ["duplicate"], 3: ["no key"]}
    assert {r.reason: r.rows for r in quality_counts(gated).collect()} == {"valid": 2, "duplicate": 1, "no key": 1}
    gaps = sequence_gaps(df.withColumn("source_partition", F.lit(0)), width=2)
    assert sorted((r.gap_start, r.gap_end, r.missing) for r in gaps.collect()) == [(2, 4, 3), (6, 6, 1)]


def test_broadcast_only_when_small(spark):
    dim = spark.range(50).withColumnRenamed("id", "k")
    facts = spark.range(100).select((F.col("id") % 60).alias("k"))
    for limit in (50, 49):
        joined = enrich.enrich(facts, dim, ["k"], "inner", max_rows=limit)
        hinted = "ResolvedHint" in joined._jdf.queryExecution().analyzed().toString() or "strategy=broadcast" in joined._jdf.queryExecution().analyzed().toString()
        assert joined.count() == 90 and hinted == (limit == 50)


def test_shared_root_refuses_a_local_folder_on_a_cluster(spark, monkeypatch):
    assert shared_root(spark) == spark.conf.get("spark.checkpoint.dir")

    class Conf:
        def get(self, *_):
            return None

    class Context:
        master = "spark://somewhere:7077"

    class Cluster:
        conf, sparkContext = Conf(), Context()

    with pytest.raises(RuntimeError):
        shared_root(Cluster())


def test_given_tables_prune_columns_and_push_time_and_user_filters(spark):
    found = search.counted(search.user_range(tables.workload(spark, "/root/testdata/sf0.001"), 42, "1997-01-01", "1998-01-01"))
    scan = next(l for l in found._jdf.queryExecution().executedPlan().toString().splitlines() if "FileScan" in l)
    pushed = scan.split("PushedFilters: ")[1]
    assert "IsNotNull(l_suppkey), IsNotNull(l_shipdate), EqualTo(l_suppkey,42), Greater" in pushed
    assert scan.rstrip().endswith("ReadSchema: struct<l_suppkey:bigint,l_shipdate:timestamp>")


def test_a_hot_key_is_spread_over_tasks(spark):
    rows = spark.range(3000).select(F.col("id").alias("pos"), F.when(F.col("id") % 3 > 0, "hot").otherwise("cold").alias("k"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        out = running(rows, ["k"], "pos", [Running("n", "sum", F.lit(1))], 100)
        per_task = out.where("k = 'hot'").groupBy(F.spark_partition_id()).agg(F.count("n").alias("rows"), F.max("n")).collect()
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
        spark.conf.set("spark.sql.shuffle.partitions", "2")
    assert len(per_task) >= 6 and max(r.rows for r in per_task) < 1000
    assert out.where("k = 'hot'").agg(F.max("n")).first()[0] == 2000


def test_searches_read_the_pages_of_their_key(spark):
    """Short pages in sort order: the layout that a search is made for reads a small part of the year it asks for."""
    from tidemark.operators import layout, search
    from tidemark.plans.facts import four_searches, stored

    read = {}
    for kind in ("user", "symbol"):
        table = spark.read.parquet(stored(spark, "/root/testdata/sf0.1", kind))
        read[kind] = {n: layout.scan_metrics(search.counted(f))[0]["rows"] for n, f in four_searches(table).items()}
    whole = read["user"]["date_range"]
    assert read["user"]["user_range"] < whole / 10 and read["symbol"]["symbol_range"] < whole / 3
    assert read["user"]["order"] < 0.1 * spark.read.parquet("/root/testdata/sf0.1/lineitem.parquet").count()
