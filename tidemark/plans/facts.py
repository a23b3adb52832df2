"""Fact tables: layouts, skew, backfill, versions, retention."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import layout, search
from tidemark.operators.versions import latest_by, without_deleted
from tidemark.plans.inputs_sql import FACTS, WORKLOAD
from tidemark.plans.registry import query
from tidemark.plans.rows import YEAR
from tidemark.session import new_folder
from tidemark.sources import fixtures, tables
from tidemark.sources.tiered import TieredTable

_STORED: dict[tuple[str, str, str], str] = {}


def stored(spark, sf, kind: str) -> str:
    """Write a layout of the workload once per session and source."""
    at = (spark.sparkContext.applicationId, sf, kind)
    if at not in _STORED:
        path = new_folder(spark, f"layout-{kind}")
        rows = tables.workload(spark, sf)
        if kind == "user":
            layout.write_layout(rows, path, layout.USER_FIRST)
        elif kind == "symbol":
            layout.write_layout(rows, path, layout.SYMBOL_FIRST)
        else:
            layout.write_lookup(rows, path, "order_id", ["order_id", "user_id", "event_time"])
        _STORED[at] = path
    return _STORED[at]


_BY_MONTH = f"""WITH {WORKLOAD} SELECT CAST(strftime(event_time, '%Y%m') AS INTEGER) AS event_month, count(*) AS rows, CAST(sum(amount) AS DOUBLE) AS amount
  FROM workload GROUP BY 1"""


def _by_month(df):
    return df.groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"), F.sum("amount").alias("amount"))


@query("layout_user_first", _BY_MONTH)
def layout_user_first(spark, sf):
    return _by_month(spark.read.parquet(stored(spark, sf, "user")))


@query("layout_symbol_first", _BY_MONTH)
def layout_symbol_first(spark, sf):
    return _by_month(spark.read.parquet(stored(spark, sf, "symbol")))


def four_searches(df) -> dict[str, object]:
    return {
        "user_range": search.user_range(df, 42, *YEAR),
        "order": search.order_lookup(df, 4243),
        "symbol_range": search.symbol_range(df, "BTC", *YEAR),
        "date_range": search.date_range(df, *YEAR),
    }


@query("layout_compare", f"""WITH {WORKLOAD}, y AS (SELECT * FROM workload WHERE event_time >= TIMESTAMP '1997-01-01' AND event_time < TIMESTAMP '1998-01-01'),
  r AS (SELECT 'user_range' AS search, count(*) AS rows FROM y WHERE user_id = 42
    UNION ALL SELECT 'order', count(*) FROM workload WHERE order_id = 4243
    UNION ALL SELECT 'symbol_range', count(*) FROM y WHERE symbol = 'BTC'
    UNION ALL SELECT 'date_range', count(*) FROM y)
  SELECT l AS layout, search, rows FROM r, (SELECT unnest(['user', 'symbol']) AS l)""")
def layout_compare(spark, sf):
    """The four searches give the same counts under both sort orders."""
    parts = []
    for kind in ("user", "symbol"):
        for name, found in four_searches(spark.read.parquet(stored(spark, sf, kind))).items():
            parts.append(search.counted(found).select(F.lit(kind).alias("layout"), F.lit(name).alias("search"), "rows"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


@query("lookup_table", f"WITH {WORKLOAD} SELECT order_id, user_id, event_time FROM workload WHERE order_id = 4243")
def lookup_table(spark, sf):
    return search.order_lookup(spark.read.parquet(stored(spark, sf, "lookup")), 4243)


@query("skew_case", """WITH n AS (SELECT count(*) * 8 // 10 AS hot FROM events),
  k AS (SELECT CASE WHEN event_id < hot THEN 0 ELSE event_id % 1000 END AS user_id FROM events, n)
  SELECT user_id, count(*) AS rows FROM k GROUP BY 1""")
def skew_case(spark, sf):
    """Four fifths of the rows on one user, counted in two stages."""
    ids = tables.events(spark, sf).select(F.col("event_id").alias("id"))
    hot = ids.agg(F.expr("count(1) * 8 div 10")).scalar()
    rows = ids.select("id", F.when(F.col("id") < hot, F.lit(0)).otherwise(F.col("id") % 1000).alias("user_id"))
    return layout.salted_counts(rows, "user_id")


@query("backfill_case", f"""WITH {WORKLOAD} SELECT CAST(strftime(event_time, '%Y%m') AS INTEGER) AS event_month, count(*) AS rows
  FROM workload GROUP BY 1""")
def backfill_case(spark, sf):
    """Live months first, then the history appended into older month folders."""
    path = new_folder(spark, "backfill")
    rows = tables.workload(spark, sf)
    live = F.col("event_time") >= F.lit("2000-01-01").cast("timestamp")
    layout.write_layout(rows.where(live), path, layout.USER_FIRST)
    layout.write_layout(rows.where(~live), path, layout.USER_FIRST)
    return spark.read.parquet(path).groupBy("event_month").agg(F.count(F.lit(1)).alias("rows"))


@query("late_version_case", f"""WITH {FACTS} SELECT (SELECT count(*) FROM facts WHERE event_time < ingested_at) AS late_rows, count(*) AS raw_rows,
    count(DISTINCT event_id) AS latest_rows,
    (SELECT CAST(sum(amount) AS DOUBLE) FROM (SELECT amount FROM facts QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, order_id DESC) = 1)) AS latest_amount
  FROM facts""")
def late_version_case(spark, sf):
    facts = tables.fact_events(spark, sf)
    latest = latest_by(facts.select("event_id", "version", "order_id", "amount"), ["event_id"], ["version", "order_id"])
    raw = facts.agg(F.count(F.when(F.col("event_time") < F.col("ingested_at"), 1)).alias("late_rows"), F.count(F.lit(1)).alias("raw_rows"))
    after = latest.agg(F.count(F.lit(1)).alias("n"), F.sum("amount").alias("a"))
    return raw.withColumns({"latest_rows": after.select("n").scalar(), "latest_amount": after.select("a").scalar()})


@query("retention_tier", f"""WITH {WORKLOAD} SELECT CASE WHEN event_time >= TIMESTAMP '2000-01-01' THEN 'hot' ELSE 'cold' END AS tier, count(*) AS rows,
    min(event_time) AS first_at, max(event_time) AS last_at FROM workload GROUP BY 1""")
def retention_tier(spark, sf):
    """Cold months change their tier in the manifest, no file is written again; both tiers together lose nothing."""
    rows = tables.workload(spark, sf)
    table = TieredTable(new_folder(spark, "tiers"), rows.schema, layout.USER_FIRST)
    table.append(rows.where("event_time < timestamp'1999-01-01'"), 0)
    table.append(rows.where("event_time >= timestamp'1999-01-01'"), 1)
    table.retier(spark, 200001)
    parts = []
    for name in ("hot", "cold"):
        found = table.read(spark, name).agg(F.count(F.lit(1)).alias("rows"), F.min("event_time").alias("first_at"), F.max("event_time").alias("last_at"))
        parts.append(found.select(F.lit(name).alias("tier"), "rows", "first_at", "last_at"))
    return parts[0].unionByName(parts[1])


@query("tombstones", f"""WITH {FACTS}, t AS (SELECT *, order_id % 15 = 2 AS deleted FROM facts),
  l AS (SELECT * FROM t QUALIFY row_number() OVER (PARTITION BY event_id ORDER BY version DESC, order_id DESC) = 1)
  SELECT event_id, order_id, version, CAST(amount AS DOUBLE) AS amount FROM l WHERE NOT deleted""")
def tombstones(spark, sf):
    rows = tables.fact_events(spark, sf).select(
        "event_id", "order_id", "version", "amount", (F.col("order_id") % 15 == 2).alias("deleted")
    )
    return without_deleted(rows, ["event_id"], ["version", "order_id"], "deleted")


@query("evolve_schema", """SELECT event_id, user_id AS account_id, CASE WHEN event_id % 2 = 0 THEN event_type ELSE 'unknown' END AS channel,
  CASE WHEN event_id % 2 = 0 THEN value END AS value FROM events""")
def evolve_schema(spark, sf):
    """Old files lack a column, use an old name, and have no channel; both read as one."""
    path = new_folder(spark, "evolve")
    e = tables.events(spark, sf)
    e.where("event_id % 2 = 1").select("event_id", "user_id").write.mode("append").parquet(path)
    e.where("event_id % 2 = 0").select(
        "event_id", F.col("user_id").alias("account_id"), F.col("event_type").alias("channel"), "value"
    ).write.mode("append").parquet(path)
    read = layout.read_evolved(
        spark,
        path,
        "event_id bigint, user_id bigint, account_id bigint, channel string, value double",
        renamed={"account_id": "user_id"},
        defaults={"channel": F.lit("unknown")},
    )
    return read.select("event_id", "account_id", "channel", "value")


_CENTS = "CAST((event_id % 10000) AS DOUBLE) / 100"


@query("fixture_workload", f"""SELECT event_id % 1000 AS user_id, event_id + 1 AS order_id, TIMESTAMP '2026-08-01' + to_days(CAST(event_id % 28 AS INTEGER)) AS event_time,
  ['BTC','ETH','SOL','XRP'][CAST(event_id % 4 AS INTEGER) + 1] AS symbol, {_CENTS} AS amount FROM events""")
def fixture_workload(spark, sf):
    return fixtures.workload_rows(tables.events(spark, sf).select(F.col("event_id").alias("id")))


@query("fixture_cases", f"""SELECT 'skew-' || event_id AS event_id, CASE WHEN event_id < 8000 THEN 0 ELSE event_id % 1000 END AS user_id, event_id + 1 AS order_id,
  TIMESTAMP '2026-08-05' + to_minutes(event_id % 60) AS event_time, TIMESTAMP '2026-08-05 01:00:00' + to_minutes(event_id % 60) AS ingested_at,
  ['BTC','ETH','SOL','XRP'][CAST(event_id % 4 AS INTEGER) + 1] AS symbol, CAST(1 AS INTEGER) AS version, {_CENTS} AS amount FROM events""")
def fixture_cases(spark, sf):
    ids = tables.events(spark, sf).select(F.col("event_id").alias("id"))
    return fixtures.case_rows(ids, "skew", "2026-08-05", "2026-08-05", fixtures.hot_user(8000))


@query("fixture_zipf", """SELECT CAST(floor(pow(1000.0, (((event_id % 2147483648) * 2654435761) % 4294967296) / 4294967296.0)) AS BIGINT) AS rank, count(*) AS rows FROM events GROUP BY 1""")
def fixture_zipf(spark, sf):
    ranked = fixtures.zipf_key(tables.events(spark, sf).select(F.col("event_id").alias("id")), 1000)
    return ranked.groupBy("rank").agg(F.count(F.lit(1)).alias("rows"))
