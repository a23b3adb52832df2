"""Fact-table layouts: how rows are placed so that searches read little."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions import month_key

USER_FIRST = ("user_id", "event_time", "symbol", "order_id")
PAGE_ROWS = 500
SYMBOL_FIRST = ("symbol", "event_time", "user_id", "order_id")


def write_layout(df: DataFrame, path: str, sort: Sequence[str], mode: str = "append", files: int | None = None,
                 bloom: Sequence[str] = ("order_id",)) -> None:
    """Month folders with rows in sort order, so row groups have narrow bounds.

    Range partitioning on (month, sort key) spreads one busy user or month over
    several tasks, which hashing the month would not. Pages are short, so their
    bounds follow the sort key and a search reads the pages of its key alone. A
    key that no sort order serves gets Bloom filters, so a point lookup skips the
    row groups without it.
    """
    keyed = df.withColumn("event_month", month_key(F.col("event_time")))
    by = ["event_month", *sort]
    ranged = keyed.repartitionByRange(files, *by) if files else keyed.repartitionByRange(*by)
    writer = ranged.sortWithinPartitions(*by).write.mode(mode).partitionBy("event_month")
    writer = writer.option("parquet.page.row.count.limit", PAGE_ROWS)
    for key in bloom:
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True).option("parquet.bloom.filter.adaptive.enabled", True)
    writer.parquet(path)


def write_lookup(df: DataFrame, path: str, key: str, columns: Sequence[str], files: int | None = None) -> None:
    """A narrow copy ordered by one key, for point lookups."""
    narrow = df.select(*columns)
    ranged = narrow.repartitionByRange(files, key) if files else narrow.repartitionByRange(key)
    ranged.sortWithinPartitions(key).write.mode("append").parquet(path)


def split_by_age(df: DataFrame, first_hot_month: int, month: str = "event_month") -> tuple[DataFrame, DataFrame]:
    """Hot and cold rows by month folder; each side reads only its own folders."""
    return df.where(F.col(month) >= first_hot_month), df.where(F.col(month) < first_hot_month)


def read_evolved(spark: SparkSession, path: str, schema: str, renamed: dict[str, str] | None = None,
                 defaults: dict[str, Column] | None = None) -> DataFrame:
    """Old and new files under one declared schema.

    Columns missing from a file read as null; a renamed column takes its old
    name's value where the new one is null, then its default.
    """
    renamed, defaults = renamed or {}, defaults or {}
    df = spark.read.schema(schema).parquet(path)
    for new, old in renamed.items():
        df = df.withColumn(new, F.coalesce(new, old)).drop(old)
    for name, value in defaults.items():
        df = df.withColumn(name, F.coalesce(F.col(name), value))
    return df


def scan_metrics(df: DataFrame) -> list[dict[str, int]]:
    """Run a query and read rows, files and bytes from its file scans."""
    query = df._jdf.queryExecution()
    query.toRdd().count()
    found: list[dict[str, int]] = []

    def visit(plan) -> None:
        name = plan.nodeName()
        if name.startswith("AdaptiveSparkPlan"):
            return visit(plan.executedPlan())
        if "QueryStage" in plan.getClass().getSimpleName():
            return visit(plan.plan())
        if name.startswith("Scan"):
            metrics = plan.metrics()
            row = {}
            for label, key in (("rows", "numOutputRows"), ("files", "numFiles"), ("bytes", "filesSize")):
                if metrics.contains(key):
                    row[label] = int(metrics.apply(key).value())
            found.append(row)
        children = plan.children()
        for i in range(children.size()):
            visit(children.apply(i))

    visit(query.executedPlan())
    return found


def salted_counts(df: DataFrame, key: str, salts: int = 64) -> DataFrame:
    """Rows per key in two stages, the first on (key, salt).

    Counting combines before the shuffle, so this only matters for values that
    do not combine; it is the shape to use for those.
    """
    salt = F.pmod(F.xxhash64(*df.columns), F.lit(salts))
    first = df.groupBy(key, salt.alias("_salt")).agg(F.count(F.lit(1)).alias("_n"))
    return first.groupBy(key).agg(F.sum("_n").alias("rows"))
