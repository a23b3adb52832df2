"""Reconciliation, data quality and stable exports."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tidemark.functions import micros, money, row_digest
from tidemark.operators.enrich import small_or_plain
from tidemark.operators.scan import AUTO, PER_ROWS, Running, running

_SIDES = ("source", "too_late", "reported")


def _tagged(source: DataFrame, rejected: DataFrame, reported: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The three tables as (keys, side, fee, n), each reduced before they meet."""
    parts = []
    for side, df, fee, n in (
        ("source", source, F.sum("fee"), F.count(F.lit(1))),
        ("too_late", rejected, F.sum("fee"), F.count(F.lit(1))),
        ("reported", reported, F.sum("total_fee"), F.sum("event_count")),
    ):
        parts.append(
            df.groupBy(*keys).agg(fee.cast("decimal(38,2)").alias("fee"), n.cast("bigint").alias("n")).withColumn("side", F.lit(side))
        )
    return reduce(DataFrame.unionByName, parts)


def reconcile(source: DataFrame, rejected: DataFrame, reported: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """source - too late - reported, in fee and in count, which must be zero.

    Each table is totalled on its own, so no join can multiply rows; a key that
    one table lacks still shows up with zeros. Without keys: one row overall.
    """
    keys = list(keys)
    tagged = _tagged(source, rejected, reported, keys)

    def fee(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("fee"))), F.lit(0))

    def n(side: str) -> Column:
        return F.coalesce(F.sum(F.when(F.col("side") == side, F.col("n"))), F.lit(0))

    out = tagged.groupBy(*keys).agg(
        *[c for s in _SIDES for c in (money(fee(s)).alias(f"{s}_fee"), n(s).cast("bigint").alias(f"{s}_count"))]
    )
    return out.withColumns(
        {
            "fee_delta": money(F.col("source_fee") - F.col("too_late_fee") - F.col("reported_fee")),
            "count_delta": F.col("source_count") - F.col("too_late_count") - F.col("reported_count"),
        }
    )


def duplicate_keys(df: DataFrame, *keys: str) -> DataFrame:
    """Rows beyond the first of each key, in one number."""
    per_key = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    return per_key.agg(F.coalesce(F.sum(F.col("_n") - 1), F.lit(0)).cast("bigint").alias("duplicates"))


def sequence_gaps(df: DataFrame, partition: str = "source_partition", sequence: str = "sequence",
                  width: int | str | None = AUTO) -> DataFrame:
    """Missing ranges of sequence numbers per source partition."""
    present = df.select(partition, sequence).distinct()
    before = running(present, [partition], sequence, [Running("_prev", "max", F.col(sequence), -1)], width, slice_width=PER_ROWS)
    return before.where(F.col(sequence) - F.col("_prev") > 1).select(
        partition,
        (F.col("_prev") + 1).alias("gap_start"),
        (F.col(sequence) - 1).alias("gap_end"),
        (F.col(sequence) - F.col("_prev") - 1).alias("missing"),
    )


def sequence_disorder(df: DataFrame, partition: str = "source_partition", sequence: str = "sequence",
                      ts: str = "occurred_at", width: int | str | None = AUTO) -> DataFrame:
    """Records whose event time goes back while their sequence advances."""
    before = running(df, [partition], sequence, [Running("previous_at", "last", F.col(ts), -1)], width, slice_width=PER_ROWS)
    return before.where(F.col(ts) < F.col("previous_at"))


def arrival_disorder(df: DataFrame, keys: Sequence[str], order: str, ts: str = "occurred_at",
                     width: int | str | None = AUTO) -> DataFrame:
    """How far each record lies behind the latest event time already seen, in microseconds."""
    us = micros(F.col(ts))
    ahead = running(df, keys, order, [Running("_seen_us", "max", us)], width, slice_width=PER_ROWS)
    return ahead.withColumn("behind_us", F.col("_seen_us") - us).drop("_seen_us")


def gate(df: DataFrame, rules: dict[str, Column], duplicates_of: Sequence[str] = (), order: str | None = None,
         width: int | str | None = AUTO) -> DataFrame:
    """Add ``reasons``: the names of the rules a row breaks (empty means valid).

    A rule is a condition that marks a bad row; an unknown condition counts as
    bad. With ``duplicates_of`` every row but the first of a key is bad too; a
    key with a null part is incomplete, not repeated. Repeats are told by a
    running count, so the table is scanned once and a key that repeats very
    often is cut into chunks.
    """
    reasons = [F.when(F.coalesce(bad, F.lit(True)), F.lit(name)) for name, bad in rules.items()]
    if duplicates_of:
        whole = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in duplicates_of])
        # Incomplete keys are no key of many rows: each stands for itself.
        alone = F.when(~whole, F.col(order))
        df = running(df.withColumn("_alone", alone), [*duplicates_of, "_alone"], order, [Running("_times", "sum", F.lit(1))], width, slice_width=PER_ROWS)
        reasons.append(F.when(whole & (F.col("_times") > 1), F.lit("duplicate")))
    return df.withColumn("reasons", F.array_compact(F.array(*reasons))).drop("_times", "_alone")


def goes_back(df: DataFrame, keys: Sequence[str], order: str, value: str, name: str, width: int | str | None = AUTO) -> DataFrame:
    """Add ``name``: whether a value that only ever grows is below the one before it in its series; false for the first.

    Null values are no step of the series.
    """
    before = running(df, list(keys), order, [Running("_last", "last", F.col(value), -1)], width, slice_width=PER_ROWS)
    return before.withColumn(name, F.coalesce(F.col(value) < F.col("_last"), F.lit(False))).drop("_last")


def unknown_to(df: DataFrame, dim: DataFrame, on: Sequence[str], name: str) -> DataFrame:
    """Add ``name``: whether a row has no row in ``dim``; a null key is unknown to it."""
    known = dim.select(*on).distinct().withColumn("_known", F.lit(True))
    return df.join(small_or_plain(known), list(on), "left").withColumn(name, F.col("_known").isNull()).drop("_known")


def split_and_count(gated: DataFrame, path: str, names: Sequence[str]) -> dict[str, int]:
    """Write valid and quarantined rows apart in one pass, counting rows, valid rows and each reason on the way.

    The counts are those of the rows as they are written: nothing is read again for them.
    """
    seen = Observation()
    each = [F.count(F.when(F.array_contains("reasons", n), 1)).alias(n) for n in names]
    counted = gated.observe(seen, F.count(F.lit(1)).alias("rows"), F.count(F.when(F.size("reasons") == 0, 1)).alias("valid"), *each)
    counted.withColumn("valid", F.when(F.size("reasons") == 0, 1).otherwise(0)).write.partitionBy("valid").parquet(path)
    return seen.get


def valid(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") == 0).drop("reasons")


def quarantine(gated: DataFrame) -> DataFrame:
    return gated.where(F.size("reasons") > 0)


def quality_counts(gated: DataFrame) -> DataFrame:
    """Rows per reason, with ``valid`` for rows without one."""
    named = F.when(F.size("reasons") == 0, F.array(F.lit("valid"))).otherwise(F.col("reasons"))
    return gated.select(F.explode(named).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("rows"))


def partition_coverage(df: DataFrame, expected: int, partition: str = "source_partition") -> DataFrame:
    """Expected partitions with their row counts; zero rows means the partition is absent."""
    counts = df.groupBy(partition).agg(F.count(F.lit(1)).alias("rows"))
    wanted = df.sparkSession.range(expected).select(F.col("id").cast(df.schema[partition].dataType).alias(partition))
    return wanted.join(counts, partition, "full").withColumn("rows", F.coalesce("rows", F.lit(0)))


def content_digest(df: DataFrame, columns: Sequence[str], by: Column) -> DataFrame:
    """Row count and digest sum per bucket: equal digests mean equal rows.

    Needs no global order, so any number of part files can be compared.
    """
    digest = row_digest(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    return df.groupBy(by.alias("bucket")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum(digest).alias("digest")
    )
