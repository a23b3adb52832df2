"""Where two tables differ, by digests that are descended only where they disagree."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import row_digest
from tidemark.operators.enrich import small_or_plain
from tidemark.session import keep


def _signed(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    mine = left.select(*columns, F.lit(1).alias("_side"))
    return mine.unionByName(right.select(*columns, F.lit(-1).alias("_side")))


def _within(rows: DataFrame, groups: DataFrame, by: Sequence[str]) -> DataFrame:
    named = groups.select(*[F.col(c).alias(f"_open_{c}") for c in by])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_open_{c}")) for c in by])
    return rows.join(small_or_plain(named), same, "left_semi")


def differing_groups(left: DataFrame, right: DataFrame, by: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(by, left_rows, right_rows) of the groups whose rows are not the same in both tables.

    A group's digest is its number of rows and the sum of its rows' digests, so it combines before the shuffle and needs
    no order. Nulls are values like others, in groups and rows.
    """
    digest = row_digest(*[F.col(c) for c in columns]).cast("decimal(38,0)")
    rows = _signed(left, right, columns).withColumn("_digest", digest * F.col("_side"))
    sums = rows.groupBy(*by).agg(
        F.count(F.when(F.col("_side") > 0, 1)).alias("left_rows"), F.count(F.when(F.col("_side") < 0, 1)).alias("right_rows"), F.sum("_digest").alias("_sum")
    )
    return sums.where("left_rows <> right_rows or _sum <> 0").drop("_sum")


def differing_rows(left: DataFrame, right: DataFrame, levels: Sequence[Sequence[str]], key: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """(key, fault, left_rows, right_rows) of the keys whose rows differ, faults named from the left table's view.

    ``missing``: no row on the right; ``extra``: none on the left; ``altered``: rows with other content on either side;
    ``repeated``: the same content more often on one side.

    ``levels`` lists the columns by which groups get finer, from coarse to fine; below each level only rows of groups that
    differ are looked at, so two tables that agree cost one aggregate. ``columns`` are compared, beside the key.
    """
    every = list(dict.fromkeys([*(c for level in levels for c in level), *key, *columns]))
    by: list[str] = []
    for level in levels:
        by += [c for c in level if c not in by]
        differ = keep(differing_groups(left, right, by, every).select(*by), "differing")
        left, right = _within(left, differ, by), _within(right, differ, by)
    rows = _signed(left, right, every).groupBy(*every).agg(
        F.count(F.when(F.col("_side") > 0, 1)).alias("_left"), F.count(F.when(F.col("_side") < 0, 1)).alias("_right")
    )

    def some(condition: Column) -> Column:
        return F.max(F.when(condition, 1).otherwise(0)) == 1

    only_left, only_right = some((F.col("_left") > 0) & (F.col("_right") == 0)), some((F.col("_right") > 0) & (F.col("_left") == 0))
    told = rows.groupBy(*key).agg(
        only_left.alias("_l"), only_right.alias("_r"), some(F.col("_left") != F.col("_right")).alias("_differs"), F.sum("_left").alias("left_rows"), F.sum("_right").alias("right_rows")
    )
    fault = F.when(F.col("_l") & F.col("_r"), "altered").when((F.col("_l") | F.col("_r")) & (F.col("left_rows") > 0) & (F.col("right_rows") > 0), "altered")
    fault = fault.when(F.col("_l"), "missing").when(F.col("_r"), "extra").otherwise("repeated")
    return told.where("_differs").select(*key, fault.alias("fault"), "left_rows", "right_rows")
