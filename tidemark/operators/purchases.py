"""Cleaning purchases and keeping running spend per customer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions import is_blank, money, strip
from tidemark.operators.scan import AUTO, PER_ROWS, Running, running


def valid_purchase(df: DataFrame) -> DataFrame:
    """Keep named customers and products with a positive amount (before normalising)."""
    return df.where(~is_blank(F.col("customer_id")) & ~is_blank(F.col("product")) & (F.col("amount") > 0))


def normalize_purchase(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {"customer_id": F.lower(strip(F.col("customer_id"))), "product": strip(F.col("product"))}
    )


def require_fields(df: DataFrame, *names: str) -> DataFrame:
    """Strict form: a missing required value fails the job."""
    checks = {
        n: F.when(F.col(n).isNull(), F.raise_error(F.lit(f"{n} is required")).cast(df.schema[n].dataType)).otherwise(F.col(n))
        for n in names
    }
    return df.withColumns(checks)


def missing_fields(*names: str):
    """Lenient form: the names of the missing required fields of a row."""
    return F.array_compact(F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names]))


def running_spend(df: DataFrame, order: str = "arrival", width: int | str | None = AUTO) -> DataFrame:
    """One output row per input: the cumulative amount with this row's time.

    The first row of a customer passes unchanged; later rows carry the label
    ``running-total`` in place of a product.
    """
    summed = running(
        df,
        ["customer_id"],
        order,
        [Running("_spent", "sum", F.col("amount")), Running("_seen", "sum", F.lit(1))],
        width,
        slice_width=PER_ROWS,
    )
    return summed.select(
        order,
        "customer_id",
        F.when(F.col("_seen") == 1, F.col("product")).otherwise(F.lit("running-total")).alias("product"),
        money(F.col("_spent")).alias("amount"),
        "occurred_at",
    )


def current_spend(df: DataFrame, order: str = "arrival") -> DataFrame:
    """What the running value leaves per customer: total, and the last arrival's time."""
    return df.groupBy("customer_id").agg(
        money(F.sum("amount")).alias("amount"),
        F.max_by("occurred_at", order).alias("updated_at"),
    )
