"""Risk patterns, alerts and point-in-time features."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import from_micros, haversine_km, micros
from tidemark.operators.automaton import reached
from tidemark.operators.scan import HOUR_US, Running, chunk_width, running, trailing
from tidemark.operators.windows import sessions


def many_cards(df: DataFrame, device: str, card: str, ts: str, size: str, at_least: int) -> DataFrame:
    """Devices that used many distinct cards within one window.

    Distinct (device, window, card) first, so a busy device is spread by card.
    """
    seen = df.select(device, card, F.window(ts, size).alias("w")).distinct()
    counts = seen.groupBy(device, "w").agg(F.count(card).alias("cards"))
    return counts.where(F.col("cards") >= at_least).select(
        device, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "cards"
    )


def implausible_travel(df: DataFrame, key: str, ts: str, lat: str, lon: str, tie: str, max_kmh: float) -> DataFrame:
    """Consecutive logins that would need more than ``max_kmh``."""
    here = F.struct(F.col(ts).alias("ts"), F.col(lat).alias("lat"), F.col(lon).alias("lon"))
    moved = running(
        df.withColumn("_us", micros(F.col(ts))), [key], "_us", [Running("_prev", "last", here, -1)], ties=[tie]
    )
    km = haversine_km(F.col("_prev.lat"), F.col("_prev.lon"), F.col(lat), F.col(lon))
    hours = (F.col("_us") - micros(F.col("_prev.ts"))) / F.lit(3.6e9)
    return (
        moved.where(F.col("_prev").isNotNull())
        .withColumns({"km": km, "hours": hours})
        .where(F.col("km") > F.col("hours") * max_kmh)
        .select(*df.columns, F.col("_prev.ts").alias("previous_at"), "km", "hours")
    )


def burst_then_large(df: DataFrame, key: str, ts: str, attempt: Column, large: Column, span_us: int, at_least: int) -> DataFrame:
    """Large events that follow many attempts within the span before them."""
    counted = trailing(
        df.withColumn("_us", micros(F.col(ts))),
        [key],
        "_us",
        span_us,
        {"attempts": F.when(attempt, 1).otherwise(0)},
        include_current=False,
    )
    return counted.where(large & (F.col("attempts") >= at_least)).drop("_us")


def ratio_alerts(df: DataFrame, keys: Sequence[str], ts: str, size: str, bad: Column, threshold: float) -> DataFrame:
    """Windows in which the share of bad rows exceeds a threshold."""
    counts = df.groupBy(*keys, F.window(ts, size).alias("w")).agg(
        F.count(F.lit(1)).alias("rows"), F.count(F.when(bad, 1)).alias("bad_rows")
    )
    return counts.withColumn("ratio", F.col("bad_rows") / F.col("rows")).where(F.col("ratio") > threshold).select(
        *keys, F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "rows", "bad_rows", "ratio"
    )


def suppress_repeats(alerts: DataFrame, keys: Sequence[str], ts: str, cooldown_us: int) -> DataFrame:
    """One alert per stretch of alerts that are never more than the cool-down apart."""
    stretches = sessions(alerts, keys, ts, cooldown_us, {"alerts": F.lit(1)})
    return stretches.select(
        *keys,
        F.col("session_start").alias("first_at"),
        from_micros(micros(F.col("session_end")) - cooldown_us).alias("last_at"),
        "alerts",
    )


def journeys(df: DataFrame, key: str, ts: str, gap_us: int, steps: dict[str, Column], tie: str) -> DataFrame:
    """Counts of each step per session, how many steps were taken in their order, and whether that is all of them.

    A purchase before its page is counted, and converts nothing. Rows of one time count by ``tie``.
    """
    sums = {name: F.when(cond, 1).otherwise(0) for name, cond in steps.items()}
    found = sessions(df, [key], ts, gap_us, {"actions": F.lit(1), **sums})
    rows = df.withColumn("_us", micros(F.col(ts)))
    before = running(rows, [key], "_us", [Running("_before", "max", F.col("_us"), -1)], ties=[tie])
    opens = F.when(F.coalesce(F.col("_us") - F.col("_before") > gap_us, F.lit(True)), F.col("_us"))
    placed = running(before.withColumn("_opens", opens), [key], "_us", [Running("_start", "max", F.col("_opens"))], ties=[tie])
    taken = reached(placed, [key, "_start"], "_us", tie, list(steps.values())).withColumn("session_start", from_micros(F.col("_start")))
    same = found[key].eqNullSafe(taken[key]) & (found["session_start"] == taken["session_start"])
    out = found.join(taken, same, "left").select(*[found[c] for c in found.columns], F.coalesce("reached", F.lit(0)).alias("reached"))
    return out.withColumn("converted", F.col("reached") == len(steps))


def point_in_time_features(df: DataFrame, key: str, ts: str, amount: str, is_order: Column, failed: Column,
                           span_us: int = HOUR_US) -> DataFrame:
    """Features from the span before each row, never from the row itself or its peers."""
    order_amount = F.when(is_order, F.col(amount)).otherwise(F.lit(0).cast(df.schema[amount].dataType))
    counted = trailing(
        df.withColumn("_us", micros(F.col(ts))),
        [key],
        "_us",
        span_us,
        {
            "orders_before": F.when(is_order, 1).otherwise(0),
            "_spent": order_amount,
            "_failed": F.when(failed, 1).otherwise(0),
            "_rows": F.lit(1),
        },
        include_current=False,
    )
    return counted.withColumns(
        {
            "average_amount": F.when(F.col("orders_before") > 0, F.col("_spent").cast("double") / F.col("orders_before")),
            "failure_ratio": F.when(F.col("_rows") > 0, F.col("_failed") / F.col("_rows")),
        }
    ).drop("_us", "_spent", "_failed", "_rows")


def partners_before(df: DataFrame, key: str, partner: str, ts: str, span_us: int) -> DataFrame:
    """Distinct partners of a key in the span before each (key, time).

    A partner counts from a sighting until the span has passed without another
    one, so overlapping sightings are merged per (key, partner) first, and the
    answer is a running sum of starts and ends.
    """
    seen = df.select(key, partner, micros(F.col(ts)).alias("_us")).distinct()
    visits = (
        sessions(seen.withColumn("_ts", from_micros(F.col("_us"))), [key, partner], "_ts", span_us, {"_n": F.lit(1)})
        .select(key, micros(F.col("session_start")).alias("_from"), micros(F.col("session_end")).alias("_until"))
    )
    steps = (
        visits.select(key, F.explode(F.array(
            F.struct(F.col("_from").alias("_us"), F.lit(1).alias("_d")),
            F.struct(F.col("_until").alias("_us"), F.lit(-1).alias("_d")),
        )).alias("s"))
        .select(key, "s.*")
        .groupBy(key, "_us").agg(F.sum("_d").alias("_d"))
        .withColumn("_asked", F.lit(0))
        .unionByName(seen.select(key, "_us").distinct().withColumns({"_d": F.lit(0).cast("bigint"), "_asked": F.lit(1)}))
    )
    out = running(steps, [key], "_us", [Running("partners_before", "sum", F.col("_d"), -1)], chunk_width(df, micros(F.col(ts))), peers=True)
    return out.where("_asked = 1").select(
        key, from_micros(F.col("_us")).alias(ts), F.coalesce("partners_before", F.lit(0)).alias("partners_before")
    )
