"""Watermarks as a table, and everything that is judged against them.

A record's class must not depend on when a job happens to run, so the progress
of event time is kept as a ledger: one row per arrival batch and source
partition. All times here are epoch microseconds.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tidemark.functions import from_micros, micros, money
from tidemark.operators.scan import Running, chunk_width, running
from tidemark.session import keep

SECOND_US = 1_000_000
MINUTE_US = 60 * SECOND_US

SIZE_US = 5 * MINUTE_US
BOUND_US = 30 * SECOND_US
LATENESS_US = 2 * MINUTE_US
IDLE_US = 3 * SECOND_US

BATCHES_PER_CHUNK = 100_000
_NEVER = -(1 << 60)


def watermark_millis(max_event_millis: Column, bound_millis: int) -> Column:
    """The watermark value itself: one millisecond short of max - bound."""
    return max_event_millis - bound_millis - 1


def ledger_of(arrivals: DataFrame, clock: str | None = None) -> DataFrame:
    """One row per (arrival_batch, source_partition).

    ``clock`` names the recorded arrival time; idleness is judged on it, never
    on the wall clock, so a replay gives the same ledger.
    """
    heard = micros(F.max(clock)) if clock else F.lit(None).cast("bigint")
    return arrivals.groupBy("arrival_batch", "source_partition").agg(
        F.max(micros(F.col("occurred_at"))).alias("max_us"),
        heard.alias("heard_us"),
        F.count(F.lit(1)).alias("records"),
    )


def watermarks(
    ledger: DataFrame,
    partitions: int,
    bound_us: int = BOUND_US,
    idle_us: int | None = None,
    width: int | None = BATCHES_PER_CHUNK,
) -> DataFrame:
    """The watermark after, and before, each arrival batch.

    It is the least over active partitions of the greatest event time each has
    shown, minus the bound, and never falls. A partition that has shown nothing
    holds it back, unless ``idle_us`` is set and the partition has been silent
    that long; silence alone never moves it forward.
    """
    dense = (
        ledger.groupBy("arrival_batch")
        .agg(F.max("heard_us").alias("now_us"))
        .select(
            "arrival_batch",
            F.explode(F.sequence(F.lit(0), F.lit(partitions - 1))).alias("source_partition"),
            "now_us",
        )
        .unionByName(
            ledger.select("arrival_batch", "source_partition", "max_us", "heard_us"),
            allowMissingColumns=True,
        )
        .groupBy("arrival_batch", "source_partition")
        .agg(*[F.max(c).alias(c) for c in ("now_us", "max_us", "heard_us")])
    )
    seen = running(
        dense,
        ["source_partition"],
        "arrival_batch",
        [
            Running("seen_us", "max", F.col("max_us")),
            Running("last_heard_us", "max", F.col("heard_us")),
            Running("started_us", "min", F.col("now_us")),
        ],
        width,
    )
    active = F.lit(True)
    if idle_us is not None:
        active = F.coalesce("last_heard_us", "started_us") >= F.col("now_us") - idle_us
    lowest = (
        seen.withColumn("_active", active)
        .groupBy("arrival_batch")
        .agg(
            F.min(F.when(F.col("_active"), F.col("seen_us"))).alias("_low"),
            F.count(F.when(F.col("_active") & F.col("seen_us").isNull(), 1)).alias("_unseen"),
        )
        .select("arrival_batch", F.when(F.col("_unseen") == 0, F.col("_low") - bound_us).alias("_raw"))
    )
    return running(
        lowest,
        [],
        "arrival_batch",
        [Running("wm_us", "max", F.col("_raw")), Running("wm_before_us", "max", F.col("_raw"), -1)],
        width,
    ).select("arrival_batch", "wm_us", "wm_before_us")


def advance(previous: DataFrame | None, ledger: DataFrame, partitions: int, bound_us: int = BOUND_US,
            idle_us: int | None = None) -> DataFrame:
    """The streaming form: progress after one more batch from progress before it.

    One row per source partition carries everything the next batch needs, so a
    batch reads one small table however long the stream has run.
    """
    spark = ledger.sparkSession
    blank = spark.range(partitions).select(F.col("id").cast("int").alias("source_partition"))
    parts = blank.unionByName(
        ledger.select(
            "source_partition",
            F.col("max_us").alias("seen_us"),
            F.col("heard_us").alias("last_heard_us"),
            F.col("heard_us").alias("now_us"),
        ),
        allowMissingColumns=True,
    )
    if previous is not None:
        parts = parts.unionByName(previous, allowMissingColumns=True)
    else:
        parts = parts.withColumns({"started_us": F.col("now_us"), "wm_us": F.lit(None).cast("bigint")})
    per = parts.groupBy("source_partition").agg(
        *[F.max(c).alias(c) for c in ("seen_us", "last_heard_us", "now_us", "wm_us")],
        F.min("started_us").alias("started_us"),
    )
    # At most one row per source partition from here on.
    every = Window.partitionBy(F.lit(0))
    clocked = per.withColumns(
        {"now_us": F.max("now_us").over(every), "started_us": F.min("started_us").over(every), "wm_us": F.max("wm_us").over(every)}
    )
    active = F.lit(True)
    if idle_us is not None:
        active = F.coalesce("last_heard_us", "started_us") >= F.col("now_us") - idle_us
    judged = clocked.withColumn("_active", active)
    low = F.min(F.when(F.col("_active"), F.col("seen_us"))).over(every)
    unseen = F.count(F.when(F.col("_active") & F.col("seen_us").isNull(), 1)).over(every)
    return judged.withColumn(
        "wm_us", F.greatest("wm_us", F.when(unseen == 0, low - bound_us))
    ).select("source_partition", "seen_us", "last_heard_us", "started_us", "now_us", "wm_us")


def stored_watermarks(arrivals: DataFrame, partitions: int, bound_us: int = BOUND_US, idle_us: int | None = None,
                      clock: str | None = None) -> DataFrame:
    """The watermarks of a bounded set of arrivals, as a stored table.

    The ledger is one row per batch and partition and the result one row per
    batch. Both are stored, so the arrivals are read once for them, and a join
    on the result is planned with its size known.
    """
    rows = keep(ledger_of(arrivals, clock), "ledger")
    short = rows.count() <= BATCHES_PER_CHUNK
    marks = watermarks(rows, partitions, bound_us, idle_us, width=None if short else BATCHES_PER_CHUNK)
    return keep(marks, "watermarks")


def classify_at(arrivals: DataFrame, wm_before: Column, size_us: int = SIZE_US, lateness_us: int = LATENESS_US) -> DataFrame:
    """Add window_start_us, window_end_us and class, judged at a watermark.

    too_late: the window's state is already gone; corrected: the window has
    fired and fires again; on_time: it has not fired.
    """
    us = micros(F.col("occurred_at"))
    start = us - F.pmod(us, F.lit(size_us))
    end = F.col("window_end_us")
    return arrivals.withColumns({"window_start_us": start, "window_end_us": start + size_us}).withColumn(
        "class",
        F.when(end + lateness_us <= wm_before, "too_late").when(end <= wm_before, "corrected").otherwise("on_time"),
    )


def classify(arrivals: DataFrame, wms: DataFrame, size_us: int = SIZE_US, lateness_us: int = LATENESS_US) -> DataFrame:
    """The batch form: each arrival at the watermark before its own batch."""
    placed = arrivals.join(wms.select("arrival_batch", "wm_before_us"), "arrival_batch", "left")
    return classify_at(placed, F.col("wm_before_us"), size_us, lateness_us)


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where("class <> 'too_late'")


def too_late(classified: DataFrame) -> DataFrame:
    return classified.where("class = 'too_late'")


def reports(classified: DataFrame) -> DataFrame:
    """Complete totals per customer and window over the accepted arrivals."""
    return (
        accepted(classified)
        .groupBy("customer_id", "window_start_us", "window_end_us")
        .agg(money(F.sum("fee")).alias("total_fee"), F.count(F.lit(1)).alias("event_count"))
    )


def with_status(report_rows: DataFrame, wms: DataFrame, lateness_us: int = LATENESS_US) -> DataFrame:
    """open: not fired yet; provisional: fired, correctable; final: state removed."""
    now = wms.agg(F.coalesce(F.max("wm_us"), F.lit(_NEVER))).scalar()
    end = F.col("window_end_us")
    return report_rows.withColumn(
        "status",
        F.when(end + lateness_us <= now, "final").when(end <= now, "provisional").otherwise("open"),
    )


def emissions(classified: DataFrame, wms: DataFrame) -> DataFrame:
    """Every complete total that leaves a window, in batch order.

    A window speaks first in the batch whose watermark reaches its end, and
    again in each later batch that adds an accepted record.
    """
    kept = accepted(classified)
    steps = (
        kept.select(F.col("window_end_us").alias("_at"), F.lit(True).alias("_window"))
        .distinct()
        .unionByName(
            wms.select(
                F.coalesce("wm_before_us", F.lit(_NEVER)).alias("_at"),
                F.lit(False).alias("_window"),
                "arrival_batch",
                "wm_us",
            ),
            allowMissingColumns=True,
        )
    )
    # The last batch that began below a window's end is the one that fires it.
    fires = (
        running(
            steps,
            [],
            "_at",
            [Running("fire_batch", "max", F.col("arrival_batch"), -1), Running("_reached", "max", F.col("wm_us"), -1)],
            chunk_width(wms, F.coalesce("wm_before_us", F.lit(_NEVER)), SECOND_US),
            peers=True,
        )
        .where(F.col("_window") & (F.col("_reached") >= F.col("_at")))
        .select(F.col("_at").alias("window_end_us"), "fire_batch")
    )
    # Reduced to one row per customer, window and batch before anything is joined.
    added = kept.groupBy("customer_id", "window_start_us", "window_end_us", "arrival_batch").agg(
        F.sum("fee").alias("_fee"), F.count(F.lit(1)).alias("_n")
    )
    changes = (
        added.join(fires, "window_end_us")
        .groupBy(
            "customer_id",
            "window_start_us",
            "window_end_us",
            F.greatest("arrival_batch", "fire_batch").alias("emit_batch"),
            "fire_batch",
        )
        .agg(F.sum("_fee").alias("_fee"), F.sum("_n").alias("_n"))
    )
    # Per window at most one row for each batch inside its allowed lateness.
    so_far = (
        Window.partitionBy("customer_id", "window_start_us")
        .orderBy("emit_batch")
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    return changes.select(
        "customer_id",
        from_micros(F.col("window_start_us")).alias("window_start"),
        from_micros(F.col("window_end_us")).alias("window_end"),
        "emit_batch",
        F.when(F.col("emit_batch") == F.col("fire_batch"), "first").otherwise("correction").alias("kind"),
        money(F.sum("_fee").over(so_far)).alias("total_fee"),
        F.sum("_n").over(so_far).alias("event_count"),
    )
