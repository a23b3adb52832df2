"""Documented application patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import money
from tidemark.operators import behaviour
from tidemark.operators.scan import DAY_US, HOUR_US
from tidemark.operators.versions import without_deleted
from tidemark.plans.eventtime import session_sql
from tidemark.plans.inputs_sql import HOUR, LOGINS
from tidemark.plans.registry import query
from tidemark.sources import tables

DAY = 24 * HOUR


@query("fraud_many_cards", f"""WITH {LOGINS} SELECT device, time_bucket(INTERVAL 6 HOUR, ts) AS window_start, time_bucket(INTERVAL 6 HOUR, ts) + INTERVAL 6 HOUR AS window_end,
    count(DISTINCT card) AS cards FROM logins GROUP BY ALL HAVING count(DISTINCT card) >= 4""")
def fraud_many_cards(spark, sf):
    return behaviour.many_cards(tables.logins(spark, sf), "device", "card", "ts", "6 hours", 4)


@query("fraud_travel", f"""WITH {LOGINS}, p AS (SELECT *, lag(ts) OVER w AS previous_at, lag(lat) OVER w AS plat, lag(lon) OVER w AS plon
    FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)),
  d AS (SELECT event_id, user_id, ts, previous_at, (epoch_us(ts) - epoch_us(previous_at)) / 3.6e9 AS hours,
    2 * 6371.0 * asin(sqrt(pow(sin(radians(lat - plat) / 2), 2) + cos(radians(plat)) * cos(radians(lat)) * pow(sin(radians(lon - plon) / 2), 2))) AS km
    FROM p WHERE previous_at IS NOT NULL)
  SELECT event_id, user_id, ts, previous_at, round(km, 3) AS km FROM d WHERE km > hours * 900""")
def fraud_travel(spark, sf):
    found = behaviour.implausible_travel(tables.logins(spark, sf), "user_id", "ts", "lat", "lon", "event_id", 900.0)
    return found.select("event_id", "user_id", "ts", "previous_at", F.round("km", 3).alias("km"))


@query("fraud_burst_then_large", f"""WITH {LOGINS}, c AS (SELECT *, count(*) FILTER (WHERE event_type = 'click') OVER (PARTITION BY user_id ORDER BY epoch_us(ts)
    RANGE BETWEEN {DAY} PRECEDING AND 1 PRECEDING) AS attempts FROM logins)
  SELECT event_id, user_id, ts, CAST(amount AS DOUBLE) AS amount, attempts FROM c WHERE event_type = 'purchase' AND amount > 50 AND attempts >= 1""")
def fraud_burst_then_large(spark, sf):
    found = behaviour.burst_then_large(
        tables.logins(spark, sf),
        "user_id",
        "ts",
        F.col("event_type") == "click",
        (F.col("event_type") == "purchase") & (F.col("amount") > 50),
        DAY_US,
        1,
    )
    return found.select("event_id", "user_id", "ts", "amount", "attempts")


@query("alert_threshold", f"""WITH {LOGINS}, r AS (SELECT device, time_bucket(INTERVAL 1 DAY, ts) AS window_start, count(*) AS rows,
    count(*) FILTER (WHERE event_type = 'error') AS bad_rows FROM logins GROUP BY ALL)
  SELECT device, window_start, window_start + INTERVAL 1 DAY AS window_end, rows, bad_rows, bad_rows / rows AS ratio FROM r WHERE bad_rows / rows > 0.3""")
def alert_threshold(spark, sf):
    return behaviour.ratio_alerts(tables.logins(spark, sf), ["device"], "ts", "1 day", F.col("event_type") == "error", 0.3)


@query("alert_suppress", f"""WITH {LOGINS}, errors AS (SELECT * FROM logins WHERE event_type = 'error'),
  {session_sql(12 * HOUR, 'errors', 'user_id', 'ts', 'count(*) AS alerts')}
  SELECT user_id, session_start AS first_at, make_timestamp(epoch_us(session_end) - {12 * HOUR}) AS last_at, alerts FROM sessions""")
def alert_suppress(spark, sf):
    errors = tables.logins(spark, sf).where("event_type = 'error'")
    return behaviour.suppress_repeats(errors, ["user_id"], "ts", 12 * HOUR_US)


@query("cdc_materialize", """WITH l AS (SELECT * FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1)
  SELECT user_id, event_id AS position, CAST(CAST(value AS DECIMAL(19,2)) AS DOUBLE) AS amount FROM l WHERE event_type <> 'error'""")
def cdc_materialize(spark, sf):
    """Ordered changes per key (an error event is a delete) to the current view."""
    changes = tables.events(spark, sf).select(
        "user_id",
        F.col("event_id").alias("position"),
        money(F.col("value")).alias("amount"),
        (F.col("event_type") == "error").alias("deleted"),
    )
    return without_deleted(changes, ["user_id"], ["position"], "deleted")


_STEPS = {"pages": "view", "carts": "click", "purchases": "purchase"}
_COUNTS = ", ".join(f"count(*) FILTER (WHERE event_type = '{kind}') AS {name}" for name, kind in _STEPS.items())


@query("journey", f"""WITH {LOGINS}, {session_sql(12 * HOUR, 'logins', 'user_id', 'ts', f"count(*) AS actions, {_COUNTS}")},
  placed AS (SELECT l.event_type, l.user_id, s.session_start, row_number() OVER (PARTITION BY l.user_id ORDER BY l.ts, l.event_id) AS pos
    FROM logins l JOIN sessions s ON l.user_id = s.user_id AND l.ts >= s.session_start AND l.ts < s.session_end),
  p1 AS (SELECT user_id, session_start, min(pos) AS pos FROM placed WHERE event_type = 'view' GROUP BY ALL),
  p2 AS (SELECT user_id, session_start, min(p.pos) AS pos FROM placed p JOIN p1 USING (user_id, session_start) WHERE event_type = 'click' AND p.pos > p1.pos GROUP BY ALL),
  p3 AS (SELECT user_id, session_start, min(p.pos) AS pos FROM placed p JOIN p2 USING (user_id, session_start) WHERE event_type = 'purchase' AND p.pos > p2.pos GROUP BY ALL)
  SELECT s.*, CAST((p1.pos IS NOT NULL)::INT + (p2.pos IS NOT NULL)::INT + (p3.pos IS NOT NULL)::INT AS INTEGER) AS reached, p3.pos IS NOT NULL AS converted
  FROM sessions s LEFT JOIN p1 USING (user_id, session_start) LEFT JOIN p2 USING (user_id, session_start) LEFT JOIN p3 USING (user_id, session_start)""")
def journey(spark, sf):
    """Sessions with the steps page, cart, purchase taken in this order."""
    steps = {name: F.col("event_type") == kind for name, kind in _STEPS.items()}
    return behaviour.journeys(tables.logins(spark, sf), "user_id", "ts", 12 * HOUR_US, steps, "event_id")


@query("features", f"""WITH {LOGINS}, c AS (SELECT event_id, user_id, ts, count(*) FILTER (WHERE event_type = 'purchase') OVER w AS orders_before,
    sum(amount) FILTER (WHERE event_type = 'purchase') OVER w AS spent, count(*) FILTER (WHERE event_type = 'error') OVER w AS failed, count(*) OVER w AS seen
    FROM logins WINDOW w AS (PARTITION BY user_id ORDER BY epoch_us(ts) RANGE BETWEEN {DAY} PRECEDING AND 1 PRECEDING))
  SELECT event_id, user_id, ts, orders_before, CASE WHEN orders_before > 0 THEN CAST(spent AS DOUBLE) / orders_before END AS average_amount,
    CASE WHEN seen > 0 THEN failed / seen END AS failure_ratio FROM c""")
def features(spark, sf):
    kind = F.col("event_type")
    found = behaviour.point_in_time_features(
        tables.logins(spark, sf), "user_id", "ts", "amount", kind == "purchase", kind == "error", DAY_US
    )
    return found.select("event_id", "user_id", "ts", "orders_before", "average_amount", "failure_ratio")


@query("features_relations", f"""WITH {LOGINS}, k AS (SELECT DISTINCT device, ts FROM logins)
  SELECT k.device, k.ts, count(DISTINCT l.user_id) AS partners_before FROM k
  LEFT JOIN logins l ON l.device = k.device AND l.ts >= k.ts - INTERVAL 24 HOUR AND l.ts < k.ts GROUP BY ALL""")
def features_relations(spark, sf):
    """Accounts seen on a device in the day before each of its events."""
    return behaviour.partners_before(tables.logins(spark, sf), "device", "user_id", "ts", DAY_US)
