"""The domain inputs of ``tidemark.sources.tables`` again, in SQL."""

HOUR = 3_600_000_000

FEE_EVENTS = """fee_events AS (
  SELECT event_id, 'user-' || user_id AS customer_id, CAST(event_id % 16 AS INTEGER) AS source_partition,
    event_id // 16 + 1 AS sequence, CAST(value AS DECIMAL(19,2)) AS fee, ts AS occurred_at,
    (event_id + s) * 197 + s AS arrival, (event_id + s) // 50 AS arrival_batch, event_id // 16 AS "offset",
    TIMESTAMP '2024-02-01 00:00:00' + to_seconds(event_id + s) AS arrived_at
  FROM (SELECT *, (event_id * 7919) % 197 AS s FROM events))"""

PURCHASES = r"""purchases AS (
  SELECT o_orderkey AS arrival,
    CASE WHEN o_orderkey % 11 = 0 THEN ' ' || chr(9) || ' ' ELSE '  CUST-' || o_custkey || ' ' || chr(9) END AS customer_id,
    CASE WHEN o_orderkey % 13 = 0 THEN '' ELSE ' ' || o_orderpriority || chr(10) END AS product,
    CAST(CASE WHEN o_orderkey % 7 = 0 THEN 0 ELSE CAST(o_totalprice AS DECIMAL(19,2)) END AS DECIMAL(19,2)) AS amount,
    o_orderdate AS occurred_at
  FROM orders),
valid AS (
  SELECT arrival, trim(lower(customer_id), ' ' || chr(9) || chr(10)) AS customer_id,
    trim(product, ' ' || chr(9) || chr(10)) AS product, amount, occurred_at
  FROM purchases
  WHERE trim(customer_id, ' ' || chr(9) || chr(10)) <> '' AND trim(product, ' ' || chr(9) || chr(10)) <> '' AND amount > 0)"""

WORKLOAD = """workload AS (
  SELECT l_suppkey AS user_id, l_orderkey AS order_id, l_shipdate AS event_time,
    ['BTC','ETH','SOL','XRP'][CAST(l_partkey % 4 AS INTEGER) + 1] AS symbol,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS amount
  FROM lineitem)"""

FACTS = """facts AS (
  SELECT 'order-' || (CASE WHEN event_id % 3 = 2 THEN event_id - 1 ELSE event_id END) AS event_id, user_id,
    event_id AS order_id, ts AS event_time,
    ts + CASE WHEN event_id % 7 = 0 THEN INTERVAL 2 DAY ELSE INTERVAL 0 DAY END AS ingested_at,
    ['BTC','ETH','SOL','XRP'][CAST(event_id % 4 AS INTEGER) + 1] AS symbol,
    CASE WHEN event_id % 3 = 2 THEN 2 ELSE 1 END AS version, CAST(value AS DECIMAL(12,2)) AS amount
  FROM events)"""

CARTS = """activity AS (
  SELECT event_id AS arrival, 'user-' || user_id AS customer_id, CAST(value AS DECIMAL(19,2)) AS amount,
    event_type = 'view' AS probe, (epoch_us(ts) // 1000) AS t_ms
  FROM events WHERE event_type IN ('purchase', 'view'))"""

LOGINS = """logins AS (
  SELECT event_id, user_id, event_type, ts, CAST(value AS DECIMAL(19,2)) AS amount,
    CAST((event_id * 37) % 121 - 60 AS DOUBLE) AS lat, CAST((event_id * 53) % 301 - 150 AS DOUBLE) AS lon,
    user_id % 20 AS device, (event_id * 31) % 11 AS card
  FROM events)"""

METRICS = """metrics AS (
  SELECT 'i-' || (user_id % 4) AS instance, ts, epoch_us(ts) AS us,
    CASE WHEN event_type = 'error' THEN 0.0::DOUBLE ELSE 1.0::DOUBLE END AS up,
    CAST(event_id % 500 AS DOUBLE) AS records_in,
    (event_id // 100) % 2 * 500 + value * 10 AS busy_ms,
    CAST((epoch_us(ts) // 1000) - 30000 AS DOUBLE) AS watermark_ms
  FROM events)"""


def watermarks(bound: int = HOUR, idle: int | None = None, partitions: int = 16) -> str:
    active = "true" if idle is None else f"coalesce(heard, started) >= now_us - {idle}"
    return f"""ledger AS (
  SELECT arrival_batch AS b, source_partition AS p, max(epoch_us(occurred_at)) AS m, max(epoch_us(arrived_at)) AS h
  FROM fee_events GROUP BY ALL),
grid AS (
  SELECT b, now_us, p FROM (SELECT b, max(h) AS now_us FROM ledger GROUP BY b), (SELECT unnest(range({partitions})) AS p)),
seen AS (
  SELECT g.b, g.p, now_us, max(m) OVER w AS seen, max(h) OVER w AS heard, min(now_us) OVER w AS started
  FROM grid g LEFT JOIN ledger l ON g.b = l.b AND g.p = l.p WINDOW w AS (PARTITION BY g.p ORDER BY g.b)),
raw AS (
  SELECT b, CASE WHEN count(*) FILTER (WHERE {active} AND seen IS NULL) = 0
    THEN min(seen) FILTER (WHERE {active}) - {bound} END AS r FROM seen GROUP BY b),
wm AS (
  SELECT b AS arrival_batch, max(r) OVER (ORDER BY b) AS wm_us,
    max(r) OVER (ORDER BY b ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS wm_before_us FROM raw)"""


CLASSIFIED = f"""classified AS (
  SELECT *, CASE WHEN window_end_us + {2 * HOUR} <= wm_before_us THEN 'too_late'
      WHEN window_end_us <= wm_before_us THEN 'corrected' ELSE 'on_time' END AS class
  FROM (SELECT f.*, epoch_us(occurred_at) - epoch_us(occurred_at) % {HOUR} AS window_start_us,
      epoch_us(occurred_at) - epoch_us(occurred_at) % {HOUR} + {HOUR} AS window_end_us, wm_before_us
    FROM fee_events f LEFT JOIN wm USING (arrival_batch)))"""

JUDGED = f"{FEE_EVENTS},\n{watermarks()},\n{CLASSIFIED}"
