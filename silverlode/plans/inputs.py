"""Inputs of the registered queries, derived from the plain tables with faults put in by arithmetic.

Each is a SELECT that Spark and the SQL oracle read alike; ``{fmt}`` is how each formats a time.
"""

from __future__ import annotations

from datetime import date, datetime, timezone
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from . import config

SPARK_FORMAT = "date_format({0}, 'yyyy-MM-dd HH:mm:ss')"
DUCK_FORMAT = "strftime({0}, '%Y-%m-%d %H:%M:%S')"
AS_OF = datetime(2024, 2, 1, tzinfo=timezone.utc)

RAW = """
SELECT CAST(e.event_id AS STRING) AS src_id, c.copy,
  concat(lpad(CAST(e.event_id AS STRING), 12, '0'), '#', CAST(c.copy AS STRING)) AS _ingestion_order,
  CASE WHEN e.event_id % 97 = 0 THEN NULL WHEN e.event_id % 89 = 0 THEN ' ' ELSE CAST(e.event_id AS STRING) END AS visit,
  CASE WHEN e.event_id % 11 = 0 THEN NULL WHEN e.event_id % 71 = 0 THEN 'x1' WHEN e.event_id % 67 = 0 THEN '' ELSE concat(' ', CAST(e.user_id AS STRING)) END AS visitor,
  CASE WHEN e.event_id % 61 = 0 THEN 'weird' WHEN e.event_id % 59 = 0 THEN NULL WHEN e.event_id % 5 = 0 THEN concat(e.event_type, ' ') ELSE e.event_type END AS action,
  CASE WHEN c.copy = 2 THEN 'zz-9' WHEN e.event_id % 11 = 0 THEN NULL WHEN e.event_id % 53 = 0 THEN 'de_12' WHEN e.event_id % 7 = 0 THEN concat('  en-', CAST(e.user_id AS STRING), ' ') ELSE concat('de-', CAST(e.user_id AS STRING)) END AS page,
  CASE WHEN e.event_id % 47 = 0 THEN '-0.25' WHEN e.event_id % 43 = 0 THEN '1,5' WHEN e.event_id % 41 = 0 THEN '12345678' ELSE concat(CAST(e.event_id % 90 AS STRING), '.', CAST(e.event_id % 10 AS STRING)) END AS spent,
  CASE e.event_id % 8 WHEN 0 THEN 'YES' WHEN 1 THEN 'no' WHEN 2 THEN 't' WHEN 3 THEN NULL ELSE 'true' END AS member,
  CASE WHEN e.event_id % 37 = 0 THEN '2024-02' WHEN e.event_id % 31 = 0 THEN '2024-02-02' ELSE '2024-02-01' END AS seen_on,
  CASE WHEN e.event_id % 83 = 0 THEN 'junk' WHEN e.event_id % 79 = 0 THEN '2024-02-01 01:30:01' WHEN e.event_id % 73 = 0 THEN '2024-02-01 01:30:00' ELSE {ts} END AS seen_at,
  CASE WHEN e.event_id % 11 = 0 THEN 'D' ELSE 'U' END AS op
FROM events e JOIN (SELECT 0 AS copy, 1 AS every UNION ALL SELECT 1, 50 UNION ALL SELECT 2, 77) c ON e.event_id % c.every = 0
"""

CHANGES = """
SELECT e.user_id, date_trunc('hour', e.ts) AS change_ts, CAST(e.event_id % 3 AS BIGINT) AS change_seq,
  CASE WHEN e.event_type = 'error' THEN 'D' WHEN e.event_type = 'signup' THEN 'I' ELSE 'U' END AS op,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE e.event_type END AS kind,
  CASE WHEN e.event_type = 'error' THEN NULL ELSE CAST(floor(e.value) AS BIGINT) % 3 END AS amount,
  concat(lpad(CAST(e.event_id AS STRING), 12, '0'), '#', CAST(c.copy AS STRING)) AS _ingestion_order
FROM events e JOIN (SELECT 0 AS copy, 1 AS every UNION ALL SELECT 1, 40) c ON e.event_id % c.every = 0
"""

ORDER_EVENTS = """
SELECT o.o_orderkey AS order_id, s.event_type, concat(CAST(o.o_orderkey AS STRING), '-', s.event_type) AS event_id, o.o_custkey AS customer_id,
  CAST(o.o_orderkey % 26 AS INT) AS store_id, o.o_orderkey % 2500 AS product_id,
  CASE WHEN o.o_orderkey % 31 = 0 THEN NULL ELSE CAST(o.o_orderkey % 5 + 1 AS INT) END AS quantity,
  CASE WHEN o.o_orderkey % 37 = 0 THEN 'junk' ELSE concat(CAST(CAST(floor(o.o_totalprice) AS BIGINT) AS STRING), '.', lpad(CAST(o.o_orderkey % 100 AS STRING), 2, '0')) END AS unit_price,
  CASE WHEN o.o_orderkey % 41 = 0 THEN 'EUR' WHEN o.o_orderkey % 43 = 0 THEN '' WHEN o.o_orderkey % 2 = 0 THEN 'THB' ELSE 'USD' END AS currency,
  o.o_orderdate + s.hours * INTERVAL 1 HOUR AS event_ts, s.rank AS _ingestion_order
FROM orders o JOIN (SELECT 'PLACED' AS event_type, 0 AS hours, 1 AS rank, 1 AS every UNION ALL SELECT 'PAID', 1, 2, 1 UNION ALL SELECT 'PAID', 1, 3, 10 UNION ALL SELECT 'SHIPPED', 2, 4, 3 UNION ALL SELECT 'CANCELLED', -1, 5, 17) s
  ON o.o_orderkey % s.every = 0 AND NOT (s.event_type = 'PAID' AND o.o_orderstatus = 'P')
"""

PRODUCTS = """
SELECT p.p_partkey AS product_id, v.effective_date, concat('c', CAST((p.p_size + v.version) % 7 AS STRING)) AS category,
  CAST(p.p_retailprice + v.version AS DECIMAL(10,2)) AS unit_price, CAST(v.version AS STRING) AS _ingestion_order
FROM part p JOIN (SELECT 0 AS version, DATE '1996-01-01' AS effective_date, 1 AS every UNION ALL SELECT 1, DATE '1998-06-01', 3 UNION ALL SELECT 2, DATE '2000-03-15', 6) v ON p.p_partkey % v.every = 0
"""

STORES = "SELECT n.n_nationkey AS store_id, CASE WHEN n.n_nationkey % 13 = 0 THEN NULL ELSE r.r_name END AS region FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey"

ACTIVITY = """
SELECT concat(CAST(user_id AS STRING), '-', substring(CAST(CAST(ts AS DATE) AS STRING), 1, 10)) AS session_id, CASE WHEN event_id % 7 = 0 THEN NULL ELSE user_id END AS customer_id,
  CASE event_type WHEN 'click' THEN 'ADD_TO_CART' WHEN 'view' THEN 'PAGE_VIEW' WHEN 'error' THEN 'REMOVE_FROM_CART' WHEN 'signup' THEN 'SEARCH' END AS activity_type,
  ts AS activity_ts, lpad(CAST(event_id AS STRING), 12, '0') AS _ingestion_order
FROM events WHERE event_type <> 'purchase'
"""

PURCHASES = "SELECT event_id AS order_id, user_id AS customer_id, ts AS event_ts FROM events WHERE event_type = 'purchase'"

NAMES = """
SELECT event_id, CASE WHEN event_id % 13 = 0 THEN concat('orders-', CAST(event_id AS STRING)) WHEN event_id % 17 = 0 THEN concat('order_events_20261345_080000_', CAST(event_id AS STRING), '.csv')
  ELSE concat('order_events_202601', lpad(CAST(event_id % 28 + 1 AS STRING), 2, '0'), '_', lpad(CAST(event_id % 24 AS STRING), 2, '0'), '3000_', CAST(event_id % 900 AS STRING), '.json') END AS name
FROM events
"""

RATES = [config.Rate("THB", date(1995, 6, 1), Decimal("35")), config.Rate("THB", date(1999, 1, 1), Decimal("36"))]

CONTRACT = config.SourceContract(
    "visits", ("visit",),
    {"visit": "bigint", "visitor": "bigint", "action": "string", "page": "string", "spent": "decimal(6,2)", "member": "boolean", "seen_on": "date", "seen_at": "timestamp", "op": "string"},
    "op", "key_only",
)
RULES = config.bind_rules(
    CONTRACT,
    [
        {"rule": "duplicate", "severity": "quarantine"},
        {"rule": "format", "column": "page", "pattern": "[a-z]{2}-[0-9]+", "severity": "quarantine"},
        {"rule": "plausibility", "column": "seen_at", "max_future_skew_minutes": 90, "severity": "quarantine"},
        {"rule": "plausibility", "column": "seen_on", "severity": "observe"},
        {"rule": "range", "column": "spent", "min": 0, "max": 85, "severity": "gate"},
        {"rule": "domain", "column": "action", "values": ["purchase", "signup", "view", "click"], "severity": "observe"},
        {"rule": "null_key", "column": "visit", "severity": "quarantine"},
        {"rule": "null_key", "column": "visitor", "severity": "observe"},
        {"rule": "try_cast", "column": "member", "severity": "observe"},
    ],
)


def derive(spark: SparkSession, sf_dir: str, select: str) -> DataFrame:
    """A SELECT over the tables of ``sf_dir``, bound by name for this statement alone."""
    text = select.replace("{ts}", SPARK_FORMAT.format("e.ts"))
    bound = {}
    for name in ("events", "orders", "lineitem", "part", "nation", "region", "customer"):
        for word in ("FROM", "JOIN"):
            if f"{word} {name}" in text:
                text = text.replace(f"{word} {name}", f"{word} {{{name}}}")
                bound[name] = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    return spark.sql(text, **bound)


def duck(select: str) -> str:
    return select.replace("{ts}", DUCK_FORMAT.format("e.ts"))
