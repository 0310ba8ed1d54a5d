"""The registered queries of the medallion engine and the SQL that states each one's result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import ingestion_order, lateness, record_hash
from ..operators import audit, cdc, dq, gold, scd2
from ..sources import files
from ..sources.tables import Warehouse, scratch
from ..streaming import bronze
from . import inputs, landed
from .inputs import derive, duck

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[name] = f
        if sql is not None:
            SQL[name] = sql.replace("count_if(", "count(*) FILTER (WHERE ")  # counts stay BIGINT
        return f

    return register


# ---- data quality

RAW = f"raw AS ({duck(inputs.RAW)})"
_SHAPES = {"BIGINT": r"[+-]?\d+", "DECIMAL(6,2)": r"[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?", "DATE": r"\d{4}-\d{1,2}-\d{1,2}", "TIMESTAMP": r"\d{4}-\d{1,2}-\d{1,2}([T ].*)?"}
_TYPES = {"visit": "BIGINT", "visitor": "BIGINT", "spent": "DECIMAL(6,2)", "seen_on": "DATE", "seen_at": "TIMESTAMP"}
_LANDED = "visit, visitor, action, page, spent, member, seen_on, seen_at, op"
_CASTS = ", ".join(f"TRY_CAST(CASE WHEN regexp_full_match(trim({c}), '{_SHAPES[t]}') THEN trim({c}) END AS {t}) AS t_{c}" for c, t in _TYPES.items())
_MISFITS = ", ".join(f"coalesce({'' if c == 'visit' else 'NOT gone AND '}trim({c}) <> '' AND t_{c} IS NULL, false) AS {c}_try_cast" for c in (*_TYPES, "member"))
_REASONS = ("visit_null_key", *(f"{c}_try_cast" for c in _TYPES), "page_format", "seen_at_plausibility", "spent_range", "row_duplicate", "key_duplicate")
CHECKED = RAW + f""", typed AS (SELECT *, op = 'D' AS gone, {_CASTS},
  CASE lower(trim(member)) WHEN 'yes' THEN true WHEN 'true' THEN true WHEN 'no' THEN false END AS t_member FROM raw),
flagged AS (SELECT *, {_MISFITS},
  (visit IS NULL OR trim(visit) = '') AS visit_null_key,
  NOT gone AND (visitor IS NULL OR trim(visitor) = '') AS visitor_null_key,
  coalesce(trim(action) NOT IN ('purchase', 'signup', 'view', 'click'), false) AS action_domain,
  coalesce(NOT gone AND trim(page) <> '' AND NOT regexp_full_match(trim(page), '[a-z]{{2}}-[0-9]+'), false) AS page_format,
  coalesce(t_spent < 0 OR t_spent > 85, false) AS spent_range,
  coalesce(t_seen_on > DATE '2024-02-01', false) AS seen_on_plausibility,
  coalesce(t_seen_at > TIMESTAMP '2024-02-01 01:30:00', false) AS seen_at_plausibility,
  row_number() OVER (PARTITION BY {_LANDED} ORDER BY _ingestion_order) > 1 AS row_duplicate FROM typed),
checked AS (SELECT *, NOT visit_null_key AND NOT row_duplicate AND sum(CASE WHEN row_duplicate THEN 0 ELSE 1 END) OVER (PARTITION BY visit) > 1 AS key_duplicate FROM flagged),
reasoned AS (SELECT *, list_sort(list_filter([""" + ", ".join(f"CASE WHEN {c} THEN '{c}' END" for c in _REASONS) + "], lambda x : x IS NOT NULL)) AS reason FROM checked)"


def _validated(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dq.validate(derive(spark, sf_dir, inputs.RAW), inputs.RULES, inputs.AS_OF)


def _rule_query(name: str, rule: str) -> None:
    flags = [r for r in inputs.RULES.rules if r.rule == rule]
    parts = " UNION ALL ".join(f"SELECT _ingestion_order, '{r.reason}' AS reason FROM checked WHERE {r.reason}" for r in flags)

    @query(name, f"WITH {CHECKED} {parts}")
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        """Rows that break the rule; only the columns under it are typed, and nothing is shuffled."""
        found = [F.when(dq.rule_violation(r, inputs.RULES, inputs.AS_OF), F.lit(r.reason)) for r in flags]
        return derive(spark, sf_dir, inputs.RAW).select("_ingestion_order", F.explode(F.array_compact(F.array(*found))).alias("reason"))


for _rule in ("null_key", "try_cast", "domain", "format", "range", "plausibility"):
    _rule_query(f"dq_{_rule}", _rule)


@query("dq_reason_array", f"WITH {CHECKED} SELECT _ingestion_order, array_to_string(reason, '|') AS reason FROM reasoned")
def dq_reason_array(spark, sf_dir):
    return _validated(spark, sf_dir).select("_ingestion_order", F.concat_ws("|", "reason").alias("reason"))


@query("dq_delete_suppression", f"WITH {CHECKED} SELECT _ingestion_order, array_to_string(reason, '|') AS reason, page_format, visitor_null_key FROM reasoned WHERE op = 'D'")
def dq_delete_suppression(spark, sf_dir):
    return _validated(spark, sf_dir).where("op = 'D'").select("_ingestion_order", F.concat_ws("|", "reason").alias("reason"), F.col("_is_page_format").alias("page_format"), F.col("_is_visitor_null_key").alias("visitor_null_key"))


for _kind in ("row", "key"):
    QUERIES[f"dq_{_kind}_duplicate"] = lambda spark, sf_dir, k=_kind: dq.flag_duplicates(derive(spark, sf_dir, inputs.RAW), list(inputs.CONTRACT.columns), inputs.CONTRACT.identity).where(f"_is_{k}_duplicate").select("_ingestion_order", "visit")
    SQL[f"dq_{_kind}_duplicate"] = f"WITH {CHECKED} SELECT _ingestion_order, visit FROM checked WHERE {_kind}_duplicate"


@query("dq_lineitem_key_duplicate", "WITH d AS (SELECT DISTINCT l_orderkey, l_suppkey, l_linenumber FROM lineitem) SELECT CAST(l_orderkey AS VARCHAR) AS l_orderkey, CAST(l_suppkey AS VARCHAR) AS l_suppkey, count(*) AS copies FROM d GROUP BY ALL HAVING count(*) > 1")
def dq_lineitem_key_duplicate(spark, sf_dir):
    """Lines whose order and supplier are not theirs alone, by the operator, on a composite identity."""
    rows = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select("l_orderkey", "l_suppkey", "l_linenumber")
    rows = rows.select(*(F.col(c).cast("string").alias(c) for c in rows.columns))
    found = dq.flag_duplicates(rows, list(rows.columns), ("l_orderkey", "l_suppkey"), "l_linenumber")
    return found.where("_is_key_duplicate").groupBy("l_orderkey", "l_suppkey").agg(F.count(F.lit(1)).alias("copies"))


@query("dq_valid", f"WITH {CHECKED} SELECT _ingestion_order, t_visit AS visit, t_visitor AS visitor, action, page, t_spent AS spent, t_member AS member, t_seen_on AS seen_on, t_seen_at AS seen_at, op FROM reasoned WHERE len(reason) = 0")
def dq_valid(spark, sf_dir):
    valid, _ = dq.split(_validated(spark, sf_dir), inputs.RULES, ("_ingestion_order",))
    return valid.withColumn("seen_at", F.col("seen_at").cast("timestamp_ntz"))


@query("dq_quarantine", f"WITH {CHECKED} SELECT _ingestion_order, {_LANDED}, array_to_string(reason, '|') AS reason FROM reasoned WHERE len(reason) > 0")
def dq_quarantine(spark, sf_dir):
    _, bad = dq.split(_validated(spark, sf_dir), inputs.RULES, ("_ingestion_order",))
    return bad.withColumn("reason", F.concat_ws("|", "reason"))


_METRICS = [(r.rule, r.column, r.severity, r.reason, "count_if(NOT gone)" if dq.suppressible(r, inputs.RULES) else "count(*)") for r in inputs.RULES.rules]
_METRICS += [(f"{k}_duplicate", k, "quarantine", f"{k}_duplicate", "count(*)") for k in ("row", "key")]


@query("dq_metrics", f"WITH {CHECKED} " + " UNION ALL ".join(f"SELECT 'visits' AS source, '{a}' AS rule, '{b}' AS \"column\", '{s}' AS severity, CAST({e} AS BIGINT) AS evaluated, CAST(count_if({v}) AS BIGINT) AS violations FROM checked" for a, b, s, v, e in _METRICS))
def dq_metrics(spark, sf_dir):
    return dq.metrics(_validated(spark, sf_dir), inputs.RULES)


@query("dq_conservation", f"WITH {CHECKED} SELECT 'visits' AS source, count(*) AS input_rows, CAST(count_if(len(reason) = 0) AS BIGINT) AS valid_rows, CAST(count_if(len(reason) > 0) AS BIGINT) AS quarantine_rows, (SELECT count(*) FROM raw) = count_if(len(reason) = 0) + count_if(len(reason) > 0) AS conserved FROM reasoned")
def dq_conservation(spark, sf_dir):
    return dq.summary(_validated(spark, sf_dir), "visits")


@query("reason_counts", f"WITH {CHECKED} SELECT u AS reason, count(*) AS rows FROM (SELECT unnest(reason) AS u FROM reasoned) GROUP BY u")
def reason_counts(spark, sf_dir):
    _, bad = dq.split(_validated(spark, sf_dir), inputs.RULES)
    return dq.reason_counts(bad)


@query("rescue_rate", "SELECT count(*) AS rows, count_if(event_id % 9 = 0) AS rescued, count_if(event_id % 9 = 0) * 100.0::DOUBLE / count(*) AS rescued_pct, count_if(event_id % 9 = 0) * 100.0::DOUBLE / count(*) > 10 AS tripped FROM events")
def rescue_rate(spark, sf_dir):
    rows = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.when(F.col("event_id") % 9 == 0, F.lit("{}")).alias("_rescued_data"))
    return dq.rescue_rate(rows, 10)


# ---- change data

SPEC = cdc.CdcSpec(("user_id",), ("change_ts", "change_seq"), "op")
EVENTS = f"""ch AS ({duck(inputs.CHANGES)}), ev AS (SELECT user_id, change_ts, change_seq, CASE WHEN op = 'D' THEN 'D' ELSE 'U' END AS _op, kind, amount FROM ch),
uniq AS (SELECT DISTINCT * FROM ev),
ranked AS (SELECT *, row_number() OVER (PARTITION BY user_id, change_ts, change_seq ORDER BY _op DESC,
  '{{"amount":' || coalesce(CAST(amount AS VARCHAR), 'null') || ',"kind":' || coalesce('"' || kind || '"', 'null') || '}}' DESC) AS rk FROM uniq),
win AS (SELECT * EXCLUDE rk, _op = 'D' AND coalesce(sum(CASE WHEN _op = 'U' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY change_ts NULLS FIRST, change_seq NULLS FIRST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) = 0 AS orphan FROM ranked WHERE rk = 1),
applied AS (SELECT * EXCLUDE orphan FROM win WHERE NOT orphan)"""
EVENT = "user_id, change_ts, change_seq, _op, kind, amount"


def _changes(spark, sf_dir):
    return derive(spark, sf_dir, inputs.CHANGES)


def _columns(df: DataFrame) -> DataFrame:
    return df.select(*EVENT.split(", "))


@query("cdc_events", f"WITH {EVENTS} SELECT {EVENT} FROM ev")
def cdc_events(spark, sf_dir):
    return _columns(cdc.to_events(_changes(spark, sf_dir), SPEC))


@query("cdc_applied", f"WITH {EVENTS} SELECT {EVENT} FROM applied")
def cdc_applied(spark, sf_dir):
    return _columns(cdc.normalize(_changes(spark, sf_dir), SPEC).applied)


@query("cdc_conflicts", f"WITH {EVENTS} SELECT {EVENT} FROM ranked WHERE rk > 1")
def cdc_conflicts(spark, sf_dir):
    return _columns(cdc.normalize(_changes(spark, sf_dir), SPEC).conflicts)


@query("cdc_orphans", f"WITH {EVENTS} SELECT {EVENT}, orphan AS is_orphan_delete FROM win WHERE orphan")
def cdc_orphans(spark, sf_dir):
    found = cdc.normalize(_changes(spark, sf_dir), SPEC).held_orphans
    return found.select(*EVENT.split(", "), "is_orphan_delete")


@query("cdc_orphans_known", f"WITH {EVENTS} SELECT {EVENT} FROM win WHERE orphan AND user_id % 2 = 1")
def cdc_orphans_known(spark, sf_dir):
    changes = _changes(spark, sf_dir)
    known = changes.where("user_id % 2 = 0").select("user_id")
    return _columns(cdc.normalize(changes, SPEC, known).held_orphans)


@query("cdc_replay_drop", f"WITH {EVENTS} SELECT (SELECT count(*) FROM ev) - (SELECT count(*) FROM uniq) AS replays_dropped")
def cdc_replay_drop(spark, sf_dir):
    return cdc.normalize(_changes(spark, sf_dir), SPEC).replays


@query("cdc_unify", "SELECT 'EVENTS' AS source_system, count(*) AS n, count(DISTINCT user_id) AS keys FROM events UNION ALL SELECT 'SNAPSHOT', count(*), count(DISTINCT c_custkey) FROM customer")
def cdc_unify(spark, sf_dir):
    snap = spark.read.parquet(f"{sf_dir}/customer.parquet").select(F.col("c_custkey").alias("user_id"))
    snap = cdc.snapshot_events(snap, {"change_ts": F.lit(None).cast("timestamp_ntz")}, "SNAPSHOT")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", F.lit("U").alias("_op"), F.col("ts").alias("change_ts"), F.lit("EVENTS").alias("source_system"))
    return cdc.unify(events, snap).groupBy("source_system").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("user_id").alias("keys"))


# ---- history

SEQ, ATTR = ["change_ts", "change_seq"], ["kind", "amount"]
HISTORY = (
    EVENTS
    + """, states AS (SELECT user_id, change_ts, change_seq, kind, amount, _op = 'D' AS is_deleted, CASE WHEN _op = 'D' THEN '' ELSE concat(amount, '/', kind) END AS content FROM applied),
kept AS (SELECT * FROM (SELECT *, lag(content) OVER w AS before FROM states WINDOW w AS (PARTITION BY user_id ORDER BY change_ts NULLS FIRST, change_seq NULLS FIRST)) WHERE content IS DISTINCT FROM before OR before IS NULL),
hist AS (SELECT user_id, change_ts, change_seq, kind, amount, is_deleted, lead(change_ts) OVER w AS _to_change_ts, lead(change_seq) OVER w AS _to_change_seq, lead(1) OVER w IS NULL AS _is_terminal,
  lead(1) OVER w IS NULL AND NOT is_deleted AS is_current FROM kept WINDOW w AS (PARTITION BY user_id ORDER BY change_ts NULLS FIRST, change_seq NULLS FIRST))"""
)


def _applied(spark, sf_dir):
    return cdc.normalize(_changes(spark, sf_dir), SPEC).applied


def _history(spark, sf_dir):
    return scd2.rebuild(_applied(spark, sf_dir), ["user_id"], SEQ, ATTR)


@query("scd2_history", f"WITH {HISTORY} SELECT * FROM hist")
def scd2_history(spark, sf_dir):
    return _history(spark, sf_dir)


@query("scd2_incremental", f"WITH {HISTORY} SELECT * FROM hist")
def scd2_incremental(spark, sf_dir):
    """The later half merged into the history of the earlier one: the history of the whole."""
    events = _applied(spark, sf_dir)
    early = F.dayofmonth("change_ts") <= 15
    first = scd2.rebuild(events.where(early), ["user_id"], SEQ, ATTR)
    return scd2.rebuild(events.where(~early), ["user_id"], SEQ, ATTR, first)


@query("scd2_current", f"WITH {HISTORY} SELECT * FROM hist WHERE is_current")
def scd2_current(spark, sf_dir):
    return scd2.current(_history(spark, sf_dir))


@query("scd2_tombstones", f"WITH {HISTORY} SELECT user_id, change_ts, change_seq, _is_terminal FROM hist WHERE is_deleted")
def scd2_tombstones(spark, sf_dir):
    return _history(spark, sf_dir).where("is_deleted").select("user_id", *SEQ, "_is_terminal")


@query("scd2_violations", f"WITH {HISTORY} SELECT user_id, 'current_count' AS violation FROM hist WHERE _is_terminal AND NOT is_deleted AND user_id % 7 = 0 UNION ALL SELECT user_id, 'gap_or_overlap' FROM hist WHERE NOT _is_terminal AND user_id % 11 = 0 GROUP BY user_id")
def scd2_violations(spark, sf_dir):
    """A history with currents and ends taken away: what the checks say of it."""
    h = _history(spark, sf_dir)
    broken = h.withColumns({"is_current": F.col("is_current") & (F.col("user_id") % 7 != 0), "_to_change_ts": F.when(F.col("user_id") % 11 != 0, F.col("_to_change_ts"))})
    return scd2.violations(broken, ["user_id"], SEQ)


@query("scd2_record_hash", f"WITH {EVENTS} SELECT user_id, change_ts, change_seq, sha256('{{\"amount\":' || coalesce(CAST(amount AS VARCHAR), 'null') || ',\"kind\":' || coalesce('\"' || kind || '\"', 'null') || '}}') AS record_hash FROM applied")
def scd2_record_hash(spark, sf_dir):
    return _applied(spark, sf_dir).select("user_id", *SEQ, record_hash(ATTR).alias("record_hash"))


@query("one_current", f"WITH {HISTORY} SELECT user_id, count(*) AS currents FROM (SELECT user_id FROM hist WHERE is_current UNION ALL SELECT user_id FROM hist WHERE is_current AND user_id % 5 = 0) GROUP BY user_id HAVING count(*) > 1")
def one_current(spark, sf_dir):
    h = _history(spark, sf_dir)
    return audit.many_current(h.unionByName(h.where("is_current and user_id % 5 = 0")), ["user_id"])


# ---- gold

ORDERS = f"""oe AS ({duck(inputs.ORDER_EVENTS)}),
life AS (SELECT order_id, bool_or(event_type = 'CANCELLED') AS cancelled, bool_or(event_type = 'PAID') AS has_paid, arg_max(event_type, (event_ts, _ingestion_order)) AS last_type,
  arg_max({{'customer_id': customer_id, 'store_id': store_id, 'product_id': product_id, 'quantity': quantity, 'unit_price': unit_price, 'currency': currency, 'event_ts': event_ts}}, (event_ts, _ingestion_order)) FILTER (event_type = 'PAID') AS paid FROM oe GROUP BY order_id),
facts AS (SELECT order_id, cancelled, has_paid, paid.customer_id AS customer_id, paid.store_id AS store_id, paid.product_id AS product_id, CAST(paid.event_ts AS DATE) AS sale_date, paid.quantity AS quantity,
  coalesce(nullif(trim(paid.currency), ''), 'USD') AS currency, TRY_CAST(paid.unit_price AS DECIMAL(18,2)) * paid.quantity AS amount_local FROM life),
rated AS (SELECT *, CASE WHEN currency = 'THB' AND sale_date >= DATE '1999-01-01' THEN 36 WHEN currency = 'THB' AND sale_date >= DATE '1995-06-01' THEN 35 END AS rate, CAST(amount_local * 100 AS BIGINT) AS cents FROM facts),
priced AS (SELECT *, CASE WHEN currency = 'USD' THEN CAST(amount_local AS DECIMAL(18,2)) ELSE CAST(CAST((2 * cents + rate) // (2 * rate) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) END AS amount_base FROM rated),
judged AS (SELECT *, CASE WHEN cancelled THEN 'cancelled' WHEN NOT has_paid THEN 'not_paid' WHEN amount_local IS NULL OR sale_date IS NULL THEN 'missing_amounts' WHEN amount_base IS NULL THEN 'unpriced_missing_fx' END AS exclusion_reason FROM priced),
lines AS (SELECT order_id, customer_id, store_id, product_id, sale_date, quantity, currency, CAST(amount_local AS DECIMAL(18,2)) AS amount_local, amount_base FROM judged WHERE exclusion_reason IS NULL)"""
FACTS = (
    ORDERS
    + f""", versions AS ({duck(inputs.PRODUCTS)}),
ph AS (SELECT product_id, effective_date, lead(effective_date) OVER (PARTITION BY product_id ORDER BY effective_date) AS until, category, unit_price AS list_price FROM versions),
sales AS (SELECT l.*, p.category, p.list_price FROM lines l LEFT JOIN ph p ON l.product_id = p.product_id AND l.sale_date >= p.effective_date AND (p.until IS NULL OR l.sale_date < p.until)),
st AS ({inputs.STORES}), regional AS (SELECT s.*, st.region FROM sales s LEFT JOIN st ON s.store_id = st.store_id)"""
)


def _orders(spark, sf_dir):
    return derive(spark, sf_dir, inputs.ORDER_EVENTS)


def _lines(spark, sf_dir):
    return gold.revenue_lines(_orders(spark, sf_dir), inputs.RATES)[0]


def _product_history(spark, sf_dir):
    rows = derive(spark, sf_dir, inputs.PRODUCTS)
    return scd2.rebuild(rows.withColumn("_op", F.lit("U")), ["product_id"], ["effective_date", "_ingestion_order"], ["category", "unit_price"])


def _sales(spark, sf_dir):
    return gold.with_product_asof(_lines(spark, sf_dir), _product_history(spark, sf_dir))


def _regional(spark, sf_dir):
    return gold.with_region(_sales(spark, sf_dir), derive(spark, sf_dir, inputs.STORES))


@query("lifecycle", f"WITH {ORDERS} SELECT order_id, cancelled, has_paid, has_paid AND NOT cancelled AS eligible, CASE WHEN cancelled THEN 'CANCELLED' ELSE last_type END AS terminal_state, paid.unit_price AS paid_price FROM life")
def lifecycle(spark, sf_dir):
    return gold.resolve_lifecycle(_orders(spark, sf_dir)).select("order_id", "cancelled", "has_paid", "eligible", "terminal_state", F.col("paid.unit_price").alias("paid_price"))


@query("revenue_lines", f"WITH {ORDERS} SELECT * FROM lines")
def revenue_lines(spark, sf_dir):
    return _lines(spark, sf_dir)


@query("revenue_excluded", f"WITH {ORDERS} SELECT order_id, exclusion_reason FROM judged WHERE exclusion_reason IS NOT NULL")
def revenue_excluded(spark, sf_dir):
    return gold.revenue_lines(_orders(spark, sf_dir), inputs.RATES)[1]


@query("revenue_total", f"WITH {ORDERS} SELECT CAST(sum(amount_base) AS DECIMAL(28,2)) AS total_base FROM lines")
def revenue_total(spark, sf_dir):
    return gold.revenue_total(_lines(spark, sf_dir))


@query("fx_convert", """WITH x AS (SELECT o_orderkey, CAST(floor(o_totalprice * 10) AS BIGINT) AS cents, CASE WHEN o_orderkey % 3 = 0 THEN 'USD' WHEN o_orderkey % 3 = 1 THEN 'THB' ELSE 'EUR' END AS currency, CAST(o_orderdate AS DATE) AS d FROM orders),
r AS (SELECT *, CASE WHEN currency = 'THB' AND d >= DATE '1999-01-01' THEN 36 WHEN currency = 'THB' AND d >= DATE '1995-06-01' THEN 35 END AS rate FROM x)
SELECT o_orderkey, currency, CASE WHEN currency = 'USD' THEN CAST(CAST(cents AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) ELSE CAST(CAST((2 * cents + rate) // (2 * rate) AS DECIMAL(18,0)) / 100 AS DECIMAL(18,2)) END AS amount_base FROM r""")
def fx_convert(spark, sf_dir):
    o = spark.read.parquet(f"{sf_dir}/orders.parquet")
    currency = F.when(F.col("o_orderkey") % 3 == 0, "USD").when(F.col("o_orderkey") % 3 == 1, "THB").otherwise("EUR")
    cents = F.floor(F.col("o_totalprice") * 10).cast("decimal(18,0)")
    o = o.select("o_orderkey", currency.alias("currency"), (cents / 100).cast("decimal(18,2)").alias("amount"), F.to_date("o_orderdate").alias("d"))
    return gold.convert(o, inputs.RATES, "amount", "currency", "d").select("o_orderkey", "currency", "amount_base")


@query("asof_product", f"WITH {FACTS} SELECT order_id, product_id, sale_date, category, list_price FROM sales")
def asof_product(spark, sf_dir):
    return _sales(spark, sf_dir).select("order_id", "product_id", "sale_date", "category", "list_price")


@query("fct_sales", f"WITH {FACTS} SELECT * FROM sales")
def fct_sales(spark, sf_dir):
    return _sales(spark, sf_dir)


def _sum_sql(dims: list[str], where: str = "true") -> str:
    keys = ", ".join(f"coalesce(CAST({d} AS VARCHAR), 'UNKNOWN') AS {d}" for d in dims)
    return f"WITH {FACTS} SELECT {keys}, CAST(sum(amount_base) AS DECIMAL(28,2)) AS total, count(*) AS row_count FROM regional WHERE {where} GROUP BY ALL"


@query("daily_by_region", _sum_sql(["sale_date", "region"]))
def daily_by_region(spark, sf_dir):
    return gold.daily_sum(_regional(spark, sf_dir), ["sale_date", "region"])


@query("daily_by_store", _sum_sql(["sale_date", "store_id"]))
def daily_by_store(spark, sf_dir):
    return gold.daily_sum(_sales(spark, sf_dir), ["sale_date", "store_id"])


@query("segment_agg", _sum_sql(["sale_date", "region"], "currency = 'THB'"))
def segment_agg(spark, sf_dir):
    return gold.segment_sum("currency", "THB", ["sale_date", "region"])(_regional(spark, sf_dir))


@query("unknown_bucket", _sum_sql(["region", "category"]))
def unknown_bucket(spark, sf_dir):
    return gold.daily_sum(_regional(spark, sf_dir), ["region", "category"])


@query("aggregate_conservation", f"""WITH {FACTS}, g AS (SELECT region, sum(amount_base) AS t FROM regional GROUP BY region),
s AS (SELECT (SELECT CAST(sum(t) AS DECIMAL(38,2)) FROM g) AS whole, (SELECT CAST(sum(t) AS DECIMAL(38,2)) FROM g WHERE region <> 'ASIA') AS part, (SELECT CAST(sum(amount_base) AS DECIMAL(38,2)) FROM lines) AS input_total)
SELECT 'whole' AS case_, whole AS groups_total, input_total, whole = input_total AS conserved FROM s UNION ALL SELECT 'part', part, input_total, part = input_total FROM s""")
def aggregate_conservation(spark, sf_dir):
    """All groups, and groups of which some are lost, against the lines they came from."""
    lines = _lines(spark, sf_dir)
    groups = gold.daily_sum(_regional(spark, sf_dir), ["region"])
    cases = (("whole", groups), ("part", groups.where("region not in ('ASIA', 'UNKNOWN')")))
    a, b = (gold.conservation(g, lines).withColumn("case_", F.lit(n)) for n, g in cases)
    return a.unionByName(b)


FUNNEL = f"""act AS ({inputs.ACTIVITY}), pur AS ({inputs.PURCHASES}),
ses AS (SELECT session_id, arg_min(customer_id, (activity_ts, _ingestion_order)) FILTER (customer_id IS NOT NULL) AS customer_id,
  max(CASE WHEN activity_type = 'ADD_TO_CART' THEN 2 WHEN activity_type IN ('PAGE_VIEW', 'SEARCH', 'WISHLIST') THEN 1 ELSE 0 END) AS stage,
  max(activity_ts) FILTER (activity_type = 'ADD_TO_CART') AS last_add, max(activity_ts) FILTER (activity_type = 'REMOVE_FROM_CART') AS last_remove,
  count(*) - count(DISTINCT activity_type) - CAST(bool_or(activity_type IS NULL) AS INT) AS dup, min(activity_ts) AS first_ts FROM act GROUP BY session_id),
won AS (SELECT s.session_id, arg_min(p.order_id, (p.event_ts, p.order_id)) AS converting_order_id FROM ses s JOIN pur p ON s.customer_id = p.customer_id AND p.event_ts BETWEEN s.last_add AND s.last_add + INTERVAL 24 HOUR GROUP BY s.session_id),
fs AS (SELECT s.session_id, s.customer_id, CASE WHEN w.session_id IS NOT NULL THEN 3 ELSE s.stage END AS stage, w.session_id IS NOT NULL AS converted, coalesce(last_remove > last_add, false) AS cart_regressed,
  dup AS duplicate_stage_events, converting_order_id, last_add AS last_cart_add_ts, CAST(coalesce(last_add, first_ts) AS DATE) AS session_date FROM ses s LEFT JOIN won w ON s.session_id = w.session_id)"""


def _sessions(spark, sf_dir):
    return gold.funnel_sessions(derive(spark, sf_dir, inputs.ACTIVITY), derive(spark, sf_dir, inputs.PURCHASES))


@query("funnel_sessions", f"WITH {FUNNEL} SELECT * FROM fs")
def funnel_sessions(spark, sf_dir):
    return _sessions(spark, sf_dir)


@query("funnel_daily", f"WITH {FUNNEL} SELECT session_date, count(*) AS sessions, count_if(stage >= 2) AS carted, count_if(converted) AS converted FROM fs GROUP BY session_date")
def funnel_daily(spark, sf_dir):
    return gold.funnel_daily(_sessions(spark, sf_dir))


@query("funnel_metrics", f"WITH {FUNNEL} SELECT count(*) AS sessions, count_if(stage >= 1) AS browsed, count_if(stage >= 2) AS carted, count_if(converted) AS converted, CAST(round_even(count_if(converted)::DOUBLE / nullif(count_if(stage >= 2), 0), 4) AS DECIMAL(10,4)) AS conversion_rate FROM fs")
def funnel_metrics(spark, sf_dir):
    return gold.funnel_metrics(_sessions(spark, sf_dir))


# ---- files, times, audit


@query("lateness", "SELECT event_id, CASE WHEN ts < TIMESTAMP '2024-02-01' - INTERVAL 7 DAY THEN 'beyond_window' ELSE 'in_window' END AS _lateness FROM events")
def late(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet")
    return e.select("event_id", lateness(F.col("ts"), F.lit("2024-02-01").cast("timestamp_ntz"), 7).alias("_lateness"))


_NAME = r"^([A-Za-z][A-Za-z_]*?)_(\d{8})_(\d{6})_(\d+)\.(\w+)$"


@query("filename_parse", f"""WITH n AS ({inputs.NAMES}), t AS (SELECT *, try_strptime(regexp_extract(name, '{_NAME}', 2) || regexp_extract(name, '{_NAME}', 3), '%Y%m%d%H%M%S') AS batch_ts FROM n)
SELECT event_id, CASE WHEN batch_ts IS NOT NULL THEN regexp_extract(name, '{_NAME}', 1) END AS source, batch_ts, CASE WHEN batch_ts IS NOT NULL THEN TRY_CAST(regexp_extract(name, '{_NAME}', 4) AS INT) END AS sequence, CASE WHEN batch_ts IS NOT NULL THEN regexp_extract(name, '{_NAME}', 5) END AS extension FROM t""")
def filename_parse(spark, sf_dir):
    out = derive(spark, sf_dir, inputs.NAMES).withColumns(files.name_columns(F.col("name")))
    return out.drop("name").withColumn("batch_ts", F.col("batch_ts").cast("timestamp_ntz"))


@query("batch_date", f"WITH n AS ({inputs.NAMES}) SELECT event_id, CAST(try_strptime(regexp_extract(name, '_(\\d{{8}})_', 1), '%Y%m%d') AS DATE) AS _batch_date FROM n")
def batch_dates(spark, sf_dir):
    return derive(spark, sf_dir, inputs.NAMES).select("event_id", files.batch_date(F.col("name")).alias("_batch_date"))


@query("file_identity", "SELECT event_id, CASE event_id % 3 WHEN 0 THEN '' WHEN 1 THEN '/' ELSE '../' END || 'orders/' || CAST(event_id AS VARCHAR) || '.json' AS file FROM events")
def file_identities(spark, sf_dir):
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id")
    start = F.when(F.col("event_id") % 3 == 0, " landing/.././/orders///").when(F.col("event_id") % 3 == 1, "/../landing/..//orders/").otherwise("../x/../orders//")
    return e.select("event_id", files.identity_column(F.concat(start, F.col("event_id").cast("string"), F.lit(".json "))).alias("file"))


@query("ingestion_order", f"WITH n AS ({inputs.NAMES}) SELECT event_id, name || '#' || lpad(CAST(event_id AS VARCHAR), 9, '0') AS _ingestion_order FROM n")
def ingestion_orders(spark, sf_dir):
    return derive(spark, sf_dir, inputs.NAMES).select("event_id", ingestion_order(F.col("name"), F.col("event_id")).alias("_ingestion_order"))


# ---- landed files


@query("bronze_csv", """SELECT CASE WHEN c_custkey % 3 < 2 THEN CAST(c_custkey AS VARCHAR) END AS person,
  CASE WHEN c_custkey % 3 = 0 AND c_custkey % 5 = 0 THEN c_name || ', "' || c_mktsegment || '"' || chr(10) || 'of ' || CAST(c_custkey AS VARCHAR) ELSE c_name END AS name, c_mktsegment AS segment, CAST(c_custkey AS VARCHAR) AS _ingestion_order,
  DATE '2026-06-01' + CAST(c_custkey % 3 AS INTEGER) AS _batch_date, CASE c_custkey % 3 WHEN 1 THEN '{"x1":"first","x30":"last"}' WHEN 2 THEN '{"name#3":"again","#5":"beyond"}' END AS _rescued_data FROM customer""")
def bronze_csv(spark, sf_dir):
    folder = scratch(spark, "landing")
    landed.land_people(spark, sf_dir, folder)
    return files.read_csv(spark, folder, landed.PEOPLE).select("person", "name", "segment", "_ingestion_order", "_batch_date", "_rescued_data")


@query("bronze_flow", """SELECT CASE WHEN p_partkey % 50 <> 1 THEN CAST(p_partkey AS VARCHAR) END AS good, CASE WHEN p_partkey % 50 <> 1 AND p_partkey % 6 <> 0 THEN p_name END AS label, CASE WHEN p_partkey % 50 <> 1 THEN CAST(p_size AS VARCHAR) END AS size,
  CASE WHEN p_partkey % 50 = 1 THEN '{"_corrupt":"{\\"good\\": ' || CAST(p_partkey AS VARCHAR) || '"}' WHEN p_partkey % 4 = 0 THEN '{"colour":"red"}' END AS _rescued_data, CASE WHEN p_partkey % 2 = 1 THEN DATE '2026-06-01' ELSE DATE '2026-06-02' END AS _batch_date
  FROM part WHERE p_partkey % 50 <> 2""")
def bronze_flow(spark, sf_dir):
    """Two emitters into one table, run after each day's landing and once more: every row once."""
    root = scratch(spark, "flow")
    w = Warehouse(spark, f"{root}/warehouse")
    for day in (1, 2, 2):
        landed.land_goods(spark, sf_dir, f"{root}/landing", day)
        bronze.ingest(spark, f"{root}/landing", w, {"goods": landed.GOODS_SOURCE}, {"goods": landed.GOODS}, f"{root}/checkpoints")
    return bronze.read_bronze(w, "goods").select("good", "label", "size", "_rescued_data", "_batch_date")


@query("run_audit", f"""WITH {CHECKED} SELECT 'r1' AS run_id, 'visits' AS source, 'dev' AS environment, (SELECT count(*) FROM raw) AS bronze_rows, count_if(len(reason) = 0) AS valid_rows, count_if(len(reason) > 0) AS quarantine_rows, true AS conserved,
  count_if(row_duplicate) AS row_duplicates FROM reasoned""")
def run_audit(spark, sf_dir):
    """A run recorded twice is there once, beside the metrics of its rules."""
    w = Warehouse(spark, scratch(spark, "audit"))
    checked = w.refresh("silver", "visits", _validated(spark, sf_dir))
    valid, bad = dq.split(checked, inputs.RULES)
    counts = audit.reconcile(derive(spark, sf_dir, inputs.RAW), valid, bad, "visits")
    for _ in range(2):
        audit.record_run(w, audit.new_run(run_id="r1"), counts, [dq.metrics(checked, inputs.RULES)])
    copies = w.read("ops", "dq_results").where("rule = 'row_duplicate'").select("run_id", F.col("violations").alias("row_duplicates"))
    return w.read("ops", "pipeline_runs").select("run_id", "source", "environment", "bronze_rows", "valid_rows", "quarantine_rows", "conserved").join(copies, "run_id")


@query("batch_order", f"WITH n AS ({inputs.NAMES}) SELECT event_id, CAST(7 AS INTEGER) AS batch_seq, event_id AS position FROM n")
def batch_order(spark, sf_dir):
    rows = derive(spark, sf_dir, inputs.NAMES).select("event_id", F.col("event_id").cast("string").alias("_ingestion_order"))
    return files.with_batch_order(rows, 7).select("event_id", "_order.batch_seq", "_order.position")


@query("cdc_metadata", f"WITH ch AS ({duck(inputs.CHANGES)}) SELECT _ingestion_order, op AS _op, change_ts AS at, change_seq AS seq FROM ch")
def cdc_metadata(spark, sf_dir):
    return cdc.with_metadata(_changes(spark, sf_dir), SPEC).select("_ingestion_order", "_op", F.col("_sequence.change_ts").alias("at"), F.col("_sequence.change_seq").alias("seq"))


@query("reconciliation", f"""WITH {CHECKED}, n AS (SELECT 's' || CAST(k AS VARCHAR) AS source, (SELECT count(*) FROM raw) AS bronze_rows, count_if(len(reason) = 0) AS valid_rows, count_if(len(reason) > 0 AND (k = 0 OR src_id NOT LIKE '%7')) AS quarantine_rows
  FROM reasoned, (SELECT unnest([0, 1]) AS k) GROUP BY k) SELECT *, bronze_rows = valid_rows + quarantine_rows AS conserved FROM n""")
def reconciliation(spark, sf_dir):
    """A source that is conserved, and one whose quarantine lost rows."""
    raw, (valid, bad) = derive(spark, sf_dir, inputs.RAW), dq.split(_validated(spark, sf_dir), inputs.RULES, ("src_id",))
    return audit.reconcile(raw, valid, bad, "s0").unionByName(audit.reconcile(raw, valid, bad.where("src_id not like '%7'"), "s1"))


@query("invariants", f"WITH {HISTORY} SELECT 'dim_user' AS subject, CAST(user_id AS VARCHAR) AS key, 'current_count' AS violation FROM hist WHERE _is_terminal AND NOT is_deleted AND user_id % 7 = 0 UNION ALL SELECT 'lost', NULL, 'not_conserved'")
def invariants(spark, sf_dir):
    """A history with currents taken away, a source that is conserved, and one that lost a region's nations."""
    h = _history(spark, sf_dir).withColumn("is_current", F.col("is_current") & (F.col("user_id") % 7 != 0))
    n = spark.read.parquet(f"{sf_dir}/nation.parquet")
    low, high = n.where("n_regionkey < 2"), n.where("n_regionkey >= 2")
    kept = audit.reconcile(n, low, high, "kept").unionByName(audit.reconcile(n, low, high.where("n_regionkey <> 3"), "lost"))
    return audit.invariants(kept, {"dim_user": (h, ["user_id"], SEQ)})


@query("batch_fingerprint")
def batch_fingerprint(spark, sf_dir):
    return files.fingerprint(spark.read.parquet(f"{sf_dir}/customer.parquet").select("c_custkey", "c_name", "c_mktsegment"))


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
