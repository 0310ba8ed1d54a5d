from datetime import date, datetime, timezone
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from silverlode.functions.values import lateness
from silverlode.operators import gold
from silverlode.plans.config import Rate

RATES = [Rate("THB", date(2026, 1, 1), Decimal("35")), Rate("THB", date(2026, 6, 1), Decimal("36"))]
EVENTS = "event_id string, order_id bigint, event_type string, customer_id bigint, store_id int, product_id bigint, quantity int, unit_price string, currency string, event_ts timestamp, _ingestion_order string"


def ts(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def order(n, kind, at, quantity=1, price="10.00", currency="USD", i="0"):
    return (f"e{n}{kind}{i}", n, kind, 1, 1, 7, quantity, price, currency, at and ts(at), i)


def test_orders(spark):
    rows = [
        order(101, "PLACED", "2026-06-01T10:00"), order(101, "PAID", "2026-06-01T11:00", 2), order(101, "SHIPPED", "2026-06-02T10:00"),
        order(102, "PAID", "2026-06-01T11:00"), order(102, "CANCELLED", "2026-06-01T09:00"), order(103, "PLACED", "2026-06-01T11:00"),
        order(104, "PAID", "2026-06-06T11:00", 1, "100.00", "THB"), order(105, "PAID", "2026-06-01T11:00", None), order(106, "PAID", "2026-06-01T11:00", 1, "5", "EUR"),
        order(107, "PAID", None), order(108, "PAID", "2026-06-01T11:00", 1, "1.00", ""), order(109, "PAID", "2026-06-01T11:00", 1, "1.00"), order(109, "PAID", "2026-06-01T12:00", 1, "3.00"),
        order(110, None, "2026-06-01T11:00"), order(111, "PAID", "2025-06-01T11:00", 1, "5", "THB"),
    ]
    lines, out = gold.revenue_lines(spark.createDataFrame(rows, EVENTS), RATES)
    assert {r["order_id"]: str(r["amount_base"]) for r in lines.collect()} == {101: "20.00", 104: "2.78", 108: "1.00", 109: "3.00"}
    assert {r["order_id"]: r["exclusion_reason"] for r in out.collect()} == {102: "cancelled", 103: "not_paid", 105: "missing_amounts", 106: "unpriced_missing_fx", 107: "missing_amounts", 110: "not_paid", 111: "unpriced_missing_fx"}


def test_half_cents_go_up(spark):
    df = spark.createDataFrame([(Decimal(n) / 100, "THB", date(2026, 2, 1)) for n in range(1, 4000)], "a decimal(18,2), c string, d date")
    got = {r["a"]: r["amount_base"] for r in gold.convert(df, RATES, "a", "c", "d").collect()}
    assert all(v == (a / 35).quantize(Decimal("0.01"), "ROUND_HALF_UP") for a, v in got.items())


def test_rate_lookup():
    assert gold.lookup_rate(RATES, "THB", date(2026, 5, 31)) == 35 and gold.lookup_rate(RATES, "THB", date(2026, 6, 1)) == 36
    with pytest.raises(LookupError):
        gold.lookup_rate(RATES, "THB", date(2025, 1, 1))


@pytest.mark.parametrize("broadcast", [True, False])
def test_product_asof(spark, broadcast):
    lines = spark.createDataFrame([(1, date(2026, 3, 1)), (1, date(2026, 6, 1)), (1, date(2025, 1, 1)), (2, date(2026, 3, 1))], "product_id bigint, sale_date date")
    products = spark.createDataFrame([(1, date(2026, 1, 1), date(2026, 6, 1), False, "OLD", Decimal(1)), (1, date(2026, 6, 1), None, True, "NEW", Decimal(2))], "product_id bigint, effective_date date, _to_effective_date date, _is_terminal boolean, category string, unit_price decimal(10,2)")
    got = gold.with_product_asof(lines, products, broadcast).orderBy("product_id", "sale_date").collect()
    assert [r["category"] for r in got] == [None, "OLD", "NEW", None]


def test_daily_sum(spark):
    df = spark.createDataFrame([("N", "d1", Decimal("1.25")), (None, "d1", Decimal("7.00")), ("N", "d1", None), ("S", "d2", Decimal("2.00"))], "region string, sale_date string, amount_base decimal(18,2)")
    got = {(r["sale_date"], r["region"]): (str(r["total"]), r["row_count"]) for r in gold.daily_sum(df, ["sale_date", "region"]).collect()}
    assert got == {("d1", "N"): ("1.25", 2), ("d1", "UNKNOWN"): ("7.00", 1), ("d2", "S"): ("2.00", 1)}
    assert gold.conservation(gold.daily_sum(df, ["region"]), df).first()["conserved"]
    makers = [gold.segment_sum("region", v, ["sale_date"]) for v in ("N", "S")]
    assert [m(df).first()["row_count"] for m in makers] == [2, 1]


def test_funnel(spark):
    a = "session_id string, customer_id bigint, activity_type string, activity_ts timestamp, _ingestion_order string"
    t0 = "2026-06-01T10:00"
    rows = [
        ("s1", None, "PAGE_VIEW", ts("2026-06-01T09:00"), "1"), ("s1", 1, "ADD_TO_CART", ts(t0), "2"), ("s2", 2, "ADD_TO_CART", ts(t0), "1"), ("s2", 2, "REMOVE_FROM_CART", ts("2026-06-01T11:00"), "2"),
        ("s3", None, "ADD_TO_CART", ts(t0), "1"), ("s4", 4, "SEARCH", ts(t0), "1"), ("s4", 4, "SEARCH", ts("2026-06-01T12:00"), "2"), ("s5", 5, None, ts(t0), "1"), ("s6", 6, "REMOVE_FROM_CART", ts(t0), "1"), ("s6", 6, "ADD_TO_CART", ts("2026-06-01T10:01"), "2"),
        ("s7", None, "PAGE_VIEW", ts(t0), "1"), ("s7", 8, "ADD_TO_CART", ts("2026-06-02T10:00"), "2"), ("s7", 9, "PAGE_VIEW", ts("2026-06-02T11:00"), "3"),
    ]
    orders = [(1, 50, "2026-06-02T10:00"), (2, 51, "2026-06-02T10:00:01"), (4, 52, "2026-06-01T11:00"), (6, 54, "2026-06-01T12:00"), (6, 53, "2026-06-01T12:00"), (8, 55, "2026-06-02T09:59:59")]
    s = gold.funnel_sessions(spark.createDataFrame(rows, a), spark.createDataFrame([(c, o, ts(t)) for c, o, t in orders], "customer_id bigint, order_id bigint, event_ts timestamp"))
    got = {r["session_id"]: (r["customer_id"], r["stage"], r["converted"], r["cart_regressed"], r["duplicate_stage_events"], r["converting_order_id"]) for r in s.collect()}
    assert got == {
        "s1": (1, 3, True, False, 0, 50), "s2": (2, 2, False, True, 0, None), "s3": (None, 2, False, False, 0, None), "s4": (4, 1, False, False, 1, None),
        "s5": (5, 0, False, False, 0, None), "s6": (6, 3, True, False, 0, 53), "s7": (8, 2, False, False, 1, None),
    }
    m = gold.funnel_metrics(s).first()
    assert (m["sessions"], m["browsed"], m["carted"], m["converted"], str(m["conversion_rate"])) == (7, 6, 5, 2, "0.4000")
    assert str(gold.funnel_metrics(s.limit(0)).first()["conversion_rate"]) == "0.0000"


def test_lateness_edges(spark):
    now = ts("2026-06-08T00:00")
    df = spark.createDataFrame([(ts("2026-06-01T00:00:00"),), (ts("2026-05-31T23:59:59"),), (ts("2027-01-01T00:00"),), (None,)], "t timestamp")
    got = [r[0] for r in df.select(lateness(F.col("t"), F.lit(now), 7)).collect()]
    assert got == ["in_window", "beyond_window", "in_window", "in_window"]
