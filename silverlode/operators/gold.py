"""Gold: order revenue, currency, point-in-time products, daily sums, session funnels."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..plans.config import Rate, parse_rates

BASE_CURRENCY = "USD"
MONEY = "decimal(18,2)"


# ---- currency


def rate_intervals(spark: SparkSession, rates: list[Rate]) -> DataFrame:
    """``(currency, from, to, per_base)``, half-open; few by contract, as each is a configured row."""
    rows, later = [], {}
    for r in sorted(rates, key=lambda r: (r.currency, r.effective_date), reverse=True):
        rows.append((r.currency, r.effective_date, later.get(r.currency), r.per_base))
        later[r.currency] = r.effective_date
    return spark.createDataFrame(rows, "_fx_currency string, _fx_from date, _fx_to date, per_base decimal(10,4)")


def rates_from_records(records: list[dict]) -> list[Rate]:
    return parse_rates(records)


def lookup_rate(rates: list[Rate], currency: str, on: date) -> Decimal:
    """The latest rate at a date; LookupError if there is none."""
    if currency == BASE_CURRENCY:
        return Decimal(1)
    found = [r for r in rates if r.currency == currency and r.effective_date <= on]
    if not found:
        raise LookupError(f"no rate for {currency} on {on}")
    return max(found, key=lambda r: r.effective_date).per_base


def convert(df: DataFrame, rates: list[Rate], amount: str, currency: str, on: str, out: str = "amount_base") -> DataFrame:
    """``df`` with the amount in the base currency, rounded half up once; null where no rate applies."""
    fx = F.broadcast(rate_intervals(df.sparkSession, rates))
    open_ = F.col("_fx_to").isNull() | (F.col(on) < F.col("_fx_to"))
    joined = df.join(fx, (F.col(currency) == F.col("_fx_currency")) & (F.col(on) >= F.col("_fx_from")) & open_, "left")
    exact = F.col(amount).cast(MONEY)
    value = F.when(F.col(currency) == BASE_CURRENCY, exact).otherwise(F.round(exact / F.col("per_base"), 2).cast(MONEY))
    return joined.withColumn(out, value).drop("_fx_currency", "_fx_from", "_fx_to", "per_base")


# ---- orders


def resolve_lifecycle(events: DataFrame, sequence: tuple[str, ...] = ("event_ts", "_ingestion_order")) -> DataFrame:
    """One row per order: ``cancelled``, ``has_paid``, ``eligible``, ``terminal_state`` and ``paid``, the facts of its last payment.

    A cancellation holds wherever it falls in the sequence. One aggregation, no Python.
    """
    last = F.struct(*sequence)
    facts = F.struct(*(c for c in events.columns if c != "order_id"))
    cancelled = F.coalesce(F.bool_or(F.col("event_type") == "CANCELLED"), F.lit(False))
    paid = F.coalesce(F.bool_or(F.col("event_type") == "PAID"), F.lit(False))
    out = events.groupBy("order_id").agg(
        cancelled.alias("cancelled"), paid.alias("has_paid"), F.max_by("event_type", last).alias("_last"),
        F.max_by(F.when(F.col("event_type") == "PAID", facts), F.when(F.col("event_type") == "PAID", last)).alias("paid"),
    )
    return out.select("order_id", "cancelled", "has_paid", (F.col("has_paid") & ~F.col("cancelled")).alias("eligible"), F.when(F.col("cancelled"), "CANCELLED").otherwise(F.col("_last")).alias("terminal_state"), "paid")


def price_orders(events: DataFrame, rates: list[Rate], sequence: tuple[str, ...] = ("event_ts", "_ingestion_order")) -> DataFrame:
    """Every order with its sale columns and ``exclusion_reason``: null for a revenue line."""
    o = resolve_lifecycle(events, sequence)
    price = F.col("paid.unit_price").try_cast(MONEY)
    currency = F.coalesce(F.nullif(F.trim(F.col("paid.currency")), F.lit("")), F.lit(BASE_CURRENCY))
    o = o.select(
        "order_id", "cancelled", "has_paid", "terminal_state", F.col("paid.customer_id").cast("bigint").alias("customer_id"), F.col("paid.store_id").cast("int").alias("store_id"),
        F.col("paid.product_id").cast("bigint").alias("product_id"), F.to_date("paid.event_ts").alias("sale_date"), F.col("paid.quantity").cast("int").alias("quantity"), currency.alias("currency"),
        (price * F.col("paid.quantity")).cast(MONEY).alias("amount_local"),
    )
    o = convert(o, rates, "amount_local", "currency", "sale_date")
    reason = (
        F.when(F.col("cancelled"), "cancelled").when(~F.col("has_paid"), "not_paid")
        .when(F.col("amount_local").isNull() | F.col("sale_date").isNull(), "missing_amounts").when(F.col("amount_base").isNull(), "unpriced_missing_fx")
    )
    return o.withColumn("exclusion_reason", reason)


LINE = ("order_id", "customer_id", "store_id", "product_id", "sale_date", "quantity", "currency", "amount_local", "amount_base")


def revenue_lines(events: DataFrame, rates: list[Rate]) -> tuple[DataFrame, DataFrame]:
    """Lines, and excluded orders with their reason; together all orders."""
    priced = price_orders(events, rates)
    return priced.where("exclusion_reason is null").select(*LINE), priced.where("exclusion_reason is not null").select("order_id", "exclusion_reason")


def revenue_total(lines: DataFrame) -> DataFrame:
    return lines.agg(F.coalesce(F.sum("amount_base"), F.lit(0).cast(MONEY)).alias("total_base"))


def with_product_asof(lines: DataFrame, products: DataFrame, broadcast: bool = False) -> DataFrame:
    """Lines with the category and list price that held on the day of sale; a line without one keeps nulls.

    The join has no hint unless asked for: Spark broadcasts a history that it finds, as planned or as
    measured at run time, under its threshold, and shuffles a larger one.
    """
    history = products.where("not is_deleted") if "is_deleted" in products.columns else products
    p = history.select(F.col("product_id").alias("_pid"), F.col("effective_date").alias("_from"), F.col("_to_effective_date").alias("_to"), F.col("_is_terminal").alias("_end"), "category", F.col("unit_price").alias("list_price"))
    p = F.broadcast(p) if broadcast else p
    held = F.col("_from").isNull() | (F.col("sale_date") >= F.col("_from"))
    return lines.join(p, (F.col("product_id") == F.col("_pid")) & held & (F.col("_end") | (F.col("sale_date") < F.col("_to"))), "left").drop("_pid", "_from", "_to", "_end")


# ---- sums


def daily_sum(df: DataFrame, dims: list[str], amount: str = "amount_base") -> DataFrame:
    """``dims`` as text with an UNKNOWN bucket, ``total`` (a null amount is 0) and ``row_count``."""
    keys = [F.coalesce(F.col(d).cast("string"), F.lit("UNKNOWN")).alias(d) for d in dims]
    kind = df.schema[amount].dataType.simpleString()
    zero = F.lit(0).cast(kind)
    return df.groupBy(*keys).agg(F.sum(F.coalesce(F.col(amount), zero)).alias("total"), F.count(F.lit(1)).alias("row_count"))


def conservation(groups: DataFrame, df: DataFrame, amount: str = "amount_base") -> DataFrame:
    """``(groups_total, input_total, conserved)``."""
    tagged = groups.select(F.lit("g").alias("side"), F.col("total").cast("decimal(38,2)").alias("v")).unionByName(df.select(F.lit("i").alias("side"), F.col(amount).cast("decimal(38,2)").alias("v")))
    zero = F.lit(0).cast("decimal(38,2)")
    out = tagged.agg(*(F.coalesce(F.sum(F.when(F.col("side") == s, F.col("v"))), zero).alias(n) for s, n in (("g", "groups_total"), ("i", "input_total"))))
    return out.withColumn("conserved", F.col("groups_total") == F.col("input_total"))


def segment_sum(segment: str, value: object, dims: list[str], amount: str = "amount_base") -> Callable[[DataFrame], DataFrame]:
    """A daily sum over the rows of one segment."""
    return lambda df: daily_sum(df.where(F.col(segment) == F.lit(value)), dims, amount)


def with_region(lines: DataFrame, stores: DataFrame) -> DataFrame:
    """Lines with the current region of their store."""
    s = stores.select(F.col("store_id").alias("_sid"), "region")
    return lines.join(s, F.col("store_id") == F.col("_sid"), "left").drop("_sid")


# ---- funnels

BROWSE, ADD, REMOVE = ("PAGE_VIEW", "SEARCH", "WISHLIST"), "ADD_TO_CART", "REMOVE_FROM_CART"


def _at_most(column: Column, when: Column) -> Column:
    return F.max(F.when(when, column))


def funnel_sessions(activity: DataFrame, orders: DataFrame, window_hours: int = 24, order: str = "_ingestion_order") -> DataFrame:
    """One row per session: its stage (0 none, 1 browse, 2 cart, 3 converted), and the order that its last cart led to.

    The session's customer is its first known one; an order converts the session if the same customer
    paid from the last addition to the cart up to ``window_hours`` later, both ends included; the
    earliest wins, then the least order id.
    """
    kind = F.col("activity_type")
    at = F.struct(F.col("activity_ts").alias("activity_ts"), F.col(order).alias("o"))
    s = activity.groupBy("session_id").agg(
        F.min_by(F.when(F.col("customer_id").isNotNull(), F.col("customer_id")), F.when(F.col("customer_id").isNotNull(), at)).alias("customer_id"),
        F.coalesce(F.max(F.when(kind == ADD, 2).when(kind.isin(*BROWSE), 1).otherwise(0)), F.lit(0)).alias("stage"),
        _at_most(at, kind == ADD).alias("_add"), _at_most(at, kind == REMOVE).alias("_remove"),
        (F.count(kind) - F.count_distinct(kind) + F.greatest(F.count_if(kind.isNull()) - 1, F.lit(0))).alias("duplicate_stage_events"),
        F.min("activity_ts").alias("_first"),
    )
    s = s.withColumns({"last_cart_add_ts": F.col("_add.activity_ts"), "cart_regressed": F.coalesce(F.col("_remove") > F.col("_add"), F.lit(False))})
    # Time is cut into spans no shorter than the window: an order falls into the span of its cart or the next, so it is shown
    # to its own span and the one before. One sorted pass for each customer and span finds the next order; no cart meets all
    # orders of its customer, and a customer with many is spread over time. Sessions that cannot convert are dealt by id.
    days = window_hours // 24 + 1
    span = lambda at: F.floor(F.datediff(at, F.lit("1970-01-01").cast("date")) / days)
    carted = F.col("last_cart_add_ts").isNotNull() & F.col("customer_id").isNotNull()
    s = s.withColumns({"_who": F.when(carted, F.col("customer_id")), "_span": F.when(carted, span("last_cart_add_ts")).otherwise(F.xxhash64("session_id")), "_at": F.col("last_cart_add_ts")})
    o = orders.where("customer_id is not null and event_ts is not null").select(F.col("customer_id").alias("_who"), F.col("event_ts").alias("_at"), F.struct(F.col("event_ts").alias("at"), F.col("order_id").alias("id")).alias("_order"))
    o = o.withColumn("_span", F.explode(F.array(span("_at"), span("_at") - 1)))
    # backwards in time, so that the nearest order is the last one passed; at the same time orders come first, the least id last
    back = Window.partitionBy("_who", "_span").orderBy(F.desc("_at"), F.desc_nulls_last("_order")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    both = s.unionByName(o, allowMissingColumns=True).withColumn("_next", F.last("_order", ignorenulls=True).over(back)).where("_order is null")
    limit = F.col("last_cart_add_ts") + F.make_interval(hours=F.lit(window_hours))
    out = both.withColumn("converting_order_id", F.when(F.col("_who").isNotNull() & (F.col("_next.at") <= limit), F.col("_next.id")))
    out = out.withColumn("converted", F.col("converting_order_id").isNotNull())
    return out.select(
        "session_id", "customer_id", F.when(F.col("converted"), 3).otherwise(F.col("stage")).alias("stage"), "converted", "cart_regressed", "duplicate_stage_events",
        "converting_order_id", "last_cart_add_ts", F.to_date(F.coalesce("last_cart_add_ts", "_first")).alias("session_date"),
    )


def paid_orders(events: DataFrame, sequence: tuple[str, ...] = ("event_ts", "_ingestion_order")) -> DataFrame:
    """Payments of orders that were not cancelled."""
    return resolve_lifecycle(events, sequence).where("eligible").select("order_id", F.col("paid.customer_id").alias("customer_id"), F.col("paid.event_ts").alias("event_ts"))


def funnel_daily(sessions: DataFrame) -> DataFrame:
    return sessions.groupBy("session_date").agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("stage") >= 2).alias("carted"), F.count_if("converted").alias("converted"))


def funnel_metrics(sessions: DataFrame) -> DataFrame:
    """Totals; the rate is converted over carted, to four places, half to even, 0 with no carts."""
    out = sessions.agg(F.count(F.lit(1)).alias("sessions"), F.count_if(F.col("stage") >= 1).alias("browsed"), F.count_if(F.col("stage") >= 2).alias("carted"), F.count_if("converted").alias("converted"))
    rate = F.bround(F.try_divide(F.col("converted").cast("decimal(20,0)"), F.col("carted").cast("decimal(20,0)")), 4)
    return out.withColumn("conversion_rate", F.coalesce(rate, F.lit(0)).cast("decimal(10,4)"))


