"""The pipeline: landed files to bronze, silver, gold and operations tables."""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import datetime
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.values import ingestion_order, lateness
from ..operators import audit, cdc, dq, gold, scd2
from ..sources.tables import Warehouse
from ..streaming import bronze
from . import config

PASSTHROUGH = ("_source_file", "_ingestion_order", "_batch_date")


@dataclass
class Pipeline:
    """A run over a landing area and a warehouse, as of a given time."""

    spark: SparkSession
    landing: str
    warehouse: Warehouse
    checkpoints: str
    as_of: datetime
    lateness_days: int = 7
    funnel_hours: int = 24
    sources: dict = field(default_factory=config.load_sources)
    contracts: dict = field(default_factory=config.load_source_contracts)
    entities: dict = field(default_factory=config.load_entity_contracts)
    rules: dict = field(default_factory=config.load_rules)
    rates: list = field(default_factory=config.load_rates)

    def run(self, run: audit.Run | None = None) -> DataFrame:
        """Ingest, rebuild every table, record the run; returns broken invariants, none if all holds."""
        bronze.ingest(self.spark, self.landing, self.warehouse, self.sources, self.contracts, self.checkpoints)
        present = [s for s in self.sources if self.warehouse.exists("bronze", f"{s}_raw")]
        metrics = [m for s in present for m in self.silver_source(s)]
        self.dimensions(present)
        self.gold(present)
        w = self.warehouse
        parts = [audit.reconcile(bronze.read_bronze(w, s), w.read("silver", f"{s}_valid"), w.read("silver", f"{s}_quarantine"), s) for s in present]
        whole = reduce(DataFrame.unionByName, parts) if parts else audit.reconcile(*[self.spark.range(0)] * 3, "").limit(0)
        whole = w.refresh("gold", "dq_reconciliation", whole)
        audit.record_run(w, run or audit.new_run(), whole, metrics)
        return self.invariants()

    def invariants(self) -> DataFrame:
        """Whatever breaks in the tables as they stand: sources not conserved, histories that do not hold together."""
        w = self.warehouse
        histories = {n: (w.read("silver", f"{n}_hist"), list(e.keys), self.sequence(n)) for n, e in self.entities.items() if e.scd_type == 2 and w.exists("silver", f"{n}_hist")}
        return audit.invariants(w.read("gold", "dq_reconciliation"), histories)

    def sequence(self, entity: str) -> list[str]:
        return list(self.entities[entity].sequence)

    def silver_source(self, source: str) -> list[DataFrame]:
        """Validate once, write it, then split what was written."""
        w, contract = self.warehouse, self.contracts[source]
        rules = config.bind_rules(contract, self.rules[source])
        raw = bronze.read_bronze(w, source)
        dq.enforce_rescue_rate(raw, rules)
        raw = raw.withColumn("_ingestion_order", ingestion_order(F.col("_source_file"), F.col("_ingestion_order")))
        checked = w.refresh("silver", f"_{source}_validated", dq.validate(raw, rules, self.as_of))
        passed = PASSTHROUGH
        if ts := config.event_time_column(source, self.entities):
            checked = checked.withColumn("_lateness", lateness(F.col(f"_typed_{ts}"), F.lit(self.as_of), self.lateness_days))
            passed = (*PASSTHROUGH, "_lateness")
        valid, _ = dq.split(checked, rules, passed)
        _, bad = dq.split(checked, rules, PASSTHROUGH)
        w.refresh("silver", f"{source}_valid", valid)
        w.refresh("silver", f"{source}_quarantine", bad)
        return [dq.metrics(checked, rules)]

    def customer_events(self) -> DataFrame:
        """Snapshots and change events as one stream of the same columns."""
        w, e = self.warehouse, self.entities["dim_customer"]
        base = [c for c in self.contracts["customers"].columns if c not in ("signup_ts", "updated_at")]
        snap = w.read("silver", "customers_valid")
        snap = cdc.snapshot_events(snap, {"change_ts": F.col("updated_at"), "change_seq": F.lit(None).cast("bigint")}, "SNAPSHOT")
        streams = [snap.select("_op", *base, "source_system", *e.sequence)]
        if w.exists("silver", "customer_updates_valid"):
            updates = w.read("silver", "customer_updates_valid").withColumn("_op", cdc.operation("op"))
            streams.append(updates.select("_op", *base, "source_system", *e.sequence))
        return cdc.unify(*streams)

    def dimensions(self, present: list[str]) -> None:
        w = self.warehouse
        if "customers" in present:
            e = self.entities["dim_customer"]
            spec = cdc.CdcSpec(e.keys, e.sequence, "_op")
            # settled once, written, then read by both tables
            settled = w.refresh("silver", "_dim_customer_settled", cdc.normalize(self.customer_events(), spec).settled)
            w.refresh("silver", "dim_customer_held_orphans", settled.where("is_orphan_delete"))
            applied = settled.where("not is_orphan_delete").drop("is_orphan_delete")
            attributes = [c for c in applied.columns if c not in (*e.keys, *e.sequence, "_op")]
            w.refresh("silver", "dim_customer_hist", scd2.rebuild(applied, list(e.keys), list(e.sequence), attributes))
        for name, source in (("dim_product", "products"), ("dim_store", "stores")):
            if source in present:
                e = self.entities[name]
                rows = w.read("silver", f"{source}_valid").select(*self.contracts[source].columns, "_ingestion_order")
                attributes = [c for c in self.contracts[source].columns if c not in (*e.keys, *e.sequence)]
                events = cdc.normalize(rows, cdc.CdcSpec(e.keys, e.sequence)).applied
                w.refresh("silver", f"{name}_hist", scd2.rebuild(events, list(e.keys), list(e.sequence), attributes))
        for name in ("dim_customer", "dim_product", "dim_store"):
            if w.exists("silver", f"{name}_hist"):
                w.refresh("gold", name, scd2.current(w.read("silver", f"{name}_hist")))

    def gold(self, present: list[str]) -> None:
        w = self.warehouse
        if "order_events" not in present:
            return
        orders = w.read("silver", "order_events_valid")
        lines, excluded = gold.revenue_lines(orders, self.rates)
        if w.exists("silver", "dim_product_hist"):
            lines = gold.with_product_asof(lines, w.read("silver", "dim_product_hist"))
        sales = w.refresh("gold", "fct_sales", lines)
        w.refresh("gold", "fct_sales_excluded", excluded)
        if w.exists("gold", "dim_store"):
            w.refresh("gold", "sales_per_region_daily", gold.daily_sum(gold.with_region(sales, w.read("gold", "dim_store")), ["sale_date", "region"]))
        w.refresh("gold", "sales_per_store_daily", gold.daily_sum(sales, ["sale_date", "store_id"]))
        if "customer_activity" in present:
            sessions = gold.funnel_sessions(w.read("silver", "customer_activity_valid"), gold.paid_orders(orders), self.funnel_hours)
            w.refresh("gold", "funnel_conversion_daily", gold.funnel_daily(sessions))
