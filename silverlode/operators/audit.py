"""Reconciliation, run records and standing invariants."""

from __future__ import annotations

import uuid
from dataclasses import dataclass
from datetime import datetime, timezone
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import DQ_RESULTS, PIPELINE_RUNS, Warehouse
from . import scd2


@dataclass(frozen=True)
class Run:
    run_id: str
    run_ts: datetime
    environment: str = "dev"
    git_sha: str = ""
    deployed_by: str = ""


def new_run(environment: str = "dev", git_sha: str = "", deployed_by: str = "", run_id: str | None = None, run_ts: datetime | None = None) -> Run:
    return Run(run_id or uuid.uuid4().hex, run_ts or datetime.now(timezone.utc), environment, git_sha, deployed_by)


def reconcile(bronze: DataFrame, valid: DataFrame, quarantine: DataFrame, source: str) -> DataFrame:
    """``(source, bronze_rows, valid_rows, quarantine_rows, conserved)``: one union and one aggregation."""
    parts = {"bronze_rows": bronze, "valid_rows": valid, "quarantine_rows": quarantine}
    tags = None
    for name, df in parts.items():
        one = df.select(F.lit(name).alias("part"))
        tags = one if tags is None else tags.unionByName(one)
    out = tags.agg(*(F.count_if(F.col("part") == n).alias(n) for n in parts))
    return out.select(F.lit(source).alias("source"), *parts, (F.col("bronze_rows") == F.col("valid_rows") + F.col("quarantine_rows")).alias("conserved"))


def not_conserved(reconciliation: DataFrame) -> DataFrame:
    return reconciliation.where("not conserved")


def many_current(history: DataFrame, keys: list[str]) -> DataFrame:
    """Keys with more than one current version."""
    return history.groupBy(*keys).agg(F.count_if("is_current").alias("currents")).where("currents > 1")


def record_run(warehouse: Warehouse, run: Run, reconciliation: DataFrame, metrics: list[DataFrame]) -> None:
    """Add the run's counts and rule metrics, under its id: recording a run again replaces what it recorded."""
    stamp = [F.lit(run.run_id).alias("run_id"), F.lit(run.run_ts).alias("run_ts")]
    warehouse.ensure("ops", "pipeline_runs", PIPELINE_RUNS)
    warehouse.ensure("ops", "dq_results", DQ_RESULTS)
    more = [F.lit(run.environment).alias("environment"), F.lit(run.git_sha).alias("git_sha"), F.lit(run.deployed_by).alias("deployed_by")]
    warehouse.append("ops", "pipeline_runs", reconciliation.select(*stamp, *more, "source", "bronze_rows", "valid_rows", "quarantine_rows", "conserved"), run.run_id)
    if metrics:
        every = reduce(DataFrame.unionByName, metrics)
        warehouse.append("ops", "dq_results", every.select(*stamp, "source", "rule", "column", "severity", "evaluated", "violations"), run.run_id)


def invariants(reconciliation: DataFrame, histories: dict[str, tuple[DataFrame, list[str], list[str]]]) -> DataFrame:
    """``(subject, key, violation)`` of everything that should always hold; empty when it does."""
    out = not_conserved(reconciliation).select(F.col("source").alias("subject"), F.lit(None).cast("string").alias("key"), F.lit("not_conserved").alias("violation"))
    for name, (history, keys, sequence) in histories.items():
        broken = scd2.violations(history, keys, sequence)
        out = out.unionByName(broken.select(F.lit(name).alias("subject"), F.concat_ws("|", *(F.col(k).cast("string") for k in keys)).alias("key"), "violation"))
    return out
