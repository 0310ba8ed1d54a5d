"""Change data: events from streams and snapshots, replays dropped, conflicts settled, orphan deletes held."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import content, earliest_first, stripped
from ..plans.config import ConfigError, EntityContract, SourceContract


@dataclass(frozen=True)
class CdcSpec:
    keys: tuple[str, ...]
    sequence: tuple[str, ...]
    op_column: str | None = None
    meta: tuple[str, ...] = ("_row_id", "_ingestion_order", "_source_file", "_batch_date", "_lateness")


def bind_spec(entity: EntityContract, source: SourceContract | None = None) -> CdcSpec:
    if source is not None and source.name not in entity.sources:
        raise ConfigError(f"{source.name} is no source of {entity.name}")
    return CdcSpec(entity.keys, entity.sequence, source.op_column if source else None)


@dataclass(frozen=True)
class NormalizedStream:
    """Four lazy relations; together with what replays dropped, they account for every event."""

    applied: DataFrame
    held_orphans: DataFrame
    conflicts: DataFrame
    replays: DataFrame
    #: Applied and held together, told apart by ``is_orphan_delete``: what to write where both are wanted.
    settled: DataFrame


def operation(op_column: str | None) -> Column:
    """``D`` for a delete; inserts, updates, blanks and what is unknown are upserts, ``U``."""
    if op_column is None:
        return F.lit("U")
    return F.when(stripped(F.coalesce(F.col(op_column), F.lit(""))) == "D", "D").otherwise("U")


def with_metadata(df: DataFrame, spec: CdcSpec, default_op: str = "U") -> DataFrame:
    """``_op`` as landed, trimmed, and ``_sequence`` as one struct."""
    op = F.lit(default_op) if spec.op_column is None else F.coalesce(F.nullif(stripped(F.col(spec.op_column)), F.lit("")), F.lit(default_op))
    return df.withColumns({"_op": op, "_sequence": F.struct(*spec.sequence)})


def payload_columns(df: DataFrame, spec: CdcSpec) -> list[str]:
    out = {spec.op_column, "_op", *spec.keys, *spec.sequence, *spec.meta}
    return [c for c in df.columns if c not in out]


def to_events(df: DataFrame, spec: CdcSpec) -> DataFrame:
    out = df.withColumn("_op", operation(spec.op_column))
    return out.drop(*(c for c in (spec.op_column, "_row_id") if c and c != "_op"))


def snapshot_events(df: DataFrame, sequence: dict[str, Column], source_system: str | None = None) -> DataFrame:
    """A snapshot as upserts: ``sequence`` gives its sequence columns."""
    out = df.withColumns({"_op": F.lit("U"), **sequence})
    return out if source_system is None else out.withColumn("source_system", F.lit(source_system))


def unify(*streams: DataFrame) -> DataFrame:
    """Streams of the same columns as one; different columns are an error, not nulls."""
    want = sorted(streams[0].columns)
    for s in streams[1:]:
        if sorted(s.columns) != want:
            raise ConfigError(f"streams differ in columns: {sorted(set(want) ^ set(s.columns))}")
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s)
    return out


def normalize(df: DataFrame, spec: CdcSpec, known_keys: DataFrame | None = None) -> NormalizedStream:
    """Settle a stream of events.

    Rows alike in key, operation, sequence and payload are one. Of rows that share key and sequence
    the upsert wins over the delete, then the greater content. A delete with no earlier upsert of its
    key, and whose key is not known, is held. One exchange by key serves every window.
    """
    events = to_events(df, spec)
    payload = payload_columns(events, spec)
    carried = [c for c in spec.meta if c in events.columns and c not in spec.sequence]
    same = [*spec.keys, "_op", *spec.sequence, *payload]
    by_key = [*spec.keys]
    # copies are merged where they are read, so that a replayed event of any number of copies is one row a partition when it is shuffled
    first = [F.min(F.struct(*carried)).alias("_first")] if carried else []
    counted = events.groupBy(*same).agg(F.count(F.lit(1)).alias("_copies"), *first)
    unique = counted.select(*(F.col(f"_first.{c}") if c in carried else F.col(c) for c in events.columns)).repartition(*spec.keys)
    slot = Window.partitionBy(*by_key, *spec.sequence).orderBy(F.desc("_op"), F.desc_nulls_last("_content"))
    ranked = unique.withColumn("_content", content(payload) if payload else F.lit("")).withColumn("_rank", F.row_number().over(slot)).drop("_content")
    winners, losers = ranked.where("_rank = 1").drop("_rank"), ranked.where("_rank > 1").drop("_rank")
    chain = Window.partitionBy(*by_key).orderBy(*earliest_first(spec.sequence)).rowsBetween(Window.unboundedPreceding, -1)
    earlier = F.coalesce(F.sum(F.when(F.col("_op") == "U", 1).otherwise(0)).over(chain), F.lit(0))
    orphan = (F.col("_op") == "D") & (earlier == 0)
    if known_keys is None:
        marked = winners.withColumn("is_orphan_delete", orphan)
    else:
        known = known_keys.select(*spec.keys).distinct().withColumn("_known", F.lit(True))
        marked = winners.withColumn("_orphan", orphan).join(known, list(spec.keys), "left")
        marked = marked.withColumn("is_orphan_delete", F.col("_orphan") & F.col("_known").isNull()).drop("_orphan", "_known")
    replays = counted.agg(F.coalesce(F.sum(F.col("_copies") - 1), F.lit(0)).alias("replays_dropped"))
    return NormalizedStream(marked.where("not is_orphan_delete").drop("is_orphan_delete"), marked.where("is_orphan_delete"), losers, replays, marked)
