"""Slowly changing dimensions, type 2: merge events with history and rebuild the chains."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.values import content, earliest_first


def rebuild(events: DataFrame, keys: list[str], sequence: list[str], attributes: list[str], history: DataFrame | None = None) -> DataFrame:
    """History as ``keys, sequence, attributes, is_deleted, _to_<sequence>, _is_terminal, is_current``.

    History re-enters as events, so one run over all events and many runs over parts agree. At one
    place in a chain the upsert wins over the tombstone, then the greater content; a state equal to the
    one before it opens no version; a version ends where the next begins. ``_is_terminal`` alone marks
    the open end, as a successor's sequence may hold nulls.
    """
    deleted = F.col("_op") == "D"
    states = events.select(*keys, *sequence, *(F.when(~deleted, F.col(a)).alias(a) for a in attributes), deleted.alias("is_deleted"))
    if history is not None:
        states = states.unionByName(history.select(*keys, *sequence, *attributes, "is_deleted"))
    states = states.withColumn("_content", F.when(F.col("is_deleted"), F.lit("")).otherwise(content(attributes) if attributes else F.lit("{}")))
    # one state a place is left where the rows are read, so that only such states are shuffled to their key
    best = F.max_by(F.struct("is_deleted", "_content", *attributes), F.struct(~F.col("is_deleted"), "_content"))
    states = states.groupBy(*keys, *sequence).agg(best.alias("_best")).select(*keys, *sequence, "_best.*").repartition(*keys)
    chain = Window.partitionBy(*keys).orderBy(*earliest_first(sequence))
    states = states.withColumn("_before", F.lag("_content").over(chain))
    states = states.where(~F.col("_content").eqNullSafe(F.col("_before")) | F.col("_before").isNull())
    ends = {f"_to_{s}": F.lead(s).over(chain) for s in sequence}
    out = states.withColumns({**ends, "_is_terminal": F.lead(F.lit(1)).over(chain).isNull()})
    out = out.withColumn("is_current", F.col("_is_terminal") & ~F.col("is_deleted"))
    return out.select(*keys, *sequence, *attributes, "is_deleted", *ends, "_is_terminal", "is_current")


def current(history: DataFrame) -> DataFrame:
    return history.where("is_current")


def violations(history: DataFrame, keys: list[str], sequence: list[str]) -> DataFrame:
    """``keys, violation`` for each break: currents, gaps and overlaps, open ends, stray currents."""
    chain = Window.partitionBy(*keys).orderBy(*earliest_first(sequence))
    whole = Window.partitionBy(*keys)
    ends = [F.col(f"_to_{s}") for s in sequence]
    marked = history.withColumns({
        "_last": F.lead(F.lit(1)).over(chain).isNull(),
        "_next": F.struct(*(F.lead(s).over(chain).alias(s) for s in sequence)),
        "_end": F.struct(*(e.alias(s) for e, s in zip(ends, sequence))),
        "_currents": F.sum(F.when(F.col("is_current"), 1).otherwise(0)).over(whole),
        "_open": F.sum(F.when(F.col("_is_terminal"), 1).otherwise(0)).over(whole),
    })
    tail_deleted = F.max(F.when(F.col("_last"), F.col("is_deleted"))).over(whole)
    marked = marked.withColumn("_expected", F.when(tail_deleted, 0).otherwise(1))
    checks = {
        "current_count": F.col("_last") & (F.col("_currents") != F.col("_expected")),
        "gap_or_overlap": ~F.col("_last") & ~F.col("_end").eqNullSafe(F.col("_next")),
        "open_tail": F.col("_last") & (~F.col("_is_terminal") | (F.col("_open") != 1)),
        "current_not_terminal": F.col("is_current") & ~F.col("_is_terminal"),
    }
    found = F.array_compact(F.array(*(F.when(c, F.lit(n)) for n, c in checks.items())))
    return marked.select(*keys, F.explode(found).alias("violation")).distinct()
