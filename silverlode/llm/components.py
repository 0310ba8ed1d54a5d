"""Connected components over edge tables, entirely in DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import materialize


def connected_components(edges: DataFrame) -> DataFrame:
    """Map each node of ``edges(a, b)`` to the least node of its component: ``(node, root)``.

    Each round hooks every node to its least smaller neighbour, flattens the forest by pointer
    jumping and contracts the edges. Rounds grow with the logarithm of the component size. Every
    join is a plain equi join, so the skew of a hub is split by adaptive execution, and each round
    ends in a written table, so lost executors repeat one round at most.
    Null ends are ignored, as are loops and repeated edges.
    """
    pairs = edges.where("a is not null and b is not null and a <> b").select(
        F.greatest("a", "b").alias("hi"), F.least("a", "b").alias("lo")
    )
    pairs = materialize(pairs.distinct(), "cc-edges")
    labels = None
    while not pairs.isEmpty():
        parents = _flatten(pairs.groupBy("hi").agg(F.min("lo").alias("up")))
        if labels is None:
            nodes = pairs.select(F.explode(F.array("hi", "lo")).alias("node")).distinct()
            labels = nodes.select("node", F.col("node").alias("root"))
        labels = materialize(_relabel(labels, "root", parents), "cc-labels")
        moved = _relabel(_relabel(pairs, "hi", parents), "lo", parents).where("hi <> lo")
        pairs = materialize(
            moved.select(F.greatest("hi", "lo").alias("hi"), F.least("hi", "lo").alias("lo")).distinct(), "cc-edges"
        )
    if labels is None:
        return pairs.select(F.col("hi").alias("node"), F.col("lo").alias("root"))
    return labels


def _relabel(df: DataFrame, column: str, parents: DataFrame) -> DataFrame:
    up = parents.select(F.col("hi").alias("_from"), F.col("up").alias("_to"))
    rest = [c for c in df.columns if c != column]
    joined = df.join(up, df[column] == up["_from"], "left")
    return joined.select(*rest, F.coalesce("_to", column).alias(column))


def _flatten(parents: DataFrame) -> DataFrame:
    """Pointer jumping until every parent is a root."""
    parents = materialize(parents, "cc-parents")
    while True:
        above = parents.select(F.col("hi").alias("_from"), F.col("up").alias("_to"))
        jumped = parents.join(above, parents["up"] == above["_from"], "left").select(
            "hi", F.coalesce("_to", "up").alias("up"), F.col("_to").isNotNull().alias("moved")
        )
        jumped = materialize(jumped, "cc-parents")
        if jumped.where("moved").isEmpty():
            return jumped.select("hi", "up")
        parents = jumped.select("hi", "up")
