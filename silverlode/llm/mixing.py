"""Mixing sources to target weights by subset-sum budget fitting.

Each source is taken whole as often as its target allows; the rest of its budget is a bounded
subset-sum over the numbers of documents of each exact length: an even share of every length first,
then greedily the longest, then bounded-knapsack dynamic programming over what is left, in a table of
bounded width: where only documents are left that are longer than it, sums are told apart less finely. Documents of a length are
taken in the order of a seeded hash.

Cases, by definition: a null text has size 0, and documents of size 0 add nothing, whole passes but
no more; the null source is a source, last in order; repeated rows count singly; a source whose
documents are all empty has target 0; an empty table gives an empty result; of rows that agree in
hash, id and length, which is taken is immaterial to the word counts; extra columns are kept, whatever their names.
There is no bound on the number of sources or lengths; a very long text is a length like any other.
"""

import math

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .store import fresh, materialize

OUTPUTS = ("_size", "_source_size", "_target", "_copies", "_taken")
WEIGHTS = (5.0, 2.0, 1.0)
MAX_TIMES = 3
SEED = 6
#: Words left for dynamic programming after the greedy steps; a document beyond this is for the greedy steps alone.
RESIDUE = 8192
#: Documents are dealt by hash into parts of about so many rows, at least so many parts, so that a hot length is no single task's.
PART_ROWS, LEAST_PARTS = 100_000, 512


def word_count(column):
    """Number of maximal runs of characters other than ASCII white space; null has none."""
    return F.coalesce(F.regexp_count(column, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def level(sorted_: DataFrame, total: int) -> float:
    """Words a unit of weight, such that targets cut off at their caps add up to ``total``; infinite where the caps do not reach it.

    ``sorted_`` is the sources with ``_cap``, ``_weight``, ``_ratio`` (cap a unit of weight) and ``_p``, laid
    out by ``_laid``: the sources whose caps bind come first. Sums of partitions find the one where the
    level lies; only it is looked into.
    """
    sums = sorted_.groupBy("_p").agg(F.sum("_cap").alias("c"), F.sum("_weight").alias("w"), F.max("_ratio").alias("r")).orderBy("_p").collect()
    whole, caps, used = sum(s["w"] for s in sums), 0.0, 0.0
    for s in sums:
        # at its last source's ratio this partition would have taken its share
        if caps + s["c"] + s["r"] * (whole - used - s["w"]) >= total:
            before = Window.orderBy("_i").rowsBetween(Window.unboundedPreceding, -1)
            part = sorted_.where(F.col("_p") == s["_p"])
            part = part.select("_i", "_ratio", *((F.lit(float(x)) + F.coalesce(F.sum(c).over(before), F.lit(0.0))).alias(n) for c, x, n in (("_cap", caps, "c"), ("_weight", used, "w"))))
            found = part.where(F.col("c") + F.col("_ratio") * (F.lit(float(whole)) - F.col("w")) >= F.lit(total)).orderBy("_i").limit(1).collect()
            if found:
                return (total - found[0]["c"]) / (whole - found[0]["w"])
        caps, used = caps + s["c"], used + s["w"]
    return math.inf


def _laid(df: DataFrame, order: list, label: str) -> DataFrame:
    """Rows in order over partitions, written, with ``_p`` and ``_i``: the partition, and the place in it."""
    laid = df.repartitionByRange(*order).sortWithinPartitions(*order)
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    return materialize(laid.select("*", F.spark_partition_id().alias("_p"), place.alias("_i")), label)


def source_targets(sizes: DataFrame, weights: tuple[float, ...] = WEIGHTS, times: int = MAX_TIMES) -> DataFrame:
    """``(_source, _source_size, _target)`` for ``sizes(_source, s)``: weights repeat over the sources in order.

    Targets share the total by weight; what a target is beyond ``times`` its source's size goes to the
    others by weight, until none is. Tables throughout: what reaches the driver is a row for each partition.
    """
    spark = sizes.sparkSession
    laid = _laid(sizes, ["_source"], "mix-sources")
    starts, at = [], 0
    for r in laid.groupBy("_p").agg(F.count(F.lit(1)).alias("n")).orderBy("_p").collect():
        starts.append((r["_p"], at))
        at += r["n"]
    starts = spark.createDataFrame(starts, "_q int, _start long")
    turn = F.pmod(F.col("_start") + F.col("_i"), F.lit(len(weights))).cast("int") + 1
    weighed = laid.join(F.broadcast(starts), F.col("_p") == F.col("_q")).select("_source", "s", F.element_at(F.array(*(F.lit(float(w)) for w in weights)), turn).alias("_weight"))
    weighed = weighed.withColumn("_cap", F.col("s").cast("double") * times).withColumn("_ratio", F.col("_cap") / F.col("_weight"))
    laid = _laid(weighed, ["_ratio", "_source"], "mix-ratios")
    total = laid.agg(F.sum("s")).first()[0] or 0
    share = level(laid, int(total))
    return laid.select("_source", F.col("s").alias("_source_size"), F.least(F.col("_cap"), F.col("_weight") * F.lit(share)).alias("_target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, budget: int, residue: int = RESIDUE, times: int = 1) -> np.ndarray:
    """How many documents of each length to take for a total as near ``budget`` as found.

    At most ``counts``, each once, until the last step, which may take each up to ``times``. The last step
    has up to ``residue`` words to make up; where documents longer than that leave a gap, it is tried with
    the length of several of the longest too, and the nearer total counts.
    """
    lengths, counts = lengths.astype(np.int64), counts.astype(np.int64)
    if budget >= int((lengths * counts).sum()):
        return counts.copy()
    gap = lambda take: abs(budget - int((lengths * take).sum()))
    take = _fit(lengths, counts, budget, residue, residue, times)
    if gap(take) and len(lengths) and (several := 8 * int(lengths.max())) > residue:
        take = min(take, _fit(lengths, counts, budget, several, residue, times), key=gap)
    return take


def _fit(lengths: np.ndarray, counts: np.ndarray, budget: int, keep: int, residue: int, times: int) -> np.ndarray:
    """An even share of each length, the longest greedily until ``keep`` words are left, a bounded knapsack for those."""
    total = int((lengths * counts).sum())
    take = np.array([int(c) * budget // total for c in counts], np.int64) if total else np.zeros_like(counts)
    if keep > residue and len(lengths):  # the even share must leave them too
        take = np.maximum(0, take - np.where(lengths > residue, 1, 0))
    left = budget - int((lengths * take).sum())
    for i in np.argsort(-lengths, kind="stable"):
        size = int(lengths[i])
        if size and left > keep:
            more = min(int(counts[i] - take[i]), (left - keep) // size if size <= keep else left // size)
            take[i] += more
            left -= more * size
    room = counts * times - take
    open_ = np.flatnonzero((lengths > 0) & (room > 0))
    if not len(open_) or left <= 0:
        return take
    # one document beyond the budget may be nearer than what stays below
    limit = left + int(lengths[open_].min())
    small = open_[lengths[open_] <= limit]
    # sums are told apart to a unit that keeps the table within twice the residue; for sums under that the unit is one word
    unit = -(-limit // (2 * residue))
    steps = np.maximum(1, (lengths[small] + unit // 2) // unit)
    width = -(-limit // unit)
    best, off = None, left
    for used in subset_sums(steps, room[small], width, min(width, round(left / unit))):
        found = abs(left - sum(int(lengths[small[i]]) * n for i, n in used))
        if found < off:
            best, off = used, found
    for i, n in best or ():
        take[small[i]] += n
    return take


def subset_sums(sizes: np.ndarray, counts: np.ndarray, limit: int, goal: int, nearest: int = 8) -> list[list[tuple[int, int]]]:
    """Bounded knapsack: for each of the sums nearest to ``goal`` up to ``limit``, ``(item, number)`` pairs that make it.

    A sum keeps the item that reached it first and how many of that one it took, so the tables are as
    wide as ``limit`` whatever the number of items; what it took them from was reached by earlier items.
    """
    via, many = np.full(limit + 1, -1, np.int32), np.zeros(limit + 1, np.int64)
    reached = np.zeros(limit + 1, bool)
    reached[0] = True
    for i, (size, most) in enumerate(zip(sizes.tolist(), counts.tolist())):
        if size > limit:
            continue
        # along each chain of sums a step apart: how far back the last one is that earlier items reached
        rows = -(-(limit + 1) // size)
        grid = np.zeros(rows * size, bool)
        grid[: limit + 1] = reached
        place = np.arange(rows)[:, None]
        last = np.maximum.accumulate(np.where(grid.reshape(rows, size), place, -1), axis=0)
        back = np.where(last >= 0, place - last, most + 1).reshape(-1)[: limit + 1]
        new = ~reached & (back <= most)
        via[new], many[new] = i, back[new]
        reached |= new
        if reached[goal]:
            break
    sums = np.flatnonzero(reached)
    out = []
    for at in sums[np.argsort(np.abs(sums - goal), kind="stable")][:nearest].tolist():
        used = []
        while at:
            used.append((int(via[at]), int(many[at])))
            at -= int(many[at]) * int(sizes[via[at]])
        out.append(used)
    return out


def mix(df: DataFrame, text: str = "text", source: str = "source", id: str = "doc_id", weights: tuple[float, ...] = WEIGHTS, times: int = MAX_TIMES, seed: int = SEED, part_rows: int = PART_ROWS) -> DataFrame:
    """``df`` with ``_size``, ``_source_size``, ``_target``, ``_copies`` (how often the mix takes the document) and ``_taken``.

    Where a column of ``df`` has one of those names, in any case, the new one is lengthened by
    underscores: ``outputs(df)`` says what they are.
    """
    key = F.xxhash64(F.lit(seed), F.col(id), F.col(text))
    parts = max(LEAST_PARTS, -(-df.count() // part_rows))
    # the source as a text that is never null, null last: plain keys, so joins and windows share one exchange
    tagged = F.concat(F.when(F.col(source).isNull(), "1").otherwise("0"), F.coalesce(F.col(source).cast("string"), F.lit("")))
    row, keys = F.struct(*(F.col(c) for c in df.columns)).alias("_row"), [F.col(id).alias("_id"), key.alias("_h"), F.pmod(key, F.lit(parts)).cast("int").alias("_part")]
    sized = df.select(row, word_count(F.col(text)).alias("_size"), tagged.alias("_source"), *keys)
    cells = sized.groupBy("_source", "_size", "_part").agg(F.count(F.lit(1)).alias("n"))
    cells = materialize(cells, "mix-cells")
    lengths = cells.groupBy("_source", "_size").agg(F.sum("n").alias("n"))
    lengths = materialize(lengths, "mix-lengths")
    plan = source_targets(lengths.groupBy("_source").agg(F.sum(F.col("_size") * F.col("n")).alias("s")), weights, times)
    whole = F.when(F.col("_source_size") > 0, F.least(F.floor(F.col("_target") / F.col("_source_size")), F.lit(times))).otherwise(0).cast("int")
    rest = F.when((F.col("_source_size") > 0) & (whole < times), F.round(F.col("_target") - whole * F.col("_source_size"))).otherwise(0).cast("long")
    plan = plan.select(F.col("_source").alias("_src"), "_source_size", "_target", whole.alias("_whole"), rest.alias("_budget"), (times - whole).alias("_more"))
    plan = materialize(plan, "mix-plan")
    fitted = lengths.join(plan.where("_budget > 0"), F.col("_source") == F.col("_src")).select("_src", "_size", "n", "_budget", "_more")
    fitted = fitted.groupBy("_src").applyInPandas(_fit_source, "_src string, _len long, _each long, _take long")
    fitted = materialize(fitted, "mix-takes")
    same = (cells["_source"] == fitted["_src"]) & (cells["_size"] == fitted["_len"])
    before = Window.partitionBy("_source", "_size").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    some = cells.join(fitted.hint("merge"), same).where("_take > 0 or _each > 0").withColumn("_before", F.coalesce(F.sum("n").over(before), F.lit(0)))
    need = F.greatest(F.lit(0), F.least(F.col("n"), F.col("_take") - F.col("_before")))
    some = some.select(F.col("_source").alias("_cs"), F.col("_size").alias("_cl"), F.col("_part").alias("_cp"), need.alias("_need"), "_each").where("_need > 0 or _each > 0")
    some = materialize(some, "mix-cells-taken")
    joined = sized.join(some.hint("merge"), (sized["_source"] == some["_cs"]) & (sized["_size"] == some["_cl"]) & (sized["_part"] == some["_cp"]), "left")
    rank = F.row_number().over(Window.partitionBy("_source", "_size", "_part").orderBy("_h", "_id"))
    extra = F.coalesce(F.col("_each"), F.lit(0)) + F.when(F.col("_need").isNotNull() & (rank <= F.col("_need")), 1).otherwise(0)
    out = joined.withColumn("_extra", extra).join(plan, F.col("_source") == F.col("_src"), "left")
    copies = (F.coalesce("_whole", F.lit(0)) + F.col("_extra")).cast("int")
    made = {"_size": F.col("_size"), "_source_size": F.col("_source_size"), "_target": F.col("_target"), "_copies": copies, "_taken": (copies * F.col("_size")).cast("long")}
    return out.select(*(F.col("_row")[c].alias(c) for c in df.columns), *(made[n].alias(name) for n, name in outputs(df).items()))


def outputs(df: DataFrame) -> dict[str, str]:
    """The names that the columns of ``mix`` have beside those of ``df``."""
    return {n: fresh(df, n) for n in OUTPUTS}


def _fit_source(frame):
    """The histogram of one source: as many rows as it has different lengths."""
    import pandas as pd

    frame = frame.sort_values("_size")
    counts = frame["n"].to_numpy()
    take = fit_counts(frame["_size"].to_numpy(), counts, int(frame["_budget"].iloc[0]), times=int(frame["_more"].iloc[0]))
    return pd.DataFrame({"_src": frame["_src"], "_len": frame["_size"], "_each": take // counts, "_take": take % counts})
