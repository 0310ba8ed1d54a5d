"""Sharding by a two-pass external shuffle, in DataFrame functions alone.

The shard of a record follows from its id and the shard count (the highest of seeded hashes), so one
more shard takes rows only into itself. Pass one scatters the whole records of each shard by seeded
hashes over piles small enough for memory, through Spark's exchange, so on disk. Pass two shuffles each
pile by a seeded Fisher-Yates and lays the piles of a shard end to end.

Cases, by definition: a null text has size 1 and no checksum; a null id is an id like any other;
repeated rows go to the same shard, where each is scattered by itself and has a slot (in a table with repeats
Spark's groups hand -0.0 back as 0.0); an empty table gives an empty result; a very long text makes its pile
larger, never lost; extra columns are kept, whatever their names, of any type that Spark hashes and sorts.
"""

from itertools import accumulate

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from .store import fresh, materialize

OUTPUTS = ("_size", "_crc", "_shard", "_slot", "_grown")
SHARDS = 16
SEED = 2
#: Bytes of records in a pile, on average, and what a record counts beside its texts.
BUCKET_BYTES = 8 << 20
RECORD_BYTES = 64
#: Tasks of pass two at most; where there are more piles, a task shuffles several that follow each other.
TASKS = 20_000
#: Repeats of one row that a task deals.
BLOCK = 1 << 16


def byte_size(column):
    return (F.coalesce(F.octet_length(column), F.lit(0)) + F.lit(1)).cast("long")


def shard_of(id: str, shards: int, seed: int = SEED):
    """The shard whose hash with the id is highest."""
    return F.greatest(*(F.struct(F.xxhash64(F.lit(seed), F.lit(s), F.col(id)).alias("h"), F.lit(s).alias("s")) for s in range(shards)))["s"] if shards > 1 else F.lit(0)


def _dealt(groups: DataFrame, most: int) -> DataFrame:
    """``groups``, each ``_n`` times, with ``_copy`` from 0 on, so that hashes tell repeats of a row apart; dealt in blocks, so no task makes all of one row."""
    columns = [c for c in groups.columns if c != "_n"]
    blocks = groups.select("*", F.explode(F.expr(f"sequence(0L, (_n - 1) div {BLOCK})")).alias("_block"))
    if most > BLOCK:
        blocks = blocks.repartition("_key", "_block")
    first = F.col("_block") * BLOCK
    return blocks.select(*columns, F.explode(F.sequence(first, F.least(F.col("_n") - 1, first + (BLOCK - 1)))).alias("_copy"))


def shuffle_shards(df: DataFrame, id: str = "doc_id", text: str = "text", shards: int = SHARDS, seed: int = SEED, bucket_bytes: int = BUCKET_BYTES, keep: list[str] | None = None) -> DataFrame:
    """``df`` (or its columns ``keep``) with ``_size``, ``_crc``, ``_shard``, ``_slot`` and ``_grown``: the shard if there were one more.

    Where a column that stays has one of those names, in any case, the new one is lengthened by
    underscores: ``outputs`` says what they are.
    """
    kept = list(df.columns if keep is None else keep)
    names = outputs(df.select(*kept))
    texts = [f.name for f in df.select(*kept).schema if isinstance(f.dataType, StringType | BinaryType)]
    load = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in texts), F.lit(RECORD_BYTES).cast("long"))
    whole = [F.col(c) for c in dict.fromkeys([id, text, *kept])]
    records = df.select(
        F.col(id).alias("_id"), F.struct(F.xxhash64(F.lit(seed + 1), *whole), F.xxhash64(F.lit(seed + 3), *whole)).alias("_key"), F.struct(*(F.col(c) for c in kept)).alias("_row"),
        byte_size(F.col(text)).alias("_size"), F.crc32(F.col(text)).alias("_crc"), load.alias("_load"), shard_of(id, shards, seed).alias("_shard"), shard_of(id, shards + 1, seed).alias("_grown"),
    )
    # The size and number of each row by its hashes of 128 bits: all that the layout of piles and slots needs.
    groups = materialize(records.groupBy("_shard", "_key").agg(F.count(F.lit(1)).alias("_n"), F.sum("_load").alias("_load")), "row-counts")
    found = {r["_shard"]: r for r in groups.groupBy("_shard").agg(F.sum("_load").alias("_load"), F.max("_n").alias("_most")).collect()}
    most = max((r["_most"] for r in found.values()), default=1)
    piles = [max(1, -(-found[s]["_load"] // bucket_bytes)) if s in found else 1 for s in range(shards)]
    before = [0, *accumulate(piles)]
    tasks = min(before[-1], TASKS)
    of_shard = lambda values: F.array(*(F.lit(v).cast("long") for v in values))[F.col("_shard")]

    def scatter(dealt: DataFrame) -> DataFrame:
        return dealt.withColumn("_pile", F.pmod(F.xxhash64(F.lit(seed + 2), F.col("_key"), F.col("_copy")), of_shard(piles)))

    # Repeats are merged before they are shuffled, then dealt one by one.
    each = records.drop("_load")
    each = each.withColumn("_copy", F.lit(0).cast("long")) if most == 1 else _dealt(each.groupBy(*each.columns).agg(F.count(F.lit(1)).alias("_n")), most)
    task = F.floor((of_shard(before[:-1]) + F.col("_pile")) * tasks / before[-1]).cast("int")
    fields = ["_row", "_size", "_crc", "_grown"]
    content = F.struct("_id", "_key", *fields)
    gathered = scatter(each).withColumn("_task", task).repartitionById(tasks, "_task").groupBy("_task", "_shard", "_pile").agg(F.sort_array(F.collect_list(content)).alias("_rows"))
    # Rows in order of content, piles in order and a number of partitions that no plan changes: the seeded Fisher-Yates gives the same order on every run.
    shuffled = gathered.sortWithinPartitions("_shard", "_pile").withColumn("_rows", F.shuffle("_rows", F.lit(seed)))
    counts = scatter(_dealt(groups.drop("_load"), most)).groupBy("_shard", "_pile").agg(F.count(F.lit(1)).alias("_n"))
    ends = Window.partitionBy("_shard").orderBy("_pile").rowsBetween(Window.unboundedPreceding, -1)
    starts = materialize(counts.select(F.col("_shard").alias("_s"), F.col("_pile").alias("_p"), F.coalesce(F.sum("_n").over(ends), F.lit(0)).alias("_start")), "shard-starts")
    placed = shuffled.join(starts, (F.col("_shard") == F.col("_s")) & (F.col("_pile") == F.col("_p")))
    rows = placed.select("_shard", "_start", F.posexplode("_rows").alias("_i", "_r"))
    made = {f: F.col("_r")[f] for f in fields[1:]} | {"_shard": F.col("_shard"), "_slot": (F.col("_start") + F.col("_i")).cast("long")}
    return rows.select(*(F.col("_r")["_row"][c].alias(c) for c in kept), *(made[n].alias(name) for n, name in names.items()))


def outputs(df: DataFrame) -> dict[str, str]:
    """The names that the columns of ``shuffle_shards`` have beside those of ``df``."""
    return {n: fresh(df, n) for n in OUTPUTS}


def write_shards(df: DataFrame, path: str, **options) -> DataFrame:
    """Write each shard as Parquet under ``path/_shard=N`` (or the name of ``outputs``) and return what was written.

    The tasks of pass two write their piles as they lie, each file in slot order; nothing is shuffled again.
    """
    laid, names = shuffle_shards(df, **options), outputs(df if options.get("keep") is None else df.select(*options["keep"]))
    order = names["_shard"], names["_slot"]
    laid.sortWithinPartitions(*order).write.partitionBy(order[0]).parquet(path)
    return df.sparkSession.read.schema(laid.schema).parquet(path).select(*laid.columns)
