"""A training corpus from ``documents`` in five stages, each written as Parquet and read by the next.

Cases, by definition: a null or empty text is clean, holds no benchmark item, has size 0 and is a document
like any other; of equal and near-equal texts the least id stays, of repeated rows one; a document that the
mixture takes twice is there twice; empty tables give an empty corpus; columns of any name pass through,
and where ``documents`` has a ``shard`` or ``slot`` of its own, the new one is ``shard_`` or ``slot_``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from silverlode.llm import decontaminate, mixing, sharding, simhash, toxicity
from silverlode.llm.store import fresh, materialize


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose expected grade is clean."""
    model = toxicity.train(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.score(docs, model)
    return scored.where(~F.col(scored.columns[-1])["toxic"]).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The least id of each SimHash component."""
    return simhash.drop_near_duplicates(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    found = decontaminate.with_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(F.size(found.columns[-1]) == 0).select(*docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mixture takes it."""
    copies = F.col(mixing.outputs(docs)["_copies"])
    times = F.explode(F.array_repeat(F.lit(0), copies)).alias(fresh(docs, "_copy"))
    return mixing.mix(docs).where(copies > 0).select(*docs.columns, times).select(*docs.columns)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every record with its ``shard`` and its ``slot`` in the shuffled shard, or those and underscores where a column is so named."""
    names = sharding.outputs(docs)
    made = [F.col(names[f"_{n}"]).alias(fresh(docs, n)) for n in ("shard", "slot")]
    return sharding.shuffle_shards(docs).select(*docs.columns, *made)


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash_dedup", drop_near_duplicates),
    ("decontamination", drop_leaks),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Fingerprints, the fitted model and the subset sums are beyond SQL; tests compare run() with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
