"""The queries of this subpackage: thin layers over its operators."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontaminate, embeddings, mixing, pii, secrets, sharding, simhash, toxicity, urls, warc
from .store import materialize, new_path, reach_package


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    reach_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = urls.train(urls.labelled_urls(spark))
    out = urls.judge(_table(spark, sf_dir, "pages").select("page_id", "url"), model)
    return out.select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"), F.col("_rule").alias("rule"), F.col("_verdict").alias("verdict"))


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    out = sharding.write_shards(docs, new_path(spark, "shards"))
    return out.select(
        "doc_id", sharding.byte_size(F.col("text")).alias("size"), F.crc32("text").alias("text_crc32"), F.lit("key").alias("law"),
        F.col("_shard").alias("shard"), F.col("_slot").alias("slot"), F.col("_grown").alias("grown_shard"),
    )


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, _table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select("doc_id", "toxicity.severity", "toxicity.grade", "toxicity.toxic")


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.with_leaks(docs, _table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", (F.size("leaks") > 0).alias("contaminated"), F.col("leaks.item").alias("item_ids"))


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.simhash_components(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select(F.col("id").alias("doc_id"), simhash.hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def op6_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(_table(spark, sf_dir, "documents").select("doc_id", "text", "source"))
    return mixed.select("doc_id", F.col("_size").alias("size"), F.col("_source_size").alias("source_size"), F.col("_target").alias("target"), F.col("_taken").alias("taken"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.with_spans(docs, pii.train(docs))
    return found.select("doc_id", *(f"pii.n_{k}" for k in pii.KINDS), "pii.base_sha256", "pii.spans")


def op8_embeddings(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embeddings.embedding_components(_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = new_path(spark, "warc")
    warc.write_warc(_table(spark, sf_dir, "pages").select("page_id", "url", "html"), path)
    records = warc.read_warc(spark, path).withColumn("payload_sha1", F.sha1("payload")).drop("payload")
    captures = warc.assemble(materialize(records, "warc-records"))
    notes = F.element_at("metadata", 1)["fields"]
    note = lambda name: F.try_element_at(notes, F.lit(name)).cast("long")
    revisit = F.col("response.type") == "revisit"
    digest = F.when(revisit, F.regexp_replace("response.payload_digest", "^sha1:", "")).otherwise(F.col("response.payload_sha1"))
    return captures.select(
        F.try_element_at(notes, F.lit("page-id")).try_cast("long").alias("page_id"), F.when(revisit, note("payload-bytes")).otherwise(F.col("response.payload_bytes")).alias("payload_bytes"),
        digest.alias("payload_digest"), F.col("response.type").alias("record_type"), note("refers-to-page").alias("refers_to"),
    )


def op10_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.with_spans(docs, secrets.train(docs))
    return found.select("doc_id", *(f"secrets.n_{k}" for k in secrets.KINDS), "secrets.base_sha256", "secrets.spans")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = [op1_urls, op2_sharding, op3_toxicity, op4_decontamination, op5_simhash, op6_mixing, op7_pii, op8_embeddings, op9_warc, op10_secrets]
    return {f.__name__: f for f in found}


OP9 = """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
d AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM p),
t AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS top FROM d)
SELECT page_id, payload_bytes, payload_digest, CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> top THEN top END AS refers_to FROM t"""


def oracle_sql() -> dict[str, str]:
    """The others rest on trained models, seeded hashes or iteration; their tests hold brute-force versions."""
    return {"op9_warc": OP9}
