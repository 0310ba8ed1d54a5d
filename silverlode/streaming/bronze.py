"""Bronze: incremental, exactly-once ingestion of landed files into append-only tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from ..plans.config import Source, SourceContract
from ..sources.files import read_csv, read_json
from ..sources.tables import Warehouse


_FILES = "path string, modificationTime timestamp, length bigint, content binary"


def start_flow(spark: SparkSession, landing: str, warehouse: Warehouse, source: Source, contract: SourceContract, emitter: str | None, checkpoints: str) -> StreamingQuery:
    """One append flow: what is new at the emitter's path, once, into the source's bronze table.

    The checkpoint knows paths, not contents: a file written again under its old name is not ingested
    again. CSV goes through ``foreachBatch``, which reads the new files by their own headers; its batch
    id names the folder it writes, so a batch that is retried replaces itself.
    """
    path = f"{landing.rstrip('/')}/{source.paths[emitter]}"
    flow = f"{source.name}_{emitter or 'all'}"
    table, checkpoint = warehouse.path("bronze", f"{source.name}_raw"), f"{checkpoints.rstrip('/')}/{flow}"
    if source.format == "json":
        stream = read_json(spark, path, contract, streaming=True)
        return stream.writeStream.foreachBatch(_append(table, flow)).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    names = spark.readStream.format("binaryFile").schema(_FILES).option("recursiveFileLookup", "true").option("maxFileAge", "3650d").load(path).select("path")

    def batch(found: DataFrame, batch_id: int) -> None:
        # one name for each new file, bounded by the batch
        paths = [r["path"] for r in found.distinct().collect()]
        if paths:
            _append(table, flow)(read_csv(found.sparkSession, paths, contract), batch_id)

    return names.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def _append(table: str, flow: str):
    def write(df: DataFrame, batch_id: int) -> None:
        df.write.mode("overwrite").parquet(f"{table}/_flow={flow}/_batch={batch_id}")

    return write


def ingest(spark: SparkSession, landing: str, warehouse: Warehouse, sources: dict[str, Source], contracts: dict[str, SourceContract], checkpoints: str) -> None:
    """Run every flow whose path exists to the end of what has landed; flows of all sources run side by side."""
    running = []
    for s in sources.values():
        for emitter, path in s.paths.items():
            if _exists(spark, f"{landing.rstrip('/')}/{path}"):
                running.append(start_flow(spark, landing, warehouse, s, contracts[s.name], emitter, checkpoints))
    for q in running:
        q.awaitTermination()


def read_bronze(warehouse: Warehouse, source: str) -> DataFrame:
    """All that was ingested of a source."""
    path = warehouse.path("bronze", f"{source}_raw")
    return warehouse.spark.read.option("recursiveFileLookup", "true").parquet(path)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(p)


def deduplicated(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """Beyond parity: at-least-once streams without repeats, in state bounded by a watermark."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)
