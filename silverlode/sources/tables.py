"""Tables of the pipeline: names, scans, full refreshes, appends."""

from __future__ import annotations

import re
import uuid

from pyspark.sql import DataFrame, SparkSession

from ..plans.config import Params

#: Fixed columns of the operations tables.
PIPELINE_RUNS = "run_id string, run_ts timestamp, environment string, git_sha string, deployed_by string, source string, bronze_rows bigint, valid_rows bigint, quarantine_rows bigint, conserved boolean"
DQ_RESULTS = "run_id string, run_ts timestamp, source string, rule string, column string, severity string, evaluated bigint, violations bigint"

_VERSION = re.compile(r"v(\d{12})")
LOCAL_ROOT = "/tmp/checkpoints/silverlode"


class Warehouse:
    """Parquet tables under a root, one folder for each layer and table; any file system that Spark writes will do.

    A refreshed table is a row of numbered folders, of which the last complete one counts: it is complete
    when Spark's committer has put its mark there, so nothing is renamed and readers see the old table or
    the new one. With ``params`` each table also has its name in the catalog, as a view of what counts.
    """

    def __init__(self, spark: SparkSession, root: str, params: Params | None = None):
        self.spark, self.root, self.params = spark, root.rstrip("/"), params

    def path(self, layer: str, table: str) -> str:
        return f"{self.root}/{layer}/{table}"

    def _at(self, path: str):
        p = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), p

    def _versions(self, layer: str, table: str) -> list[int]:
        """Numbers of the complete versions, in order."""
        fs, at = self._at(self.path(layer, table))
        if not fs.exists(at):
            return []
        numbers = [int(m[1]) for f in fs.listStatus(at) if (m := _VERSION.fullmatch(f.getPath().getName()))]
        return [n for n in sorted(numbers) if fs.exists(self._at(f"{self._version(layer, table, n)}/_SUCCESS")[1])]

    def _version(self, layer: str, table: str, number: int) -> str:
        return f"{self.path(layer, table)}/v{number:012d}"

    def read(self, layer: str, table: str) -> DataFrame:
        """The last complete version; of a table that is appended to, all its parts."""
        if versions := self._versions(layer, table):
            return self.spark.read.parquet(self._version(layer, table, versions[-1]))
        return self.spark.read.option("recursiveFileLookup", "true").parquet(self.path(layer, table))

    def exists(self, layer: str, table: str) -> bool:
        fs, at = self._at(self.path(layer, table))
        return fs.exists(at)

    def refresh(self, layer: str, table: str, df: DataFrame) -> DataFrame:
        """Replace a table with a recomputed one, which may read the old one; the version before it stays for readers under way."""
        known = self._versions(layer, table)
        number = max(known, default=0) + 1
        new = self._version(layer, table, number)
        df.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "true").parquet(new)
        for old in known[:-1]:
            fs, at = self._at(self._version(layer, table, old))
            fs.delete(at, True)
        self._publish(layer, table, new)
        return self.spark.read.parquet(new)

    def append(self, layer: str, table: str, df: DataFrame, part: str | None = None) -> None:
        """Add rows as a part of a table; a part that is written again replaces itself, so a retry adds nothing."""
        df.write.mode("overwrite").parquet(f"{self.path(layer, table)}/_part={part or uuid.uuid4().hex}")
        self._publish(layer, table, self.path(layer, table))

    def ensure(self, layer: str, table: str, ddl: str) -> None:
        if not self.exists(layer, table):
            self.append(layer, table, self.spark.createDataFrame([], ddl), "0")

    def _publish(self, layer: str, table: str, path: str) -> None:
        if self.params is None:
            return
        name = self.params.qualified(layer, table)
        self.spark.sql(f"CREATE SCHEMA IF NOT EXISTS {name.rpartition('.')[0]}")
        if path == self.path(layer, table):  # parts: a table over the folder finds those added later
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.read(layer, table).schema)
            self.spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (recursiveFileLookup 'true') LOCATION '{path}'")
            self.spark.catalog.refreshTable(name)
        else:
            self.spark.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")


def catalog_table(spark: SparkSession, params: Params, layer: str, table: str) -> DataFrame:
    """A table by its name in the catalog."""
    return spark.read.table(params.qualified(layer, table))


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: under ``spark.checkpoint.dir``, which only a local master may leave unset."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("spark.checkpoint.dir must name a shared folder")
        root = LOCAL_ROOT
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"
