"""Intermediate tables in the folder that driver and executors share."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from ..sources.tables import scratch

_made: list[tuple[SparkSession, str]] = []


def reach_package(spark: SparkSession) -> None:
    """Let Python workers that share this machine's files import the package, wherever the driver was started.

    On a cluster the package is installed or shipped with ``--py-files``; the path is then of no effect.
    """
    here, env = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment
    known = env.get("PYTHONPATH", "")
    if here not in known.split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join(p for p in (here, known) if p)


def new_path(spark: SparkSession, label: str) -> str:
    """A new folder under the one named by ``spark.checkpoint.dir``; only a local master may leave that unset, a cluster raises."""
    path = scratch(spark, label)
    _made.append((spark, path))
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends at files that survive executors."""
    spark = df.sparkSession
    reach_package(spark)
    path = new_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def fresh(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column has it."""
    while name.lower() in {c.lower() for c in df.columns}:
        name += "_"
    return name


def clean(spark: SparkSession) -> int:
    """Delete the intermediate tables that this process has written, once no result over them is wanted; how many there were."""
    mine = [path for of, path in _made if of is spark]
    _made[:] = [m for m in _made if m[0] is not spark]
    conf = spark._jsparkSession.sessionState().newHadoopConf()
    for path in mine:
        at = spark._jvm.org.apache.hadoop.fs.Path(path)
        at.getFileSystem(conf).delete(at, True)
    return len(mine)
