"""A session with the settings that the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: Times are UTC in every layer; raw values go through try_ functions alone, so ANSI errors are real errors.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def create_session(app: str = "silverlode", master: str | None = None, **settings: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for k, v in {**SETTINGS, **settings}.items():
        builder = builder.config(k, v)
    return builder.getOrCreate()
