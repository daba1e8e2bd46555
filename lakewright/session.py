"""Spark session with the settings that the engine's semantics need."""

from __future__ import annotations

from pyspark.sql import SparkSession

#: UTC days, partition-wise overwrite, typed partition values kept as text (month=03 keeps its zero).
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def session(name: str = "lakewright", master: str | None = None, **more: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    if master:
        builder = builder.master(master)
    return builder.config(map=SETTINGS | more).getOrCreate()
