"""Session settings the pipeline is meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # Zone-less timestamps do not depend on it, current_timestamp() in dead letters does.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM never compiles methods above 8000 bytes: let Spark split such stages instead.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def configured(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder
