"""Session settings the plans rely on.  All can be changed while a session runs."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # The JVM does not compile methods over 8000 bytes of bytecode.  A wide fused stage (enrichment
    # with its three joins) exceeds that and would run interpreted; above this limit Spark runs the
    # operators one by one in generated code small enough to be compiled.
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
