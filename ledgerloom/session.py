"""Session settings the jobs are meant to run with."""

from __future__ import annotations

from pyspark.sql import SparkSession

_METHOD_LIMIT = "spark.sql.codegen.hugeMethodLimit"
SETTINGS = {
    # Dates are UTC dates
    "spark.sql.session.timeZone": "UTC",
    # Re-plan joins and split skewed partitions at run time
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # The JVM does not compile methods of more than 8000 bytes, and the wide projections here get larger than that when
    # they are fused with their neighbours. Above the limit Spark generates them as several smaller methods instead.
    _METHOD_LIMIT: "8000",
}


def configure(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def tune(spark: SparkSession) -> SparkSession:
    """Set in a running session, which may have been built without ``configure``, what its wide projections need."""
    spark.conf.set(_METHOD_LIMIT, SETTINGS[_METHOD_LIMIT])
    return spark
