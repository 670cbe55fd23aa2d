"""Session settings the datamart relies on."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    # dates and timestamps without zone must not move
    "spark.sql.session.timeZone": "UTC",
    # run-time sizing of shuffles, and splitting of skewed joins and writes
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    # wide tables make long generated methods; beyond this size HotSpot leaves
    # a method uncompiled, and Spark does better without fusing that stage
    "spark.sql.codegen.hugeMethodLimit": "8000",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a session, also one that somebody else made.

    The number of shuffle partitions stays the caller's: spark.sql.shuffle.partitions
    has to suit the data (about 200 MB each for the largest shuffle), not the cores.
    The adaptive plan merges small partitions; it does not split large ones.
    """
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def session(app_name: str = "creditmart", **settings: str) -> SparkSession:
    """A tuned session; the master comes from the launcher."""
    builder = SparkSession.builder.appName(app_name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return tune(builder.getOrCreate())
