"""Session set-up. Timestamps without zone are only stable under a UTC session."""

from __future__ import annotations

from pyspark.sql import SparkSession


def prepare(spark: SparkSession) -> SparkSession:
    """Apply the settings every session needs, also one built elsewhere."""
    if spark.conf.get("spark.sql.session.timeZone") != "UTC":
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark


def build(app: str = "stormledger", master: str | None = None, **conf: str) -> SparkSession:
    """A session with adaptive execution, skew splitting and size-checked broadcast.

    No join in this package carries a broadcast hint for a table that grows:
    Catalyst broadcasts a side whose size statistics (or, at run time, whose
    measured shuffle size) stay under ``autoBroadcastJoinThreshold`` and sorts
    and merges otherwise, splitting skewed partitions.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.parquet.compression.codec": "zstd",
        "spark.sql.sources.partitionOverwriteMode": "dynamic",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return prepare(builder.getOrCreate())
