"""Session factory with the settings that every plan of this package assumes."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession

#: ANSI stays on; the code uses try_* where the semantics want NULL.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.sources.partitionColumnTypeInference.enabled": "false",
    "spark.sql.parquet.compression.codec": "zstd",
}


def get_session(app: str = "tessera", master: str | None = None, **extra: str) -> SparkSession:
    """The active session, or a new one with SETTINGS; `master` only where none is configured."""
    builder = SparkSession.builder.appName(app)
    if master or "SPARK_MASTER" in os.environ:
        builder = builder.master(master or os.environ["SPARK_MASTER"])
    for key, value in {**SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
