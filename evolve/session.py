"""Session settings that suit migrations of large, skewed tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Chained updates on one key share a shuffle; without this a hot key in such
    # a chain is left whole rather than shuffled once more.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Python steps work on slices of 2 MB of text; a batch of 10,000 long texts would only stand in
    # memory on both sides, outside the heap.
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
    # Stored instants have no zone and mean UTC.
    "spark.sql.session.timeZone": "UTC",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the settings to a running session; all of them are run-time settings."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark
