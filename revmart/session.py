"""Session settings the marts rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Settings that may change in a running session.
RUNTIME_SETTINGS = {
    # Timestamps without a zone in the extracts are UTC.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Lookup sides up to this estimated size are broadcast; larger ones are shuffled.
    "spark.sql.autoBroadcastJoinThreshold": str(64 * 1024 * 1024),
}
START_SETTINGS = {
    "spark.ui.enabled": "false",
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
    # No Python call sites per column expression: the marts build thousands of them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tune(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings to a session somebody else started."""
    for key, value in RUNTIME_SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str = "revmart", **settings: str) -> SparkSession:
    """Return a session with the marts' settings; ``settings`` overrides or adds to them.

    Shuffle parallelism is left to the cluster (``spark.sql.shuffle.partitions``): AQE
    coalesces small partitions, so a cluster should set it high.
    """
    builder = SparkSession.builder.appName(app_name)
    for key, value in {**RUNTIME_SETTINGS, **START_SETTINGS, **settings}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
