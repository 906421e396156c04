"""Session settings the engine expects, in one place."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution picks join strategies from measured shuffle sizes, splits
# skewed join partitions and merges small ones. Dimension joins carry no
# broadcast hint: a side is broadcast only when its size is below the threshold,
# otherwise the join shuffles.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.autoBroadcastJoinThreshold": "32m",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "32m",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app: str, master: str | None = None, **extra: str) -> SparkSession:
    """Create (or fetch) a session with the engine's settings; ``extra`` wins.

    Keys in ``extra`` use ``__`` for dots, e.g. ``spark__ui__enabled="false"``.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = SETTINGS | {k.replace("__", "."): v for k, v in extra.items()}
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
