"""Session settings the jobs are written for."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Adaptive execution is relied on: it merges small shuffle partitions, so that
# spark.sql.shuffle.partitions can be set for the largest job, splits skewed ones in
# joins and before writes, and picks broadcast joins from measured sizes.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Query call sites are recorded per column expression otherwise.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}
# Only for clusters: fewer, larger partitions instead of as many as there are cores.
CLUSTER_SETTINGS = {
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "256m",
    "spark.sql.shuffle.partitions": "20000",
}


def build_session(app: str = "pairpulse", master: str | None = None, **extra: str) -> SparkSession:
    """A session with the settings above. ``master`` is for single-machine runs; without
    it the cluster settings apply, unless the submit command overrides them."""
    builder = SparkSession.builder.appName(app)
    settings = SETTINGS | ({} if master else CLUSTER_SETTINGS) | extra
    if master:
        builder = builder.master(master)
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
