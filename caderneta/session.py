"""Session settings the operators rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Correctness: dates never depend on the machine's zone.
# Scale: AQE sizes shuffles from real bytes and splits skewed join partitions.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Plans here hold many column expressions; recording where each one was written
    # takes longer than building them.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(
    app: str = "caderneta", master: str | None = None, **conf: str
) -> SparkSession:
    """Session with ``SETTINGS``; the cluster supplies sizes, shuffles and paths.

    ``conf`` takes setting names with ``__`` for the dots.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
