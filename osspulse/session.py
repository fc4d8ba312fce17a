"""Session settings the plans rely on."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Static and runtime settings, each with the reason it is here.
SETTINGS: dict[str, str] = {
    # Day, month and hour boundaries are UTC boundaries everywhere.
    "spark.sql.session.timeZone": "UTC",
    # Bad text in a typed column must fail, not turn into NULL.
    "spark.sql.ansi.enabled": "true",
    # Runtime join choice, partition sizing and splitting of hot join partitions.
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Table rewrites touch only the partitions present in the written rows.
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


def build_session(app_name: str = "osspulse", master: str | None = None, **extra: str) -> SparkSession:
    """Create (or get) a session with `SETTINGS`; `extra` uses `__` for dots in setting names."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    for key, value in extra.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()
