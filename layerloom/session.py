"""Session for local runs and tests. On a cluster, pass in the session you have."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(
    app_name: str = "layerloom", cores: str = "*", memory: str = "8g", config: dict[str, str] | None = None
) -> SparkSession:
    """A single-JVM session; the shuffle width suits small data only."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app_name)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
    )
    for key, value in (config or {}).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()
