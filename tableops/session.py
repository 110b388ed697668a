"""Session used by the tests, the bench and local work."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, warehouse: str | None = None) -> SparkSession:
    """A local UTC session. On a cluster use the session the cluster gives."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("tableops")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", str(cpus).replace("*", "8"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    if warehouse is not None:
        builder = builder.config("spark.sql.warehouse.dir", warehouse)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark
