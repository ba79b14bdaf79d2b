"""A local session for tests and the bench. On a cluster the caller's own session is used as it is."""

from __future__ import annotations

from pyspark.sql import SparkSession


def local_session(cores: int = 8, memory: str = "12g") -> SparkSession:
    session = (
        SparkSession.builder.master(f"local[{cores}]").appName("paylens")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session
