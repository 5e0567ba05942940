"""Sessions for local runs; on a cluster the session comes from outside."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(name: str = "weftline", cpus: int | None = None, memory: str = "8g") -> SparkSession:
    """A local session with adaptive execution and UTC; ``cpus`` threads, ``$BENCH_CPUS`` or 8 by default."""
    cpus = cpus or int(os.environ.get("BENCH_CPUS", "8"))
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", memory)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
