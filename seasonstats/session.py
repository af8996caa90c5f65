"""Session for local runs. On a cluster the job's own session is used as it is."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(app: str = "seasonstats", cpus: int | None = None, memory: str = "8g") -> SparkSession:
    cpus = cpus or int(os.environ.get("BENCH_CPUS") or os.cpu_count() or 4)
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
