"""Local session for tests, checks and the bench."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def session(cpus: str | int | None = None, partitions: int = 8) -> SparkSession:
    cpus = cpus or os.environ.get("BENCH_CPUS", "8")
    spark = (SparkSession.builder.master(f"local[{cpus}]").appName("rollbook")
             .config("spark.sql.shuffle.partitions", str(partitions)).config("spark.sql.session.timeZone", "UTC")
             .config("spark.sql.adaptive.enabled", "true").config("spark.sql.adaptive.skewJoin.enabled", "true")
             .config("spark.driver.memory", "12g").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
             .config("spark.sql.autoBroadcastJoinThreshold", "32m").getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark
