"""Local Spark session for tests, comparison and benchmark."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | None = None) -> SparkSession:
    cpus = cpus or min(8, os.cpu_count() or 1)
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("linkloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
