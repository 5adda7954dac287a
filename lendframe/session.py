"""Local session for tests, bench and examples."""

import os

from pyspark.sql import SparkSession


def local_session(cores: str | int | None = None, name: str = "lendframe") -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cores}]").appName(name)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark
