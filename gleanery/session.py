"""Session helper for local runs, tests and the bench; cluster jobs bring their own session."""

from __future__ import annotations

import os

from pyspark.sql import SparkSession


def local_session(cpus: int | str = 8, app: str = "gleanery") -> SparkSession:
    """A local session with the settings that results depend on (UTC) and AQE switched on."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus) if str(cpus).isdigit() else "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("SPARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def read_table(spark: SparkSession, sf_dir: str, name: str):
    """One of the tables that lie as ``<sf_dir>/<name>.parquet``."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
