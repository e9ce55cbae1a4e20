"""Session and scratch locations."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def local_session(cores: str | int = "*", app: str = "matchstats", **settings: str) -> SparkSession:
    """A single-machine session for tests and benchmarks; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.driver.memory", "8g")
        # Building a plan takes half the time without a Python call site per column.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in settings.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh directory that every executor can reach.

    It lies in the shared folder the session names in ``spark.checkpoint.dir``, or else
    beside the tables, in the warehouse folder.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        shared = spark.conf.get("spark.sql.warehouse.dir").rstrip("/") + "/_scratch"
    return f"{shared.rstrip('/')}/{name}-{uuid.uuid4().hex}"
