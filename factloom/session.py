"""A session for local work, and the package for executors that don't have it."""

from __future__ import annotations

import os
import tempfile
import zipfile

from pyspark.sql import SparkSession


def local_session(cores: str = "*", **conf: str) -> SparkSession:
    base = {
        "spark.sql.shuffle.partitions": "8",
        "spark.sql.session.timeZone": "UTC",
        "spark.ui.enabled": "false",
        "spark.driver.memory": "8g",
        "spark.ui.showConsoleProgress": "false",
    }
    return SparkSession.builder.master(f"local[{cores}]").config(map=base | conf).getOrCreate()


def ship(spark: SparkSession) -> None:
    """Give Python workers this package, once per application."""
    context = spark.sparkContext
    if getattr(context, "_factloom_shipped", False):
        return
    root = os.path.dirname(os.path.abspath(__file__))
    path = os.path.join(tempfile.mkdtemp(prefix="factloom-"), "factloom.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, files in os.walk(root):
            for name in files:
                if name.endswith(".py"):
                    full = os.path.join(folder, name)
                    z.write(full, os.path.join("factloom", os.path.relpath(full, root)))
    context.addPyFile(path)
    context._factloom_shipped = True
