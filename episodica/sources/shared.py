"""The folder that driver and executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new path under `spark.checkpoint.dir`. Only on one machine a folder of its own stands in where that is unset; a cluster without it is refused."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if spark.sparkContext.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir isn't set: executors and driver need a folder that they share")
        found = "file://" + tempfile.mkdtemp(prefix="spark-", dir="/tmp")
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"
