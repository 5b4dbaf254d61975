"""Lets Python workers import this package where it is not installed.

On a cluster the package comes with the job (``--py-files`` or the image).  In
local mode workers only look below the driver's working folder.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def reach(spark: SparkSession) -> SparkSession:
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(":") if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([ROOT, *paths])
    return spark
