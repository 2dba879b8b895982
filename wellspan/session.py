"""Session helpers."""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import SparkSession

ROOT = str(Path(__file__).resolve().parent.parent)


def with_code(spark: SparkSession) -> SparkSession:
    """Let Python workers of this session import the package, whatever folder they start in.

    On a cluster the package ships with ``--py-files``; the extra path is then unused.
    """
    environment = spark.sparkContext.environment
    paths = environment.get("PYTHONPATH", "").split(":")
    if ROOT not in paths:
        environment["PYTHONPATH"] = ":".join([*filter(None, paths), ROOT])
    return spark
