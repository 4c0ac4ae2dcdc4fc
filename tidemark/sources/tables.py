"""Table access by folder and name."""

from __future__ import annotations

import os
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

ROOT = str(Path(__file__).resolve().parents[2])


def workers_find_package(spark: SparkSession) -> None:
    """Put the folder of this package on the path of Python workers, wherever the driver was started."""
    environment = spark.sparkContext.environment
    paths = [p for p in environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if ROOT not in paths:
        environment["PYTHONPATH"] = os.pathsep.join([ROOT, *paths])


def read_table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table ``folder/name.parquet`` (one file or a folder of parts)."""
    workers_find_package(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")
