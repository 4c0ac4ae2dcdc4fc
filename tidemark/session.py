"""Session defaults and lineage cuts."""

from __future__ import annotations

import os
import re
import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def local_session(cpus: str = "8", name: str = "tidemark", **conf: str) -> SparkSession:
    """A session for tests and bench runs on one machine."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.driver.memory", os.environ.get("TIDEMARK_DRIVER_MEMORY", "8g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df`` with a checkpoint in the shared folder.

    The folder is ``spark.checkpoint.dir`` of the session. Only where that is
    unset and all runs in one process (tests) a temporary folder is chosen; on a
    cluster that is an error, as its machines would not see it.
    """
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        folder = df.sparkSession.conf.get("spark.checkpoint.dir", None) or context.getConf().get("spark.checkpoint.dir")
        if not folder and not re.match(r"local(\[|$)", context.master):
            raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
        context.setCheckpointDir(folder or tempfile.mkdtemp(prefix="spark-checkpoint-"))
    return df.checkpoint(eager=True)


def if_small(df: DataFrame, max_rows: int = 100_000) -> DataFrame:
    """``df`` with a broadcast hint if it has at most ``max_rows`` rows, else as it is (its join then shuffles).

    The rows are counted up to the limit, so give a table that is cheap to read,
    as a checkpointed one is.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df
