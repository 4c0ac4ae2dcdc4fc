"""Rebuild decisions from a stream of events."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def _folder(spark: SparkSession) -> str:
    """A new folder under the shared checkpoint folder of the session, else (in one process only) a temporary one."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not base and not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir must name a folder that all machines share")
    base = base or tempfile.gettempdir()
    return f"{base.rstrip('/')}/stream-{uuid.uuid4().hex}"


def table_stream(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """The parquet table as a file stream, be it one file or a folder of parts."""
    static = spark.read.parquet(f"{folder}/{name}.parquet")
    in_folder = any(f"/{name}.parquet/" in f for f in static.inputFiles())
    reader = spark.readStream.schema(static.schema)
    return reader.parquet(f"{folder}/{name}.parquet") if in_folder else reader.option("pathGlobFilter", f"{name}.parquet").parquet(folder)


def daily_counts_stream(events: DataFrame, time: str, group: str, delay: str = "30 days") -> DataFrame:
    """group, day, n, total of a stream, run over what is there and read back once it ends.

    Counts by day are the state; rows later than ``delay`` behind the newest are
    let go by the watermark only between runs of the stream, never within one
    batch. Each batch replaces the table of counts.
    """
    out = _folder(events.sparkSession)
    stamped = events.withColumn("_t", F.col(time).cast("timestamp")).withWatermark("_t", delay)
    counts = stamped.groupBy(F.window("_t", "1 day").alias("w"), group).agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    flat = counts.select(group, F.date_format("w.start", "yyyy-MM-dd").alias("day"), "n", "total")
    query = flat.writeStream.outputMode("complete").option("checkpointLocation", f"{out}/state").trigger(availableNow=True).foreachBatch(lambda df, _: df.write.mode("overwrite").parquet(f"{out}/counts")).start()
    query.awaitTermination()
    return events.sparkSession.read.schema(flat.schema).parquet(f"{out}/counts")


def rebuild_calls(counts: DataFrame, group: str, few: int = 2) -> DataFrame:
    """group, day, n, change, call: ``first``, ``shrunk``, ``few`` or ``rebuild`` against the day before that has rows."""
    change = F.col("n") - F.lag("n").over(Window.partitionBy(group).orderBy("day"))
    rows = counts.select(group, "day", "n", change.alias("change"))
    return rows.withColumn("call", F.when(F.col("change").isNull(), "first").when(F.col("change") < 0, "shrunk").when(F.col("change") < few, "few").otherwise("rebuild"))
