"""Candidates as a stream: an extension, as the batch search has none.

Files of candidates that arrive in a folder are gated and matched as they come; a watermark bounds the
state in which the best candidate of a beam and minute is kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.operators.candidates import gate

SCHEMA = "beam long, dm double, sn double, time double, sample long, filter_width long, arrived timestamp"


def read_arrivals(spark: SparkSession, folder: str, files_per_trigger: int = 100) -> DataFrame:
    return spark.readStream.schema(SCHEMA).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def best_by_minute(arrivals: DataFrame, least_dm: float = 10.0, above_sn: float = 7.0, late: str = "10 minutes") -> DataFrame:
    """The best gated candidate of each beam and minute of arrival, and how many there were.

    Rows later than ``late`` are dropped with their window's state.
    """
    best = F.max(F.struct("sn", "dm", "time", "sample", "filter_width")).alias("b")
    windows = gate(arrivals, least_dm, above_sn).withWatermark("arrived", late).groupBy("beam", F.window("arrived", "1 minute").alias("w"))
    return windows.agg(best, F.count("*").alias("n")).select("beam", F.col("w.start").alias("minute"), "b.sn", "b.dm", "b.time", "b.sample", "b.filter_width", "n")


def write_best(best: DataFrame, path: str, checkpoint: str):
    return best.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
