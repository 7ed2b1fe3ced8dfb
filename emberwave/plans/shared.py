"""The folder that driver and executors share, and tables written there to cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new path in the folder that the cluster names in ``spark.checkpoint.dir``.

    Only where that is unset in a session of one machine, as in tests, a temporary folder takes its place; on a cluster
    each executor would write to a disk of its own, so there it is an error.
    """
    context = spark.sparkContext
    root = context.getConf().get("spark.checkpoint.dir") or context.getCheckpointDir()
    if not root:
        if context.master.split("[")[0] != "local":
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = f"file://{tempfile.mkdtemp(prefix='emberwave-')}"
        context.setCheckpointDir(root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(frame: DataFrame, path: str) -> DataFrame:
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def saved(frame: DataFrame, name: str) -> DataFrame:
    """``frame`` as a written table: later plans read its files instead of computing it again."""
    return _written(frame, shared_dir(frame.sparkSession, name))


class Scratch:
    """The tables that an operator writes on its way; they go when its result is written.

    A lost executor costs the tasks it ran, as every table is complete in the shared folder before it is
    read; a table is deleted only after what was made of it is complete there too.
    """

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.root = spark, shared_dir(spark, name)
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def saved(self, frame: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}-{uuid.uuid4().hex}"
        out = _written(frame, path)
        self.paths[id(out)] = (out, path)
        return out

    def drop(self, *frames: DataFrame) -> None:
        """Deletes tables that nothing reads any more."""
        for frame in frames:
            _delete(self.spark, self.paths.pop(id(frame))[1])

    def result(self, frame: DataFrame, name: str) -> DataFrame:
        """``frame`` as a table that stays; all others are deleted."""
        out = saved(frame, name)
        self.done()
        return out

    def done(self) -> None:
        """Deletes all tables, where what was made of them is complete elsewhere."""
        self.paths.clear()
        _delete(self.spark, self.root)


def _delete(spark: SparkSession, path: str) -> None:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def dealt_anew(frame: DataFrame, key: str) -> DataFrame:
    """``frame`` with its integer ``key`` worked out once more, so that a join shuffles it though it was grouped by it.

    Adaptive execution splits a partition with very many rows of one key only where both sides of a join come
    straight from a shuffle; an aggregate by the same key between them would keep it whole.
    """
    return frame.withColumn(key, F.col(key).bitwiseXOR(F.lit(0).cast("long")))


def release(spark: SparkSession) -> None:
    """Lets the driver drop what finished rounds of a loop have left: plans, broadcasts and shuffle files.

    They are cleaned when the driver's objects are collected, which in a short loop would not happen
    before its memory is full.
    """
    gc.collect()
    spark.sparkContext._jvm.System.gc()
