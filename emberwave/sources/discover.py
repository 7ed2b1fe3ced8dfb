"""Which files there are, by name alone."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from emberwave.functions import names


def files(spark: SparkSession, path: str, pattern: str = "*") -> DataFrame:
    """(path, length, name, folder) of the files under a folder or glob; Spark lists them and reads none."""
    listed = spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", "true").load(path).select("path", "length")
    return with_names(listed)


def with_names(frame: DataFrame) -> DataFrame:
    """``frame`` (path) with the file's name and the folder it is in."""
    return frame.withColumn("name", F.regexp_extract("path", "([^/]*)$", 1)).withColumn("folder", F.regexp_extract("path", "([^/]*)/[^/]*$", 1))


def in_beam_folder(folder: Column, name: Column) -> Column:
    """Filterbanks in a folder whose name begins with B."""
    return folder.startswith("B") & name.endswith(".fil")


def beam_files(listed: DataFrame, pattern: str = r"_32bit\.fil$") -> DataFrame:
    """(path, beam) of the files that match, in order of their paths; null where a name tells no beam."""
    return listed.where(F.col("path").rlike(pattern)).select("path", names.beam_of(F.col("path")).alias("beam")).orderBy("path")


def first_in_folder(listed: DataFrame, end: str = ".fits") -> DataFrame:
    """The first file by name of each folder."""
    rank = F.row_number().over(Window.partitionBy("folder").orderBy("path"))
    return listed.where(F.col("path").endswith(end)).withColumn("_rank", rank).where("_rank = 1").drop("_rank")
