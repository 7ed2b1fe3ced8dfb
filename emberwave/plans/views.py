"""Views of the driver's tables in the shapes that the operators take."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """beam, dm, sn, time, sample, filter_width from lineitem."""
    return table(spark, sf_dir, "lineitem").select(
        (F.col("l_suppkey") % 73).alias("beam"),
        (((F.col("l_partkey") * 37) % 100190) / 10.0).alias("dm"),
        (F.col("l_quantity") / 5.0).alias("sn"),
        ((F.col("l_orderkey") % 3600) + F.col("l_linenumber") / 10.0).alias("time"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("sample"),
        F.pow(F.lit(2.0), F.col("l_linenumber") - 1).cast("long").alias("filter_width"),
    )


def catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """psrj, dm, ra_deg, dec_deg, ord from every tenth part."""
    key = F.col("p_partkey")
    return (
        table(spark, sf_dir, "part")
        .where(key % 10 == 0)
        .select(
            F.col("p_name").alias("psrj"),
            (((key * 53) % 10019).cast("double") + 0.25).alias("dm"),
            ((key * 7) % 360).cast("double").alias("ra_deg"),
            (F.col("p_size").cast("double") - 25).alias("dec_deg"),
            key.alias("ord"),
        )
    )


def samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    """chan, t, x: sixteen channels of event values in time order."""
    return table(spark, sf_dir, "events").selectExpr(
        "user_id % 16 AS chan", "CAST(row_number() OVER (PARTITION BY user_id % 16 ORDER BY ts, event_id) - 1 AS BIGINT) AS t", "value AS x"
    )


def series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """series_id, beam, x: an embedding as a series of 64 values, its label as beam."""
    return table(spark, sf_dir, "embeddings").select(
        F.col("vec_id").alias("series_id"), F.col("label").alias("beam"), F.col("embedding").cast("array<double>").alias("x")
    )
