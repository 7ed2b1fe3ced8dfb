"""``python -m emberwave FOLDER OUT``: searches the filterbanks of a folder; the exit status is 1 if a beam failed."""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from emberwave.plans import search
from emberwave.plans.settings import Settings

SOURCES = "psrj string, dm double, ord long"


def main(arguments: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="emberwave", description="Searches filterbanks for single pulses.")
    parser.add_argument("path", help="a filterbank, a folder of them, or a glob")
    parser.add_argument("out", help="where candidates, detections and the run log go")
    parser.add_argument("--settings", help="a file of settings in JSON or YAML")
    parser.add_argument("--sources", help="known sources as Parquet or CSV (psrj, dm, ord)")
    chosen = parser.parse_args(arguments)
    spark = SparkSession.builder.appName("emberwave").getOrCreate()
    settings = Settings.load(Path(chosen.settings).read_text()) if chosen.settings else Settings()
    if not chosen.sources:
        sources = spark.createDataFrame([], SOURCES)
    elif chosen.sources.endswith(".csv"):
        sources = spark.read.schema(SOURCES).option("header", True).csv(chosen.sources)
    else:
        sources = spark.read.parquet(chosen.sources).select("psrj", "dm", "ord")
    try:
        found = search.run_search(spark, chosen.path, sources, chosen.out, settings)
    except Exception as error:
        print(f"failed: {error}", file=sys.stderr)
        return 1
    for row in found.groupBy("detection_type").agg(F.count("*").alias("n")).orderBy("detection_type").collect():
        print(f"{row.detection_type}: {row.n}")
    return 0


if __name__ == "__main__":
    sys.exit(main())
