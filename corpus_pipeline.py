"""The corpus pipeline: quality rules, near duplicates, benchmark passages, mixing, token ids.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read
again as the next one's docs. All but the last return the columns of documents.

In every stage a null doc_id, lang or source is a value of its own, columns beyond those of documents pass through
whatever their names, and an empty table gives an empty one. What a stage does with null and empty texts, ties and
repeated rows stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from emberwave.llm import common, decontam, mixing, neardup, quality, tokenfile


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules reject go: null, empty and short texts among them. Repeated rows go or stay together."""
    return quality.keep_good(docs)


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates stays (five-word shingles, 0.8 or more).

    It is the one with the smallest doc_id; of repeated rows one stays, and rows without words all do.
    """
    return neardup.keep_one(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item, or a whole shorter one, go.

    Null and empty texts stay, repeated rows go or stay together; items that are null or empty occur nowhere.
    """
    return decontam.keep_uncontaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of the sources takes it; repeated rows are taken equally often.

    A null source is one of its own, the last; a source without words, as all null and empty texts, is not taken.
    """
    return mixing.mixed_documents(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token-id files of all documents, repeats included, and each document's place in them.

    A null doc_id comes first; a null or empty text has the end id alone.
    """
    return tokenfile.through_files(docs, "byte_bpe_50k.json", end_id=2)


STAGES = [
    ("quality_rules", quality_stage),
    ("minmax_near_dedup", near_dedup_stage),
    ("benchmark_decontamination", decontamination_stage),
    ("source_mixing", mixing_stage),
    ("token_files", token_stage),
]

#: Suffix arrays and tokenizers have no SQL; a brute-force version checks the stages in tests/llm.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = common.saved(stage(spark, docs, sf_dir), name)
    return docs
