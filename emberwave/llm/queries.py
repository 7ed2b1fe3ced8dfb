"""The registered queries of the training-data operators, each over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from emberwave.llm import audit, decontam, fst_tokens, html, langid, mixing, neardup, oracle, prefixes, quality, secrets, tokenfile, toxic, warc


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.scan(_table(spark, sf_dir, "documents"))


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.assess(_table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenfile.through_files(_table(spark, sf_dir, "documents"), "byte_bpe_50k.json", end_id=2)


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = decontam.stored_index(_table(spark, sf_dir, "documents"))
    hits = decontam.exact_hits(index, _table(spark, sf_dir, "benchmark"), size=10)
    return hits.select("doc_id", "n_words", "n_hit", "n_items", decontam.items_digest().alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def benchmark_proximity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The proximity half of op4: windows of which each word lies at its place or the next to it."""
    return decontam.near_report(decontam.stored_index(_table(spark, sf_dir, "documents")), _table(spark, sf_dir, "benchmark"), size=10, slop=1)


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.identify(_table(spark, sf_dir, "documents"))


def op6_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(_table(spark, sf_dir, "pages"))


def op7_minmax_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = neardup.near_duplicates(_table(spark, sf_dir, "documents"), size=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


def op8_warc_derivatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.derivatives(warc.responses(_table(spark, sf_dir, "pages")))


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(_table(spark, sf_dir, "documents"))


def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fst_tokens.count_tokens(_table(spark, sf_dir, "documents"), "piece_bpe_32k.model", limit=4096)


def op11_toxic_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = _table(spark, sf_dir, "documents")
    return toxic.toxicity(documents, toxic.fit(documents, _table(spark, sf_dir, "labels")))


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefixes.prefix_trie(_table(spark, sf_dir, "conversations"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


_QUERIES = (
    op1_secret_scan,
    op2_quality_rules,
    op3_token_files,
    op4_decontamination,
    op5_language_id,
    op6_main_text,
    op7_minmax_near_dedup,
    op8_warc_derivatives,
    op9_source_mix,
    op10_token_counts,
    op11_toxic_spans,
    op12_prefix_trie,
    op13_filter_audit,
    benchmark_proximity,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in _QUERIES}


def oracle_sql() -> dict[str, str]:
    return dict(oracle.SQL)
