"""The registered queries of this subpackage: each applies one operator to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from loomspark.llm import byte_bpe, divergence, periodic_runs
from loomspark.llm import embedding_dedup as embeddings
from loomspark.llm import jaccard_join as jaccard
from loomspark.llm import quality_rules as rules
from loomspark.llm import substring_dedup as substrings
from loomspark.llm import suffix_dedup as suffixes
from loomspark.llm import warc
from loomspark.llm.common import spread, table
from loomspark.llm.language_id import language_id
from loomspark.llm.license_scan import license_scan
from loomspark.llm.mixing import mix
from loomspark.llm.packing import best_fit_packing


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rules.quality_rules(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("text")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.convert_pages(table(spark, sf_dir, "pages"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(spread(table(spark, sf_dir, "documents").select("doc_id", "text", "lang")))


def op4_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_join(table(spark, sf_dir, "documents"))


def op5_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.substring_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op6_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))).drop("spans")


def op7_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), with_ids=False)


def op8_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix(table(spark, sf_dir, "documents").select("doc_id", "text", "source")).drop("text")


def op9_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.embedding_dedup(table(spark, sf_dir, "embeddings"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.suffix_dedup(table(spark, sf_dir, "documents"), with_text=False)


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergence(spread(table(spark, sf_dir, "documents").select("text", "lang", "source")))


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.periodic_runs(spread(table(spark, sf_dir, "documents").select("doc_id", "text")), with_text=False, plant=True)


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return byte_bpe.decode(byte_bpe.encode(spread(table(spark, sf_dir, "documents").select("doc_id", "text"))), with_text=False)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_quality_rules, op2_warc, op3_language_id, op4_ngram_jaccard_join, op5_substring_dedup, op6_license_scan, op7_best_fit_packing, op8_source_mixing, op9_embedding_dedup, op10_suffix_dedup, op11_source_divergence, op12_periodic_runs, op13_byte_bpe)}

ORACLES: dict[str, str] = {"op1_quality_rules": rules.ORACLE, "op2_warc": warc.ORACLE, "op4_ngram_jaccard_join": jaccard.ORACLE, "op5_substring_dedup": substrings.ORACLE, "op9_embedding_dedup": embeddings.ORACLE, "op10_suffix_dedup": suffixes.ORACLE, "op11_source_divergence": divergence.ORACLE}
