"""From raw documents to packed training sequences: five of the training-data operators, one after another.

Every stage takes texts whole, however long, null and empty ones too, repeated rows and null ids as rows of their own, columns of any
name beside those of documents, and gives no rows for an empty table. All but the last return the columns that they were given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.llm.common import materialize, table
from loomspark.llm.jaccard_join import jaccard_join
from loomspark.llm.mixing import mix
from loomspark.llm.packing import best_fit_packing
from loomspark.llm.quality_rules import accepted
from loomspark.llm.suffix_dedup import suffix_dedup


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the base conditions and every rule accept; null and empty texts go."""
    return accepted(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates the document of the smallest id; of rows equal in id all."""
    kept = jaccard_join(docs).filter("kept").select(F.col("doc_id").alias("__id")).distinct()
    return docs.join(kept, docs["doc_id"].eqNullSafe(kept["__id"]), "left_semi")


def repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the bytes of passages that stand elsewhere too; n_chars is counted anew."""
    made = {"text": F.col("kept_text"), "n_chars": F.length("kept_text").cast("long")}
    cut = suffix_dedup(docs, carry=[c for c in docs.columns if c not in ("doc_id", *made)])
    return cut.select(*[made[c].alias(c) if c in made else "doc_id" if c == "doc_id" else f"carried.{c}" for c in docs.columns])


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as its source's weight takes it, once at least. The whole row comes along, whatever its columns are called."""
    return mix(docs.select("doc_id", "text", "source", F.struct(*docs.columns).alias("row"))).select("row.*")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents with their ids and their places in sequences of 1024 tokens."""
    return best_fit_packing(docs)


STAGES = [("quality rules", quality), ("n-gram Jaccard join", near_duplicates), ("suffix-array dedup", repeated_passages), ("mixing sources to target weights", mixture), ("best-fit packing", packing)]

#: SQL can't express packing by token ids; the stages are tested one by one against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
