"""Writers of text, chats, media and the ledger."""

from __future__ import annotations

import os
import re
import shutil
import uuid
from collections.abc import Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from loomspark.functions.text import media_ext, media_hash, media_type
from loomspark.operators.chats import chat_json
from loomspark.operators.frontier import new_ledger_rows
from loomspark.sources.shards import SHARD, shard_by_size, write_shards

def text_rows(df: DataFrame, collected_at: str) -> DataFrame:
    """text, source, collected_at (ISO text), ai_enhanced."""
    return df.select("text", "source", F.lit(collected_at).alias("collected_at"), F.coalesce("ai_enhanced", F.lit(False)).alias("ai_enhanced"))


def chat_json_rows(df: DataFrame, collected_at: str) -> DataFrame:
    return df.select(chat_json(F.col("messages")).alias("messages"), "source", F.lit(collected_at).alias("collected_at"), F.coalesce("ai_enhanced", F.lit(False)).alias("ai_enhanced"))


def write_text(df: DataFrame, path: str, collected_at: str, target: int = SHARD) -> None:
    """Append text rows to numbered files of at most ``target`` bytes of text (see :func:`shard_by_size`), written once."""
    shard_by_size(text_rows(df, collected_at), path, "text", target)


def write_chat(df: DataFrame, path: str, collected_at: str, target: int = SHARD) -> None:
    shard_by_size(chat_json_rows(df, collected_at), path, "messages", target)


def save(df: DataFrame, text_path: str, chat_path: str, collected_at: str, target: int = SHARD) -> None:
    """Rows of both kinds (kind, text, messages, source, ai_enhanced) to their places. They are computed once and written once, each task
    parting its rows by kind."""
    rows = df.filter(F.col("kind").isin("text", "chat")).withColumn("messages", F.when(F.col("kind") == "chat", chat_json(F.col("messages"))))
    rows = rows.select("kind", "text", "messages", "source", F.lit(collected_at).alias("collected_at"), F.coalesce("ai_enhanced", F.lit(False)).alias("ai_enhanced"))
    write_shards(rows, {"text": (text_path, "text"), "chat": (chat_path, "messages")}, target)


def write_ledger(outputs: DataFrame, ledger: DataFrame, path: str, run: str | None = None) -> None:
    """Append the sources of the outputs that are not in the ledger. Call it after the outputs are written: a crash in between is
    harmless, since the next run finds those sources in the outputs.

    run: a name of this run. It has a folder of its own, which is replaced when the run is repeated; runs at the same time don't meet, and
    a source that two of them add is one source to :func:`ledger_sources`.
    """
    rows = new_ledger_rows(outputs, ledger)
    if run is None:
        rows.write.mode("append").parquet(path)
    else:
        rows.withColumn("run", F.lit(run)).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)


def _written(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """These columns of the table at path, empty where there is none yet."""
    try:
        found = spark.read.schema(schema).parquet(path)
        return found.select(*(c.split()[0] for c in schema.split(", ")))
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def ledger_sources(spark: SparkSession, path: str) -> DataFrame:
    """source: those that any run has added to the ledger at path, each once; none where nothing is written yet."""
    return _written(spark, path, "source string").distinct()


def media_rows(blobs: DataFrame) -> DataFrame:
    """content to hash, ext, media_type, content, equal contents once."""
    c = F.col("content")
    rows = blobs.filter("content is not null").select(media_hash(c).alias("hash"), media_ext(c).alias("ext"), media_type(c).alias("media_type"), c)
    return rows.dropDuplicates(["hash"])


def write_media(blobs: DataFrame, path: str) -> None:
    """Append the blobs whose content is not there yet, each once. Contents meet by hash; those that are there are known by
    their hashes alone."""
    known = _written(blobs.sparkSession, path, "hash string").distinct()
    fresh = blobs.filter("content is not null").withColumn("hash", media_hash(F.col("content"))).join(known, "hash", "left_anti")
    media_rows(fresh.select("content")).write.mode("append").partitionBy("media_type").parquet(path)


class _MediaWriter(DataSourceWriter):
    """Tasks write to a folder of their own and move each file to its place when it is whole. A place is the content's hash, so a task that
    runs twice, or two at the same time, put the same file there; an aborted one leaves nothing but whole files."""

    def __init__(self, root: str):
        self.root, self.stage = root, os.path.join(root, f".stage-{uuid.uuid4().hex}")

    def write(self, rows: Iterator[Row]) -> WriterCommitMessage:
        own, n = os.path.join(self.stage, uuid.uuid4().hex), 0
        os.makedirs(own, exist_ok=True)
        try:
            for row in rows:
                place = os.path.join(self.root, row["media_type"], f"{row['hash']}.{row['ext']}")
                if os.path.exists(place):
                    continue
                os.makedirs(os.path.dirname(place), exist_ok=True)
                draft = os.path.join(own, row["hash"])
                with open(draft, "wb") as f:
                    f.write(row["content"])
                os.replace(draft, place)
                n += 1
        finally:
            shutil.rmtree(own, ignore_errors=True)
        return _Files(n)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.stage, ignore_errors=True)

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        shutil.rmtree(self.stage, ignore_errors=True)


class _Files(WriterCommitMessage):
    def __init__(self, n: int):
        self.n = n


class MediaFiles(DataSource):
    """Format ``media_files``: rows hash, ext, media_type, content to files ``<media_type>/<hash>.<ext>`` below ``path``, a folder that is
    mounted on every node."""

    @classmethod
    def name(cls) -> str:
        return "media_files"

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceWriter:
        return _MediaWriter(re.sub("^file:(//)?(?=/)", "", self.options["path"]))


def write_media_files(blobs: DataFrame, path: str) -> None:
    """Blobs (content) as files named by kind and hash; a content that is there already is not written again."""
    blobs.sparkSession.dataSource.register(MediaFiles)
    media_rows(blobs).write.format("media_files").mode("append").save(path)
