"""Extracted documents (PDF and the like): page windows, joined text, text and chat rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import media_hash
from loomspark.operators.chats import assistant, media_content, message, ordered, text_content


def select_pages(pages: DataFrame, start: int = 0, most: int | None = None) -> DataFrame:
    """Pages start ... start + most - 1, from 0."""
    if start < 0 or most is not None and most < 1:
        raise ValueError("start must be 0 or more, most 1 or more")
    kept = pages.filter(F.col("page_no") >= start)
    return kept if most is None else kept.filter(F.col("page_no") < start + most)


def joined_pages(pages: DataFrame) -> DataFrame:
    """url, markdown: the pages of a document in order, with a blank line between."""
    return pages.groupBy("url").agg(F.array_join(ordered(F.col("page_no"), F.coalesce("markdown", F.lit(""))), "\n\n").alias("markdown"))


def pdf_rows(documents: DataFrame, prompt: str) -> DataFrame:
    """Documents (url, markdown, content) to a text row and a chat row each: kind, text, messages, source, ai_enhanced."""
    chat = F.array(message("user", text_content(F.lit(prompt)), media_content(F.lit("other_media"), media_hash(F.col("content")))), assistant(F.col("markdown")))
    rows = F.array(
        F.struct(F.lit("text").alias("kind"), F.col("markdown").alias("text"), F.lit(None).alias("messages")),
        F.struct(F.lit("chat").alias("kind"), F.lit(None).cast("string").alias("text"), chat.alias("messages")),
    )
    return documents.select("url", F.explode(rows).alias("r")).select("r.*", F.col("url").alias("source"), F.lit(True).alias("ai_enhanced"))
