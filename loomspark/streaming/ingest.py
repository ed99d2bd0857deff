"""Incremental ingest: new sources only, batch after batch, safe to run again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from loomspark.jobs.build import Handler, convert, first_pages
from loomspark.operators.chats import chat_json
from loomspark.operators.frontier import new_ledger_rows, route_urls, unseen_urls
from loomspark.session import materialize


def _parquet(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """The table at path; empty where nothing has been written yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema)


def _put(rows: DataFrame, path: str, batch_id: int) -> None:
    """Rows of a batch to its own folder, which is replaced when the batch is run again."""
    rows = rows.withColumn("batch", F.lit(batch_id).cast("long"))
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)


def ingest_batch(pages: DataFrame, registry: DataFrame, handlers: dict[str, Handler], ledger_path: str, text_path: str, batch_id: int, chat_path: str | None = None, failed_path: str | None = None) -> None:
    """Pages (url, html, and pos or not) that are new: route, convert, write, then append the ledger.

    Of a url that is there more than once the row of least pos is taken. Pages are read once and written by handler; each handler is a
    job of its own, and one that raises turns its pages into failures. Texts, chats and failures (source, error) go to their tables;
    a source is in the ledger once a row of it is written, so a failed one is taken up again when it comes again. A batch
    writes to its own folders and replaces them when it is run again; the ledger is written last. After a crash in between the batch is
    run again with the same ledger, so nothing is lost or doubled.
    """
    spark = pages.sparkSession
    ledger = _parquet(spark, ledger_path, "source string, batch long").filter(F.col("batch") != batch_id)
    fresh = unseen_urls(pages.select("url").distinct(), ledger)
    routed = route_urls(fresh, registry).filter("handler is not null")
    todo = materialize(first_pages(pages, routed).select("url", "html", "handler"), by="handler")
    outputs, _ = convert(todo, handlers)
    _put(outputs.filter("error is null and kind = 'text'").select("text", "source", "ai_enhanced"), text_path, batch_id)
    good = _parquet(spark, text_path, "source string, batch long")
    if chat_path is not None:
        _put(outputs.filter("error is null and kind = 'chat'").select(chat_json(F.col("messages")).alias("messages"), "source", "ai_enhanced"), chat_path, batch_id)
        good = good.unionByName(_parquet(spark, chat_path, "source string, batch long"))
    if failed_path is not None:
        _put(outputs.filter("error is not null").select("source", "error"), failed_path, batch_id)
    _put(new_ledger_rows(good.filter(F.col("batch") == batch_id), ledger), ledger_path, batch_id)


def incremental_ingest(stream: DataFrame, registry: DataFrame, handlers: dict[str, Handler], ledger_path: str, text_path: str, checkpoint: str, chat_path: str | None = None, failed_path: str | None = None) -> StreamingQuery:
    """A stream of pages (url, html, and pos or not), all that is there now; run again, it takes up what came since.

    Tables are as in :func:`ingest_batch`; without chat_path or failed_path chats or failures are not kept.
    """
    write = stream.writeStream.trigger(availableNow=True).option("checkpointLocation", checkpoint)
    return write.foreachBatch(lambda df, i: ingest_batch(df, registry, handlers, ledger_path, text_path, i, chat_path, failed_path)).start()
