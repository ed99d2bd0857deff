"""From pages to text rows and chats: handlers by prefix, each a job of its own, failures as rows, the ledger last."""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from loomspark.operators.frontier import dedup_urls, route_urls, unseen_urls
from loomspark.schema import MESSAGE
from loomspark.session import materialize

#: Takes pages (url, html) and gives source, text or messages, and if it likes kind (text or chat), ai_enhanced, error.
Handler = Callable[[DataFrame], DataFrame]
OUTPUT = f"kind string, source string, text string, messages array<{MESSAGE.simpleString()}>, ai_enhanced boolean, error string"
COLUMNS = re.findall(r"(?:^|, )(\w+) ", OUTPUT)
#: Handlers that run at the same time.
AT_ONCE = 8


@dataclass
class Registry:
    """Handlers by prefix: reversed host labels and path segments, joined by slashes."""

    prefixes: dict[str, str] = field(default_factory=dict)
    handlers: dict[str, Handler] = field(default_factory=dict)

    def register(self, prefix: str, handler: Handler, name: str | None = None) -> Registry:
        name = name or getattr(handler, "__name__", prefix)
        self.prefixes[prefix] = name
        self.handlers[name] = handler
        return self

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(self.prefixes.items()), "prefix string, handler string")


@dataclass
class Built:
    """outputs (kind, source, text, messages, ai_enhanced, error), outcomes (url, status), and of each handler that ran how many rows and
    errors it gave and, if it failed as a whole, why."""

    outputs: DataFrame
    outcomes: DataFrame
    counts: dict[str, dict]

    def __iter__(self) -> Iterator[DataFrame]:
        return iter((self.outputs, self.outcomes))


def first_pages(pages: DataFrame, urls: DataFrame) -> DataFrame:
    """url, html and the other columns of urls: of each url the first row of pages, that of least pos or, without that column, of least hash.

    Which row that is, is settled on urls, places and hashes; pages meet that decision once.
    """
    placed = pages.select("url", "html", (F.col("pos").cast("long") if "pos" in pages.columns else F.lit(0).cast("long")).alias("pos"), F.xxhash64("html").alias("hash"))
    lead = placed.groupBy("url").agg(F.min(F.struct("pos", "hash")).alias("lead"))
    lead = lead.join(urls, "url").select(F.col("url"), F.col("lead.pos").alias("pos"), F.col("lead.hash").alias("hash"), *(c for c in urls.columns if c != "url"))
    met = placed.join(lead, ["url", "pos", "hash"])
    return met.dropDuplicates(["url", "pos", "hash"]).drop("pos", "hash")


def shaped(rows: DataFrame) -> DataFrame:
    """What a handler gave with all columns of an output; kind follows from messages where it is not said."""
    have = {c.lower(): c for c in rows.columns}
    kinds = dict(x.split(" ", 1) for x in OUTPUT.split(", ", 5))
    of = lambda c: F.col(f"`{have[c]}`").cast(kinds[c]) if c in have else F.lit(None).cast(kinds[c])
    made = rows.select(*(of(c).alias(c) for c in COLUMNS))
    kind = F.coalesce("kind", F.when(F.col("messages").isNotNull(), "chat").otherwise("text"))
    return made.withColumns({"kind": kind, "ai_enhanced": F.coalesce("ai_enhanced", F.lit(False))})


def convert(todo: DataFrame, handlers: dict[str, Handler]) -> tuple[DataFrame, dict[str, dict]]:
    """Each handler over its pages (url, html, handler), as a job of its own in a pool of its own, several at a time.

    todo is a written table parted by handler, so each job reads its own pages alone; what it gives is written once, and its counts are
    taken while it is written. A handler that raises, when it is planned or when it runs, fails for all its pages of this run: they
    become rows with an error, and the other handlers' rows stay.
    """
    spark = todo.sparkSession

    def job(name: str) -> tuple[str, DataFrame, dict]:
        own = todo.filter(F.col("handler") == name).select("url", "html")
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", f"handler-{name}")
        try:
            seen = Observation(f"handler {name}")
            rows = shaped(handlers[name](own)).observe(seen, F.count(F.lit(1)).alias("rows"), F.count("error").alias("errors"))
            written = materialize(rows)
            return name, written, {**seen.get, "failed": None}
        except Exception as e:  # noqa: BLE001  whatever a handler does, the others go on
            why = f"{type(e).__name__}: {str(e).strip().splitlines()[0][:200] if str(e).strip() else ''}"
            failed = own.select(F.col("url").alias("source"), F.lit(f"handler {name} failed: {why}").alias("error"))
            return name, shaped(failed), {"rows": 0, "errors": 0, "failed": why}
        finally:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", None)

    names = sorted(handlers)
    with ThreadPoolExecutor(min(AT_ONCE, max(1, len(names)))) as pool:
        done = list(pool.map(inheritable_thread_target(spark)(job), names))
    outputs = spark.createDataFrame([], OUTPUT)
    for _, rows, _ in done:
        outputs = outputs.unionByName(rows)
    return outputs, {name: counts for name, _, counts in done}


def build(pages: DataFrame, ledger: DataFrame, registry: Registry) -> Built:
    """Pages (url, html) that are new, converted by the handler of their longest prefix.

    A url that is there more than once is handled once, with the html of its first row. outputs hold texts, chats and errors;
    outcomes say of each url: skipped where no handler is registered, failed where its handler gave nothing but errors, else
    processed, a handler that gives no row included. Nothing that one handler does stops another.
    """
    spark = pages.sparkSession
    urls = unseen_urls(dedup_urls(pages.select("url", F.lit(0).alias("pos"))), ledger)
    routed = materialize(route_urls(urls.select("url"), registry.table(spark)))
    todo = materialize(first_pages(pages, routed.filter("handler is not null")).select("url", "html", "handler"), by="handler")
    outputs, counts = convert(todo, registry.handlers)
    state = outputs.groupBy(F.col("source").alias("url")).agg(F.max(F.col("error").isNull()).alias("good"))
    status = F.when(F.col("handler").isNull(), "skipped").when(F.coalesce("good", F.lit(True)), "processed").otherwise("failed")
    return Built(outputs, routed.join(state, "url", "left").select("url", status.alias("status")), counts)
