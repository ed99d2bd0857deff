"""Which sources to process next: dedup, ledger, order over domains, routing to handlers, counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions.urls import candidate_prefixes, url_netloc
from loomspark.session import lookup, with_rank

#: Prefixes up to which a registry is looked up in the expression.
MAPPED = 1_000


def dedup_urls(urls: DataFrame) -> DataFrame:
    """First occurrence of each url (exact match): url, pos."""
    return urls.groupBy("url").agg(F.min("pos").alias("pos"))


def unseen_urls(urls: DataFrame, ledger: DataFrame) -> DataFrame:
    """Rows whose url no ledger row names as its source."""
    return urls.join(ledger.select(F.col("source").alias("url")), "url", "left_anti")


def order_urls(urls: DataFrame) -> DataFrame:
    """Round-robin over domains: url, netloc, round (from 0), ordinal (from 0).

    Within a domain urls go by name; domains by their first url. Ranks come from a range sort, so neither a domain with a third of
    all urls nor the total order passes through one task.
    """
    ranked = with_rank(urls.select("url", url_netloc(F.col("url")).alias("netloc")), ["netloc"], ["url"], "round")
    first = ranked.groupBy("netloc").agg(F.min("url").alias("first"))
    return with_rank(ranked.join(first, "netloc"), [], ["round", "first", "url"], "ordinal").select("url", "netloc", "round", "ordinal")


def route_urls(urls: DataFrame, registry: DataFrame) -> DataFrame:
    """urls with handler: that of the longest registered prefix (registry: prefix, handler); null where none fits.

    A prefix that is registered twice gives its least handler. A registry of up to ``MAPPED`` prefixes becomes a map in the expression:
    the candidates of a url are looked up from the longest on, without a join or a shuffle. A larger one is joined.
    """
    known = registry.filter("prefix is not null").groupBy("prefix").agg(F.min("handler").alias("handler"))
    few = known.limit(MAPPED + 1).collect()
    if len(few) <= MAPPED:
        table = F.map_from_arrays(*(F.array(*map(F.lit, x)).cast("array<string>") for x in ([r.prefix for r in few], [r.handler for r in few])))
        hits = F.filter(F.transform(candidate_prefixes(F.col("url")), lambda p: F.element_at(table, p)), lambda h: h.isNotNull())
        return urls.withColumn("handler", F.get(hits, F.lit(0)) if few else F.lit(None).cast("string"))
    steps = urls.select("url").distinct().select("url", F.posexplode(candidate_prefixes(F.col("url"))).alias("pos", "prefix"))
    found = steps.join(lookup(known), "prefix").groupBy("url").agg(F.min_by("handler", "pos").alias("handler"))
    return urls.join(found, "url", "left")


def dispatch_exact(urls: DataFrame, handlers: DataFrame) -> DataFrame:
    """urls with handler by exact url (handlers: url, handler) and status: processed, or failed where there is none."""
    found = urls.join(lookup(handlers), "url", "left")
    return found.withColumn("status", F.when(F.col("handler").isNull(), "failed").otherwise("processed"))


def run_summary(outcomes: DataFrame) -> DataFrame:
    """Number of sources by status: processed, skipped, failed."""
    return outcomes.groupBy("status").agg(F.count("*").alias("n"))


def routed_status(routed: DataFrame) -> DataFrame:
    return routed.withColumn("status", F.when(F.col("handler").isNull(), "skipped").otherwise("processed"))


def new_ledger_rows(outputs: DataFrame, ledger: DataFrame) -> DataFrame:
    """Sources of the outputs that the ledger does not name yet."""
    return outputs.select("source").distinct().join(ledger.select("source"), "source", "left_anti")
