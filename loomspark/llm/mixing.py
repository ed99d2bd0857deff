"""Temperature mixing of sources, with DataFrame functions alone.

A source with share p of the tokens gets weight p**a / sum of all. The exponent a is bisected in millionths, 32 ways at a time so that
four small jobs do: the smallest one, so the flattest mixture, with which no source is repeated more often than a limit, or with which the entropy of the weights
is at most a target. Weights become token budgets; a budget is spent in epochs, each a new permutation of the source's blocks
and of the documents within each block, the last one cut off where the budget ends.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.llm.common import materialize
from loomspark.llm.quality_rules import words

MAX_REPEAT = 1.5
#: Documents of a block, on average.
BLOCK = 4096
SEED = 17
#: Sources up to which their table is broadcast.
SOURCES = 50_000
_GRID, _POINTS = 1_000_000, 32


def _key():
    return F.coalesce(F.concat(F.lit("s"), F.col("source").cast("string")), F.lit("-"))


def _measured(sources: DataFrame, exponents: list[int]) -> dict[int, tuple[float, float, float, float]]:
    """For each exponent: sum of p**a, of p**a ln p**a, largest p**a / p, largest p / p**a."""
    a = F.col("k") / _GRID
    rows = sources.select("share", F.explode(F.array(*map(F.lit, exponents))).alias("k")).select("k", "share", F.pow("share", a).alias("q"))
    rows = rows.groupBy("k").agg(F.sum("q"), F.sum(F.col("q") * F.ln("q")), F.max(F.col("q") / F.col("share")), F.max(F.col("share") / F.col("q")))
    return {r[0]: tuple(r)[1:] for r in rows.collect()}  # a row for each exponent; an iterator would run a job for each partition


def exponent(sources: DataFrame, max_repeat: float | None, entropy: float | None, budget: float | None) -> float:
    """Smallest a of 0 ... 1 that keeps to the limits; budget is in multiples of all tokens (None: every document at least once)."""

    def fits(z: float, plogp: float, most: float, least: float) -> bool:
        repeat = most * least if budget is None else budget * most / z
        ok = max_repeat is None or repeat <= max_repeat * (1 + 1e-9)
        return ok and (entropy is None or math.log(z) - plogp / z <= entropy + 1e-9)

    low, high = 0, _GRID
    if fits(*_measured(sources, [0])[0]):
        return 0.0
    while high - low > 1:  # low does not fit; high fits, or is 1
        points = sorted({low + (high - low) * i // _POINTS for i in range(1, _POINTS)} - {low, high})
        found = _measured(sources, points)
        good = [k for k in points if fits(*found[k])]
        high = min(good, default=high)
        low = max([k for k in points if k < high and k not in good], default=low)
    return high / _GRID


def mix(docs: DataFrame, max_repeat: float | None = MAX_REPEAT, entropy: float | None = None, budget: float | None = None, seed: int = SEED) -> DataFrame:
    """Rows of docs (doc_id, text, source, any others) as often as the mixture takes them, with n_tokens, epoch, block,
    block_key and doc_key; sorted by epoch, block_key, doc_key the rows of a source are its permuted blocks.

    Tokens are words. budget is in multiples of all tokens; None is the least with which every document is used. Null text
    has no tokens; a null source is a source of its own; sources without tokens are taken once. Blocks are dealt by id and text, so
    rows of one id, or of none, spread over them; rows equal in both tie and are in or out together. Texts are counted whole. Columns
    that bear a name made here, or one that begins with __m_, are replaced, others kept. An empty table gives an empty one.
    """
    made = ["n_tokens", "epoch", "block", "block_key", "doc_key"]
    kept = [c for c in docs.columns if c not in made and not c.startswith("__m_")]
    sized = docs.select(*kept, F.size(words(F.coalesce("text", F.lit("")))).cast("long").alias("n_tokens"), _key().alias("__m_s"), F.xxhash64("doc_id", "text").alias("__m_d"))
    meta = materialize(sized.select("__m_d", "n_tokens", "__m_s"))
    totals = meta.groupBy("__m_s").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("n"))
    total = totals.agg(F.sum("tokens")).first()[0] or 0
    sources = materialize(totals.withColumn("share", F.col("tokens") / F.lit(float(max(1, total)))))
    live = sources.filter("tokens > 0")
    a = exponent(live, max_repeat, entropy, budget) if total else 1.0
    q = F.pow("share", F.lit(a))
    z, _, _, least = _measured(live, [round(a * _GRID)])[round(a * _GRID)] if total else (1.0, 0, 0, 1.0)
    repeat = q / F.col("share") * least if budget is None else budget * q / (z * F.col("share"))
    plan = sources.withColumn("take", F.when(F.col("tokens") > 0, F.floor(repeat * F.col("tokens") + 1e-6)).otherwise(0).cast("long"))
    full = F.when(F.col("tokens") > 0, F.floor(F.col("take") / F.greatest("tokens", F.lit(1)))).otherwise(1).cast("int")
    plan = plan.withColumn("__m_full", full).withColumn("rest", F.when(F.col("tokens") > 0, F.col("take") - F.col("__m_full") * F.col("tokens")).otherwise(0))
    plan = plan.withColumn("__m_blocks", F.ceil(F.col("n") / BLOCK).cast("int")).select("__m_s", "__m_full", "__m_blocks", "rest")
    if sources.count() <= SOURCES:
        plan = F.broadcast(plan)

    def keyed(x: DataFrame, epoch) -> DataFrame:
        x = x.withColumn("block", F.pmod(F.xxhash64("__m_d", F.lit(seed)), F.col("__m_blocks")).cast("int"))
        return x.withColumns({"block_key": F.xxhash64(F.lit(seed), epoch, "__m_s", "block"), "doc_key": F.xxhash64(F.lit(seed + 1), epoch, "__m_d")})

    # where the last epoch ends: first the block, then the document within it
    last = keyed(meta.join(plan, "__m_s"), F.col("__m_full"))
    blocks = last.groupBy("__m_s", "block_key", "rest").agg(F.sum("n_tokens").alias("t"))
    upto = W.partitionBy("__m_s").orderBy("block_key").rangeBetween(W.unboundedPreceding, W.currentRow)
    edge = blocks.withColumn("upto", F.sum("t").over(upto)).filter(F.col("upto") > F.col("rest"))
    edge = edge.groupBy("__m_s").agg(F.min("block_key").alias("__m_block"), F.min_by(F.col("rest") - F.col("upto") + F.col("t"), "block_key").alias("left"))
    inside = last.join(edge.select("__m_s", F.col("__m_block").alias("block_key"), "left"), ["__m_s", "block_key"]).select("__m_s", "doc_key", "n_tokens", "left")
    inside = inside.groupBy("__m_s", "doc_key", "left").agg(F.sum("n_tokens").alias("n_tokens"))  # equal rows, of which a block may hold any number, are one
    within = W.partitionBy("__m_s").orderBy("doc_key").rangeBetween(W.unboundedPreceding, W.currentRow)
    stop = inside.withColumn("upto", F.sum("n_tokens").over(within)).filter(F.col("upto") > F.col("left")).groupBy("__m_s").agg(F.min("doc_key").alias("__m_doc"))
    cut = materialize(plan.join(edge.select("__m_s", "__m_block"), "__m_s", "left").join(stop, "__m_s", "left").select("__m_s", "__m_full", "__m_blocks", "__m_block", "__m_doc"))
    if sources.count() <= SOURCES:
        cut = F.broadcast(cut)
    out = sized.join(cut, "__m_s").withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("__m_full"))))
    out = keyed(out, F.col("epoch"))
    before = (F.col("block_key") < F.col("__m_block")) | (F.col("block_key") == F.col("__m_block")) & (F.col("doc_key") < F.col("__m_doc"))
    return out.filter((F.col("epoch") < F.col("__m_full")) | before).select(*kept, *made)
