"""Best-fit packing of token sequences, bulk-synchronous.

Documents are tokenised and cut into pieces of at most ``capacity`` tokens. Pieces are range-sorted by length, so that each
knows its rank among those of its length. Lengths are whole numbers up to the capacity, so both sorted lists, documents and
gaps, are held as runs (length, count): one round takes all documents of a length, longest first. Its sweep gives each run
of documents its successor, the run of smallest gaps that are large enough; documents of equal length that want the same gap
are resolved by rank; the filled runs become runs of smaller gaps and the sweep goes on until no gap fits; the rest open new
sequences. Only runs pass through the driver (at most one row for each length comes in, however large the corpus);
each piece then looks up its own run by its rank.
"""

from __future__ import annotations

import functools
import heapq
import json
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from loomspark.llm.common import bounded, materialize, partitions

CAPACITY = 1024
END = 2


def _byte_of() -> dict[str, int]:
    """The printable character that stands for each byte in the vocabulary files of byte-level BPE, reversed."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(other)}


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> tiktoken.Encoding:
    """The tokenizer of a byte-level BPE file, in a library that gives the same ids several times faster."""
    model = json.load(open(path, encoding="utf-8"))
    special = {x["content"]: x["id"] for x in model.get("added_tokens", [])}
    byte = _byte_of()
    ranks = {bytes(byte[c] for c in word): i for word, i in model["model"]["vocab"].items() if word not in special}
    return tiktoken.Encoding("bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)


@functools.lru_cache(maxsize=2)
def _plain(path: str) -> Tokenizer:
    return Tokenizer.from_file(path)


def ids_of(text: str, path: str) -> np.ndarray:
    """Token ids as ``tokenizers`` gives them with add_special_tokens=False, with the end id behind them.

    Names of special tokens that stand in a text are those tokens. A text with a run of white space on which the fast library's
    pattern gives up goes to the other one.
    """
    try:
        ids = encoder(path).encode_to_numpy(text, allowed_special="all")
    except ValueError:
        ids = np.array(_plain(path).encode(text, add_special_tokens=False).ids)
    return np.append(ids.astype("<u4"), np.array([END], "<u4"))


def _pieces(batches: Iterator[pa.RecordBatch], path: str, capacity: int, with_ids: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary())
        for lo in range(0, len(batch), 500):
            row, piece, start, length, crc, ids = [], [], [], [], [], []
            for i in range(lo, min(lo + 500, len(batch))):
                got = ids_of((texts[i].as_py() or b"").decode("utf-8", "replace"), path)
                cuts = [0, *range(len(got) % capacity or capacity, len(got) + 1, capacity)]
                for k, (a, b) in enumerate(zip(cuts, cuts[1:], strict=False)):
                    part = got[a:b]
                    row.append(i)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(part.tobytes()))
                    ids.append(part)
            made = {"doc_id": batch.column("doc_id").take(pa.array(row, pa.int64())), "piece": pa.array(piece, pa.int32()), "start": pa.array(start, pa.int64()), "length": pa.array(length, pa.int64()), "ids_crc32": pa.array(crc, pa.int64())}
            if with_ids:
                made["ids"] = pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def tokenize(docs: DataFrame, path: str, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """Pieces of each document: doc_id, piece, start, length, ids_crc32 and, with_ids, ids. Only the first piece may be short."""
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, piece int, start long, length long, ids_crc32 long" + ", ids array<int>" * with_ids
    return bounded(docs).select("doc_id", "text").mapInArrow(lambda it: _pieces(it, path, capacity, with_ids), schema)


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[int, int, int, int, int]]:
    """Runs (length, first rank, number, first sequence, offset) for so many pieces of each length."""
    runs: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[tuple[int, int]]] = {}
    opened = 0
    for size in sorted(counts, reverse=True):
        left, rank = counts[size], 0
        reach = [g for g in gaps if g >= size]
        heapq.heapify(reach)
        while left and reach:
            gap = heapq.heappop(reach)
            held = gaps.pop(gap)
            rest = gaps.setdefault(gap - size, []) if gap > size else []
            if gap - size >= size and not rest:
                heapq.heappush(reach, gap - size)
            while left and held:
                first, n = held.pop()
                take = min(left, n)
                runs.append((size, rank, take, first, capacity - gap))
                rest.append((first, take))
                rank, left = rank + take, left - take
                if take < n:
                    held.append((first + take, n - take))
            if held:
                gaps.setdefault(gap, []).extend(held)
        if left:
            each = capacity // size
            bins = -(-left // each)
            for k in range(each):
                take = min(left, bins)
                if not take:
                    break
                runs.append((size, rank, take, opened, k * size))
                rank, left, gap = rank + take, left - take, capacity - (k + 1) * size
                if take < bins and capacity - k * size:  # these sequences end here
                    gaps.setdefault(capacity - k * size, []).append((opened + take, bins - take))
                    bins_left = take
                else:
                    bins_left = bins
                if (k + 1 == each or not left) and gap:
                    gaps.setdefault(gap, []).append((opened, bins_left))
            opened += bins
    return runs


def _place(batches: Iterator[pa.RecordBatch], keys: np.ndarray, runs: np.ndarray, top: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rank, length = batch.column("__pack_rank").to_numpy(), batch.column("length").to_numpy()
        at = np.searchsorted(keys, length * top + rank, "right") - 1
        made = {n: batch.column(n) for n in batch.schema.names if n != "__pack_rank"}
        made |= {"sequence_id": pa.array(runs[at, 3] + rank - runs[at, 1]), "offset": pa.array(runs[at, 4])}
        yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def pack(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """pieces (doc_id, piece, length <= capacity, any others) with sequence_id and offset, packed best-fit.

    Ties of length go by doc_id and piece. Rows that repeat are packed each; a null doc_id is a value like others. Columns named
    sequence_id or offset are replaced, and those whose names begin with __pack_. An empty table gives an empty one.
    """
    spark = pieces.sparkSession
    pieces = pieces.drop("sequence_id", "offset", *[c for c in pieces.columns if c.startswith("__pack_")])
    n = partitions(spark)
    ranked = pieces.repartitionByRange(n, "length", "doc_id", "piece").sortWithinPartitions("length", "doc_id", "piece")
    ranked = materialize(ranked.withColumns({"__pack_p": F.spark_partition_id(), "__pack_i": F.monotonically_increasing_id()}))
    # a length has one run of rows in each partition that it reaches, so this has at most partitions + capacity rows
    runs = ranked.groupBy("__pack_p", "length").agg(F.min("__pack_i").alias("__pack_first"), F.count("*").alias("n"))
    runs = runs.withColumn("__pack_before", F.sum("n").over(W.partitionBy("length").orderBy("__pack_p").rowsBetween(W.unboundedPreceding, -1)))
    where = ranked.join(F.broadcast(runs.select("__pack_p", "length", "__pack_first", "__pack_before")), ["__pack_p", "length"])
    where = where.select(*pieces.columns, (F.col("__pack_i") - F.col("__pack_first") + F.coalesce("__pack_before", F.lit(0))).alias("__pack_rank"))
    counts = {r["length"]: r["n"] for r in ranked.groupBy("length").agg(F.count("*").alias("n")).collect()}  # capacity rows at most, in one job
    plan = np.array(sorted(best_fit(counts, capacity)), np.int64).reshape(-1, 5)
    top = int(max(counts.values(), default=0)) + 1
    keys = plan[:, 0] * top + plan[:, 1]
    made = spark.createDataFrame([], pieces.schema).schema.add("sequence_id", "long").add("offset", "long")
    return where.mapInArrow(lambda it: _place(it, keys, plan, top), made)


def best_fit_packing(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, with_ids: bool = True) -> DataFrame:
    """docs (doc_id, text) tokenised and packed: doc_id, piece, start, length, ids_crc32, ids (with_ids), sequence_id, offset.

    Null and empty texts are one piece, the end id alone. Only documents of more than ``capacity`` tokens are cut. Texts are tokenised
    whole, however long. Rows that repeat and ties are packed each. Only doc_id and text are read; other columns, whatever their names,
    do not come along. An empty table gives an empty one.
    """
    path = path or public_tokenizers.path("byte_bpe_50k.json")
    return pack(materialize(tokenize(docs, path, capacity, with_ids)), capacity)  # range-sorting reads its input twice
