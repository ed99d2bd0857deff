"""Suffix-array deduplication: every passage of N bytes that stands anywhere else is cut out, all its copies.

The suffixes sorted are those at anchors (see :mod:`loomspark.llm.repeats`), one for each 80 bytes or so of what may repeat. Splitters
sampled from them range-partition them by their leading bytes; of suffixes that agree in these, by their anchor. A bucket
sorts its suffixes, and the reversed prefixes in front of them, by multikey sort and reads repeats off the common lengths of
neighbours. Suffixes that hold equal windows agree in an anchor of 40 bytes, and splitters fall between anchors: the last suffix of
a bucket and the first of the next agree in less, so that comparing across the boundary can find nothing. Only a hot anchor is
parted further, by content that equal windows share.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import partitions
from loomspark.llm.repeats import Repeats, keyed, merged, repeated_spans

#: Bytes of the gram that anchors a window.
GRAM = 40


def _cut_bytes(batches: Iterator[pa.RecordBatch], keep: list[str], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        spans = batch.column("spans")
        at = spans.offsets.to_numpy()
        pairs = np.column_stack([spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e")]) if len(spans.values) else np.zeros((0, 2), np.int64)
        n = np.diff(offsets)
        removed, runs, digest, texts, bounds = np.zeros(len(n), np.int64), np.zeros(len(n), np.int64), [], [], []
        for i in range(len(n)):
            text = data[offsets[i] : offsets[i + 1]]
            cut = merged(pairs[at[i] : at[i + 1]], n[i]) if at[i + 1] > at[i] else np.zeros((0, 2), np.int64)
            if len(cut):
                gone = np.zeros(len(text) + 1, np.int8)
                gone[cut[:, 0]] += 1
                gone[cut[:, 1]] -= 1
                text = text[np.cumsum(gone[:-1]) == 0]
                removed[i], runs[i] = (cut[:, 1] - cut[:, 0]).sum(), len(cut)
            digest.append(hashlib.sha256(text).hexdigest())
            if with_text:
                texts.append(text.tobytes().decode("utf-8", "ignore"))
                bounds.append([{"s": int(s), "e": int(e)} for s, e in cut])
        made = {"n_bytes": pa.array(n), "n_removed": pa.array(removed), "n_spans": pa.array(runs), "kept_sha256": pa.array(digest, pa.string())}
        if with_text:
            made |= {"kept_text": pa.array(texts, pa.string()), "removed": pa.array(bounds, pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())])))}
        yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), *made.values()], [*keep, *made])


def suffix_dedup(docs: DataFrame, length: int = 200, gram: int = GRAM, with_text: bool = True, carry: Sequence[str] = ()) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_bytes, n_removed, n_spans, kept_sha256; with_text adds kept_text and removed.
    Columns named in carry come along in a struct, carried.

    A byte goes if a window of ``length`` bytes covers it that also starts anywhere else in the corpus. Null text reads as empty
    and stays empty; texts shorter than ``length`` stay whole; equal texts of at least ``length`` bytes all go. A null doc_id
    is a value like any other; rows equal in id and text are copies. kept_text drops the bytes of characters that a cut split.
    An empty table gives an empty one. Texts are read whole, however long. Other columns, whatever their names, are not read.
    """
    spec = Repeats("bytes", length, gram, first=False)
    keep = ["doc_id", "carried"] if carry else ["doc_id"]
    base = docs.select("doc_id", "text", *([F.struct(*carry).alias("carried")] if carry else []))
    rows = keyed(base).repartition(partitions(docs.sparkSession), "d", "th")
    both = rows.join(repeated_spans(spec, rows), ["d", "th"], "left").select(*keep, "text", _spans_or_none())
    kinds = dict(base.dtypes)
    schema = ", ".join(f"{c} {kinds[c]}" for c in keep) + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    schema += ", kept_text string, removed array<struct<s:long,e:long>>" if with_text else ""
    return both.mapInArrow(lambda it: _cut_bytes(it, keep, with_text), schema)


def _spans_or_none():
    return F.coalesce("spans", F.array().cast("array<struct<s:long,e:long>>")).alias("spans")


ORACLE = """
WITH t AS (SELECT doc_id, encode(coalesce(text, '')) AS b FROM documents),
g AS (SELECT doc_id, i, md5_number(b[i:i + 199]) AS g FROM (SELECT doc_id, b, unnest(range(1, octet_length(b) - 198)) AS i FROM t WHERE octet_length(b) >= 200)),
r AS (SELECT doc_id, i FROM g WHERE g IN (SELECT g FROM g GROUP BY g HAVING count(*) > 1)),
e AS (SELECT doc_id, i, lag(i) OVER (PARTITION BY doc_id ORDER BY i) AS p, lead(i) OVER (PARTITION BY doc_id ORDER BY i) AS n FROM r),
s AS (SELECT doc_id, i AS s, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE p IS NULL OR i - p > 200),
z AS (SELECT doc_id, i + 200 AS z, row_number() OVER (PARTITION BY doc_id ORDER BY i) AS k FROM e WHERE n IS NULL OR n - i > 200),
v AS (SELECT doc_id, s, z, coalesce(lag(z) OVER (PARTITION BY doc_id ORDER BY s), 1) AS was FROM s JOIN z USING (doc_id, k)),
h AS (SELECT doc_id, count(*) AS n_spans, sum(z - s) AS n_removed, max(z) AS last, string_agg(CASE WHEN s > was THEN hex(b[was:s - 1]) ELSE '' END, '' ORDER BY s) AS kept FROM v JOIN t USING (doc_id) GROUP BY doc_id)
SELECT t.doc_id, octet_length(b)::BIGINT AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
  sha256(unhex(coalesce(kept, '') || CASE WHEN coalesce(last, 1) <= octet_length(b) THEN hex(b[coalesce(last, 1):octet_length(b)]) ELSE '' END)) AS kept_sha256
FROM t LEFT JOIN h ON t.doc_id = h.doc_id
"""
