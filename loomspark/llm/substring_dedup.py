"""Substring deduplication by seed and extend: of a passage of N words or more that repeats, the first occurrence alone stays.

Seeds are winnowed anchors (see :mod:`loomspark.llm.repeats`): documents are joined on equal anchors, each with the first one that
agrees in a window; their match is extended to the right (from the anchor on) and to the left (in front of it), and maximal
repeats of at least N words are kept for removal.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomspark.llm import textnum as X
from loomspark.llm.common import partitions
from loomspark.llm.repeats import Repeats, keyed, merged, repeated_spans
from loomspark.llm.suffix_dedup import _spans_or_none

#: Words of the gram that anchors a window.
GRAM = 5


def _cut_words(batches: Iterator[pa.RecordBatch], with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        spans = batch.column("spans")
        at = spans.offsets.to_numpy()
        pairs = np.column_stack([spans.values.field(c).to_numpy(zero_copy_only=False) for c in ("s", "e")]) if len(spans.values) else np.zeros((0, 2), np.int64)
        for lo, hi in X.slices(offsets, 2 * X.PIECE):
            base = offsets[lo]
            text = data[base : offsets[hi]]
            starts, ends, first = X.word_spans(text, offsets[lo : hi + 1] - base)
            n = np.diff(first)
            removed, digest, texts, bounds = np.zeros(hi - lo, np.int64), [], [], []
            gone = np.zeros(len(starts) + 1, np.int32)
            for i in np.flatnonzero(np.diff(at[lo : hi + 1])):
                cut = merged(pairs[at[lo + i] : at[lo + i + 1]], n[i]) + first[i]
                cut = cut[cut[:, 1] > cut[:, 0]]
                np.add.at(gone, cut[:, 0], 1)
                np.add.at(gone, cut[:, 1], -1)
                removed[i] = (cut[:, 1] - cut[:, 0]).sum()
            stay = np.cumsum(gone[:-1]) == 0
            # kept words, each with one space behind it
            size = np.where(stay, ends - starts + 1, 0)
            place = X.starts_of(size)
            blob = np.full(place[-1], 0x20, np.uint8)
            blob[X.ranges(place[:-1][stay], (size - 1)[stay])] = text[X.ranges(starts[stay], (size - 1)[stay])]
            for i in range(hi - lo):
                a, b = place[first[i]], place[first[i + 1]]
                body = blob[a : max(a, b - 1)].tobytes()
                digest.append(hashlib.sha256(body).hexdigest())
                if with_text:
                    texts.append(body.decode("utf-8", "replace"))
            made = {"doc_id": batch.column("doc_id").slice(lo, hi - lo), "n_words": pa.array(n), "n_removed": pa.array(removed), "kept_sha256": pa.array(digest, pa.string())}
            if with_text:
                made["kept_text"] = pa.array(texts, pa.string())
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def substring_dedup(docs: DataFrame, length: int = 20, gram: int = GRAM, with_text: bool = True) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_removed, kept_sha256 and, with_text, kept_text (words joined by a space).

    A word goes if a window of ``length`` words covers it whose words also start earlier: in a document of smaller id, or
    earlier in the same one. Null text has no words; shorter texts stay whole; a null doc_id comes before all others; rows equal
    in id and text are one document; of rows with one id and several texts the smaller text fingerprint comes first. An empty
    table gives an empty one. Texts are read whole, however long. Columns other than doc_id and text, whatever their names, are not
    read.
    """
    spec = Repeats("words", length, gram, first=True, extend=True)
    rows = keyed(docs.select("doc_id", "text")).repartition(partitions(docs.sparkSession), "d", "th")
    both = rows.join(repeated_spans(spec, rows), ["d", "th"], "left").select("doc_id", "text", _spans_or_none())
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_removed long, kept_sha256 string" + ", kept_text string" * with_text
    return both.mapInArrow(lambda it: _cut_words(it, with_text), schema)


ORACLE = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
g AS (SELECT doc_id, i, row_number() OVER (PARTITION BY g ORDER BY doc_id, i) AS k
      FROM (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM w WHERE len(w) >= 20))),
x AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS j, unnest(w) AS word FROM w),
gone AS (SELECT DISTINCT doc_id, i + o AS j FROM g, range(0, 20) AS t(o) WHERE k > 1),
k AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY j) AS kept FROM x ANTI JOIN gone USING (doc_id, j) GROUP BY doc_id)
SELECT w.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k ON w.doc_id = k.doc_id
"""
