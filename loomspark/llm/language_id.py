"""Language identification: multinomial naive Bayes over hashed character n-grams.

The model is a matrix of log-probabilities, buckets x languages, of fixed size; it is learned from a bounded sample and
broadcast. More languages than a matrix holds have several, by ranges of labels in order: texts go past one after another and carry the
best language so far and the sum of the probabilities, so the prediction is that of one large matrix. A batch of texts is a sparse matrix in rows (the buckets of all its n-grams, one after another, and where each text
begins); its product with the model is one gather and one segmented sum.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded, materialize

#: Labelled documents that a model is fitted on, about at most, and languages of one matrix: more have matrices by ranges of labels.
SAMPLE, LANGUAGES = 20_000, 256
#: Matrices that texts go past in one stage, each in workers of its own; then the texts are written.
CHAIN = 3
BITS = 15
ORDERS = (1, 2, 3)
SMOOTHING = 0.5


@functools.lru_cache(maxsize=1)
def _folded() -> np.ndarray:
    """Lower case of every code point that is a letter; a space for all others."""
    out = np.full(0x110000, 32, np.uint32)
    for i in range(0x110000):
        c = chr(i)
        if c.isalpha():
            low = c.lower()
            out[i] = ord(low) if len(low) == 1 else i
    return out


def grams(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code points folded, first code point of each row, whether a row has a letter."""
    try:
        text = data.tobytes().decode("utf-8")
        first = X.starts_of((data & 0xC0) != 0x80)[offsets]
    except UnicodeDecodeError:
        rows = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in zip(offsets, offsets[1:], strict=False)]
        text, first = "".join(rows), X.starts_of(np.array([len(x) for x in rows], np.int64))
    codes = _folded()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    seen = X.starts_of(codes != 32)
    return codes, first, seen[first[1:]] > seen[first[:-1]]


def _buckets(codes: np.ndarray, order: int) -> np.ndarray:
    """Bucket of the n-gram that starts at each code point; those of blanks alone have the last bucket, which says nothing."""
    n = len(codes) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    h = np.full(n, order, np.uint32)
    blank = np.ones(n, bool)
    for i in range(order):
        part = codes[i : i + n]
        h = (h ^ part) * np.uint32(0x9E3779B1)
        h ^= h >> np.uint32(15)
        blank &= part == 32
    out = (h >> np.uint32(32 - BITS)).astype(np.int64)
    out[blank] = 1 << BITS
    return out


def _count(batches: Iterator[pa.RecordBatch], langs: list[str]) -> Iterator[pa.RecordBatch]:
    width = (1 << BITS) + 1
    total = np.zeros(len(langs) * width, np.int64)
    at = {x: i for i, x in enumerate(langs)}
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        lang = np.array([at[x] for x in batch.column("lang").to_pylist()], np.int64)
        for lo, hi in X.slices(offsets):
            codes, first, _ = grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            row = np.repeat(np.arange(lo, hi), np.diff(first))
            for order in ORDERS:
                b = _buckets(codes, order)
                same = row[: len(b)] == row[order - 1 : order - 1 + len(b)]
                total += np.bincount(lang[row[: len(b)][same]] * width + b[same], minlength=len(total))
    hit = np.flatnonzero(total)
    yield pa.RecordBatch.from_arrays([pa.array((hit // width).astype(np.int32)), pa.array((hit % width).astype(np.int32)), pa.array(total[hit])], ["lang", "bucket", "n"])


def fit(labelled: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES, seed: int = 3) -> tuple[list[str], np.ndarray]:
    """Languages and log-probabilities (buckets + 1, languages) from about ``sample`` rows of labelled (text, lang), never many more.

    The last row holds the logarithms of the languages' shares. Rows with null lang or text teach nothing. Of more labels than
    ``languages`` the most frequent are learned (ties by name), so the model is at most 2**15 * languages numbers of 4 bytes.
    """
    chosen = _sampled(labelled, sample, seed).persist()
    try:
        often = chosen.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang").limit(languages)
        share = {r["lang"]: r["n"] for r in often.collect()}  # languages rows at most
        return _matrix(chosen, sorted(share), share)
    finally:
        chosen.unpersist()


def models(labelled: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES, seed: int = 3) -> Iterator[tuple[list[str], np.ndarray]]:
    """As :func:`fit`, for every label of the sample: matrices of at most ``languages`` labels each, labels in order, one at least."""
    chosen = _sampled(labelled, sample, seed).persist()
    try:
        share = {r["lang"]: r["n"] for r in chosen.groupBy("lang").agg(F.count("*").alias("n")).collect()}  # at most a label for each row of the sample
        langs = sorted(share)
        for k in range(0, max(1, len(langs)), languages):
            yield _matrix(chosen, langs[k : k + languages], share)
    finally:
        chosen.unpersist()


def _sampled(labelled: DataFrame, sample: int, seed: int) -> DataFrame:
    labelled = labelled.filter("lang is not null and text is not null").select("text", F.col("lang").cast("string").alias("lang"))
    n = labelled.count()
    return labelled.sample(0.95 * sample / n, seed=seed) if n > sample else labelled


def _matrix(chosen: DataFrame, langs: list[str], share: dict[str, int]) -> tuple[list[str], np.ndarray]:
    counts = np.full(((1 << BITS) + 1, max(1, len(langs))), SMOOTHING)
    if langs:
        known = chosen.filter(F.col("lang").isin(langs))
        rows = known.mapInArrow(lambda it: _count(it, langs), "lang int, bucket int, n long").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
        got = rows.toPandas()  # buckets x languages of a matrix at most
        counts[got["bucket"], got["lang"]] += got["n"]
    logs = np.log(counts[:-1] / counts[:-1].sum(0))
    prior = np.log(np.array([share[x] for x in langs] or [1], float) / max(1, sum(share.values())))
    return langs, np.vstack([logs, prior]).astype(np.float32)


def _predict(batches: Iterator[pa.RecordBatch], langs: list[str], model: np.ndarray, last: bool) -> Iterator[pa.RecordBatch]:
    """Rows with the best language up to this matrix, its logarithm and the sum of all probabilities by that one; or, last, the result."""
    table = model.copy()
    table[-1] = 0
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        name: list[str] = []
        peak, mass, letters = [np.zeros(0)], [np.zeros(0)], [np.zeros(0, bool)]
        for lo, hi in X.slices(offsets):
            codes, first, letter = grams(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            logs = np.tile(model[-1].astype(np.float64), (hi - lo, 1))
            for order in ORDERS:
                b = _buckets(codes, order)
                end = np.maximum(first[1:] - order + 1, first[:-1])  # n-grams stay within their text
                edge = np.minimum(np.column_stack([first[:-1], end]).reshape(-1), len(b))
                for i in range(len(langs)):
                    sums = np.add.reduceat(np.r_[table[:, i][b], np.float32(0)].astype(np.float64), edge)[::2]
                    logs[:, i] += np.where(end > first[:-1], sums, 0)
            name += [langs[i] if langs else "und" for i in logs.argmax(1)]
            peak.append(logs.max(1))
            mass.append(np.exp(logs - logs.max(1, keepdims=True)).sum(1))
            letters.append(letter)
        top, total, known = np.concatenate(peak), np.concatenate(mass), np.concatenate(letters) & bool(langs)
        best = pa.array(name, pa.string())
        if "best" in batch.schema.names:
            before = batch.column("peak").to_numpy()
            best = pc.if_else(pa.array(top > before), best, batch.column("best"))  # ties go to the first in order
            high = np.maximum(top, before)
            total = total * np.exp(top - high) + batch.column("mass").to_numpy() * np.exp(before - high)
            top = high
        made = {"doc_id": batch.column("doc_id"), "held_out": batch.column("held_out")}
        if last:
            made |= {"lang_pred": pc.if_else(pa.array(known), best, "und"), "score": pa.array(np.where(known, 1 / total, 0.0))}
        else:
            made |= {"text": batch.column("text"), "best": best, "peak": pa.array(top), "mass": pa.array(total)}
        yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def held_out() -> Column:
    """The documents that no model may learn from; a null id is not among them."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def language_id(docs: DataFrame, sample: int = SAMPLE, languages: int = LANGUAGES) -> DataFrame:
    """Per row of docs (doc_id, text, lang): doc_id, held_out, lang_pred, score (posterior probability of lang_pred).

    Learned from rows that are not held out and have a lang, about ``sample`` of them, all their labels; ``languages`` is how many of these
    a matrix holds, and changes no prediction. lang_pred is 'und', with score 0, where text is null or has no
    letter, or where there was nothing to learn from. Ties go to the language that is first in order. Every row is judged alone on its
    whole text, however long, so repeated rows change nothing. Only the three columns are read; others, whatever their names, do
    not come along. Empty gives empty.
    """
    rows = bounded(docs).select("doc_id", "text", F.col("lang").cast("string").alias("lang"), held_out().alias("held_out"))
    head = f"doc_id {dict(docs.dtypes)['doc_id']}, held_out boolean"
    found = [(langs, docs.sparkSession.sparkContext.broadcast(model)) for langs, model in models(rows.filter(~F.col("held_out")), sample, languages)]
    rows = rows.select("doc_id", "text", "held_out")
    for i, (langs, shared) in enumerate(found):
        last = i == len(found) - 1
        schema = head + (", lang_pred string, score double" if last else ", text string, best string, peak double, mass double")
        rows = rows.mapInArrow(lambda it, langs=langs, shared=shared, last=last: _predict(it, langs, shared.value, last), schema)
        if not last and i % CHAIN == CHAIN - 1:
            rows = materialize(rows)
    return rows
