"""Join of documents whose sets of word n-grams have a Jaccard similarity of at least a threshold.

1. Documents with equal words form a class, by a digest of them; one representative of each goes on.
2. Banded MinHash puts representatives into buckets (of a pair at the threshold, 3 in a million miss every band).
3. Within a bucket, Bayesian pruning compares further MinHash values in steps and drops a pair as soon as the posterior
   probability that its similarity reaches the threshold is below a tolerance. Survivors leave as a spanning forest, so a
   bucket of m documents gives fewer than m edges. Hot buckets are compared in blocks, each pair of blocks a task of its own.
4. Components of these edges hold every surviving pair, so each text goes to its component once. There the pairs that share a band
   and survive pruning, no others, are verified exactly on the sets. A component of more than a few blocks is not compared all with
   all: its texts go to their buckets (as many as there are bands at most, however large the component), and a pair is verified
   in the first bucket that it shares. N-grams count as equal there if their words are, not their fingerprints. What leaves is each document's number of links and a spanning forest of the links.
"""

from __future__ import annotations

import functools
import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded, materialize, partitions, sieve
from loomspark.llm.graph import components
from loomspark.llm.repeats import _lists

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
#: MinHash values of the sketch, one byte each, and how many are compared at a step.
SKETCH, STEP = 64, 16
#: A pair is dropped when its probability of reaching the threshold falls below this.
TOLERANCE = 1e-6
#: Documents of a bucket, and of a component, that one task compares with each other; n-grams of a component's block.
BUCKET, BLOCK, BLOCK_GRAMS = 20_000, 1_000, 2_000_000
#: Blocks up to which a component is compared block by block; a larger one is compared bucket by bucket.
MOST_BLOCKS = 8
_RNG = np.random.default_rng(41)
_A = _RNG.integers(0, 1 << 31, BANDS * ROWS + SKETCH, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_B = _RNG.integers(0, 1 << 32, BANDS * ROWS + SKETCH, dtype=np.uint32)


def shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct fingerprints of n-grams of words, row by row, with first[i]:first[i + 1] those of row i.

    A row of fewer than n words has one, of all its words; a row without words has none.
    """
    values, _, _, first = X.words_of(data, offsets)
    count = np.diff(first)
    roll = X.Rolling(values, bytes_in=False)
    grams = np.where(count == 0, 0, np.maximum(count - n + 1, 1))
    row = np.repeat(np.arange(len(count)), grams)
    start = X.ranges(first[:-1], grams)
    got = roll.spans(start, np.minimum(start + n, first[row + 1]))
    order = np.lexsort((got, row))
    row, got = row[order], got[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (got[1:] != got[:-1])][: len(row)]
    return got[new], X.starts_of(np.bincount(row[new], minlength=len(count)))


def exact_shingles(data: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """As shingles, with a number for each n-gram that is equal for equal n-grams alone, within this call."""
    starts, ends, first = X.word_spans(data, offsets)
    codes = X.word_numbers(data, starts, ends).astype(np.int64)
    count = np.diff(first)

    def pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.unique(a * (int(b.max(initial=0)) + 1) + b, return_inverse=True)[1]

    ids, have = codes, 1
    while have < n and len(ids) > min(have, n - have):
        step = min(have, n - have)  # two runs that overlap make up a longer one
        ids = pairs(ids[:-step], ids[step:])
        have += step
    long = np.flatnonzero(count >= n)
    size = count[long] - n + 1
    row, got = np.repeat(long, size), ids[X.ranges(first[long], size)]
    short = np.flatnonzero((count > 0) & (count < n))
    known: dict[bytes, int] = {}
    other = np.array([-1 - known.setdefault(codes[first[i] : first[i + 1]].tobytes(), len(known)) for i in short], np.int64)
    row, got = np.concatenate([row, short]), np.concatenate([got, other])
    order = np.lexsort((got, row))
    row, got = row[order], got[order]
    new = np.r_[True, (row[1:] != row[:-1]) | (got[1:] != got[:-1])][: len(row)]
    return got[new], X.starts_of(np.bincount(row[new], minlength=len(count)))


def signatures(got: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bucket keys (rows, BANDS) and sketches (rows, SKETCH) of sets of fingerprints, none empty, that begin at ``at``."""
    low = (got & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    least = np.empty((len(at), len(_A)), np.uint32)
    for i, (a, b) in enumerate(zip(_A, _B, strict=True)):
        least[:, i] = np.minimum.reduceat(low * a + b, at) if len(at) else 0
    bands = np.zeros((len(at), BANDS), np.uint64)
    for i in range(ROWS):
        bands = X.mix(bands * np.uint64(0x9E3779B97F4A7C15) + least[:, i * BANDS : (i + 1) * BANDS] + np.uint64(1))
    bands = X.mix(bands + np.arange(BANDS, dtype=np.uint64))
    return bands, np.ascontiguousarray(least[:, BANDS * ROWS :].astype(np.uint8))


def _signatures(batches: Iterator[pa.RecordBatch], n: int) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        for lo, hi in X.slices(offsets, 2 * X.PIECE):
            got, first = shingles(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo], n)
            full = np.flatnonzero(np.diff(first))
            at = first[full]
            ids = batch.column("d").slice(lo, hi - lo)
            if not len(full):
                continue
            bands, sketch = signatures(got, at)
            size = np.full(len(full), SKETCH, np.int64)
            starts, ends, word = X.word_spans(data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            blob, place = X.joined(data[offsets[lo] : offsets[hi]], starts, ends)
            blob, edges = memoryview(blob), place[word].tolist()
            same = b"".join(hashlib.blake2b(blob[edges[i] : edges[i + 1]], digest_size=16).digest() for i in full.tolist())
            same = np.frombuffer(same, "<i8").reshape(-1, 2)
            yield pa.RecordBatch.from_arrays(
                [
                    ids.take(pa.array(full)), pa.array(same[:, 0].copy()), pa.array(same[:, 1].copy()), pa.array(np.diff(first)[full].astype(np.int32)),
                    _lists(bands.reshape(-1).view(np.int64), np.full(len(full), BANDS)), pa.Array.from_buffers(pa.binary(), len(full), [None, pa.py_buffer(X.starts_of(size).astype(np.int32)), pa.py_buffer(sketch)]),
                ],
                ["d", "set_a", "set_b", "n", "bands", "sketch"],
            )


@functools.lru_cache(maxsize=8)
def least_matches(threshold: float, tolerance: float) -> np.ndarray:
    """Fewest equal values of the first 1 ... SKETCH with which a pair stays: Bayes' rule from a uniform prior on similarity."""
    grid = (np.arange(2000) + 0.5) / 2000
    equal = grid + (1 - grid) / 256  # one byte also agrees by chance
    out = np.zeros(SKETCH + 1, np.int64)
    for m in range(1, SKETCH + 1):
        for k in range(m + 1):
            like = k * np.log(equal) + (m - k) * np.log1p(-equal)
            like = np.exp(like - like.max())
            if like[grid >= threshold].sum() >= tolerance * like.sum():
                out[m] = k
                break
    return out


def _survivors(x: np.ndarray, y: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Which row pairs of two equally long lists of sketches stay to the end."""
    alive = np.arange(len(x))
    equal = np.zeros(len(x), np.int64)
    for at in range(0, SKETCH, STEP):
        equal += (x[alive, at : at + STEP] == y[alive, at : at + STEP]).sum(1)
        stay = equal >= bounds[at + STEP]
        alive, equal = alive[stay], equal[stay]
    return alive


def _forest(d: np.ndarray, sketch: np.ndarray, bounds: np.ndarray) -> list[tuple[int, int]]:
    """Spanning forest of the surviving pairs of one bucket, breadth first: found documents are not compared again."""
    edges, rest = [], np.arange(1, len(d))
    queue = [0]
    while len(rest):
        if not queue:
            queue, rest = [rest[0]], rest[1:]
            continue
        one = queue.pop()
        hit = _survivors(np.broadcast_to(sketch[one], (len(rest), SKETCH)), sketch[rest], bounds)
        edges += [(d[one], x) for x in d[rest[hit]]]
        queue += list(rest[hit])
        rest = np.delete(rest, hit)
    return edges


def _prune(batches: Iterator[pa.RecordBatch], threshold: float, tolerance: float) -> Iterator[pa.RecordBatch]:
    """Rows sorted by bucket -> edges."""
    bounds = least_matches(threshold, tolerance)
    held: list = []

    def out(edges) -> pa.RecordBatch:
        a, b = np.array(edges, np.int64).reshape(-1, 2).T
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    def done(final: bool):
        nonlocal held
        key = np.concatenate([h[0] for h in held])
        d = np.concatenate([h[1] for h in held])
        sketch = np.concatenate([h[2] for h in held])
        upto = len(key) if final else int(np.searchsorted(key, key[-1]))
        held = [(key[upto:], d[upto:], sketch[upto:])] if upto < len(key) else []
        if not upto:
            return
        cut = np.flatnonzero(np.r_[True, key[1:upto] != key[: upto - 1], True])
        size = np.diff(cut)
        small = np.flatnonzero((size > 1) & (size <= 8))
        # pairs of small buckets, all at once
        for m in np.unique(size[small]):
            at = cut[small[size[small] == m]]
            i, j = np.triu_indices(m, 1)
            for k in range(0, len(at), max(1, 200_000 // len(i))):
                x, y = ((at[k : k + max(1, 200_000 // len(i)), None] + z).reshape(-1) for z in (i, j))
                stay = _survivors(sketch[x], sketch[y], bounds)
                if len(stay):
                    yield out(np.column_stack([d[x[stay]], d[y[stay]]]))
        edges: list = []
        for g in np.flatnonzero(size > 8):
            edges += _forest(d[cut[g] : cut[g + 1]], sketch[cut[g] : cut[g + 1]], bounds)
            if len(edges) > 50_000:
                yield out(edges)
                edges = []
        if edges:
            yield out(edges)

    for batch in batches:
        blob, _ = X.flat(batch.column("sketch"))
        held.append((batch.column("key").to_numpy(), batch.column("d").to_numpy(), blob.reshape(-1, SKETCH)))
        if sum(len(h[0]) for h in held) >= 100_000:
            yield from done(False)
    if held:
        yield from done(True)


def _buckets(reps: DataFrame) -> DataFrame:
    """Rows (key, n, d, sketch) of the buckets of two or more representatives, n of them.

    Few rows have such a bucket. So the sketches, most of the bytes, are joined to these alone: what is sent for every band is a key and
    the hash of a row, and that at every size.
    """
    reps = reps.withColumn("row", F.xxhash64("d", "set_a"))  # rows that share an id are told apart
    counts = reps.select(F.explode("bands").alias("key")).groupBy("key").agg(F.count("*").alias("n")).filter("n > 1")
    counts = materialize(counts)  # so that the join can deal the rows of a common key to several tasks
    shared = reps.select("row", F.explode("bands").alias("key")).join(counts.hint("merge"), "key")  # the same plan at every size
    return materialize(shared.join(reps.select("row", "d", "sketch"), "row").select("key", "n", "d", "sketch"))


def _candidates(reps: DataFrame, threshold: float, tolerance: float, buckets: DataFrame | None = None) -> DataFrame:
    """Edges (a, b) that span every surviving pair. buckets: those of reps, if they are there."""
    buckets = _buckets(reps) if buckets is None else buckets
    blocks = F.when(F.col("n") > BUCKET, F.ceil(F.col("n") / (BUCKET // 2))).otherwise(1).cast("int")  # one, but for hot buckets
    own = F.pmod(F.xxhash64("d"), F.col("blocks")).cast("int")
    dealt = buckets.withColumn("blocks", blocks).withColumn("own", own)
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select(F.xxhash64("key", F.least("own", "other"), F.greatest("own", "other")).alias("key"), "d", "sketch")
    dealt = dealt.repartition(partitions(reps.sparkSession), "key").sortWithinPartitions("key", "d")
    return dealt.mapInArrow(lambda it: _prune(it, threshold, tolerance), "a long, b long")


ORACLE = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS i FROM w WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
l AS MATERIALIZED (SELECT a, b FROM p JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 5 * c >= 4 * (x.n + y.n - c)),
r(a, b) AS (SELECT a, b FROM l UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
k AS (SELECT a, least(a, min(b)) AS c FROM r GROUP BY a), m AS (SELECT a, count(*) AS n FROM l GROUP BY a)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(c, doc_id) AS component_id, coalesce(c, doc_id) = doc_id AS kept
FROM documents LEFT JOIN k ON doc_id = k.a LEFT JOIN m ON doc_id = m.a
"""


VERIFIED = "d long, links long, a long, b long"


def _surviving(bands: np.ndarray, sketch: np.ndarray, apart: np.ndarray, bounds: np.ndarray, bucket: int | None) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of rows i < j, apart[i, j] true, that share a band and survive pruning. bucket: only if that is the first band they share."""
    m = len(bands)
    one, two = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    step = max(1, (1 << 21) // max(1, m))
    for lo in range(0, m, step):
        shared = np.zeros((min(m, lo + step) - lo, m), bool)
        own = np.zeros_like(shared)
        for k in range(BANDS):
            same = bands[lo : lo + step, None, k] == bands[None, :, k]
            if bucket is not None:
                own |= same & ~shared & (bands[lo : lo + step, None, k].view(np.int64) == bucket)
            shared |= same
        i, j = np.nonzero((shared if bucket is None else own) & apart[lo : lo + step])
        up = i + lo < j
        i, j = i[up] + lo, j[up]
        for at in range(0, len(i), 200_000):
            x, y = i[at : at + 200_000], j[at : at + 200_000]
            stay = _survivors(sketch[x], sketch[y], bounds)
            one.append(x[stay])
            two.append(y[stay])
    return np.concatenate(one), np.concatenate(two)


def _common(got: np.ndarray, first: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Size of the intersections of sets i and j: pair by pair if they are few, else by products of incidence matrices."""
    m = len(first) - 1
    if len(i) <= 4 * m:
        return np.array([first[x + 1] - first[x] + first[y + 1] - first[y] - len(np.unique(np.concatenate([got[first[x] : first[x + 1]], got[first[y] : first[y + 1]]]))) for x, y in zip(i, j, strict=True)], np.int64)
    _, column, often = np.unique(got, return_inverse=True, return_counts=True)
    shared = np.cumsum(often > 1) - 1
    row = np.repeat(np.arange(m), np.diff(first))
    keep = often[column] > 1
    row, column = row[keep], shared[column[keep]]
    order = np.argsort(column, kind="stable")
    row, column = row[order], column[order]
    common = np.zeros((m, m), np.float32)
    width = 4096
    for at in range(0, int(column[-1]) + 1 if len(column) else 0, width):
        a, b = np.searchsorted(column, [at, at + width])
        x = np.zeros((m, min(width, int(column[-1]) + 1 - at)), np.float32)
        x[row[a:b], column[a:b] - at] = 1
        common += x @ x.T
    return np.rint(common[i, j]).astype(np.int64)


def _verify(key, batch: pd.DataFrame, n: int, threshold: float, tolerance: float) -> pd.DataFrame:
    """Links within one block of a component or bucket, or between two of them, and a spanning forest of the links."""
    batch = batch.sort_values("d", kind="stable")
    data = X.flat(pa.array(batch["text"], pa.string()))
    got, first = shingles(*data, n)
    d, block, weight = (batch[c].to_numpy() for c in ("d", "block", "members"))
    bucket, one, two = (None if key[1] is None or key[1] != key[1] else int(key[1])), key[2], key[3]
    bands, sketch = signatures(got, first[:-1])
    apart = (block[:, None] == one) & (block[None, :] == two) | (block[:, None] == two) & (block[None, :] == one)
    apart &= d[:, None] != d[None, :]
    i, j = _surviving(bands, sketch, apart, least_matches(threshold, tolerance), bucket)
    got, first = exact_shingles(*data, n)
    common, size = _common(got, first, i, j), np.diff(first)
    link = common >= threshold * (size[i] + size[j] - common) - 1e-9
    i, j = i[link], j[link]
    if len(np.unique(d)) < len(d):  # rows that share an id are one document
        _, each = np.unique(np.sort(np.column_stack([d[i], d[j]]), axis=1), axis=0, return_index=True)
        i, j = i[each], j[each]
    links = np.bincount(i, weight[j], len(d)) + np.bincount(j, weight[i], len(d))
    up = np.arange(len(d))

    def root(x: int) -> int:
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    edges = []
    for x, y in zip(i.tolist(), j.tolist(), strict=True):
        a, b = root(x), root(y)
        if a != b:
            up[max(a, b)] = min(a, b)
            edges.append((d[x], d[y]))
    e = np.array(edges, np.int64).reshape(-1, 2)
    none = pd.array([None] * len(d), "Int64")
    found = pd.DataFrame({"d": pd.array(d, "Int64"), "links": pd.array(np.rint(links).astype(np.int64), "Int64"), "a": none, "b": none})
    none = pd.array([None] * len(e), "Int64")
    return pd.concat([found, pd.DataFrame({"d": none, "links": none, "a": pd.array(e[:, 0], "Int64"), "b": pd.array(e[:, 1], "Int64")})], ignore_index=True)


def _blocked(sized: DataFrame, by: list[str]) -> DataFrame:
    """Rows (d, n, members and by) with the pairs of blocks, one and two, in which they are compared."""
    total = sized.groupBy(*by).agg(F.count("*").alias("size"), F.sum("n").alias("grams"))
    blocks = F.greatest(F.ceil(F.col("size") / BLOCK), F.ceil(F.col("grams") / BLOCK_GRAMS)).cast("int")
    total = materialize(total.withColumn("blocks", blocks).filter("size > 1").select(*by, "blocks"))
    return sized.join(total, by).withColumn("block", F.pmod(F.xxhash64("d"), "blocks").cast("int"))


def _paired(blocked: DataFrame) -> DataFrame:
    other = blocked.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    return other.select("d", "component", "bucket", "members", "block", F.least("block", "other").alias("one"), F.greatest("block", "other").alias("two"))


def jaccard_join(docs: DataFrame, n: int = WORDS, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_links (other documents at or over the threshold), component_id, kept.

    component_id is the smallest doc_id reachable by links, kept whether that is the row's own. Documents with fewer than n words
    are one gram of all of them; documents without words (null text too) link with nothing. Equal texts link with each other.
    A null doc_id counts as the least id, and component_id is null where it leads. Rows that share an id are one document.
    Texts are read whole, however long. An empty table gives an empty one. Columns other than doc_id and text, whatever their names, are
    not read.
    """
    base = bounded(docs).select("doc_id", "text", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"))
    signed = materialize(base.select("d", "text").mapInArrow(lambda it: _signatures(it, n), "d long, set_a long, set_b long, n int, bands array<long>, sketch binary"))
    ids = signed.select("d", "set_a", "set_b").distinct()
    classes = ids.groupBy("set_a", "set_b").agg(F.min("d").alias("lead"), F.count("*").alias("members"))
    member = ids.join(classes, ["set_a", "set_b"]).select("d", "lead", "members")
    leads = classes.select(F.col("lead").alias("d"), "set_a", "set_b", "members")
    reps = materialize(signed.join(leads, ["d", "set_a", "set_b"]).dropDuplicates(["d", "set_a", "set_b"]).select("d", "set_a", "members", "n", "bands", "sketch"))
    buckets = _buckets(reps)
    near = components(_candidates(reps, threshold, tolerance, buckets))
    known = reps.groupBy("d").agg(F.max("members").alias("members"), F.sum("n").alias("n"))
    sized = _blocked(near.withColumnRenamed("node", "d").join(known, "d"), ["component"])
    few = sized.filter(F.col("blocks") <= MOST_BLOCKS).withColumn("bucket", F.lit(None).cast("long"))
    many = sized.filter(F.col("blocks") > MOST_BLOCKS).drop("blocks", "block").join(buckets.select("d", F.col("key").alias("bucket")), "d")
    pairs = _paired(few).unionByName(_paired(_blocked(many, ["component", "bucket"])))
    by = ["component", "bucket", "one", "two"]
    # the work of a group grows faster than its bytes, so groups are dealt to all tasks instead of being joined by size
    texts = sieve(base.select("d", "text"), near.select(F.col("node").alias("d")), "d")  # all others are in no pair
    groups = texts.join(pairs, "d").repartition(partitions(docs.sparkSession), *by).groupBy(*by)
    verified = materialize(groups.applyInPandas(lambda key, x: _verify(key, x, n, threshold, tolerance), VERIFIED))
    linked = verified.filter("d is not null").groupBy("d").agg(F.sum("links").alias("links"))
    final = components(verified.filter("a is not null").select("a", "b"))
    led = member.join(linked.withColumnRenamed("d", "lead"), "lead", "left").join(final.withColumnRenamed("node", "lead"), "lead", "left")
    result = led.groupBy("d").agg(F.sum(F.coalesce("links", F.lit(0)) + F.col("members") - 1).alias("n_links"), F.min(F.coalesce("component", "lead")).alias("component"))
    rows = base.select("doc_id", "d").join(result, "d", "left")
    component = F.coalesce("component", "d")
    return rows.select("doc_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.when(component != -(1 << 63), component).alias("component_id"), (component == F.col("d")).alias("kept"))
