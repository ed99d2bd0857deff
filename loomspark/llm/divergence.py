"""How far the sources of each language differ in what words they use, in exact integer arithmetic.

1. Texts are cut into terms by a table over the bytes of whole batches: boundaries come from one lookup, terms are grouped by xxhash of
   their slices, and every slice is compared with the first of its group byte by byte before it counts as the same term.
2. Spark sums occurrences and documents by (lang, source, term) and keeps, of each language, the terms of enough documents.
3. The kept terms of a language are dealt to blocks by hash, its sources to tiles by name. For a block and two tiles a task holds a
   sparse matrix, a row for each source, and fills in the shares of absent terms run by run; the divergences of a source to all sources
   of the other tile are summed by ``reduceat``. Neither a language nor a source is ever gathered in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded, materialize

#: Documents of its language that a term must occur in.
LEAST = 10
#: Parts of the whole that shares are counted in, and what is added to each count.
SCALE, PRIOR = 1_000_000_000, 2
#: Terms reported for each source.
TOP = 10
#: Terms of a block and sources of a tile, about; terms whose shares a task lays out at once.
TERMS, SOURCES, WIDTH = 512, 256, 512

_LETTER = np.zeros(256, bool)
_LETTER[0x41:0x5B] = _LETTER[0x61:0x7B] = _LETTER[0x80:] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[0x41:0x5B] += 0x20


def _groups(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The number of each slice's group, equal slices having one, and a slice of each group."""
    view = memoryview(np.ascontiguousarray(data))
    digest = xxhash.xxh3_64_intdigest
    prints = np.fromiter((digest(view[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
    _, head, group = np.unique(prints, return_index=True, return_inverse=True)
    size = ends - starts
    one, other = head[group], np.arange(len(starts))
    same = size[one] == size
    inside = np.flatnonzero(same & (one != other))
    run = size[inside]
    equal = data[X.ranges(starts[inside], run)] == data[X.ranges(starts[one[inside]], run)]
    if len(inside):
        same[inside] = np.logical_and.reduceat(equal, X.starts_of(run)[:-1])
    if not same.all():  # two terms with one hash: those that differ from the first are told apart by their bytes
        made: dict[bytes, int] = {}
        head = head.tolist()
        for i in np.flatnonzero(~same):
            word = data[starts[i] : ends[i]].tobytes()
            if word not in made:
                made[word] = len(head)
                head.append(i)
            group[i] = made[word]
        head = np.array(head)
    return group, np.asarray(head)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per piece of a batch: lang, source, term, n (occurrences), docs (documents with it); a row without term for each lang and source."""
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        lang, source = (batch.column(c).dictionary_encode() for c in ("lang", "source"))
        code = lang.indices.to_numpy().astype(np.int64) * len(source.dictionary) + source.indices.to_numpy()
        for lo, hi in X.slices(offsets, X.PIECE):
            text = _LOWER[data[offsets[lo] : offsets[hi]]]
            starts, ends, first = X.word_spans(text, offsets[lo : hi + 1] - offsets[lo], ~_LETTER)
            which, place = np.unique(code[lo:hi], return_inverse=True)
            out = [(which, np.full(len(which), -1), np.zeros(len(which), np.int64), np.zeros(len(which), np.int64))]
            head = np.zeros(0, np.int64)
            if len(starts):
                term, head = _groups(text, starts, ends)
                row = np.repeat(np.arange(hi - lo), np.diff(first))
                pair, n = np.unique(row * np.int64(len(head)) + term, return_counts=True)  # one for each document and term
                key = place[pair // len(head)] * np.int64(len(head)) + pair % len(head)
                order = np.argsort(key, kind="stable")
                key = key[order]
                at = np.flatnonzero(np.r_[True, key[1:] != key[:-1]])
                out.append((which[key[at] // len(head)], key[at] % len(head), np.add.reduceat(n[order], at), np.diff(np.r_[at, len(key)])))
            group, term, n, docs = (np.concatenate(x) for x in zip(*out, strict=True))
            blob = text[X.ranges(starts[head], (ends - starts)[head])] if len(head) else text[:0]
            words = pa.Array.from_buffers(pa.string(), len(head), [None, pa.py_buffer(X.starts_of((ends - starts)[head]).astype(np.int32)), pa.py_buffer(np.ascontiguousarray(blob))])
            columns = [
                lang.dictionary.take(pa.array(group // len(source.dictionary))), source.dictionary.take(pa.array(group % len(source.dictionary))),
                words.take(pa.array(term, mask=term < 0)), pa.array(n.astype(np.int64)), pa.array(docs.astype(np.int64)),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["lang", "source", "term", "n", "docs"])


def shares(count: np.ndarray, total: np.ndarray) -> np.ndarray:
    """1 + floor(SCALE * count / total), exactly, for counts up to 9e15 that are no larger than their total: long division by thousands."""
    out, rest = np.zeros(np.broadcast(count, total).shape, np.int64), count
    for _ in range(3):
        rest = rest * 1000
        out = out * 1000 + rest // total
        rest = rest % total
    return out + 1


def _compared(key: tuple, rows: pd.DataFrame, top: int) -> pd.DataFrame:
    """One block of terms, two tiles of sources: sums of divergences over the block's terms, and the most telling terms of each source."""
    one, two = key[2], key[3]
    sides = rows[rows["term"].isna()].sort_values("source")
    held = rows[rows["term"].notna()]
    names = sides["source"].to_numpy(object)
    tile, whole = sides["tile"].to_numpy(), sides["n"].to_numpy(np.int64) + PRIOR * sides["kept"].to_numpy(np.int64)
    words, column = np.unique(held["term"].to_numpy(object), return_inverse=True)
    place = {name: i for i, name in enumerate(names)}
    row = np.fromiter(map(place.__getitem__, held["source"]), np.int64, len(held))
    order = np.lexsort((column, row))
    row, column, n = row[order], column[order], held["n"].to_numpy(np.int64)[order]
    indptr = np.searchsorted(row, np.arange(len(names) + 1))  # the sparse matrix: a row for each source, sorted columns
    p = shares(n + PRIOR, whole[row])
    absent = shares(np.full(len(names), PRIOR, np.int64), whole)
    out: list[tuple] = []
    left, right = np.flatnonzero(tile == one), np.flatnonzero(tile == two)
    sums = np.zeros((len(left), len(right)), np.int64)
    for at in range(0, len(words), WIDTH):
        wide = min(WIDTH, len(words) - at)
        full = np.repeat(absent[:, None], wide, 1)
        inside = (column >= at) & (column < at + wide)
        full[row[inside], column[inside] - at] = p[inside]
        begins = np.arange(0, len(right) * wide, wide)
        for k, i in enumerate(left):
            q = full[right]
            sums[k] += np.add.reduceat(((full[i] - q) ** 2 // (full[i] + q)).ravel(), begins) if len(right) else 0
    a, b = np.nonzero(left[:, None] < right[None, :])
    out.append(("pair", names[left][a], names[right][b], sums[a, b], np.full(len(a), len(words))))
    if one == two:
        lang_whole = int(sides["lang_n"].iloc[0]) + PRIOR * int(sides["kept"].iloc[0])
        q = shares(held["lang_n"].to_numpy(np.int64)[order] + PRIOR, np.int64(lang_whole))
        more = np.flatnonzero(p > q)
        value = (p[more] - q[more]) ** 2 // (p[more] + q[more])
        best = np.lexsort((column[more], -value, row[more]))  # columns are in the order of their terms
        begin = np.searchsorted(row[more][best], np.arange(len(names)))
        best = best[np.arange(len(best)) - begin[row[more][best]] < top]
        out.append(("term", names[row[more][best]], words[column[more][best]], value[best], np.zeros(len(best), np.int64)))
    part, source, item, value, seen = (np.concatenate(x) for x in zip(*((np.full(len(x[1]), x[0], object), *x[1:]) for x in out), strict=True))
    return pd.DataFrame({"lang": key[0], "part": part, "source": source, "item": item, "value": value, "seen": seen})


def divergence(docs: DataFrame, least: int = LEAST, top: int = TOP) -> DataFrame:
    """Per lang and source of docs (text, lang, source): part ``pair``, a row for each other source of the lang with how far the two differ,
    and part ``term``, the ``top`` terms that it has more of than its lang. lang, source, part, item, value, rank (from 1).

    Terms are runs of letters A-Z, a-z and of all characters beyond ASCII; A-Z alone are lower-cased. A lang's terms are those in
    ``least`` or more of its documents. A share is 1 + floor(1e9 (count + 2) / (N + 2 V)), N the source's occurrences of the V kept
    terms; the divergence of p and q is floor((p - q)^2 / (p + q)). Larger values come first, then items by their bytes.

    Null text, lang and source count as empty strings, so they are a lang and a source of their own; a source without kept terms has
    its pairs, with 0 where the lang keeps no term. Texts are read whole, however long; repeated rows count each; an empty table gives
    an empty one. Other columns, whatever their names, are not read.
    """
    rows = bounded(docs).select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("text", "lang", "source")))
    counts = rows.mapInArrow(_terms, "lang string, source string, term string, n long, docs long").groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))
    counts = materialize(counts)
    kept = counts.filter("term is not null").groupBy("lang", "term").agg(F.sum("n").alias("lang_n"), F.sum("docs").alias("docs")).filter(F.col("docs") >= least)
    kept = materialize(kept.select("lang", "term", "lang_n"))
    langs = kept.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_n"), F.ceil(F.count("*") / TERMS).cast("int").alias("blocks"))
    cells = materialize(counts.filter("term is not null").join(kept, ["lang", "term"]).select("lang", "source", "term", "n", "lang_n"))
    # every source with its lang's totals, its own, and its tile
    place = F.row_number().over(W.partitionBy("lang").orderBy("source")) - 1
    sides = counts.filter("term is null").select("lang", "source").join(cells.groupBy("lang", "source").agg(F.sum("n").alias("n")), ["lang", "source"], "left")
    sides = sides.join(langs, "lang", "left").select("lang", "source", *(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("n", "kept", "lang_n")), F.coalesce("blocks", F.lit(0)).alias("blocks"), F.floor(place / SOURCES).cast("int").alias("tile"))
    sides = materialize(sides)
    tiles = sides.groupBy("lang").agg(F.max("tile").alias("last"), F.max("blocks").alias("blocks"))
    block = F.pmod(F.xxhash64("term"), F.greatest("blocks", F.lit(1))).cast("int")
    dealt = cells.join(sides.select("lang", "source", "tile", "kept"), ["lang", "source"]).join(tiles, "lang").select("lang", "source", "term", "n", "lang_n", "kept", "tile", "last", block.alias("block"))
    every = sides.filter("blocks > 0").join(tiles.select("lang", "last"), "lang").select("lang", "source", F.lit(None).cast("string").alias("term"), "n", "lang_n", "kept", "tile", "last", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
    work = dealt.unionByName(every).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("last"))))
    work = work.select("lang", "block", F.least("tile", "other").alias("one"), F.greatest("tile", "other").alias("two"), "source", "term", "n", "lang_n", "kept", "tile")
    found = work.groupBy("lang", "block", "one", "two").applyInPandas(lambda key, x: _compared(key, x, top), "lang string, part string, source string, item string, value long, seen long")
    found = materialize(found)
    # terms that no source of two tiles has add the same to each of their pairs
    a, b = (sides.select("lang", *(F.col(c).alias(f"{s}_{c}") for c in ("source", "n", "kept"))) for s in "ab")
    pairs = a.join(b, "lang").filter("a_source < b_source")
    sums = found.filter("part = 'pair'").groupBy("lang", F.col("source").alias("a_source"), F.col("item").alias("b_source")).agg(F.sum("value").alias("value"), F.sum("seen").alias("seen"))
    share = lambda s: F.expr(f"1 + (cast({SCALE} as decimal(10,0)) * {PRIOR} div ({s}_n + {PRIOR} * {s}_kept))")
    pairs = pairs.join(sums, ["lang", "a_source", "b_source"], "left").withColumns({"p": F.when(F.col("a_kept") > 0, share("a")), "q": F.when(F.col("a_kept") > 0, share("b"))})
    rest = F.expr("(a_kept - coalesce(seen, 0)) * ((p - q) * (p - q) div (p + q))")
    pairs = pairs.select("lang", "a_source", "b_source", (F.coalesce("value", F.lit(0)) + F.coalesce(rest, F.lit(0))).cast("long").alias("value"))
    both = F.explode(F.array(F.struct(F.col("a_source").alias("source"), F.col("b_source").alias("item")), F.struct(F.col("b_source").alias("source"), F.col("a_source").alias("item"))))
    pairs = pairs.select("lang", both.alias("x"), "value").select("lang", "x.source", F.lit("pair").alias("part"), "x.item", "value")
    rank = F.row_number().over(W.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item"))
    terms = found.filter("part = 'term'").select("lang", "source", "part", "item", "value").withColumn("rank", rank).filter(F.col("rank") <= top)
    return pairs.withColumn("rank", rank).unionByName(terms)


ORACLE = rf"""
WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
  regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
x AS MATERIALIZED (SELECT r, lang, source, term, count(*) AS n FROM (SELECT r, lang, source, unnest(w) AS term FROM d) GROUP BY ALL),
k AS MATERIALIZED (SELECT lang, term, sum(n)::HUGEINT AS n FROM x GROUP BY lang, term HAVING count(*) >= {LEAST}),
v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT x.lang, x.source, x.term, sum(x.n)::HUGEINT AS n FROM x JOIN k ON x.lang = k.lang AND x.term = k.term GROUP BY ALL),
s AS (SELECT g.lang, g.source, coalesce(sum(c.n), 0)::HUGEINT AS n FROM g LEFT JOIN c ON g.lang = c.lang AND g.source = c.source GROUP BY ALL),
p AS MATERIALIZED (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n, (1 + ({SCALE}::HUGEINT * (coalesce(c.n, 0) + 2)) // (s.n + 2 * v.v))::BIGINT AS p,
    (1 + ({SCALE}::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v))::BIGINT AS q
  FROM s JOIN v ON s.lang = v.lang JOIN k ON s.lang = k.lang LEFT JOIN c ON s.lang = c.lang AND s.source = c.source AND k.term = c.term),
f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
o AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
    LEFT JOIN f ON a.lang = f.lang AND a.source = f.source AND b.source = f.item
  UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q) // (p + q))::BIGINT FROM p WHERE n > 0 AND p > q),
r AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank FROM o)
SELECT lang, source, part, item, value, rank FROM r WHERE part = 'pair' OR rank <= {TOP}
"""
