"""Windows of fixed length that occur more than once in a corpus, found exactly.

Windows are 200 bytes or 20 words, say. Every window has one anchor that its content alone determines: its gram
(k bytes or words) of least fingerprint. Equal windows so have equal anchors at equal places, and a run of windows with
one anchor is a *segment*. Steps:

1. Each document lists its anchors; exact copies of a document count once (the one with the smallest id). An anchor is named by its
   leading tokens and, below them, by its fingerprint, so names sort as the suffixes that begin at the anchors do.
2. Anchors that occur twice or more are candidates. All other windows are unique and never move.
3. Segments of candidate anchors are range-partitioned by splitters sampled from the candidates. An anchor with very many
   segments is cut by the place of the anchor within the window (windows can only match at the same place) and dealt by the
   content that all windows of a cell share, so nothing is lost; of its equal segments a task sends one, the others are decided.
4. A partition finds equal windows among the segments of an anchor, by sorted suffixes (:func:`equal_windows`) or by extending
   from the anchor (:func:`extended_windows`). Should more segments of one cell meet than a task may hold, it sends their
   windows on by digest, and they are counted by Spark's aggregation.
5. Spans go back to their documents.
"""

from __future__ import annotations

import dataclasses
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded, materialize, partitions

#: End of a span that reaches to the document's end.
WHOLE = 1 << 62
#: Segments of one anchor in one task; anchors with more are cut by place.
HOT = 50_000
#: Segments that a task sorts at once, and of one anchor that it holds at most.
SORTED, HELD = 15_000, 100_000
#: Bytes or tokens that a task works on at once.
PIECE = 1 << 19
#: Different segments of hot anchors that a task remembers.
SEEN = 50_000
_IDS = "d", "th"
#: Places the cells of a hot anchor far from each other (wraps around 2**64).
_CELL = np.int64(0x1E3779B97F4A7C15)


@dataclasses.dataclass(frozen=True)
class Repeats:
    """unit: bytes or words. first: an occurrence is marked only if an equal window starts earlier (id, then place). extend: equal
    windows are found by extending from the anchor instead of sorting."""

    unit: str
    length: int
    gram: int
    first: bool
    extend: bool = False

    @property
    def places(self) -> int:
        return self.length - self.gram + 1


def _tokens(spec: Repeats, data: np.ndarray, offsets: np.ndarray):
    """Token fingerprints or bytes, first token of each row, and each token's start and end in bytes."""
    if spec.unit == "bytes":
        return data, offsets, None, None
    values, starts, ends, first = X.words_of(data, offsets)
    return values, first, starts, ends


def _units(spec: Repeats, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes, or numbers of words that are equal for equal words alone, and the first of each row: what decisions rest on."""
    if spec.unit == "bytes":
        return data, offsets
    starts, ends, first = X.word_spans(data, offsets)
    return X.word_numbers(data, starts, ends), first


def _segments(spec: Repeats, values: np.ndarray, first: np.ndarray):
    """row, first window, last window, anchor (token indices from the row's start), name of the anchor."""
    out = []
    for lo, hi in X.slices(first, PIECE // 2):
        for at in range(first[lo], max(first[lo] + 1, first[hi] - spec.length + 1), PIECE):  # a long row goes in pieces
            to = min(first[hi], at + PIECE + spec.length - 1)
            part = values[at:to]
            if len(part) < spec.length:
                continue
            grams = X.Rolling(part, spec.unit == "bytes").grams(spec.gram)
            rank = (grams & np.uint64(0xFFFFFFFF00000000)) | np.arange(len(grams), dtype=np.uint64)
            anchor = (X.window_min(rank, spec.places) & np.uint64(0xFFFFFFFF)).astype(np.int64)
            row = np.repeat(np.arange(lo, hi), np.diff(np.clip(first[lo : hi + 1] - at, 0, len(anchor))))
            ok = np.arange(len(row)) + at + spec.length <= first[row + 1]
            starts = np.flatnonzero(ok & np.r_[True, (anchor[1 : len(row)] != anchor[: len(row) - 1]) | ~ok[:-1] | (row[1:] != row[:-1])])
            if not len(starts):
                continue
            ends = np.flatnonzero(ok & np.r_[(anchor[1 : len(row)] != anchor[: len(row) - 1]) | ~ok[1:] | (row[1:] != row[:-1]), True])
            base = at - first[row[starts]]
            out.append((row[starts], starts + base, ends + base, anchor[starts] + base, _names(part, anchor[starts], grams)))
    if not out:
        return tuple(np.zeros(0, np.int64) for _ in range(5))
    return tuple(np.concatenate(x) for x in zip(*out, strict=True))


def _names(values: np.ndarray, at: np.ndarray, grams: np.ndarray) -> np.ndarray:
    """Names of the grams at some places: their leading tokens above, 32 bits of the fingerprint below, in signed order."""
    if values.dtype == np.uint64:
        lead = values[at] >> np.uint64(32)
    else:
        lead = np.zeros(len(at), np.uint64)
        for i in range(4):
            lead = lead << np.uint64(8) | values[at + i]
    return (lead << np.uint64(32) | grams[at] & np.uint64(0xFFFFFFFF) ^ np.uint64(1 << 63)).view(np.int64)


def _lists(values: np.ndarray, lengths: np.ndarray) -> pa.ListArray:
    return pa.ListArray.from_arrays(pa.array(X.starts_of(lengths).astype(np.int32)), pa.array(values))


def _anchors(spec: Repeats, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct anchors of each document, once, or twice if they occur more than once."""
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        for lo, hi in X.slices(offsets, PIECE):
            values, first, _, _ = _tokens(spec, data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo])
            row, _, _, _, g = _segments(spec, values, first)
            order = np.lexsort((g, row))
            row, g = row[order], g[order]
            new = np.r_[True, (row[1:] != row[:-1]) | (g[1:] != g[:-1])][: len(row)]
            keep = new | np.r_[False, new[:-1] & ~new[1:]][: len(row)]
            lists = _lists(g[keep], np.bincount(row[keep], minlength=hi - lo))
            yield pa.RecordBatch.from_arrays([batch.column(c).slice(lo, hi - lo) for c in (*_IDS, "copy_of")] + [lists], ["d", "th", "copy_of", "g"])


SEGMENT = "part int, g long, d long, th long, anchor long, least int, most int, body binary"


def _cut(spec: Repeats, splitters: list[int], batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments of the candidate anchors. Rows without body are spans already decided, repeats within one document: the last
    ``most`` tokens before ``anchor``."""
    edges = np.array(splitters, np.int64)
    seen: dict[tuple, tuple] = {}
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        hits = batch.column("hits")
        hit_at = hits.offsets.to_numpy().astype(np.int64)
        flat = hits.values
        hit_g, hit_n = flat.field("g").to_numpy(), flat.field("n").to_numpy()
        d, th = (batch.column(c).to_numpy() for c in _IDS)
        for lo, hi in X.slices(offsets, PIECE):
            base = offsets[lo]
            values, first, word_at, word_to = _tokens(spec, data[base : offsets[hi]], offsets[lo : hi + 1] - base)
            row, start, end, anchor, g = _segments(spec, values, first)
            # of each row its own candidates: (row, g) pairs are looked up in sorted order
            span = slice(hit_at[lo], hit_at[hi])
            want_row, want_g, want_n = np.repeat(np.arange(hi - lo), np.diff(hit_at[lo : hi + 1])), hit_g[span], hit_n[span]
            order = np.lexsort((want_g, want_row))
            known = np.empty(len(order), [("r", np.int64), ("g", np.int64)])
            known["r"], known["g"] = want_row[order], want_g[order]
            both = np.lexsort((g, row))
            place = _find(known["r"], known["g"], row[both], g[both])
            keep, place = both[place >= 0], place[place >= 0]
            cells = want_n[order][place]
            order = np.argsort(keep, kind="stable")
            keep, cells = keep[order], cells[order]
            row, start, end, anchor, g = (x[keep] for x in (row, start, end, anchor, g))
            if not len(row):
                continue
            # cut the runs of hot anchors by the anchor's place in the window
            width = -(-spec.places // np.maximum(cells, 1))
            least, most = anchor - end, anchor - start
            n = most // width - least // width + 1
            i = np.repeat(np.arange(len(row)), n)
            cell = X.ranges(least // width, n)
            row, anchor, g, width, hot = row[i], anchor[i], g[i], width[i], cells[i] > 1
            least, most = np.maximum(least[i], cell * width), np.minimum(most[i], cell * width + width - 1)
            begin, stop = first[row] + anchor - most, first[row] + anchor - least + spec.length
            roll = X.Rolling(values, spec.unit == "bytes")
            same = roll.spans(begin, stop)
            # a hot anchor is parted by cell and by the tokens that all windows of the cell hold
            from_, to_ = cell * width, np.minimum(cell * width + width, spec.places) - 1
            core = roll.spans(first[row] + anchor - from_, first[row] + anchor - to_ + spec.length)
            parted = X.mix(core + (g + cell * _CELL).view(np.uint64))
            g = np.where(hot, parted.view(np.int64), g)
            # repeats within the document: all but the first segment are decided here (the first too, unless it may stay)
            order = np.lexsort((begin, least, same, g, row))
            a = [x[order] for x in (row, g, same, least, most)]
            new = np.r_[True, np.any([x[1:] != x[:-1] for x in a], 0)]
            if not new.all():
                units = values if spec.unit == "bytes" else X.word_numbers(data[base : offsets[hi]], word_at, word_to)
                k = np.flatnonzero(~new)
                new[k] = ~_same_spans(units, begin[order[k]], begin[order[k - 1]], (stop - begin)[order[k]])
            often = ~new
            if not spec.first:
                often = often | np.r_[~new[1:], False]
            sent, known_span = order[new], order[often]
            where = np.where(hot, parted % np.uint64(len(edges) + 1), np.searchsorted(edges, g, "right")).astype(np.int32)
            ids_d, ids_th = d[lo:hi][row], th[lo:hi][row]
            if spec.unit == "bytes":
                from_, to_ = begin, stop
            else:
                from_, to_ = word_at[begin], word_to[stop - 1]
            text = data[base : offsets[hi]]
            again, told = _equal_ones(spec, seen, sent[hot[sent]], text, from_, to_, g, ids_d, ids_th, anchor, least, most)
            if len(again):
                sent = sent[~np.isin(sent, again)]
            if len(told):
                yield _told(spec, told, len(edges) + 1)
            for k in range(0, len(sent), 20_000):
                i = sent[k : k + 20_000]
                size = to_[i] - from_[i]
                blob = text[X.ranges(from_[i], size)]
                bodies = pa.Array.from_buffers(pa.binary(), len(i), [None, pa.py_buffer(X.starts_of(size).astype(np.int32)), pa.py_buffer(blob)])
                yield _segment_batch(where[i], g[i], ids_d[i], ids_th[i], anchor[i], least[i], most[i], bodies)
            if len(known_span):  # joined per document and dealt evenly: no one has to compare them
                runs = merged(np.column_stack([begin[known_span], stop[known_span]]), len(values))
                at_row = np.searchsorted(first, runs[:, 0], "right") - 1
                parts = []
                for i, (a, b) in zip(at_row, runs, strict=True):  # runs of neighbouring documents may touch
                    while b > first[i + 1]:
                        parts.append((i, a, first[i + 1]))
                        i, a = i + 1, first[i + 1]
                    parts.append((i, a, b))
                i, a, b = np.array(parts, np.int64).T
                deal = (X.mix(d[lo:hi][i].view(np.uint64) + a.astype(np.uint64)) % np.uint64(len(edges) + 1)).astype(np.int32)
                yield _segment_batch(deal, np.zeros(len(i), np.int64), d[lo:hi][i], th[lo:hi][i], b - first[i], np.zeros(len(i), np.int64), b - a, pa.nulls(len(i), pa.binary()))


def _same_spans(units: np.ndarray, one: np.ndarray, two: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Whether spans of one length, unit by unit, are equal."""
    out = np.empty(len(one), bool)
    for k in range(0, len(one), 8192):
        n = size[k : k + 8192]
        equal = units[X.ranges(one[k : k + 8192], n)] == units[X.ranges(two[k : k + 8192], n)]
        out[k : k + 8192] = np.logical_and.reduceat(equal, X.starts_of(n)[:-1])
    return out


def _equal_ones(spec: Repeats, seen: dict, rows: np.ndarray, text, from_, to_, g, d, th, anchor, least, most) -> tuple[np.ndarray, np.ndarray]:
    """Which segments need not go, because an equal one has gone, and the decided ones among all (d, th, anchor, least, most)."""
    again, told = [], []
    for j in rows.tolist():
        key = (int(g[j]), int(least[j]), int(most[j]), text[from_[j] : to_[j]].tobytes())
        me = (int(d[j]), int(th[j]), int(anchor[j]))
        one = seen.get(key)
        if one is None or (spec.first and me < one):
            if len(seen) >= SEEN:
                seen.clear()
            seen[key] = me
            continue
        again.append(j)
        if one != me:  # a row that is there twice is one document
            told.append((*me, key[1], key[2]))
            if not spec.first:
                told.append((*one, key[1], key[2]))
    return np.array(again, np.int64), np.array(sorted(set(told)), np.int64).reshape(-1, 5)


def _told(spec: Repeats, told: np.ndarray, parts: int) -> pa.RecordBatch:
    """Decided segments as rows without body, dealt evenly."""
    d, th, anchor, least, most = told.T
    end = anchor - least + spec.length
    deal = (X.mix(d.astype(np.int64).view(np.uint64) + end.astype(np.uint64)) % np.uint64(parts)).astype(np.int32)
    return _segment_batch(deal, np.zeros(len(d), np.int64), d, th, end, np.zeros(len(d), np.int64), end - (anchor - most), pa.nulls(len(d), pa.binary()))


def _segment_batch(part, g, d, th, anchor, least, most, bodies) -> pa.RecordBatch:
    columns = [pa.array(part), pa.array(g), pa.array(d), pa.array(th), pa.array(anchor), pa.array(least.astype(np.int32)), pa.array(most.astype(np.int32)), bodies]
    return pa.RecordBatch.from_arrays(columns, ["part", "g", "d", "th", "anchor", "least", "most", "body"])


def _find(rows: np.ndarray, keys: np.ndarray, row: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Place of each (row, key) among sorted distinct (rows, keys), or -1. Both sides are sorted."""
    n = len(rows)
    if not n or not len(row):
        return np.full(len(row), -1)
    order = np.lexsort((np.r_[np.zeros(n, np.int8), np.ones(len(row), np.int8)], np.r_[keys, key], np.r_[rows, row]))
    last = np.maximum.accumulate(np.where(order < n, order, -1))
    asked = order >= n
    out = np.empty(len(row), np.int64)
    out[order[asked] - n] = last[asked]
    safe = np.maximum(out, 0)
    return np.where((out >= 0) & (rows[safe] == row) & (keys[safe] == key), out, -1)


def multikey_order(columns: list[np.ndarray]) -> np.ndarray:
    """Order of rows by their columns, left to right: ties alone are sorted on, column by column."""
    order = np.argsort(columns[0], kind="stable")
    key = columns[0][order]
    tied = key[1:] == key[:-1]
    for column in columns[1:]:
        at = np.flatnonzero(np.r_[tied, False] | np.r_[False, tied])
        if not len(at):
            break
        run = np.cumsum(np.r_[True, ~tied])[at]
        rows = order[at]
        order[at] = rows[np.lexsort((column[rows], run))]
        key = column[order[at]]
        pair = np.flatnonzero(at[1:] - at[:-1] == 1)
        tied[at[pair]] &= key[pair + 1] == key[pair]
    return order


def _common(units: np.ndarray, order: np.ndarray) -> np.ndarray:
    """Length of the common start of each row and the one before it in the order; 0 for the first."""
    out = np.zeros(len(order), np.int64)
    for at in range(1, len(order), 8192):
        o = order[at - 1 : at + 8192]
        differ = units[o[1:]] != units[o[:-1]]
        out[at : at + len(o) - 1] = np.where(differ.any(1), differ.argmax(1), units.shape[1])
    return out


def _matrix(values: np.ndarray, at: np.ndarray, lengths: np.ndarray, width: int, step: int) -> np.ndarray:
    """One row of width values for each start, forward or backward (step -1), padded with zeros."""
    out = np.zeros((len(at), width), values.dtype)
    columns = np.arange(width)
    for k in range(0, len(at), 8192):
        have = columns[None, :] < lengths[k : k + 8192, None]
        index = at[k : k + 8192, None] + step * columns[None, :]
        out[k : k + 8192][have] = values[index[have]]
    return out


def _columns(units: np.ndarray) -> list[np.ndarray]:
    if units.dtype == np.uint64:
        return [units[:, i] for i in range(units.shape[1])]
    pad = -units.shape[1] % 8
    wide = np.ascontiguousarray(np.pad(units, ((0, 0), (0, pad)))).view(">u8").astype(np.uint64)
    return [np.ascontiguousarray(wide[:, i]) for i in range(wide.shape[1])]


def equal_windows(spec: Repeats, least, most, after: np.ndarray, before: np.ndarray) -> np.ndarray:
    """Which windows of distinct segments, in order of precedence, equal one of another: rows x places of the anchor.

    after holds the tokens from the anchor on, before those ahead of it, nearest first. The suffixes that begin at the anchors are
    sorted, and the reversed prefixes in front of them; the common lengths of neighbours tell, for every place of the anchor, which
    windows are equal. The shortest of these is a gram, and a gram has one name, so no suffix of another bucket can match.
    """
    m = len(least)
    right = multikey_order(_columns(after))
    left = multikey_order(_columns(before)) if before.shape[1] else np.arange(m)
    forward = _common(after, right)
    backward = _common(before, left) if before.shape[1] else np.zeros(m, np.int64)
    right_at, left_at = np.empty(m, np.int64), np.empty(m, np.int64)
    right_at[right], left_at[left] = np.arange(m), np.arange(m)
    marked = np.zeros((m, spec.places), bool)
    for place in range(int(least.min()), int(most.max()) + 1):
        rows = np.flatnonzero((least <= place) & (place <= most))
        if len(rows) < 2:
            continue
        key = np.cumsum(forward < spec.length - place)[right_at[rows]] * (m + 1) + np.cumsum(backward < place)[left_at[rows]]
        order = np.argsort(key, kind="stable")
        key = key[order]
        same = key[1:] == key[:-1]
        hit = np.r_[False, same] if spec.first else np.r_[False, same] | np.r_[same, False]
        marked[rows[order[hit]], place] = True
    return marked


def extended_windows(spec: Repeats, least, most, after: np.ndarray, before: np.ndarray, roll: X.Rolling, at: np.ndarray) -> np.ndarray:
    """As equal_windows. A window joins its segment to the first one that seems to have it too (by fingerprint); from the anchor the two
    are extended both ways, unit by unit, and the windows within their maximal repeat are marked."""
    m = len(least)
    row = np.repeat(np.arange(m), most - least + 1)
    place = X.ranges(least, most - least + 1)
    start = at[row] - place
    prints = roll.spans(start, start + spec.length)
    order = np.argsort(prints, kind="stable")
    key = prints[order]
    head = order[np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(key)), 0))]
    one, other, where = row[order], row[head], place[order]
    met = one != other
    one, other, where = one[met], other[met], where[met]
    pairs, pair = np.unique(one * np.int64(m) + other, return_inverse=True)
    a, b = pairs // m, pairs % m
    ahead, back = np.zeros(len(a), np.int64), np.zeros(len(a), np.int64)
    for k in range(0, len(a), 8192):
        i, j = a[k : k + 8192], b[k : k + 8192]
        for out, side in ((ahead, after), (back, before)):
            if side.shape[1]:
                differ = side[i] != side[j]
                out[k : k + 8192] = np.where(differ.any(1), differ.argmax(1), side.shape[1])
    same = (where <= back[pair]) & (spec.length - where <= ahead[pair])
    if not same.all():  # equal fingerprints of unequal windows
        return equal_windows(spec, least, most, after, before)
    # the places whose windows lie within the extended match
    low = np.maximum.reduce([spec.length - ahead, least[a], least[b]])
    high = np.minimum.reduce([back, most[a], most[b]]) + 1
    step = np.zeros((m, spec.places + 1), np.int32)
    for rows in (a,) if spec.first else (a, b):
        np.add.at(step, (rows, low), 1)
        np.add.at(step, (rows, high), -1)
    return np.cumsum(step, axis=1)[:, :-1] > 0


def _compact(spec: Repeats, t: pa.Table) -> tuple[pa.Table, tuple]:
    """Segments of one anchor, of equal ones only the first, and the spans so decided."""
    code = t["body"].combine_chunks().dictionary_encode().indices.to_numpy()
    d, th, anchor, least, most = (t[c].to_numpy().astype(np.int64) for c in ("d", "th", "anchor", "least", "most"))
    order = np.lexsort((anchor, th, d, code, most, least))
    a = [x[order] for x in (least, most, code)]
    new = np.r_[True, np.any([x[1:] != x[:-1] for x in a], 0)]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    other = (d[order] != d[head]) | (th[order] != th[head]) | (anchor[order] != anchor[head])
    done = order[other] if spec.first else np.unique(np.r_[order[other], head[other]])
    return t.take(pa.array(order[new])), (d[done], th[done], anchor[done] - most[done], anchor[done] - least[done] + spec.length)


def _match_by_place(spec: Repeats, d, th, anchor, least, most, bodies: pa.Array):
    """As _match for very many segments of one anchor: place after place, so that a row costs little more than its body."""
    order = np.lexsort((least, anchor, th, d))
    a = [x[order] for x in (d, th, anchor, least)]
    order = order[np.r_[True, np.any([x[1:] != x[:-1] for x in a], 0)]]
    d, th, anchor, least, most = (x[order].astype(np.int64) for x in (d, th, anchor, least, most))
    data, offsets = X.flat(bodies.take(pa.array(order)))
    if spec.unit == "words":
        data, offsets = _units(spec, data, offsets)
        data = data.astype(np.uint32)
    for place in range(int(least.min()), int(most.max()) + 1):
        rows = np.flatnonzero((least <= place) & (place <= most))
        prints = np.zeros(len(least), np.uint64)
        windows = np.zeros((len(rows), spec.length), data.dtype)
        for lo, hi in X.slices(offsets, X.PIECE // data.itemsize):
            values, first = data[offsets[lo] : offsets[hi]], offsets[lo : hi + 1] - offsets[lo]
            p, q = np.searchsorted(rows, [lo, hi])
            if p == q:
                continue
            at = first[rows[p:q] - lo] + most[rows[p:q]] - place
            prints[rows[p:q]] = X.Rolling(values if spec.unit == "bytes" else values.astype(np.uint64), spec.unit == "bytes").spans(at, at + spec.length)
            windows[p:q] = _matrix(values, at, np.full(q - p, spec.length), spec.length, 1)
        by = np.argsort(prints[rows], kind="stable")
        key = prints[rows][by]
        head = by[np.maximum.accumulate(np.where(np.r_[True, key[1:] != key[:-1]], np.arange(len(by)), 0))]
        equal = head != by
        for k in range(0, len(by), 8192):
            equal[k : k + 8192] &= (windows[by[k : k + 8192]] == windows[head[k : k + 8192]]).all(1)
        hit = by[equal] if spec.first else np.unique(np.r_[by[equal], head[equal]])
        hit = rows[hit]
        yield d[hit], th[hit], anchor[hit] - place, anchor[hit] - place + spec.length


def _match(spec: Repeats, g, d, th, anchor, least, most, bodies: pa.Array):
    """Spans (document, from, to) of the repeated windows of some anchors' segments."""
    order = np.lexsort((least, anchor, th, d))
    a = [x[order] for x in (d, th, anchor, least, g)]
    order = order[np.r_[True, np.any([x[1:] != x[:-1] for x in a], 0)]]  # a row that is there twice is one document
    g, d, th, anchor, least, most = (x[order] for x in (g, d, th, anchor, least.astype(np.int64), most.astype(np.int64)))
    values, first = _units(spec, *X.flat(bodies.take(pa.array(order))))
    at = first[:-1] + most
    size = first[1:] - at
    after = _matrix(values, at, size, spec.length, 1)
    before = _matrix(values, at - 1, most, int(most.max()), -1)
    # equal segments are sorted once
    roll = X.Rolling(values, spec.unit == "bytes")
    content = roll.spans(first[:-1], first[1:])
    order = np.lexsort((content, most, least, g))
    a = [x[order] for x in (g, least, most, content)]
    new = np.r_[True, np.any([x[1:] != x[:-1] for x in a], 0)]
    head = order[np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))]
    equal = (after[order] == after[head]).all(1) & (before[order] == before[head]).all(1)
    rep = np.empty(len(order), np.int64)
    rep[order] = np.where(equal, head, order)
    lead = np.flatnonzero(rep == np.arange(len(rep)))
    if spec.extend:
        part = extended_windows(spec, least[lead], most[lead], after[lead], before[lead], roll, at[lead])
    else:
        part = equal_windows(spec, least[lead], most[lead], after[lead], before[lead])
    marked = np.zeros((len(g), spec.places), bool)
    marked[lead] = part
    place = np.arange(spec.places)
    inside = (place >= least[:, None]) & (place <= most[:, None])
    if spec.first:  # within a group of equal segments the first in order leads
        marked |= (rep != np.arange(len(rep)))[:, None] & inside
    else:
        marked |= (np.bincount(rep, minlength=len(rep))[rep] > 1)[:, None] & inside
    # runs of marked places
    step = np.diff(np.pad(marked, ((0, 0), (1, 1))).astype(np.int8), axis=1)
    row, low = np.nonzero(step == 1)
    _, high = np.nonzero(step == -1)
    return d[row], th[row], anchor[row] - high + 1, anchor[row] - low + spec.length


SPANS = "d long, th long, s long, e long, k1 long, k2 long"


def _windows(spec: Repeats, t: pa.Table) -> Iterator[pa.RecordBatch]:
    """Every window of some segments as a row with its digest of 128 bits: for the anchors of which a task can't hold all segments."""
    for lo in range(0, len(t), SORTED // 8):
        some = t.slice(lo, SORTED // 8)
        data, offsets = X.flat(some["body"].combine_chunks())
        if spec.unit == "bytes":
            first, blob, place_of, gap = offsets, data, np.arange(len(data) + 1), 0
        else:
            starts, ends, first = X.word_spans(data, offsets)
            (blob, place_of), gap = X.joined(data, starts, ends), 1
        d, th, anchor, least, most = (some[c].to_numpy().astype(np.int64) for c in ("d", "th", "anchor", "least", "most"))
        row = np.repeat(np.arange(len(d)), most - least + 1)
        place = X.ranges(least, most - least + 1)
        start = first[row] + most[row] - place
        view = memoryview(np.ascontiguousarray(blob))
        ends_at = place_of[start + spec.length] - gap
        digest = b"".join(hashlib.blake2b(view[a:b], digest_size=16).digest() for a, b in zip(place_of[start].tolist(), ends_at.tolist(), strict=True))
        keys = np.frombuffer(digest, "<i8").reshape(-1, 2)
        s = anchor[row] - place
        yield _span_batch(d[row], th[row], s, s + spec.length, np.ascontiguousarray(keys[:, 0]), np.ascontiguousarray(keys[:, 1]))


def _span_batch(d, th, s, e, k1=None, k2=None) -> pa.RecordBatch:
    none = pa.nulls(len(d), pa.int64())
    return pa.RecordBatch.from_arrays([*(pa.array(x) for x in (d, th, s, e)), none if k1 is None else pa.array(k1), none if k2 is None else pa.array(k2)], [x.split()[0] for x in SPANS.split(", ")])


def _spans(spec: Repeats, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Segments sorted by anchor -> spans, and windows yet to be counted. Whole anchors are gathered until there are enough to match."""
    held: list[pa.RecordBatch] = []
    count, limit = 0, SORTED
    sent_on: int | None = None  # the anchor whose windows are being sent on

    def flush(upto: int | None):
        nonlocal held, count, limit
        limit = SORTED
        t = pa.Table.from_batches(held).combine_chunks()
        rows = len(t) if upto is None else upto
        held, count = ([] if rows == len(t) else t.slice(rows).to_batches()), len(t) - rows
        t = t.slice(0, rows)
        if rows:
            c = {k: t[k].to_numpy() for k in ("g", "d", "th", "anchor", "least", "most")}
            if rows > 2 * SORTED and c["g"][0] == c["g"][-1]:
                del c["g"]
                for found in _match_by_place(spec, *c.values(), t["body"].combine_chunks()):
                    yield _span_batch(*found)
                return
            yield _span_batch(*_match(spec, *c.values(), t["body"].combine_chunks()))

    for batch in batches:
        known = batch.column("body").is_null().to_numpy(zero_copy_only=False)
        if known.any():
            c = {k: batch.column(k).to_numpy()[known] for k in ("d", "th", "anchor", "least", "most")}
            yield _span_batch(c["d"], c["th"], c["anchor"] - c["most"], c["anchor"])
            batch = batch.filter(pa.array(~known))
        if sent_on is not None and len(batch):
            end = int(np.searchsorted(batch.column("g").to_numpy(), sent_on, "right"))
            yield from _windows(spec, pa.Table.from_batches([batch.slice(0, end)]))
            batch = batch.slice(end)
            sent_on = sent_on if not len(batch) else None
        if not len(batch):
            continue
        held.append(batch)
        count += len(batch)
        if count >= limit:
            g = np.concatenate([b.column("g").to_numpy() for b in held])
            last = int(np.searchsorted(g, g[-1]))  # the last anchor may go on in the next batch
            if last:
                yield from flush(last)
            else:
                t, found = _compact(spec, pa.Table.from_batches(held))
                held, count = t.combine_chunks().to_batches(), len(t)
                limit = max(SORTED, 2 * count)
                if len(found[0]):
                    yield _span_batch(*found)
                if count > HELD:
                    yield from _windows(spec, t)
                    held, count, limit, sent_on = [], 0, SORTED, int(g[-1])
    if held:
        yield from flush(None)


def keyed(docs: DataFrame) -> DataFrame:
    """docs with the internal row key: a null id counts as the least; rows equal in id and text are one document."""
    return docs.select("*", F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63))).alias("d"), F.xxhash64("text").alias("th"))


def repeated_spans(spec: Repeats, docs: DataFrame) -> DataFrame:
    """docs must come from keyed(), dealt by (d, th). Returns d, th, spans array<struct<s,e>>: windows to remove, unmerged."""
    spark = bounded(docs).sparkSession
    n = partitions(spark)
    texts = docs.select(*_IDS, "text")
    named = texts.withColumn("copy_of", F.sha2(F.coalesce("text", F.lit("")), 256))
    anchors = materialize(named.mapInArrow(lambda it: _anchors(spec, it), "d long, th long, copy_of string, g array<long>"))
    ids = anchors.select("copy_of", *_IDS, F.size("g").alias("n"))
    # written before it is joined, so that the join can deal the members of one large class to several tasks
    classes = ids.groupBy("copy_of").agg(F.min("d").alias("lead"), F.min_by("th", "d").alias("lead_th"), F.count("*").alias("members")).filter("members > 1")
    classes = materialize(classes)
    copies = materialize(ids.join(classes, "copy_of").filter("d != lead or th != lead_th").select(*_IDS, "n"))
    each = anchors.join(copies.select(*_IDS).distinct(), [*_IDS], "left_anti").select(*_IDS, F.explode("g").alias("g"))
    counts = each.groupBy("g").agg(F.count("*").alias("n")).filter("n > 1")
    cells = F.least(F.lit(spec.places), F.ceil(F.col("n") / HOT)).cast("int")
    # written before it is joined, so that the join can deal the documents of a common anchor to several tasks
    hits = materialize(each.join(materialize(counts.select("g", cells.alias("n"))), "g"))
    edges = _splitters(hits, n)
    listed = hits.groupBy(*_IDS).agg(F.collect_set(F.struct("g", "n")).alias("hits"))
    segments = texts.join(listed, [*_IDS]).select("text", *_IDS, "hits").mapInArrow(lambda it: _cut(spec, edges, it), SEGMENT)
    dealt = segments.repartitionById(n, F.col("part")).sortWithinPartitions("g")
    found = materialize(dealt.mapInArrow(lambda it: _spans(spec, it), SPANS))
    spans = found.filter("k1 is null").select(*_IDS, "s", "e").unionByName(_counted(spec, found.filter("k1 is not null")))
    # exact copies: all but the first go whole, or all of them
    gone = copies
    if not spec.first:
        gone = gone.unionByName(classes.join(ids.withColumnsRenamed({"d": "lead", "th": "lead_th"}), ["copy_of", "lead", "lead_th"]).select(F.col("lead").alias("d"), F.col("lead_th").alias("th"), "n"))
    whole = gone.filter(F.col("n") > 0).select(*_IDS, F.lit(0).cast("long").alias("s"), F.lit(WHOLE).alias("e"))
    return spans.unionByName(whole).groupBy(*_IDS).agg(F.collect_list(F.struct("s", "e")).alias("spans"))


def _counted(spec: Repeats, windows: DataFrame) -> DataFrame:
    """Of windows (d, th, s, e and a digest k1, k2) those that equal another one, or an earlier one."""
    first = windows.groupBy("k1", "k2").agg(F.min(F.struct(*_IDS, "s")).alias("lead"), F.max(F.struct(*_IDS, "s")).alias("last")).filter("lead < last")
    first = materialize(first)  # as above: a common window is in very many documents
    again = windows.join(first, ["k1", "k2"])
    if spec.first:
        again = again.filter(F.struct(*_IDS, "s") > F.col("lead"))
    return again.select(*_IDS, "s", "e")


def _splitters(hits: DataFrame, n: int) -> list[int]:
    """n - 1 keys that part the anchors evenly, from a sketch of the candidates."""
    if n < 2:
        return []
    row = hits.agg(F.percentile_approx("g", [i / n for i in range(1, n)], 10_000).alias("q")).first()
    return sorted(set(row["q"] or []))


def merged(spans: np.ndarray, n: int) -> np.ndarray:
    """Sorted disjoint runs, cut at n; runs that touch are one."""
    spans = np.minimum(spans, n)
    spans = spans[np.argsort(spans[:, 0], kind="stable")]
    reach = np.maximum.accumulate(spans[:, 1])
    new = np.r_[True, spans[1:, 0] > reach[:-1]]
    begin = np.flatnonzero(new)
    return np.column_stack([spans[begin, 0], np.maximum.reduceat(spans[:, 1], begin)])
