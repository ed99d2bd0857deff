"""Stretches of a text that repeat themselves: all maximal runs of words with a period, each found once.

Words of a batch are numbered exactly, and the suffixes of all its texts are sorted together by doubling (texts never mix: the first key
is the text). The ranks of each doubling step give the common lengths of neighbours (LCP). Of each place the nearest earlier places in
the suffix order, to either side, give the longest previous factor (LPF) and where it stands; jumping by it parts a text into
Lempel-Ziv blocks. A run either meets a block's border or lies within a block:

* At a border the text is extended both ways for each period at once, by prefix tables (Main's extensions). Borders whose two blocks are
  too short for a run of the asked length need none.
* What lies within a block lies in its earlier copy too: runs are kept in buckets by start and copied over, left to right.
"""

from __future__ import annotations

import bisect
import hashlib
import heapq
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded

#: Words of a run at least, and how many times its period.
LENGTH, TIMES = 24, 3
#: Bytes of text whose suffixes are sorted together, about; one text at least.
TOGETHER = 2 << 20


def word_numbers(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A number for each word, equal for equal words alone."""
    size = ends - starts
    solid = np.ascontiguousarray(data[X.ranges(starts, size)])
    words = pa.Array.from_buffers(pa.large_binary(), len(starts), [None, pa.py_buffer(X.starts_of(size)), pa.py_buffer(solid)])
    return words.dictionary_encode().indices.to_numpy().astype(np.int64)


def suffix_order(codes: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """Suffixes of all rows in order, rows one after another, and the ranks by the first 1, 2, 4, ... words while any are equal."""
    n = len(codes)
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    key = row * np.int64(codes.max() + 1 if n else 1) + codes
    order = np.argsort(key, kind="stable")
    end = first[row + 1]
    rank = np.empty(n, np.int32)
    new = np.r_[True, key[order][1:] != key[order][:-1]][:n]
    head = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    rank[order] = head
    ranks, step = [rank], 1
    tied = np.flatnonzero(~new | ~np.r_[new[1:], True][:n])
    while len(tied):
        at = order[tied]
        far = at + step
        follow = np.where(far < end[at], rank[np.minimum(far, n - 1)] + np.int64(1), 0)
        key = (rank[at].astype(np.int64) << 32) | follow
        by = np.argsort(key, kind="stable")
        order[tied] = at = at[by]
        key = key[by]
        new = np.r_[True, key[1:] != key[:-1]]
        rank = rank.copy()
        rank[at] = tied[np.maximum.accumulate(np.where(new, np.arange(len(key)), 0))]
        ranks.append(rank)
        step *= 2
        tied = tied[~new | ~np.r_[new[1:], True]]
    return order, ranks


def common_lengths(order: np.ndarray, ranks: list[np.ndarray], first: np.ndarray) -> np.ndarray:
    """Words that each suffix shares with the one before it in the order (0 for the first)."""
    n = len(order)
    out = np.zeros(n, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    same = ranks[0][a] == ranks[0][b] if n else np.zeros(0, bool)
    live = np.flatnonzero(same)
    a, b = a[live], b[live]
    end = first[1:][np.searchsorted(first, a, "right") - 1] if n else a
    for k in range(len(ranks) - 1, -1, -1):
        ok = (a < end) & (b < end)
        ok[ok] = ranks[k][a[ok]] == ranks[k][b[ok]]
        width = ok * (np.int64(1) << k)
        a, b = a + width, b + width
        out[live + 1] += width
    return out


def _nearest(order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each place of the order, going down: the shared length with the nearest suffix there that starts earlier in the text, and where
    that one starts; 0 and -1 if none shares a word. lcp: shared length of each with the one before."""
    n = len(order)
    to = np.arange(-1, n - 1)
    least = lcp.copy()
    live = np.flatnonzero(least > 0)
    while len(live):
        live = live[order[to[live]] > order[live]]
        if not len(live):
            break
        via = to[live]
        least_via = np.minimum(least[live], least[via])
        to_via = to[via]
        least[live], to[live] = least_via, to_via
        live = live[least_via > 0]
    found = least > 0
    return np.where(found, least, 0), np.where(found, order[np.maximum(to, 0)], -1)


def previous_factors(order: np.ndarray, lcp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By place in the text: length of the longest factor that also starts earlier, and an earlier start of it."""
    n = len(order)
    up, up_at = _nearest(order, lcp)
    back = np.r_[0, lcp[1:][::-1]][:n] if n else lcp
    down, down_at = (x[::-1] for x in _nearest(order[::-1], back))
    longest, source = np.zeros(n, np.int64), np.full(n, -1, np.int64)
    longest[order] = np.maximum(up, down)
    source[order] = np.where(up >= down, up_at, down_at)
    return longest, source


def _prefixes(s: list) -> list[int]:
    """How many items each suffix of s shares with s itself."""
    n = len(s)
    z = [0] * n
    if n:
        z[0] = n
    left = right = 0
    for i in range(1, n):
        k = min(right - i, z[i - left]) if i < right else 0
        if i + k >= right:
            k = max(k, 0)
            while i + k < n and s[k] == s[i + k]:
                k += 1
            left, right = i, i + k
        z[i] = k
    return z


class Runs:
    """The maximal runs of one text (a list of word numbers), given its Lempel-Ziv blocks."""

    def __init__(self, words: np.ndarray, length: int, times: int):
        self.array, self.words, self.length, self.times = words, words.tolist(), length, times
        self.found: dict[tuple[int, int], int] = {}  # (start, end) -> period

    def _grow(self, start: int, end: int, period: int) -> None:
        """Take in the run that holds a stretch of a period, to its full length."""
        w, n = self.array, len(self.array)
        while end < n:
            to = min(n, end + max(64, end - start))
            differ = w[end:to] != w[end - period : to - period]
            end += int(differ.argmax()) if differ.any() else to - end
            if differ.any():
                break
        while start > 0:
            to = max(0, start - max(64, end - start))
            differ = (w[to:start] != w[to + period : start + period])[::-1]
            start -= int(differ.argmax()) if differ.any() else start - to
            if differ.any():
                break
        known = self.found.get((start, end))
        if known is None or period < known:
            self.found[start, end] = period

    def at_border(self, c: int, before: int, behind: int) -> None:
        """Runs that meet the border at word c, between blocks of so many words."""
        most = (before + behind) // (self.times - 1)
        left, right = self.words[max(0, c - before - most) : c], self.words[c : c + behind]
        if not right:
            return
        both, m, k = left + right, len(left), len(right)
        ahead = _prefixes(right)  # shared by c and c + q, forward
        turned = left[::-1]
        back = _prefixes(turned)  # shared by c and c - q, backward
        forward = _prefixes([*right, -1, *both])[k + 1 :]  # shared by c and any place, forward
        rear = _prefixes([*turned, -1, *both[::-1]])[m + 1 :]  # the same backward; rear[i]: the end lies i before the end of both
        for q in range(1, most + 1):
            if q <= k:  # a period to the right of the border
                a, b = rear[k - q] if k - q < len(rear) else 0, ahead[q] if q < k else 0
                if a + b >= (self.times - 1) * q and a + b + q >= self.length:
                    self._known_or_grow(c - a, c + q + b, q)
            if q <= m:  # a period to its left
                a, b = back[q] if q < m else 0, forward[m - q]
                if a + b >= (self.times - 1) * q and a + b + q >= self.length:
                    self._known_or_grow(c - q - a, c + b, q)

    def _known_or_grow(self, start: int, end: int, period: int) -> None:
        if self.found.get((start, end), period + 1) > period:
            self._grow(start, end, period)

    def copied(self, blocks: list[tuple[int, int, int]]) -> None:
        """Runs within a block (start, end, earlier start of the same words), from the runs of the earlier copy."""
        queue = sorted((s, e, q) for (s, e), q in self.found.items())
        starts = [r[0] for r in queue]
        for begin, end, source in blocks:
            size, shift = end - begin, begin - source
            lo = bisect.bisect_right(starts, source)
            later: list[tuple[int, int, int]] = []
            heap = queue[lo : bisect.bisect_left(starts, source + size - self.length + 1)]
            heapq.heapify(heap)
            while heap:
                s, e, q = heapq.heappop(heap)
                cut = min(e, source + size)
                if cut - s < max(self.length, self.times * q):
                    continue
                run = (s + shift, cut + shift, q)
                known = self.found.get(run[:2])
                if known is not None and known <= q:
                    continue
                if run[1] == end:
                    before = len(self.found)
                    self._grow(*run)
                    if len(self.found) == before:
                        continue
                else:
                    self.found[run[:2]] = q
                later.append(run)
                if run[0] < source + size - self.length + 1:  # a copy that overlaps its source
                    heapq.heappush(heap, run)
            for run in later:
                place = bisect.bisect(queue, run)
                queue.insert(place, run)
                starts.insert(place, run[0])

    def sorted(self) -> list[tuple[int, int, int]]:
        """(start, length, period) by start, then period."""
        good = ((s, e - s, q) for (s, e), q in self.found.items() if e - s >= max(self.length, self.times * q))
        return sorted(good, key=lambda r: (r[0], r[2]))


def all_runs(codes: np.ndarray, first: np.ndarray, length: int = LENGTH, times: int = TIMES) -> dict[int, list[tuple[int, int, int]]]:
    """Of rows of word numbers those that have runs, with their runs (start, length, period) by start, then period.

    A run is a stretch with smallest period q that is at least ``length`` words long and ``times`` (2 or more) periods, and that no
    neighbouring word prolongs.
    """
    order, ranks = suffix_order(codes, first)
    lcp = common_lengths(order, ranks, first)
    longest, source = previous_factors(order, lcp)
    del order, ranks, lcp
    # behind its first period a run repeats what came before, so the blocks that hold that part are no shorter together
    least = length - length // times
    out: dict[int, list[tuple[int, int, int]]] = {}
    jump = np.maximum(longest, 1)
    for i in range(len(first) - 1):
        a, b = int(first[i]), int(first[i + 1])
        if b - a < length or longest[a:b].max() < least // 2:
            continue
        steps, at, n, borders = jump[a:b].tolist(), 0, b - a, []
        while at < n:
            borders.append(at)
            at += steps[at]
        at = np.array([*borders, n])
        size = np.diff(at)
        before = np.r_[0, size[:-1]]
        meet = np.flatnonzero(before + size >= least)
        if not len(meet):
            continue
        runs = Runs(codes[a:b], length, times)
        for k in meet.tolist():
            runs.at_border(int(at[k]), int(before[k]), int(size[k]))
        long = np.flatnonzero(size >= length)
        runs.copied([(int(at[k]), int(at[k + 1]), int(source[a + at[k]] - a)) for k in long.tolist() if source[a + at[k]] >= 0])
        if found := runs.sorted():
            out[i] = found
    return out


def planted(n: int, doc_id: int) -> np.ndarray | None:
    """Which word stands at each place of the test data: one document in ten has a tail that repeats, as a checksum of its id says."""
    h = zlib.crc32(str(doc_id).encode())
    if h % 10 or not n:
        return None
    g = h // 10
    a = g % n
    i = np.arange(n)
    return np.where(i < a, i, a + (i - a) % (1 + (n - a) // (3 + g % 8)))


OUT = "n_runs long, start long, length long, period long, exponent_milli long, runs_sha256 string, collapsed_sha256 string"
SPANS = "runs array<struct<start:long,length:long,period:long>>, collapsed string"


def _rows(batches: Iterator[pa.RecordBatch], length: int, times: int, plant: bool, with_text: bool) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        ids = batch.column("doc_id").to_pylist()
        for lo, hi in X.slices(offsets, TOGETHER):
            text = data[offsets[lo] : offsets[hi]]
            starts, ends, first = X.word_spans(text, offsets[lo : hi + 1] - offsets[lo])
            if plant:
                for i in range(hi - lo):
                    a, b = first[i], first[i + 1]
                    where = planted(int(b - a), ids[lo + i]) if ids[lo + i] is not None else None
                    if where is not None:
                        starts[a:b], ends[a:b] = starts[a:b][where], ends[a:b][where]
            runs = all_runs(word_numbers(text, starts, ends), first, length, times)
            gone = np.zeros(len(starts) + 1, np.int32)
            best: list[tuple] = []
            digests, lists = [], []
            for i in range(hi - lo):
                found = runs.get(i, [])
                s = np.array(found, np.int64).reshape(-1, 3)
                np.add.at(gone, first[i] + s[:, 0] + s[:, 2], 1)
                np.add.at(gone, first[i] + s[:, 0] + s[:, 1], -1)
                top: tuple = (None, None, None)
                for r in found:  # by start, then period: the first of equals stays
                    if top[0] is None or r[1] * top[2] > top[1] * r[2]:
                        top = r
                best.append((len(found), *top, None if top[0] is None else 1000 * top[1] // top[2]))
                digests.append(hashlib.sha256("".join(f"{r[0]},{r[1]},{r[2]}\n" for r in found).encode()).hexdigest())
                if with_text:
                    lists.append([{"start": r[0], "length": r[1], "period": r[2]} for r in found])
            stay = np.cumsum(gone[:-1]) == 0
            size = np.where(stay, ends - starts + 1, 0)
            place = X.starts_of(size)
            blob = np.full(place[-1], 0x20, np.uint8)
            blob[X.ranges(place[:-1][stay], (size - 1)[stay])] = text[X.ranges(starts[stay], (size - 1)[stay])]
            bodies = [blob[a : max(a, b - 1)] for a, b in zip(place[first[:-1]].tolist(), place[first[1:]].tolist(), strict=True)]
            made = {"doc_id": batch.column("doc_id").slice(lo, hi - lo)}
            made |= {c: pa.array([r[k] for r in best], pa.int64()) for k, c in enumerate(("n_runs", "start", "length", "period", "exponent_milli"))}
            made |= {"runs_sha256": pa.array(digests, pa.string()), "collapsed_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in bodies], pa.string())}
            if with_text:
                made["runs"] = pa.array(lists, pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")])))
                made["collapsed"] = pa.array([x.tobytes().decode("utf-8", "replace") for x in bodies], pa.string())
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def periodic_runs(docs: DataFrame, length: int = LENGTH, times: int = TIMES, with_text: bool = True, plant: bool = False) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_runs, the run of greatest exponent (start, length, period, exponent_milli; null without
    runs), runs_sha256, collapsed_sha256 and, with_text, runs and collapsed: the words without those that repeat a run's first period.

    A run is a stretch of words with smallest period q, at least ``length`` words and ``times`` periods long, that no neighbouring word
    prolongs. Null text has no words and counts as empty; texts are read whole, however long, one text in one task; rows come out as
    they go in, repeated ones too; an empty table gives an empty one. plant: texts are first changed as :func:`planted` says, but those
    of a null id. Columns other than doc_id and text, whatever their names, are not read.
    """
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, {OUT}" + f", {SPANS}" * with_text
    return bounded(docs).select("doc_id", "text").mapInArrow(lambda it: _rows(it, length, times, plant, with_text), schema)
