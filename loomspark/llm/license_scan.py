"""Licence scan: matching statistics against a generalised suffix automaton of template tokens, chained into covered spans.

The automaton is built from the templates, so its size does not depend on the corpus. Texts are tokenised in bulk; only runs of
words that occur in some template are streamed through it, since any other word breaks every match.
"""

from __future__ import annotations

import bisect
import dataclasses
import functools
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded
from loomspark.llm.license_texts import BASE, TEMPLATES

#: Words of a match that a chain may be built on (fewer for shorter templates).
SEED = 4
#: Words of the text that may stand between two matches of a chain.
GAP = 12
#: Share of a template that a span has to cover.
COVER = 0.6

_CLASS = np.zeros(256, np.uint8)
_CLASS[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = [*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]
_CLASS[range(0x41, 0x5B)] = range(0x61, 0x7B)


def folded(data: np.ndarray) -> np.ndarray:
    """A-Z lower-cased, every byte that is not part of a word replaced by a space."""
    out = _CLASS[data]
    out[out == 0] = 0x20
    return out


def words(text: str) -> list[str]:
    return re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text))


class Automaton:
    """Suffix automaton of several token sequences. ends[state] gives, for each sequence, where the state's words first end."""

    def __init__(self, sequences: Sequence[Sequence[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        self.ends: list[dict[int, int]] = [{}]
        for k, sequence in enumerate(sequences):
            last = 0
            for at, token in enumerate(sequence):
                last = self._extend(last, token)
                self.ends[last].setdefault(k, at)
        for state in sorted(range(1, len(self.next)), key=lambda s: -self.length[s]):  # a state's ends hold for its suffixes
            up = self.ends[self.link[state]]
            for k, at in self.ends[state].items():
                up[k] = min(at, up.get(k, at))

    def places(self, sequences: Sequence[Sequence[int]], least: int) -> dict[int, dict[int, list[int]]]:
        """For each state of at least ``least`` words and each sequence, every place where the state's words end."""
        out: dict[int, dict[int, list[int]]] = {}
        for k, sequence in enumerate(sequences):
            state = 0
            for at, token in enumerate(sequence):
                state = up = self.next[state][token]
                while up > 0 and self.length[up] >= least:
                    out.setdefault(up, {}).setdefault(k, []).append(at)
                    up = self.link[up]
        return out

    def _extend(self, last: int, token: int) -> int:
        if token in self.next[last]:
            to = self.next[last][token]
            return to if self.length[to] == self.length[last] + 1 else self._clone(last, token, to)
        new = self._state(self.length[last] + 1)
        p = last
        while p >= 0 and token not in self.next[p]:
            self.next[p][token] = new
            p = self.link[p]
        if p < 0:
            self.link[new] = 0
        else:
            to = self.next[p][token]
            self.link[new] = to if self.length[to] == self.length[p] + 1 else self._clone(p, token, to)
        return new

    def _state(self, length: int) -> int:
        self.next.append({})
        self.link.append(0)
        self.length.append(length)
        self.ends.append({})
        return len(self.next) - 1

    def _clone(self, p: int, token: int, to: int) -> int:
        clone = self._state(self.length[p] + 1)
        self.next[clone] = dict(self.next[to])
        self.link[clone] = self.link[to]
        self.ends[clone] = dict(self.ends[to])
        self.link[to] = clone
        while p >= 0 and self.next[p].get(token) == to:
            self.next[p][token] = clone
            p = self.link[p]
        return clone

    def matches(self, tokens: Sequence[int]) -> Iterator[tuple[int, int, int]]:
        """(end, length, state) of every match that cannot be extended to the right."""
        state = length = 0
        for at, token in enumerate(tokens):
            if token not in self.next[state]:
                if length:
                    yield at, length, state
                while state and token not in self.next[state]:
                    state = self.link[state]
                    length = self.length[state]
            if token in self.next[state]:
                state, length = self.next[state][token], length + 1
        if length:
            yield len(tokens), length, state


@dataclasses.dataclass
class Scanner:
    """Templates, base phrases and the automaton of both; made once on the driver."""

    templates: Sequence[tuple[str, str]]
    base: dict[str, str]
    seed: int = SEED
    gap: int = GAP
    cover: float = COVER

    def __post_init__(self):
        sequences = [words(x) for _, x in self.templates]
        phrases = {label: words(x) for label, x in self.base.items()}
        self.vocabulary = sorted({w for s in [*sequences, *phrases.values()] for w in s})
        number = {w: i for i, w in enumerate(self.vocabulary)}
        self.sequences = [[number[w] for w in s] for s in sequences]
        self.phrases = {label: [number[w] for w in s] for label, s in phrases.items()}
        self.least = min([self.seed, *map(len, self.sequences)])
        self.automaton = Automaton(self.sequences)
        self.places = self.automaton.places(self.sequences, self.least)
        blob = np.frombuffer(" ".join(self.vocabulary).encode() + b" ", np.uint8)
        prints = X.words_of(blob, np.array([0, len(blob)]))[0]
        self.order = np.argsort(prints)
        self.prints = prints[self.order]

    def numbers(self, prints: np.ndarray) -> np.ndarray:
        """Numbers of words in the vocabulary, -1 for others."""
        at = np.minimum(np.searchsorted(self.prints, prints), len(self.prints) - 1)
        return np.where(self.prints[at] == prints, self.order[at], -1)

    def spans(self, tokens: Sequence[int]) -> list[tuple[int, int, int, float]]:
        """(template, first word, end, share covered) in a run of known words' numbers, -1 between such runs.

        A span within a span of which more words agree is left out: a notice that is part of a whole licence, a licence that is
        another one less a paragraph.
        """
        hits: dict[int, list[tuple[int, int, list[int]]]] = {}
        for end, length, state in self.automaton.matches(tokens):
            if length < self.least:
                continue
            for k, at in self.places[state].items():
                if length >= min(self.seed, len(self.sequences[k])):
                    hits.setdefault(k, []).append((end - length, end, at))
        spans = []
        for k, found in hits.items():
            for chain in self._chains(found, len(self.sequences[k])):
                covered = np.zeros(len(self.sequences[k]), bool)
                for a, b, to in chain:
                    covered[to - (b - a) : to] = True
                if covered.mean() >= self.cover:
                    spans.append((k, chain[0][0], chain[-1][1], float(covered.mean()), int(covered.sum())))
        spans.sort(key=lambda x: (-x[4], -x[3], x[0]))
        kept: list[tuple] = []
        for x in spans:
            if not any(y[1] <= x[1] and x[2] <= y[2] for y in kept):
                kept.append(x)
        return sorted(x[:4] for x in kept)

    def _chains(self, found: list[tuple[int, int, list[int]]], size: int) -> Iterator[list[tuple[int, int, int]]]:
        """Matches near each other that follow the template's order, as (first word, end, end in the template).

        Of several places in the template a match takes the one nearest to where the chain would go on. A match that only points
        back begins a new chain; a short one that does is a phrase of a long template, and is passed over.
        """
        chain: list[tuple[int, int, int]] = []
        for start, end, places in found:
            far = bool(chain) and start - chain[-1][1] > self.gap
            ahead = places[bisect.bisect_left(places, chain[-1][2]) :] if chain and not far else []
            if chain and not far and not ahead and end - start < 2 * self.seed < size // 2:
                continue
            if chain and not ahead:
                yield chain
                chain = []
            if ahead:
                there = chain[-1][2] + end - chain[-1][1] - 1
                near = bisect.bisect_left(ahead, there)
                at = min(ahead[max(0, near - 1) : near + 1], key=lambda x: abs(x - there))
            else:
                at = places[0]
            chain.append((start, end, at + 1))
        if chain:
            yield chain


@functools.lru_cache(maxsize=1)
def standard() -> Scanner:
    return Scanner(TEMPLATES, BASE)


_SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("covered", pa.float64())])


def _scan(batches: Iterator[pa.RecordBatch], scanner: Scanner) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        data, offsets = X.flat(batch.column("text"))
        for lo, hi in X.slices(offsets, 2 * X.PIECE):
            prints, _, _, first = X.words_of(folded(data[offsets[lo] : offsets[hi]]), offsets[lo : hi + 1] - offsets[lo])
            token = scanner.numbers(prints)
            row = np.repeat(np.arange(hi - lo), np.diff(first))
            n, low, high = np.zeros(hi - lo, np.int64), np.full(hi - lo, -1), np.full(hi - lo, -1)
            labels: list[set] = [set() for _ in range(hi - lo)]
            base: list[set] = [set() for _ in range(hi - lo)]
            score = np.zeros(hi - lo)
            spans: list[list] = [[] for _ in range(hi - lo)]
            for label, phrase in scanner.phrases.items():
                m = len(token) - len(phrase) + 1
                at = np.flatnonzero(np.all([token[i : i + m] == x for i, x in enumerate(phrase)], 0) & (row[:m] == row[len(phrase) - 1 :])) if m > 0 else []
                for p in at:
                    i, w = row[p], p - first[row[p]]
                    n[i] += 1
                    low[i] = w if low[i] < 0 else min(low[i], w)
                    high[i] = max(high[i], w)
                    base[i].add(label)
                    score[i] = 1
            # runs of words of the vocabulary that can hold a match; runs of one text within the gap are streamed together
            known = np.r_[False, token >= 0, False]
            edge = np.r_[True, row[1:] != row[:-1], True] if len(row) else np.zeros(1, bool)
            start = np.flatnonzero(known[1:-1] & (~known[:-2] | edge[:-1]))
            stop = np.flatnonzero(known[1:-1] & (~known[2:] | edge[1:])) + 1
            keep = stop - start >= scanner.least
            start, stop = start[keep], stop[keep]
            far = np.r_[True, (start[1:] - stop[:-1] > scanner.gap) | (row[start[1:]] != row[start[:-1]])] if len(start) else np.zeros(0, bool)
            group = np.flatnonzero(far)
            for a, b in zip(start[group], np.r_[stop[group[1:] - 1], stop[-1:]] if len(group) else [], strict=True):
                i = row[a]
                for k, s, e, share in scanner.spans(token[a:b].tolist()):
                    label = scanner.templates[k][0]
                    labels[i].add(label)
                    score[i] = max(score[i], share)
                    spans[i].append({"label": label, "first": int(a + s - first[i]), "last": int(a + e - 1 - first[i]), "covered": share})
            made = {
                "doc_id": batch.column("doc_id").slice(lo, hi - lo),
                "n_words": pa.array(np.diff(first)),
                "n_base": pa.array(n),
                "first_word": pa.array(low, mask=low < 0),
                "last_word": pa.array(high, mask=high < 0),
                "base_labels": pa.array([",".join(sorted(x)) for x in base], pa.string()),
                "labels": pa.array([",".join(sorted(x | y)) for x, y in zip(base, labels, strict=True)], pa.string()),
                "score": pa.array(score),
                "spans": pa.array(spans, pa.list_(_SPAN)),
            }
            yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def license_scan(docs: DataFrame, scanner: Scanner | None = None) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Base phrases are found as they stand; labels adds those of templates of which a span covers enough; spans lists these, in
    words from 0; score is the largest share covered, 1 with a base phrase. first_word and last_word are where the first and the last
    base phrase start. Null text has no words; texts without a find have empty labels, null places and score 0. Rows are judged
    alone on their whole text, however long, so repeated rows, ties and null ids change nothing. Only doc_id and text are read; other
    columns, whatever their names, do not come along. Empty gives empty.
    """
    scanner = scanner or standard()
    shared = docs.sparkSession.sparkContext.broadcast(scanner)
    schema = f"doc_id {dict(docs.dtypes)['doc_id']}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans array<struct<label:string,first:long,last:long,covered:double>>"
    return bounded(docs).select("doc_id", "text").mapInArrow(lambda it: _scan(it, shared.value), schema)
