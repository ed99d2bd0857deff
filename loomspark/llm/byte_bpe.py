"""Byte-level BPE by a finite-state transducer, and its streaming inverse.

Text is cut by the vocabulary's pattern; each piece is encoded on its own. What follows from the merges is compiled into two
tables: a trie of the tokens' bytes, and which token may follow which (two tokens stand side by side in an encoding just when the
merges of their joined bytes end in these two). Of the bytes read so far exactly one sequence of tokens obeys that at every seam, so
the nondeterministic machine that guesses where tokens end has one guess for each place that a token still being read may have begun
at. Determinised, a state is the list of these guesses: place in the trie, last token, tokens not yet emitted. States and moves are
made when they are first met and kept (:class:`Transducer`). A token leaves as soon as all guesses share it, which takes at most as
many further bytes as the longest token has.

Ids are decoded as a stream: bytes come from one table, and :class:`Utf8Stream`, an automaton over bytes, holds back what is not a
whole character yet.
"""

from __future__ import annotations

import array
import base64
import functools
import gc
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import public_tokenizers
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.llm import textnum as X
from loomspark.llm.common import bounded

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Moves of the automaton, pairs of tokens and pieces of text that a worker keeps; beyond it starts anew, with the same results.
MOVES, PAIRS, PIECES = 500_000, 500_000, 500_000
#: Characters of a text above which its pieces are taken in runs of this number instead of all at once.
LONG, RUN = 1 << 20, 1 << 16
_NEVER = 1 << 40


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, f)}


class Transducer:
    """Pieces of text to tokens. ranks: bytes to id; of two neighbours those merge first whose joined bytes have the least id."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("a byte-level vocabulary has a token for every byte")
        self.ranks = ranks
        self.words = {i: word for word, i in ranks.items()}
        self.next: dict[int, int] = {}
        self.token = [-1]
        inner = {0}
        for word, i in ranks.items():
            node = 0
            for b in word:
                inner.add(node)
                step = node << 8 | b
                node = self.next.get(step, -1)
                if node < 0:
                    node = self.next[step] = len(self.token)
                    self.token.append(-1)
            self.token[node] = i
        self.inner = inner
        self.pairs: dict[tuple[int, int], bool] = {}
        self._restart()

    def _restart(self) -> None:
        start = ((0, -1, ()),)
        self.states: list[tuple] = [start]
        self.number = {start: 0}
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}

    def merged(self, word: bytes) -> list[int]:
        """The merges themselves, on a few bytes: what the tables are compiled from."""
        parts, rank = [word[i : i + 1] for i in range(len(word))], self.ranks.get
        pairs = [rank(word[i : i + 2], _NEVER) for i in range(len(word) - 1)]
        while pairs and (best := min(pairs)) < _NEVER:
            i = pairs.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del pairs[i]
            if i:
                pairs[i - 1] = rank(parts[i - 1] + parts[i], _NEVER)
            if i < len(pairs):
                pairs[i] = rank(parts[i] + parts[i + 1], _NEVER)
        return [self.ranks[p] for p in parts]

    def may_follow(self, one: int, two: int) -> bool:
        """Whether token two stands behind token one in encodings; one -1: at the start."""
        known = self.pairs.get((one, two))
        if known is None:
            if len(self.pairs) >= PAIRS:
                self.pairs.clear()
            ahead = [] if one < 0 else [one]
            known = self.pairs[one, two] = self.merged(b"".join(self.words[t] for t in (*ahead, two))) == [*ahead, two]
        return known

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        """The state behind a byte, and the tokens that leave on the way."""
        guesses, ended, step, inner = [], None, self.next, self.inner
        for node, last, held in self.states[state]:
            node = step.get(node << 8 | byte)
            if node is None:
                continue
            if ended is None and (token := self.token[node]) >= 0 and self.may_follow(last, token):
                ended = (0, token, (*held, token))
            if node in inner:
                guesses.append((node, last, held))
        if ended is None:
            raise ValueError("no token of this vocabulary can end here")
        shared = ended[2]
        for _, _, held in guesses:
            n, most = 0, min(len(held), len(shared))
            while n < most and held[n] == shared[n]:
                n += 1
            shared = shared[:n]
        guesses.append(ended)
        cut = len(shared)
        key = tuple([(node, last, held[cut:]) for node, last, held in guesses] if cut else guesses)
        to = self.number.get(key)
        if to is None:
            to = self.number[key] = len(self.states)
            self.states.append(key)
        made = self.moves[state << 8 | byte] = (to, shared)
        return made

    def encode(self, piece: bytes) -> list[int]:
        whole = self.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state, known = 0, self.moves
        for byte in piece:
            move = known.get(state << 8 | byte)
            if move is None:
                if len(known) >= MOVES:
                    here = self.states[state]
                    self._restart()
                    known = self.moves
                    if here not in self.number:
                        self.number[here] = len(self.states)
                        self.states.append(here)
                    state = self.number[here]
                move = self._move(state, byte)
            state, left = move
            if left:
                out += left
        out += self.states[state][-1][2]
        return out


class _Pieces(dict):
    """Piece of text -> its place in a table of encodings, made when it is first asked for."""

    def __init__(self, machine: Transducer):
        super().__init__()
        self.machine, self.ids, self.sizes = machine, array.array("I"), array.array("q")

    def __missing__(self, piece: str) -> int:
        got = self.machine.encode(piece.encode())
        self.ids.extend(got)
        self.sizes.append(len(got))
        self[piece] = n = len(self)
        return n


class Encoder:
    def __init__(self, path: str, pattern: str):
        self.machine, self.find = Transducer(ranks_of(path)), regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.pieces = _Pieces(self.machine)
        self.table = (np.zeros(0, np.uint32), np.zeros(1, np.int64))

    def _ids(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of some pieces, and how many each has."""
        at = np.fromiter(map(self.pieces.__getitem__, pieces), np.int64, len(pieces))
        if len(self.table[1]) <= len(self.pieces):
            self.table = (np.array(self.pieces.ids, np.uint32), X.starts_of(np.array(self.pieces.sizes, np.int64)))
        flat, first = self.table
        sizes = first[at + 1] - first[at]
        return flat[X.ranges(first[at], sizes)], sizes

    def encode(self, text: str) -> np.ndarray:
        """Ids of a text as unsigned 32-bit integers."""
        if len(self.pieces) > PIECES:
            self._forget()
        if len(text) <= LONG:
            return self._ids(self.find.findall(text))[0]
        found, out = (m[0] for m in self.find.finditer(text)), []
        while run := list(itertools.islice(found, RUN)):
            out.append(self._ids(run)[0])
            if len(self.pieces) > PIECES:
                self._forget()
        return np.concatenate(out)

    def encode_all(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Ids of several texts, one behind the other, and where each begins."""
        if sum(map(len, texts)) > LONG:
            each = [self.encode(t) for t in texts]
            return (np.concatenate(each) if each else np.zeros(0, np.uint32)), X.starts_of(np.array([len(x) for x in each], np.int64))
        if len(self.pieces) > PIECES:
            self._forget()
        cut = [self.find.findall(t) for t in texts]
        ids, sizes = self._ids(list(itertools.chain.from_iterable(cut)))
        return ids, X.starts_of(sizes)[X.starts_of(np.array([len(c) for c in cut], np.int64))]


def _automaton() -> np.ndarray:
    """State x byte -> state of UTF-8. 0: between characters; 1, 2, 3: so many more bytes; 4 to 7: behind E0, ED, F0, F4, whose second byte
    has a smaller range; 8: not UTF-8."""
    t = np.full((9, 256), 8, np.int8)
    t[0, :0x80] = 0
    t[0, 0xC2:0xE0], t[0, 0xE1:0xF0], t[0, 0xF1:0xF4] = 1, 2, 3
    t[0, [0xE0, 0xED, 0xF0, 0xF4]] = 4, 5, 6, 7
    for state in (1, 2, 3):
        t[state, 0x80:0xC0] = state - 1
    t[4, 0xA0:0xC0], t[5, 0x80:0xA0], t[6, 0x90:0xC0], t[7, 0x80:0x90] = 1, 1, 2, 2
    return t


UTF8 = _automaton().tolist()


class Utf8Stream:
    """Text of a stream of bytes, however it is cut. What can still become a character is held back; what can't is U+FFFD."""

    def __init__(self) -> None:
        self.held = b""

    def feed(self, data: bytes) -> str:
        data = self.held + data
        cut = len(data)
        for back in range(1, min(4, cut + 1)):  # the automaton is at 0 before any byte that is no continuation
            if data[-back] & 0xC0 != 0x80:
                state = 0
                for b in data[-back:]:
                    state = UTF8[state][b]
                if 0 < state < 8:
                    cut -= back
                break
        self.held = data[cut:]
        return data[:cut].decode("utf-8", "replace")

    def end(self) -> str:
        rest, self.held = self.held, b""
        return rest.decode("utf-8", "replace")


@functools.lru_cache(maxsize=2)
def encoder(path: str, pattern: str) -> Encoder:
    return Encoder(path, pattern)


@functools.lru_cache(maxsize=2)
def _bytes(path: str) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all tokens one behind the other, and where each id's begin; none for ids that are no token."""
    ranks = ranks_of(path)
    words = [b""] * (max(ranks.values()) + 1)
    for word, i in ranks.items():
        words[i] = word
    return np.frombuffer(b"".join(words), np.uint8), X.starts_of(np.array([len(w) for w in words], np.int64))


def _sha256(data: np.ndarray, first: np.ndarray) -> pa.Array:
    view = memoryview(np.ascontiguousarray(data).view(np.uint8))
    return pa.array([hashlib.sha256(view[a:b]).hexdigest() for a, b in itertools.pairwise(first.tolist())], pa.string())


def _encoded(batches: Iterator[pa.RecordBatch], path: str, pattern: str) -> Iterator[pa.RecordBatch]:
    machine = encoder(path, pattern)
    gc.disable()  # the tables hold a million small tuples, none in a cycle, that each collection would look through
    try:
        for batch in batches:
            data, offsets = X.flat(batch.column("text"))
            for lo, hi in X.slices(offsets, X.PIECE // 2):
                texts = [data[a:b].tobytes().decode("utf-8", "replace") for a, b in itertools.pairwise(offsets[lo : hi + 1].tolist())]
                ids, first = machine.encode_all(texts)
                lists = pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(ids.view(np.int32)))
                columns = [batch.column("doc_id").slice(lo, hi - lo), pa.array(np.diff(first)), _sha256(ids.astype("<u4"), 4 * first), lists]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "n_tokens", "ids_sha256", "ids"])
    finally:
        gc.enable()


def encode(docs: DataFrame, path: str | None = None, pattern: str = public_tokenizers.PATTERN) -> DataFrame:
    """Per row of docs (doc_id, text): doc_id, n_tokens, ids_sha256 (of the ids as little-endian unsigned 32-bit integers), ids array<int>.

    path: ranks, a line for each token, its bytes in base64 and its id; the file is on every node. Names of special tokens are ordinary
    text. Null and empty texts have no tokens; texts are read whole, however long; rows, repeated ones and null ids too, come out as
    they go in, and an empty table gives an empty one. Columns other than doc_id and text, whatever their names, are not read.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    rows = bounded(docs).select("doc_id", "text")
    return rows.mapInArrow(lambda it: _encoded(it, path, pattern), f"doc_id {dict(docs.dtypes)['doc_id']}, n_tokens long, ids_sha256 string, ids array<int>")


def _decoded(batches: Iterator[pa.RecordBatch], path: str, keep: list[str], with_text: bool) -> Iterator[pa.RecordBatch]:
    words, first = _bytes(path)
    for batch in batches:
        lists = batch.column("ids")
        if lists.null_count:
            lists = lists.fill_null([])
        at = lists.offsets.to_numpy().astype(np.int64)
        ids = lists.values.to_numpy(zero_copy_only=False).view(np.int32).astype(np.int64) if len(lists.values) else np.zeros(0, np.int64)
        digests, chars, texts = [], [], []
        for a, b in itertools.pairwise(at.tolist()):
            digest, stream, n, parts = hashlib.sha256(), Utf8Stream(), 0, []
            for k in range(a, b, RUN):
                some = ids[k : min(b, k + RUN)]
                if some.min() < 0 or some.max() >= len(first) - 1:
                    raise ValueError("an id that is not in the vocabulary")
                data = words[X.ranges(first[some], first[some + 1] - first[some])].tobytes()
                digest.update(data)
                text = stream.feed(data)
                n += len(text)
                parts.append(text)
            rest = stream.end()
            digests.append(digest.hexdigest())
            chars.append(n + len(rest))
            if with_text:
                texts.append("".join(parts) + rest)
        made = {c: batch.column(c) for c in keep} | {"decoded_sha256": pa.array(digests, pa.string()), "n_chars": pa.array(chars, pa.int64())}
        if with_text:
            made["text"] = pa.array(texts, pa.string())
        yield pa.RecordBatch.from_arrays(list(made.values()), list(made))


def decode(tokens: DataFrame, path: str | None = None, with_text: bool = True) -> DataFrame:
    """Rows with ids array<int> -> the other columns, decoded_sha256 (of the bytes), n_chars and, with_text, text.

    Bytes that are no UTF-8 become U+FFFD in the text, and count as such. Null ids are an empty text. An id that is not in the
    vocabulary is an error. Other columns are kept, but for those named as the new ones.
    """
    path = path or public_tokenizers.path(VOCABULARY)
    made = ["decoded_sha256", "n_chars", *["text"] * with_text]
    keep = [c for c in tokens.columns if c not in ("ids", *made)]
    kinds = dict(tokens.dtypes)
    schema = ", ".join([*(f"`{c}` {kinds[c]}" for c in keep), "decoded_sha256 string, n_chars long", *["text string"] * with_text])
    return bounded(tokens).select(*(F.col(f"`{c}`") for c in keep), "ids").mapInArrow(lambda it: _decoded(it, path, keep, with_text), schema)
