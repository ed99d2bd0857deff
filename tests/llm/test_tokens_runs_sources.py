"""Byte-level BPE, periodic runs, source divergence: against the library, plain loops and plain counting."""

import collections
import hashlib
import random
import re
import zlib

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from loomspark.llm import byte_bpe, divergence, periodic_runs
from loomspark.llm import textnum as X
from tests.llm.data import SCHEMA, WORD, frame, rows

PATH = public_tokenizers.path(byte_bpe.VOCABULARY)
ODD = [(900, "'s 'T it's    x\t\n  \n", "en", "a"), (901, "😀é日本́ ½² ǅ\x1c\x85 z", "en", "a"), (902, " " * 3000 + "\n" * 50, "en", "a"), (903, "a" * 5000, "en", "a"), (904, "<|endoftext|> <unk>", "fr", "a")]


@pytest.fixture(scope="module")
def library():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=byte_bpe.ranks_of(PATH), special_tokens={})


def test_encode_and_decode(spark, library):
    data = rows() + ODD
    ids = byte_bpe.encode(frame(spark, data))
    got = byte_bpe.decode(ids).collect()
    assert len(got) == len(data)
    for r, (i, text, *_) in zip(got, data, strict=True):  # one narrow stage keeps the order
        want = library.encode_ordinary(text or "")
        assert (r.doc_id, r.n_tokens, r.text, r.n_chars) == (i, len(want), text or "", len(text or ""))
        assert r.ids_sha256 == hashlib.sha256(np.array(want, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert [r.ids for r in ids.select("ids").collect()] == [library.encode_ordinary(t or "") for _, t, *_ in data]
    empty = spark.createDataFrame([], SCHEMA)
    assert byte_bpe.decode(byte_bpe.encode(empty)).count() == 0
    kept = byte_bpe.decode(spark.createDataFrame([(1, None, "x"), (2, [], "y")], "k int, ids array<int>, text string"))
    assert sorted((r.k, r.text, r.n_chars) for r in kept.collect()) == [(1, "", 0), (2, "", 0)]


def test_transducer_is_the_merges(library):
    machine = byte_bpe.Transducer(byte_bpe.ranks_of(PATH))
    r, words = random.Random(1), list(machine.ranks)
    for k in range(6000):
        piece = b"".join(r.choice(words) for _ in range(r.randint(1, 4))) if k % 2 else bytes(r.choice(b"\xc3\xa9\xe4\xb8\x80aab ") for _ in range(r.randint(1, 30)))
        assert machine.encode(piece) == library._core_bpe.encode_single_piece(piece)
    tiny = byte_bpe.Transducer({bytes([b]): b for b in range(256)} | {b"aa": 256, b"ab": 257, b"aab": 258, b"aaaa": 259, b"ba": 260})
    for k in range(1, 1 << 11):
        piece = bin(k)[2:].replace("0", "a").replace("1", "b").encode()
        whole = machine.ranks and tiny.ranks.get(piece)
        assert tiny.encode(piece) == ([whole] if whole is not None else tiny.merged(piece))


def test_few_states_change_nothing(library, monkeypatch):
    """Tables that are thrown away again and again give the same ids, in one long text and in many short ones."""
    for name, value in (("MOVES", 40), ("PAIRS", 30), ("PIECES", 25), ("LONG", 500), ("RUN", 7)):
        monkeypatch.setattr(byte_bpe, name, value)
    machine = byte_bpe.Encoder(PATH, public_tokenizers.PATTERN)
    texts = [t or "" for _, t, *_ in rows()]
    for text in texts:
        assert machine.encode(text).tolist() == library.encode_ordinary(text)
    ids, first = machine.encode_all(texts)
    assert [ids[a:b].tolist() for a, b in zip(first, first[1:], strict=False)] == [library.encode_ordinary(t) for t in texts]


def test_long_text_and_word(spark, library):
    r = random.Random(4)
    long = " ".join("".join(r.choice("abcdefgé") for _ in range(r.randint(1, 9))) for _ in range(300_000)) + " " + "xyz" * 20_000
    got = byte_bpe.decode(byte_bpe.encode(spark.createDataFrame([(1, long)], "doc_id int, text string")), with_text=False).first()
    assert got.ids_sha256 == hashlib.sha256(np.array(library.encode_ordinary(long), "<u4").tobytes()).hexdigest()
    assert (got.n_chars, got.decoded_sha256) == (len(long), hashlib.sha256(long.encode()).hexdigest())


def test_stream_of_utf8():
    r = random.Random(2)
    for _ in range(3000):
        data = b"".join(r.choice([b"a", "é".encode(), "日".encode(), "😀".encode(), b"\xff", b"\xe6", b"\xf0\x9f", b"\x80", b"\xed\xa0\x80", b"\xc0\xaf"]) for _ in range(r.randint(0, 12)))
        stream, out, at = byte_bpe.Utf8Stream(), "", 0
        while at < len(data):
            step = r.randint(1, 4)
            out += stream.feed(data[at : at + step])
            at += step
        assert out + stream.end() == data.decode("utf-8", "replace")


def plain_runs(w, length, times):
    out = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j + q - i >= max(length, times * q):
                out.setdefault((i, j + q), q)
            i = j + 1
    return sorted(((s, e - s, q) for (s, e), q in out.items()), key=lambda x: (x[0], x[2]))


def wordy(r):
    letters = r.choice([1, 2, 2, 3, 5, 300])
    w = [r.randrange(letters) for _ in range(r.randint(0, 60))]
    for _ in range(r.randint(0, 4)):
        unit = [r.randrange(letters) for _ in range(r.randint(1, 14))]
        w += unit * r.randint(2, 9) + unit[: r.randint(0, len(unit))]
        if r.random() < 0.4:
            w += w[r.randrange(len(w)) :]
        w += [r.randrange(letters) for _ in range(r.choice([0, 0, 5]))]
    return w


def test_runs_of_random_words():
    r = random.Random(3)
    for _ in range(150):
        each = [wordy(r) for _ in range(r.randint(1, 5))]
        for length, times in ((24, 3), (6, 3), (4, 2)):
            got = periodic_runs.all_runs(np.array(sum(each, []), np.int64), X.starts_of(np.array([len(x) for x in each])), length, times)
            for i, w in enumerate(each):
                assert got.get(i, []) == plain_runs(w, length, times)


def test_suffixes_and_factors():
    r = random.Random(6)
    for _ in range(60):
        each = [wordy(r)[:120] for _ in range(3)]
        flat, first = sum(each, []), X.starts_of(np.array([len(x) for x in each]))
        order, ranks = periodic_runs.suffix_order(np.array(flat, np.int64), first)
        lcp = periodic_runs.common_lengths(order, ranks, first)
        longest, source = periodic_runs.previous_factors(order, lcp)
        assert order.tolist() == sorted(range(len(flat)), key=lambda i: (np.searchsorted(first, i, "right"), flat[i : first[np.searchsorted(first, i, "right")]]))
        for k, w in enumerate(each):
            for i in range(len(w)):
                shared = [next((n for n in range(len(w) - i) if w[i + n] != w[j + n]), len(w) - i) for j in range(i)]
                at = first[k] + i
                assert longest[at] == max(shared, default=0)
                assert not longest[at] or shared[source[at] - first[k]] == longest[at]


def answer(doc_id, text, plant):
    w = WORD.findall(text or "")
    h = zlib.crc32(str(doc_id).encode())
    if plant and doc_id is not None and h % 10 == 0 and w:
        g, n = h // 10, len(w)
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
    found = plain_runs(w, 24, 3)
    best = min(found, key=lambda x: (-x[1] / x[2], x[0], x[2]), default=(None, None, None))
    gone = {i for s, n, q in found for i in range(s + q, s + n)}
    kept = " ".join(x for i, x in enumerate(w) if i not in gone)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    return (doc_id, len(found), *best, None if best[0] is None else 1000 * best[1] // best[2], sha("".join(f"{s},{n},{q}\n" for s, n, q in found)), sha(kept)), found, kept


def test_runs_of_documents(spark):
    data = rows() + [(300, "a b c " * 9 + "x " * 40 + "a b c " * 9, "en", "a"), (301, ("w " * 23 + "v ") * 5, "en", "a"), (302, "u " * 23, "en", "a"), (303, "u " * 24, "en", "a"), (304, "ab" * 300_000 + " ", "en", "a")]
    for plant in (False, True):
        got = periodic_runs.periodic_runs(frame(spark, data), plant=plant).collect()
        assert len(got) == len(data)
        for r, (i, text, *_) in zip(got, data, strict=True):
            want, found, kept = answer(i, text, plant)
            assert (r.doc_id, r.n_runs, r.start, r.length, r.period, r.exponent_milli, r.runs_sha256, r.collapsed_sha256) == want
            assert [tuple(x) for x in r.runs] == found and r.collapsed == kept
    assert any(r.n_runs for r in got)
    assert periodic_runs.periodic_runs(spark.createDataFrame([], SCHEMA)).count() == 0


def test_runs_of_a_long_text(spark):
    r = random.Random(8)
    text = " ".join(["one", *(["two three four"] * 60_000), "five", *(f"w{r.randrange(90)}" for _ in range(60_000)), *(["six"] * 30_000)])
    got = periodic_runs.periodic_runs(spark.createDataFrame([(7, text)], "doc_id int, text string"), with_text=False).first()
    assert (got.n_runs, got.start, got.length, got.period, got.exponent_milli) == (2, 1, 180_000, 3, 60_000_000)


def counted(data, least=divergence.LEAST):
    letters = re.compile(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")
    low = str.maketrans({chr(c): chr(c + 32) for c in range(65, 91)})
    n, docs, groups = collections.Counter(), collections.Counter(), set()
    for _, text, lang, source in data:
        lang, source = lang or "", source or ""
        groups.add((lang, source))
        terms = letters.findall((text or "").translate(low))
        for t in terms:
            n[lang, source, t] += 1
        for t in set(terms):
            docs[lang, t] += 1
    out = set()
    for lang in {g[0] for g in groups}:
        kept = sorted(t for (x, t), k in docs.items() if x == lang and k >= least)
        sources = sorted(s for x, s in groups if x == lang)
        total = {s: sum(n[lang, s, t] for t in kept) for s in sources}
        share = lambda c, whole: 1 + 1_000_000_000 * (c + 2) // (whole + 2 * len(kept))
        p = {s: [share(n[lang, s, t], total[s]) for t in kept] for s in sources}
        q = [share(sum(n[lang, s, t] for s in sources), sum(total.values())) for t in kept]
        far = lambda a, b: (a - b) ** 2 // (a + b)
        for s in sources:
            pairs = sorted((-sum(map(far, p[s], p[o])), o) for o in sources if o != s)
            out |= {(lang, s, "pair", o, -v, i + 1) for i, (v, o) in enumerate(pairs)}
            terms = sorted((-far(a, b), t) for t, a, b in zip(kept, p[s], q, strict=True) if n[lang, s, t] and a > b)[:10]
            out |= {(lang, s, "term", t, -v, i + 1) for i, (v, t) in enumerate(terms)}
    return out


def spread_sources():
    r, data = random.Random(9), rows()
    words = [d[1] for d in data if d[1]]
    data = data + [(i, r.choice(words), r.choice(["en", "fr"]), r.choice(["a", "b", "c", "d\x00", "d", "É", "z"])) for i in range(500, 620)]
    return data + [(700, "NEWS Ünï été Été", "de", "only"), (701, "!!! 123", "en", "none"), (702, None, "it", None), (703, "x" * 1_200_000, "en", "a")]


@pytest.mark.parametrize("tile", [256, 2])
def test_divergence(spark, monkeypatch, tile):
    monkeypatch.setattr(divergence, "SOURCES", tile)
    monkeypatch.setattr(divergence, "TERMS", 40)
    monkeypatch.setattr(divergence, "WIDTH", 16)
    data = spread_sources()
    got = [tuple(r) for r in divergence.divergence(frame(spark, data)).select("lang", "source", "part", "item", "value", "rank").collect()]
    assert len(got) == len(set(got)) and set(got) == counted(data)
    assert divergence.divergence(spark.createDataFrame([], SCHEMA)).count() == 0


def test_terms_of_one_hash_are_told_apart(monkeypatch):
    monkeypatch.setattr(divergence.xxhash, "xxh3_64_intdigest", lambda x: len(x) % 2)
    data = np.frombuffer(b"ab cd ab e f abcd cd ef e", np.uint8)
    starts, ends, _ = X.word_spans(data, np.array([0, len(data)]))
    group, head = divergence._groups(data, starts, ends)
    words = [data[a:b].tobytes() for a, b in zip(starts, ends, strict=True)]
    assert [words[head[g]] for g in group] == words and len(set(group.tolist())) == len(set(words))


def test_shares_are_exact():
    r = random.Random(5)
    count = [r.randrange(1 << r.randint(1, 52)) for _ in range(2000)]
    total = [c + r.randrange(1, 1 << r.randint(1, 52)) for c in count]
    assert divergence.shares(np.array(count), np.array(total)).tolist() == [1 + 1_000_000_000 * c // t for c, t in zip(count, total, strict=True)]
