import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest

from loomspark.llm import repeats
from loomspark.llm import textnum as X
from loomspark.llm.substring_dedup import substring_dedup
from loomspark.llm.suffix_dedup import suffix_dedup
from tests.llm.data import SCHEMA, WORD, frame, key, rows


def by_bytes(data, length=200):
    texts = [(i, (t or "").encode()) for i, t, *_ in data]
    seen = collections.Counter(b[k : k + length] for _, b in texts for k in range(len(b) - length + 1))
    out = []
    for i, b in texts:
        gone = bytearray(len(b))
        for k in range(len(b) - length + 1):
            if seen[b[k : k + length]] > 1:
                gone[k : k + length] = b"\x01" * length
        kept = bytes(x for x, g in zip(b, gone) if not g)
        out.append((i, len(b), sum(gone), len(re.findall(b"\x01+", bytes(gone))), hashlib.sha256(kept).hexdigest()))
    return out


def by_words(data, length=20):
    seen, out, done = set(), {}, {}
    for i, t, *_ in sorted(data, key=lambda r: key(r[0])):
        if (i, t) in done:  # rows equal in id and text are one document
            continue
        w = WORD.findall(t or "")
        gone = [0] * len(w)
        for k in range(len(w) - length + 1):
            x = tuple(w[k : k + length])
            if x in seen:
                gone[k : k + length] = [1] * length
            seen.add(x)
        done[i, t] = (i, len(w), sum(gone), hashlib.sha256(" ".join(a for a, g in zip(w, gone) if not g).encode()).hexdigest())
    return [done[i, t] for i, t, *_ in data]


def order(found):
    return sorted(map(tuple, found), key=lambda r: (key(r[0]), r[1:]))


@pytest.fixture(params=["usual", "hot anchors cut by place, small sorts"])
def limits(request, monkeypatch):
    if request.param != "usual":
        monkeypatch.setattr(repeats, "HOT", 2)


def test_bytes(spark, limits):
    got = suffix_dedup(frame(spark), with_text=False).collect()
    assert order(got) == order(by_bytes(rows()))


def test_words(spark, limits):
    got = substring_dedup(frame(spark), with_text=False).collect()
    assert order(got) == order(by_words(rows()))


def test_texts_and_spans(spark):
    got = {r.doc_id: r for r in suffix_dedup(frame(spark)).collect()}
    for i, t, *_ in rows():
        r = got[i]
        assert sum(e - s for s, e in r.removed) == r.n_removed and len(r.removed) == r.n_spans
        if not r.n_removed:
            assert r.kept_text == (t or "")
    words = {r.doc_id: r.kept_text for r in substring_dedup(frame(spark)).collect()}
    assert words[100] == "" and words[0] == " ".join(WORD.findall(rows()[0][1]))


def test_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert suffix_dedup(empty).count() == 0 and substring_dedup(empty).count() == 0


def test_windows_that_meet_only_beyond_one_anchor(spark):
    """Passages at every offset of a long text, so that anchors sit at every place of the window."""
    import random

    r = random.Random(1)
    text = "".join(chr(r.randrange(97, 123)) for _ in range(3000))
    data = [(0, text, None, None)] + [(1 + i, "!" * i + text[37 * i : 37 * i + 195 + i % 12] + "?", None, None) for i in range(40)]
    got = suffix_dedup(spark.createDataFrame(data, SCHEMA), with_text=False).collect()
    assert order(got) == order(by_bytes(data))


@pytest.mark.parametrize("unit", ["bytes", "words"])
@pytest.mark.parametrize("sort", [40_000, 20])
def test_hot_anchor_is_bounded(monkeypatch, unit, sort):
    """Many documents share a passage and differ around it: no key of the shuffle holds all of them."""
    import random

    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(repeats, "SORTED", sort)
    spec = repeats.Repeats("bytes", 200, 40, first=False) if unit == "bytes" else repeats.Repeats("words", 20, 5, first=True)
    r = random.Random(5)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(60))
    data = [(i, f"{' '.join(word() for _ in range(40))} {passage} {' '.join(word() for _ in range(40))}", None, None) for i in range(300)]
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in data]), pa.array([0] * len(data)), pa.array([x[1] for x in data]), pa.array([""] * len(data))], ["d", "th", "text", "copy_of"])
    grams = [x["g"] for b in repeats._anchors(spec, iter([batch])) for x in b.to_pylist()]
    often = collections.Counter(g for x in grams for g in set(x))
    hits = pa.array([[{"g": g, "n": 4} for g in set(x) if often[g] > 1] for x in grams], pa.list_(pa.struct([("g", pa.int64()), ("n", pa.int32())])))
    cut = pa.Table.from_batches(repeats._cut(spec, [0], iter([batch.append_column("hits", hits)])))
    keys = collections.Counter(cut.filter(cut["body"].is_valid())["g"].to_pylist())
    found = {i: [] for i, *_ in data}
    for b in repeats._spans(spec, iter(cut.sort_by("g").to_batches(max_chunksize=50))):
        for x in b.to_pylist():
            found[x["d"]].append((x["s"], x["e"]))
    want = {x[0]: x[2] for x in (by_bytes(data) if unit == "bytes" else by_words(data))}
    size = {i: len(t) if unit == "bytes" else len(t.split()) for i, t, *_ in data}
    assert {i: sum(int(b - a) for a, b in repeats.merged(np.array(x), size[i])) if x else 0 for i, x in found.items()} == want
    assert sum(n >= len(data) for n in keys.values()) <= 2  # a cell at each end of the passage, where segments differ
    assert sum(keys.values()) < len(often) * len(data)


@pytest.mark.parametrize("unit", ["bytes", "words"])
def test_an_anchor_that_no_task_can_hold(spark, monkeypatch, unit):
    """Its windows go on by digest and are counted by Spark."""
    import random

    import numpy as np
    import pyarrow as pa

    monkeypatch.setattr(repeats, "SORTED", 16)
    monkeypatch.setattr(repeats, "HELD", 30)
    spec = repeats.Repeats("bytes", 200, 40, first=False) if unit == "bytes" else repeats.Repeats("words", 20, 5, first=True, extend=True)
    r = random.Random(6)
    word = lambda: "".join(r.choice("abcdefghij") for _ in range(6))
    passage = " ".join(word() for _ in range(40))
    data = [(i, f"{' '.join(word() for _ in range(20))} {passage} {' '.join(word() for _ in range(20))}", None, None) for i in range(120)]
    batch = pa.RecordBatch.from_arrays([pa.array([x[0] for x in data]), pa.array([0] * len(data)), pa.array([x[1] for x in data]), pa.array([""] * len(data))], ["d", "th", "text", "copy_of"])
    grams = [x["g"] for b in repeats._anchors(spec, iter([batch])) for x in b.to_pylist()]
    often = collections.Counter(g for x in grams for g in set(x))
    hits = pa.array([[{"g": g, "n": 1} for g in set(x) if often[g] > 1] for x in grams], pa.list_(pa.struct([("g", pa.int64()), ("n", pa.int32())])))
    cut = pa.Table.from_batches(repeats._cut(spec, [0], iter([batch.append_column("hits", hits)])))
    got = pa.Table.from_batches(repeats._spans(spec, iter(cut.sort_by("g").to_batches(max_chunksize=20))))
    windows = got.filter(got["k1"].is_valid())
    assert len(windows) > 1000
    counted = repeats._counted(spec, spark.createDataFrame(windows.to_pandas(), repeats.SPANS)).collect()
    found = {i: [] for i, *_ in data}
    for x in [*got.filter(got["k1"].is_null()).to_pylist(), *(y.asDict() for y in counted)]:
        found[x["d"]].append((x["s"], x["e"]))
    want = {x[0]: x[2] for x in (by_bytes(data) if unit == "bytes" else by_words(data))}
    size = {i: len(t) if unit == "bytes" else len(t.split()) for i, t, *_ in data}
    assert {i: sum(int(b - a) for a, b in repeats.merged(np.array(x), size[i])) if x else 0 for i, x in found.items()} == want


@pytest.mark.parametrize("first", [False, True])
def test_extending_finds_what_sorting_finds(first):
    import numpy as np

    from loomspark.llm import textnum as X

    r = np.random.default_rng(4)
    spec = repeats.Repeats("words", 6, 2, first=first)
    for _ in range(30):
        values = r.integers(0, 2, 400).astype(np.uint64)
        at = r.integers(10, 380, 40)
        least, most = r.integers(0, 3, 40), r.integers(2, 5, 40)
        after = repeats._matrix(values, at, 6 - least, 6, 1)
        before = repeats._matrix(values, at - 1, most, int(most.max()), -1)
        a = repeats.equal_windows(spec, least, most, after, before)
        b = repeats.extended_windows(spec, least, most, after, before, X.Rolling(values, bytes_in=False), at)
        assert (a == b).all()


def test_very_long_texts(spark):
    """One word, one run of blanks, one line of words, a period: a few MB each, among ordinary documents."""
    import random

    r = random.Random(2)
    prose = " ".join("".join(r.choice("abcdefghij") for _ in range(6)) for _ in range(40))
    data = [(0, "x" * 5_000_000), (1, " " * 5_000_000), (2, "ab " * 400_000), (3, prose), (4, f"y {prose} z"), (5, " ".join(str(i) for i in range(400_000)))]
    df = spark.createDataFrame(data, "doc_id long, text string")
    got = {x.doc_id: x for x in suffix_dedup(df, with_text=False).collect()}
    assert [(got[i].n_bytes, got[i].n_removed) for i, _ in data[:3]] == [(5_000_000,) * 2, (5_000_000,) * 2, (1_200_000,) * 2]
    assert got[3].n_removed == len(prose) == got[4].n_removed and got[5].n_removed == 0
    words = {x.doc_id: x for x in substring_dedup(df, with_text=False).collect()}
    assert [(words[i].n_words, words[i].n_removed) for i, _ in data] == [(1, 0), (0, 0), (400_000, 399_999), (40, 0), (42, 40), (400_000, 0)]


def test_clashing_columns(spark):
    extra = {c: repeats.F.lit(c) for c in ("g", "s", "e", "k1", "copy_of", "hits", "part", "n_removed", "kept_sha256", "spans", "lead")}
    for f in (suffix_dedup, substring_dedup):
        a, b = f(frame(spark).withColumns(extra), with_text=False), f(frame(spark).select("doc_id", "text"), with_text=False)
        assert order(a.collect()) == order(b.collect())


def morse(n: int) -> str:
    """Letters a and b by the parity of the ones of a number: sums of powers of a base can't tell them from their complements."""
    return "".join("ab"[i.bit_count() & 1] for i in range(n))


@pytest.mark.parametrize("n", [1024, 4096])
def test_long_words_are_told_apart_by_their_letters(spark, n):
    from loomspark.llm.jaccard_join import exact_shingles, jaccard_join

    one, two = morse(n), morse(n).translate(str.maketrans("ab", "ba"))
    front = " ".join(f"w{i}" for i in range(19))
    texts = [f"{front} {one}", f"{front} {two}", one, two, f"{front} {one}  "]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r for r in substring_dedup(docs).collect()}
    assert [got[i].n_removed for i in range(5)] == [0, 0, 0, 0, 20]
    links = {r.doc_id: r for r in jaccard_join(docs).collect()}
    assert [links[i].n_links for i in range(5)] == [2, 2, 0, 0, 2]  # 15 of 17 grams of the long ones; the words alone are different texts
    prints = X.words_of(np.frombuffer(f"{one} {two}".encode(), np.uint8), np.array([0, 2 * n + 1]))[0]
    assert prints[0] != prints[1]
    grams, first = exact_shingles(*X.flat(pa.array([f"{one} a b", f"{two} a b", "x", "x ", "", None, f"a  b {one} a b c"])), 3)
    sets = [set(grams[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
    assert [len(s) for s in sets] == [1, 1, 1, 1, 0, 0, 4] and not sets[0] & sets[1] and sets[2] == sets[3] and sets[0] < sets[6]


def test_exact_shingles_are_sets_of_words():
    from loomspark.llm.jaccard_join import exact_shingles

    r = random.Random(12)
    for n in (1, 2, 3, 4, 5, 7, 8):
        texts = [" ".join(r.choice("abc") for _ in range(r.randint(0, 40))) for _ in range(12)]
        grams, first = exact_shingles(*X.flat(pa.array(texts)), n)
        sets = [set(grams[a:b].tolist()) for a, b in zip(first, first[1:], strict=False)]
        want = []
        for t in texts:
            w = tuple(t.split())
            want.append({w[i : i + n] for i in range(max(1, len(w) - n + 1))} if w else set())
        assert all(len(x) == len(y) for x, y in zip(sets, want, strict=True))
        assert all(len(sets[i] & sets[j]) == len(want[i] & want[j]) for i in range(12) for j in range(12))
