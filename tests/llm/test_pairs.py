"""Jaccard join, embedding links, components, archives, the pipeline's stages."""

import collections
import gzip
import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from loomspark.llm import embedding_dedup, graph, hnsw, jaccard_join, mixing, warc
from loomspark.llm.common import shared_dir, sieve
from tests.llm.data import SCHEMA, WORD, frame, key, rows
from tests.llm.test_repeats import by_bytes


def flood(nodes, links):
    found = {}
    for i in sorted(nodes, key=key):
        if i not in found:
            stack, found[i] = [i], i
            while stack:
                for j in links[stack.pop()]:
                    if j not in found:
                        found[j] = i
                        stack.append(j)
    return found


def grams(text, n=5):
    w = WORD.findall(text or "")
    return frozenset(tuple(w[i : i + n]) for i in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


@pytest.mark.parametrize("small", [False, True])
def test_jaccard(spark, monkeypatch, small):
    if small:  # every bucket and component in blocks
        monkeypatch.setattr(jaccard_join, "BUCKET", 2)
        monkeypatch.setattr(jaccard_join, "BLOCK", 3)
    r = random.Random(9)
    base = [f"w{r.randrange(500)}" for _ in range(120)]
    data = rows()[:-1]  # without the repeated row
    for i in range(30):  # a chain of edits around the threshold
        base = list(base)
        base[r.randrange(len(base))] = f"e{i}"
        data.append((600 + i, " ".join(base), None, None))
    sets = {i: grams(t) for i, t, *_ in data}
    links = collections.defaultdict(set)
    for i, x in sets.items():
        for j, y in sets.items():
            if i != j and x and y and 5 * len(x & y) >= 4 * len(x | y):
                links[i].add(j)
    component = flood(sets, links)
    got = {r.doc_id: (r.n_links, r.component_id, r.kept) for r in jaccard_join.jaccard_join(frame(spark, data)).collect()}
    assert got == {i: (len(links[i]), component[i], component[i] == i) for i in sets}


def test_jaccard_buckets_meet_across_files(spark, monkeypatch, tmp_path):
    """Near-duplicates in different files, each read by a task of its own, where the counts of buckets are broadcast and the rows are not."""
    r = random.Random(12)
    data = []
    for i in range(200):
        words = [f"w{r.randrange(5000)}" for _ in range(120)]
        data += [(i, " ".join(words), None, None), (1000 + i, " ".join([*words, f"x{i}"]), None, None)]
    path = str(tmp_path / "reps")
    for part in (data[::2], data[1::2]):
        docs = frame(spark, part).coalesce(1).selectExpr("doc_id d", "text")
        docs.mapInArrow(lambda it: jaccard_join._signatures(it, 5), "d long, set_a long, set_b long, n int, bands array<long>, sketch binary").write.mode("append").parquet(path)
    reps = spark.read.parquet(path)
    assert reps.select(F.spark_partition_id()).distinct().count() == 2
    join = type(reps).join
    monkeypatch.setattr(type(reps), "join", lambda self, other, *on: join(self, F.broadcast(other), *on))
    edges = {(min(e), max(e)) for e in jaccard_join._candidates(reps, 0.8, 1e-6).collect()}
    sets = {i: grams(t) for i, t, *_ in data}
    assert edges >= {(i, j) for i in sets for j in sets if i < j and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} >= {(i, 1000 + i) for i in range(200)}


def moved(spark):
    """Bytes that the session has shuffled."""
    scala = spark.sparkContext._jsc.sc()
    scala.listenerBus().waitUntilEmpty(30_000)
    return scala.statusStore().executorSummary("driver").totalShuffleWrite()


def test_jaccard_sends_what_candidates_need(spark):
    """Texts without a candidate, and sketches for each of their bands, are not shuffled, whether or not the other side is small."""
    r = random.Random(14)
    data = [(i, " ".join(f"w{r.randrange(10**6)}" for _ in range(1200)), None, None) for i in range(600)]
    data += [(1000 + i, f"{data[i][1]} x{i}", None, None) for i in range(20)]
    docs, sent = frame(spark, data), []
    try:
        for most in ("-1", "10m"):
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", most)
            before = moved(spark)
            got = {r.doc_id: (r.n_links, r.component_id) for r in jaccard_join.jaccard_join(docs).collect()}
            sent.append(moved(spark) - before)
            assert got == {i: (1, i % 1000) if i % 1000 < 20 else (0, i) for i, *_ in data}
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert max(sent) < sum(len(t) for _, t, *_ in data) / 2, sent
    assert sent[0] < 1.5 * sent[1], sent


def test_sieve_keeps_every_row_that_matches(spark):
    for n in (0, 1, 5000):
        ids = spark.range(-n, n, 2).selectExpr("id d")
        got = [r.d for r in sieve(spark.range(-50_000, 50_000).selectExpr("id d", "'x' bits"), ids, "d").select("d").collect()]
        want = set(range(-n, n, 2))
        assert want <= set(got) and len(set(got)) == len(got) and len(got) - len(want) <= 0.04 * 100_000
    assert sieve(spark.createDataFrame([(1, "a"), (1, "b"), (2, "c")], "d long, t string"), spark.range(1, 2).selectExpr("id d"), "d").count() >= 2


def test_jaccard_edges(spark):
    assert jaccard_join.jaccard_join(spark.createDataFrame([], SCHEMA)).count() == 0
    twice = jaccard_join.jaccard_join(frame(spark, [rows()[0]] * 2)).collect()
    assert [(r.doc_id, r.n_links, r.kept) for r in twice] == [(0, 0, True)] * 2


def test_pruning_keeps_what_may_reach_the_threshold():
    least = jaccard_join.least_matches(0.8, 1e-6)
    assert list(least) == sorted(least) and least[16] < 0.8 * 16 and least[64] < 0.8 * 64
    r = np.random.default_rng(0)
    x = r.integers(0, 256, (4000, 64), dtype=np.uint8)
    y = np.where(r.random(x.shape) < 0.8, x, r.integers(0, 256, x.shape, dtype=np.uint8))
    assert len(jaccard_join._survivors(x, y, least)) == 4000
    z = np.where(r.random(x.shape) < 0.3, x, r.integers(0, 256, x.shape, dtype=np.uint8))
    assert len(jaccard_join._survivors(x, z, least)) < 40


def test_components(spark):
    r = random.Random(4)
    edges = [(r.randrange(300), r.randrange(300)) for _ in range(200)] + [(i, i + 1) for i in range(1000, 1080)] + [(2000, 2000 + i) for i in range(90)] + [(7, 7)]
    links = collections.defaultdict(set)
    for a, b in edges:
        if a != b:
            links[a].add(b)
            links[b].add(a)
    got = {r.node: r.component for r in graph.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == flood(links, links)
    assert graph.components(spark.createDataFrame([], "a long, b long")).count() == 0


def vectors(n=400, dim=16):
    r = np.random.default_rng(6)
    centres = r.normal(size=(25, dim))
    v = [(centres[i % 25] + 0.12 * r.normal(size=dim)).tolist() for i in range(n)]
    v += [v[0], v[0], [3 * x for x in v[1]]] + [(centres[0] + 0.01 * r.normal(size=dim)).tolist() for _ in range(150)]
    out = [(i, x) for i, x in enumerate(v)]
    odd = [None, [0.0] * dim, [float("nan")] + [1.0] * (dim - 1), [float("inf")] * dim, [None] + [1.0] * (dim - 1), [], [1.0, 2.0], [2.0, 4.0]]
    return out + [(1000 + i, x) for i, x in enumerate(odd)] + [(None, v[2])]


def test_embeddings(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 200)
    monkeypatch.setattr(embedding_dedup, "SHARDS", 3)
    data = vectors()
    df = spark.createDataFrame(data, "vec_id long, embedding array<double>").withColumns({"label": F.lit(1), "d": F.lit("x"), "node": F.lit(0)})
    got = {r.vec_id: r for r in embedding_dedup.embedding_dedup(df).collect()}
    assert len(got) == len(data)
    good = {i: np.array(x, float) for i, x in data if x and None not in x and np.isfinite(np.array(x, float)).all() and any(x)}
    unit = {i: x / np.linalg.norm(x) for i, x in good.items()}
    links = collections.defaultdict(set)
    for i, x in unit.items():
        for j, y in unit.items():
            if i != j and len(x) == len(y) and x @ y >= 0.95:
                links[i].add(j)
    true = sum(map(len, links.values()))
    assert all(r.n_links <= len(links[i]) for i, r in got.items())
    assert sum(r.n_links for r in got.values()) >= 0.97 * true
    component = flood([i for i, _ in data], links)
    assert sum(got[i].component_id == c for i, c in component.items()) >= 0.97 * len(data)
    assert all(got[i].n_links == 0 and got[i].kept for i in range(1000, 1006))
    assert got[1006].n_links == 1 and got[1007].component_id == 1006
    assert embedding_dedup.embedding_dedup(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_small_world_recall():
    r = np.random.default_rng(8)
    v = r.normal(size=(3000, 24)).astype(np.float32)
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    level = np.sort(hnsw.levels(np.maximum(r.random(3000), 1e-9)))[::-1]
    g = hnsw.build(v, level)
    ids, _ = g.search(v[:200], 64)
    true = np.argsort(-(v[:200] @ v.T), axis=1)[:, :10]
    assert np.mean([len(set(a) & set(b)) for a, b in zip(ids, true)]) >= 9


def test_archives(spark):
    big, other = "<p>" + "é" * 900 + "</p>", "<i>" + "y" * 2000
    data = [(1, "http://a/x y", big), (2, "http://b", big), (3, "http://c", big), (4, None, "small"), (5, "http://d", "small"), (6, "http://e", None), (7, "http://f", ""), (8, "http://g", other), (None, "http://h", other), (9, "http://i", "WARC/1.0\r\n\r\nx" + "\r\n" * 700)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({"type": F.lit("x"), "record_id": F.lit(1)})
    got = warc.convert_pages(df).collect()
    assert len(got) == len(data)
    lead = {hashlib.sha1(big.encode()).hexdigest(): 3, hashlib.sha1(other.encode()).hexdigest(): 8}
    for r in got:
        html = next((h or "" for i, _, h in data if i == r.page_id)).encode()
        digest = hashlib.sha1(html).hexdigest()
        assert (r.payload_bytes, r.payload_digest) == (len(html), digest)
        again = lead.get(digest) not in (None, r.page_id)
        assert (r.record_type, r.refers_to) == (("revisit", lead[digest]) if again else ("response", None))
    assert warc.convert_pages(df.limit(0)).count() == 0


def test_arc_versions():
    v1 = b"filedesc://a.arc 0.0.0.0 20080101120000 text/plain 76\n1 0 InternetArchive\nURL IP-address Archive-date Content-type Archive-length\n\n"
    v1 = v1.replace(b" 76\n", b" %d\n" % len(v1.split(b"\n", 1)[1][:-1]))
    body = b"HTTP/1.0 200 OK\r\nX-Page-Id: 5\r\n\r\nhi\nthere"
    v1 += b"http://x/a b 1.2.3.4 20080101120001 text/html %d\n" % len(body) + body + b"\n"
    v1 += b"dns:x 1.2.3.4 200801011200 text/dns 3\nabc\n" + b"http://y/ 1.2.3.4 bad no-type 2\n\n\n\n"
    got = list(warc.parse_arc(gzip.compress(v1)))
    assert [(r["uri"], r["payload"], r["type"], r["date"]) for r in got] == [("http://x/a b", b"hi\nthere", "response", "2008-01-01T12:00:01Z"), ("dns:x", b"abc", "response", "2008-01-01T12:00:00Z"), ("http://y/", b"\n\n", "resource", "1970-01-01T00:00:00Z")]
    assert got[0]["page_id"] == 5 and got[0]["http"].endswith(b"\r\n\r\n") and got[2]["content_type"] == "application/octet-stream"
    v2 = b"filedesc://a.arc 0.0.0.0 20080101120000 text/plain 200 - - 0 a.arc 22\n2 0 InternetArchive\nU\n\n"
    v2 += b"http://x/ 1.2.3.4 20080101120001 image/png 200 abc - 9 a.arc 4\n\x00\xff\n1\n"
    assert [(r["uri"], r["payload"], r["content_type"]) for r in warc.parse_arc(v2)] == [("http://x/", b"\x00\xff\n1", "image/png")]
    assert [r["error"] for r in warc.parse_arc(v2[:-4])] == ["truncated"]
    assert [r["type"] for r in warc.parse_arc(b"nonsense\n")] == ["error"] and list(warc.parse_arc(b"")) == []


def test_written_archives_are_well_formed(spark):
    import glob

    path = shared_dir(spark)
    pages = spark.createDataFrame([(i, f"http://h/{i % 7}", ("body %d " % (i % 5)) * 300) for i in range(60)], "page_id long, url string, html string")
    warc.convert(warc.to_arc(pages), path)
    seen = 0
    for name in glob.glob(f"{path}/part-*"):
        content = gzip.decompress(open(name, "rb").read())
        at = 0
        while at < len(content):
            end = content.index(b"\r\n\r\n", at)
            head = dict(x.split(b": ", 1) for x in content[at:end].split(b"\r\n")[1:])
            assert content[at : at + 10] == b"WARC/1.0\r\n" and {b"WARC-Type", b"WARC-Record-ID", b"WARC-Date", b"Content-Length"} <= set(head)
            n = int(head[b"Content-Length"])
            assert content[end + 4 + n : end + 8 + n] == b"\r\n\r\n"
            at = end + 8 + n
            seen += head[b"WARC-Type"] != b"warcinfo"
    assert seen == 60


def test_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert len(names) == 5
    stage = dict(corpus_pipeline.STAGES)
    kept = stage[names[0]](spark, docs, sf)
    assert kept.columns == docs.columns and 0 < kept.count() < docs.count()
    data = [(r.doc_id, r.text) for r in kept.collect()]
    alone = stage[names[1]](spark, kept, sf)
    sets = {i: grams(t) for i, t in data}
    links = {i: {j for j in sets if j != i and sets[i] and sets[j] and 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])} for i in sets}
    assert {r.doc_id for r in alone.collect()} == set(flood(sets, links).values())
    cut = stage[names[2]](spark, kept, sf)
    want = {i: (n - gone) for i, n, gone, _, _ in by_bytes(data)}
    found = {r.doc_id: r for r in cut.collect()}
    assert cut.columns == docs.columns and set(found) == set(want)
    assert all(want[i] - 8 * 3 <= len(r.text.encode()) <= want[i] and r.n_chars == len(r.text) for i, r in found.items())
    mixed = stage[names[3]](spark, cut, sf)
    assert mixed.columns == docs.columns and {r.doc_id for r in mixed.collect()} == set(found)
    assert collections.Counter(r.doc_id for r in mixed.collect()).most_common(1)[0][1] <= mixing.MAX_REPEAT + 1
    packed = stage[names[4]](spark, mixed, sf)
    assert packed.select("sequence_id").distinct().count() <= packed.agg(F.sum("length")).first()[0] / 1024 + 2


def test_stages_take_odd_documents(spark, sf):
    docs = frame(spark).withColumn("n_chars", F.length("text").cast("long"))
    docs = docs.withColumns({c: F.lit("mine") for c in ("epoch", "block", "block_key", "n_tokens", "base_failed", "n_links", "component_id", "row", "carried", "removed", "kept_text")})
    for _, f in corpus_pipeline.STAGES[:-1]:
        got = f(spark, docs, sf)
        assert got.columns == docs.columns and {r.block for r in got.collect()} == {"mine"} == {r.row for r in got.collect()}
    for _, f in corpus_pipeline.STAGES:
        assert f(spark, docs, sf).count() > 0
        assert f(spark, docs.limit(0), sf).count() == 0


def test_large_groups_are_linked_in_bounded_memory():
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(8)
    v = r.normal(size=32) + 0.02 * r.normal(size=(1200, 32))
    table = pa.table({"node": pa.array(range(1200), pa.int64()), "members": pa.array([1] * 1200, pa.int64()), "embedding": pa.array(v.tolist())})
    key = (pa.scalar(32), pa.scalar(0))
    shard = embedding_dedup._build(key, table)
    tracemalloc.start()
    got = embedding_dedup._ask(key, shard, table, 0.95, 32).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert all(x["links"] == 1199 for x in got if x["node"] is not None)
    edges = [(x["a"], x["b"]) for x in got if x["a"] is not None]
    links = collections.defaultdict(set)
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    assert len(edges) == 1199 and set(flood(range(1200), links).values()) == {0}
    print("PEAK", peak)
    assert peak < 150 << 20


def test_queries_stream_past_a_shard_in_bounded_memory():
    """A cluster of 20,000 near vectors, asked in chunks: every link is counted, one forest comes out."""
    import tracemalloc

    import pyarrow as pa

    r = np.random.default_rng(8)
    n = 20_000
    v = (r.normal(size=16) + 0.02 * r.normal(size=(n, 16))).astype(np.float32)
    table = pa.table({"node": pa.array(range(n), pa.int64()), "members": pa.array([1] * n, pa.int64()), "embedding": pa.array(list(v), pa.list_(pa.float32()))})
    shard = embedding_dedup._build((pa.scalar(16), pa.scalar(0)), table.slice(0, n // 4))
    shard = shard.set_column(0, "task", pa.array([7] * len(shard))).select(["task", "pos", "node", "members", "embedding", "links"])
    queries = table.append_column("task", pa.array([7] * n)).append_column("pos", pa.nulls(n, pa.int32())).append_column("links", pa.nulls(n, shard["links"].type)).select(shard.column_names)
    tracemalloc.start()
    got = pa.Table.from_batches(embedding_dedup._answers(iter([*shard.sort_by("pos").to_batches(), *queries.to_batches(max_chunksize=3000)]), 0.95, 32, 4096)).to_pylist()
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    count = {x["node"]: x["links"] for x in got if x["node"] is not None}
    assert all(count[i] == n // 4 - (i < n // 4) for i in range(n))
    links = collections.defaultdict(set)
    edges = [(x["a"], x["b"]) for x in got if x["a"] is not None]
    for a, b in edges:
        links[a].add(b)
        links[b].add(a)
    assert len(edges) == n - 1 and set(flood(range(n), links).values()) == {0}
    audits = [(x["found"], x["true"]) for x in got if x["true"]]
    assert audits and all(f == t > 0 for f, t in audits)
    assert peak < 250 << 20


def test_an_audit_looks_until_it_has_seen_links(spark):
    """Few links: the recall in the output comes from true ones."""
    r = np.random.default_rng(5)
    v = r.normal(size=(3000, 24))
    v[1::20] = v[::20] + 0.001 * r.normal(size=(150, 24))
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<float>")
    got = embedding_dedup.embedding_dedup(df).collect()
    assert {x.audited_recall for x in got} == {1.0}
    assert [x.n_links for x in sorted(got, key=lambda x: x.vec_id)] == [1 if i % 20 < 2 else 0 for i in range(3000)]


def test_embeddings_edges(spark):
    twice = spark.createDataFrame([(1, [1.0, 0.0]), (1, [1.0, 0.0]), (2, [1.0, 0.1]), (3, [0.0, 1.0])], "vec_id long, embedding array<double>")
    twice = twice.withColumns({c: F.lit("x") for c in ("n_links", "kept", "component_id", "dim", "shard", "members", "task", "pos", "links", "real", "k1")})
    got = sorted((x.vec_id, x.n_links, x.component_id, x.kept) for x in embedding_dedup.embedding_dedup(twice).collect())
    assert got == [(1, 2, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 0, 3, True)]
    lone = embedding_dedup.embedding_dedup(twice.filter("vec_id = 3")).collect()
    assert [(x.n_links, x.audited_recall) for x in lone] == [(0, None)]


def test_archive_files_are_bounded_and_records_are_members(spark):
    import glob
    import os
    import zlib

    path = shared_dir(spark)
    bodies = [("%d " % i + "".join(random.Random(i).choices("abcdefgh", k=5000))) for i in range(200)]
    pages = spark.createDataFrame([(i, f"http://h/{i}", b) for i, b in enumerate(bodies)], "page_id long, url string, html string")
    warc.convert(warc.to_arc(pages), path, file_bytes=20_000)
    names = [x for x in glob.glob(f"{path}/part-*") if os.path.getsize(x)]
    assert len(names) > 25
    records = 0
    for name in names:
        content, members = open(name, "rb").read(), []
        assert len(gzip.decompress(content)) < 150_000
        while content:
            one = zlib.decompressobj(31)
            members.append(one.decompress(content))
            assert one.eof
            content = one.unused_data
        assert all(x.startswith(b"WARC/1.0\r\n") and x.count(b"WARC-Type:") == 1 for x in members) and b"warcinfo" in members[0]
        records += len(members) - 1
    assert records == 200
    back = {r.page_id: bytes(r.payload).decode() for r in warc.read_warc(spark, path).collect()}
    assert back == dict(enumerate(bodies))


def test_archives_of_long_and_equal_pages(spark):
    long = "é" * 9_000_000
    data = [(1, "u", long), (2, "v", long), (3, "w", "x" * 1000), (3, "w", "x" * 1000), (2, "y", "x" * 1000), (4, "z", "x" * 999), (5, "z", "x" * 999)]
    df = spark.createDataFrame(data, "page_id long, url string, html string").withColumns({c: F.lit("c") for c in ("content", "path", "payload", "refers_to", "payload_bytes")})
    got = sorted((r.page_id, r.payload_bytes, r.record_type, r.refers_to) for r in warc.convert_pages(df).collect())
    assert got[0] == (1, 18_000_000, "revisit", 2) and (2, 18_000_000, "response", None) in got
    assert [x for x in got if x[1] == 1000] == [(2, 1000, "revisit", 3), (3, 1000, "response", None), (3, 1000, "response", None)]
    assert [x[2] for x in got if x[1] == 999] == ["response"] * 2


def test_a_file_that_breaks_off_is_told():
    content = gzip.compress(b"WARC/1.0\r\nWARC-Type: response\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n" * 50)
    rows = list(warc.parse_warc(content[:-20]))
    assert rows[-1]["type"] == "error" and list(warc.parse_arc(content[:20]))[-1]["type"] == "error"
