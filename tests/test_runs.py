"""Builds, ingests, guarded generations and files: failures stay with their handler, runs can be repeated."""

import random

from pyspark.sql import functions as F

from loomspark.jobs.build import Registry, build
from loomspark.operators import repofiles
from loomspark.operators.documents import pdf_rows
from loomspark.sources.readers import read_comment_styles
from loomspark.streaming.ingest import ingest_batch


def texts(pages):
    return pages.select(F.col("url").alias("source"), F.upper("html").alias("text"))


def chats(pages):
    return pdf_rows(pages.select("url", F.col("html").alias("markdown"), F.col("html").cast("binary").alias("content")), "read")


def planned_badly(pages):
    raise RuntimeError("no plan")


def runs_badly(pages):
    return pages.select(F.col("url").alias("source"), F.raise_error(F.lit("bad page")).cast("string").alias("text"))


HANDLERS = {"org/t": texts, "org/c": chats, "org/p": planned_badly, "org/r": runs_badly, "org/none": lambda p: texts(p).filter("false")}


def test_a_handler_fails_alone(spark):
    registry = Registry()
    for prefix, f in HANDLERS.items():
        registry.register(prefix, f, prefix[4:])
    pages = spark.createDataFrame([(f"https://{p}.org/{i}", f"{p}{i}") for p in ("t", "c", "p", "r", "none", "else") for i in range(3)] + [("https://t.org/0", "t0")], "url string, html string")
    built = build(pages, spark.createDataFrame([("https://t.org/2",)], "source string"), registry)
    rows = {(r.kind, r.source, r.text, r.messages[1].text.text if r.messages else None, (r.error or "").split(":")[0]) for r in built.outputs.collect()}
    want = {("text", f"https://t.org/{i}", f"T{i}", None, "") for i in range(2)}
    want |= {("text", f"https://c.org/{i}", f"c{i}", None, "") for i in range(3)} | {("chat", f"https://c.org/{i}", None, f"c{i}", "") for i in range(3)}
    assert rows == want | {("text", f"https://{p}.org/{i}", None, None, f"handler {p} failed") for p in "pr" for i in range(3)}
    assert built.outputs.count() == len(rows)
    status = {r.url: r.status for r in built.outcomes.collect()}
    assert status == {f"https://{p}.org/{i}": s for p, s in {"t": "processed", "c": "processed", "p": "failed", "r": "failed", "none": "processed", "else": "skipped"}.items() for i in range(3) if (p, i) != ("t", 2)}
    assert (built.counts["t"]["rows"], built.counts["c"]["rows"], built.counts["none"]["rows"]) == (2, 6, 0)
    assert "no plan" in built.counts["p"]["failed"] and built.counts["r"]["failed"] and built.counts["t"]["failed"] is None
    empty = build(pages.limit(0), pages.select(F.col("url").alias("source")).limit(0), registry)
    assert empty.outputs.count() == empty.outcomes.count() == 0
    assert build(pages, pages.select(F.col("url").alias("source")).limit(0), Registry()).outcomes.filter("status = 'skipped'").count() == 18


def test_a_batch_can_be_run_again(spark, tmp_path):
    registry = spark.createDataFrame([("org/t", "t"), ("org/c", "c")], "prefix string, handler string")
    at = [f"{tmp_path}/{k}" for k in ("ledger", "text")]
    rest = {"chat_path": f"{tmp_path}/chat", "failed_path": f"{tmp_path}/failed"}
    pages = spark.createDataFrame([("https://t.org/1", "second", 2), ("https://t.org/1", "first", 1), ("https://c.org/1", "c", 3), ("https://t.org/2", None, 4)], "url string, html string, pos long")

    def read(name, *columns):
        return sorted(tuple(r) for r in spark.read.parquet(f"{tmp_path}/{name}").select(*columns).collect())

    for _ in range(2):
        ingest_batch(pages, registry, {"t": texts, "c": planned_badly}, *at, 0, **rest)
        assert read("ledger", "source", "batch") == [("https://t.org/1", 0), ("https://t.org/2", 0)]
        assert [r for r in read("text", "source", "text") if r[1]] == [("https://t.org/1", "FIRST")] and [r[0] for r in read("failed", "source")] == ["https://c.org/1"]
    for _ in range(2):
        ingest_batch(pages, registry, {"t": texts, "c": chats}, *at, 1, **rest)
        assert read("ledger", "source", "batch") == [("https://c.org/1", 1), ("https://t.org/1", 0), ("https://t.org/2", 0)]
        assert read("chat", "source") == [("https://c.org/1",)] and len(read("text", "source")) == 3


def test_guard_over_many_batches(spark, tmp_path):
    """Lists that were cut, long outputs, both dialects: the finds are those of one batch."""
    from loomspark.streaming.repetition import repetition_guard

    r = random.Random(4)
    rows = []
    for g in range(6):
        seq = 0
        for _ in range(120):
            rows.append((f"g{g}", seq, "".join(r.choice("abcdefghij ") for _ in range(400)), None))
            seq += 1
        if g % 2:
            rows += [(f"g{g}", seq + i, "and once more, again and again. "[: 20 + g], None) for i in range(60)]
    rows += [("f", i, None, "deep thought ") for i in range(90)] + [("h", i, "x" * 100 if i > 5 else "", "why? " if i <= 5 else None) for i in range(30)]
    found = {}
    for name, parts, dialect in (("one", 1, "fields"), ("many", 9, "fields"), ("tags", 5, "tags")):
        for k in range(parts):
            part = [x for x in rows if (x[1] * parts // 181) == k or k == parts - 1 and x[1] >= 181]
            spark.createDataFrame(part, "gen_id string, seq long, token string, reasoning string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/{name}")
        stream = spark.readStream.schema("gen_id string, seq long, token string, reasoning string").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/{name}")
        q = repetition_guard(stream, timeout=None, dialect=dialect).writeStream.format("memory").queryName(f"guard_{name}").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/{name}_state").start()
        assert q.awaitTermination(200)
        found[name] = {x.gen_id: (x.verdict, x.pos, x.window) for x in spark.sql(f"select * from guard_{name}").collect()}
    assert found["one"] == found["many"] and set(found["one"]) == {"g1", "g3", "g5", "f", "h"} and found["one"]["f"][0] == "thinking"
    assert found["tags"] == {k: v for k, v in found["one"].items() if k[0] == "g"} | {"h": ("response", 29, "x" * 30)}


def test_file_tree_opens_what_is_asked_for(spark, tmp_path):
    from loomspark.sources.readers import read_file_tree

    for i in range(200):
        (tmp_path / f"{i}.{'py' if i % 2 else 'bin'}").write_bytes(b"x" * i)
    closed = tmp_path / "deep"
    closed.mkdir()
    (closed / "_a.py").write_bytes(b"y" * 5000)
    tree = read_file_tree(spark, f"file://{tmp_path}", ways=5)
    assert tree.rdd.getNumPartitions() == 10 and tree.count() == 201
    spread = [len(x) for x in tree.select("path").rdd.glom().collect()]
    assert sum(n > 0 for n in spread) >= 5  # one flat folder is many tasks
    some = tree.filter(F.endswith("path", F.lit(".py")) & (F.col("size") < 100))
    assert {r.path for r in some.collect()} == {f"{i}.py" for i in range(1, 100, 2)}
    assert "EndsWith" not in some._jdf.queryExecution().executedPlan().toString().split("BatchScan")[0]  # judged by the source
    assert read_file_tree(spark, str(tmp_path), listing=True).columns == ["path", "size"]


def test_media_are_written_once(spark, tmp_path):
    import os

    from loomspark.sources import sinks

    one = spark.createDataFrame([(b"GIF89a",), (b"GIF89a",), (b"?",), (None,)], "content binary")
    two = spark.createDataFrame([(b"?",), (b"new",), (b"",)], "content binary")
    for blobs in (one, two, two):
        sinks.write_media(blobs, f"{tmp_path}/rows")
        sinks.write_media_files(blobs, f"{tmp_path}/files")
    assert sorted(bytes(r.content) for r in spark.read.parquet(f"{tmp_path}/rows").collect()) == [b"", b"?", b"GIF89a", b"new"]
    files = {os.path.join(d, n): open(os.path.join(d, n), "rb").read() for d, _, names in os.walk(f"{tmp_path}/files") for n in names}
    assert sorted(files.values()) == [b"", b"?", b"GIF89a", b"new"] and not any(".stage" in x for x in os.listdir(f"{tmp_path}/files"))
    assert all(__import__("hashlib").sha256(v).hexdigest() in k for k, v in files.items())


def test_an_aborted_media_task_leaves_nothing(tmp_path):
    import os

    from pyspark.sql import Row

    from loomspark.sources.sinks import _MediaWriter

    def rows():
        yield Row(hash="h", ext="bin", media_type="other_media", content=b"whole")
        raise RuntimeError("executor lost")

    writer = _MediaWriter(str(tmp_path))
    try:
        writer.write(rows())
    except RuntimeError:
        writer.abort([None])
    assert [n for _, _, names in os.walk(tmp_path) for n in names] == ["h.bin"]
    assert (tmp_path / "other_media" / "h.bin").read_bytes() == b"whole" and os.listdir(tmp_path) == ["other_media"]


def test_ledger_runs_at_once(spark, tmp_path):
    from concurrent.futures import ThreadPoolExecutor

    from loomspark.sources import sinks

    outputs = spark.createDataFrame([("a",), ("b",), ("b",)], "source string")
    none = outputs.limit(0)
    with ThreadPoolExecutor(2) as pool:
        list(pool.map(lambda run: sinks.write_ledger(outputs, none, f"{tmp_path}/l", run), ["r1", "r2"]))
    sinks.write_ledger(outputs, none, f"{tmp_path}/l", "r2")
    assert sorted(r.source for r in sinks.ledger_sources(spark, f"{tmp_path}/l").collect()) == ["a", "b"]
    assert spark.read.parquet(f"{tmp_path}/l").count() == 4  # the repeated run replaced its own folder
    assert sinks.ledger_sources(spark, f"{tmp_path}/none").count() == 0


def test_cuts():
    import numpy as np

    from loomspark.sources.shards import cuts

    r = random.Random(3)
    for _ in range(500):
        sizes, target, held = [r.choice([0, 1, 5, 30, 300]) for _ in range(r.randint(0, 40))], r.randint(1, 60), r.choice([0, 0, 7, 55])
        want, full, rows = [], held, bool(held)
        for i, s in enumerate(sizes):
            if rows and full + s > target:
                want.append(i)
                full = 0
            full, rows = full + s, True
        assert cuts(np.array(sizes, np.int64), held, target) == want


def test_shards_are_bounded_and_numbered(spark, tmp_path):
    import glob
    import os

    import pyarrow.parquet as pq

    from loomspark.sources import shards, sinks

    rows = spark.range(3000).selectExpr("case when id % 1000 = 7 then repeat('y', 300000) when id % 50 = 3 then null else repeat('x', cast(id % 400 as int)) end text", "cast(id as string) source", "true ai_enhanced")
    for run in range(2):
        sinks.write_text(rows.repartition(3), f"{tmp_path}/t", "now", target=20_000)
        files = sorted(glob.glob(f"{tmp_path}/t/*.parquet"))
        assert [os.path.basename(f) for f in files] == [f"{i + 1:05d}.parquet" for i in range(len(files))]
        for f in files:
            t = [x for x in pq.read_table(f)["text"].to_pylist()]
            assert sum(len(x or "") for x in t) <= 20_000 or len(t) == 1
        assert spark.read.parquet(f"{tmp_path}/t").count() == 3000 * (run + 1)
        assert not glob.glob(f"{tmp_path}/t/.stage*")
    bad = rows.withColumn("text", F.when(F.col("source") == "2999", F.raise_error(F.lit("late"))).otherwise(F.col("text")))
    try:
        sinks.write_text(bad, f"{tmp_path}/t", "now", target=20_000)
        raise AssertionError("the write should fail")
    except Exception as e:
        assert "late" in str(e)
    assert sorted(glob.glob(f"{tmp_path}/t/*.parquet")) == files and not glob.glob(f"{tmp_path}/t/.stage*")
    # a move that was cut short is ended by the next run
    stage = f"{tmp_path}/t/.stage-lost"
    os.mkdir(stage)
    os.replace(files[-1], f"{stage}/a.parquet")
    with open(f"{tmp_path}/t/_shards/lost.json", "w") as f:
        f.write('{"stage": "%s", "moves": [["%s/a.parquet", "%s", 1, 1]]}' % (stage, stage, files[-1]))
    shards.shard_by_size(sinks.text_rows(rows.limit(1), "now"), f"file://{tmp_path}/t", "text")
    assert len(glob.glob(f"{tmp_path}/t/*.parquet")) == len(files) + 1 and not os.path.exists(stage)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 6001


def test_comment_marks(spark, tmp_path):
    """Every mark that is built in, by one file each; a table of marks comes before these and may be odd."""
    paths, want = [], {}
    for marks, pattern in ((repofiles.SUFFIXES, "d/file{}"), (repofiles.NAMES, "d/{}")):
        for mark, keys in marks.items():
            for key in keys.split():
                paths.append(pattern.format(key))
                want[paths[-1]] = mark
    assert len(set(paths)) == len(paths)
    want |= {"d/x.unheard": (None, "# <!--", "-->"), "": (None, "# <!--", "-->"), "d/README": want["d/readme"], "d/A.PY": want["d/file.py"]}
    odd = [(p,) for p in want] + [(None,), ("d/A.PY",)]
    files = spark.createDataFrame(odd, "path string")
    styled = repofiles.comment_style(files)
    got = styled.collect()
    assert len(got) == len(odd)
    assert {r.path: (r.line, r.open, r.close) for r in got} == {**want, None: (None, "# <!--", "-->")}
    assert "Join" not in styled._jdf.queryExecution().toString()

    (tmp_path / "marks.json").write_text('{"key": ".UNHEARD", "line": "@@"}\n{"key": ".py", "open": "(*"}\n{"key": ".py", "open": "(*", "close": "*)"}\n{"key": ".c"}\n{"line": "#"}\n{}\n')
    table = read_comment_styles(spark, str(tmp_path))
    assert {tuple(r) for r in table.collect()} == {(".unheard", "@@", None, None), (".py", None, "(*", "")}
    given = {r.path: (r.line, r.open, r.close) for r in repofiles.comment_style(files, suffixes=table).collect()}
    assert given == {**want, None: (None, "# <!--", "-->"), "d/x.unheard": ("@@", None, None), "d/A.PY": (None, "(*", ""), "d/file.py": (None, "(*", "")}
    assert repofiles.comment_style(files.limit(0), suffixes=table, names=table.limit(0)).count() == 0


def test_build_counts_pages_that_share_a_url(spark, tmp_path):
    import duckdb

    import __spark_entry__

    url = "https://tionsh.example.net/blog/en/1"
    rows = [(3, url, "x"), (4, url, "<article>a</article>"), (5, url, "none"), (8, url + "#top", None), (7, "https://else.org/", "x"), (10, None, "x")]
    rows += [(11, "https://else.org/", "x"), (6, "https://else.org/", "x")]
    spark.createDataFrame(rows, "page_id long, url string, html string").coalesce(1).write.parquet(f"{tmp_path}/pages.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW pages AS SELECT * FROM read_parquet('{tmp_path}/pages.parquet/*.parquet')")
    want = dict(con.execute(__spark_entry__.oracle_sql()["corpus_build"]).fetchall())
    assert want == {"processed": 1, "failed": 2, "skipped": 2}
    assert {r.status: r.n for r in __spark_entry__.queries()["corpus_build"](spark, str(tmp_path)).collect()} == want
