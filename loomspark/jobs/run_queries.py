"""Registered queries of whole runs: builds, ingests, guarded generations, files written and read again, each over the driver's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.jobs.queries import query
from loomspark.operators import documents, repofiles
from loomspark.session import scratch, table
from loomspark.sources import readers, sinks

_TITLE = r"(?s)<title>(.*?)</title>"
#: Handlers of the hosts of these runs, h0.org and on; h6.org has none.
_NAMES = ["titles", "chats", "silent", "broken", "late", "half"]
_PREFIXES = {f"org/h{i}": name for i, name in enumerate(_NAMES)}
_URL_SQL = "'https://h' || page_id % 7 || '.org/' || page_id"


def _url() -> Column:
    return F.concat(F.lit("https://h"), (F.col("page_id") % 7).cast("string"), F.lit(".org/"), F.col("page_id").cast("string"))


def _titles(pages: DataFrame) -> DataFrame:
    return pages.select(F.col("url").alias("source"), F.regexp_extract("html", _TITLE, 1).alias("text"))


def _chats(pages: DataFrame) -> DataFrame:
    """A text row and a chat row for each page."""
    title = F.regexp_extract("html", _TITLE, 1)
    return documents.pdf_rows(pages.select("url", title.alias("markdown"), title.cast("binary").alias("content")), "Read this.")


def _silent(pages: DataFrame) -> DataFrame:
    return _titles(pages).filter("false")


def _broken(pages: DataFrame) -> DataFrame:
    raise ValueError("no plan")


def _late(pages: DataFrame) -> DataFrame:
    """Fails when it runs, on its first page."""
    return pages.select(F.col("url").alias("source"), F.raise_error(F.lit("no page")).cast("string").alias("text"))


def _half(pages: DataFrame) -> DataFrame:
    """Pages of long urls are errors of their own."""
    bad = F.length("url") % 2 == 1
    return pages.select(F.col("url").alias("source"), F.when(~bad, F.regexp_extract("html", _TITLE, 1)).alias("text"), F.when(bad, "odd").alias("error"))


_HANDLERS = {"titles": _titles, "chats": _chats, "silent": _silent, "broken": _broken, "late": _late, "half": _half}
_BUILT_SQL = f"""WITH g AS (SELECT {_URL_SQL} AS url, {_NAMES!r}[page_id % 7 + 1] AS handler, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS t, length({_URL_SQL}) % 2 = 1 AS odd FROM pages WHERE page_id % 3 > 0)"""


def _built(spark: SparkSession, sf_dir: str):
    """Pages under urls of their own, a quarter of them fetched a second time, a third in the ledger."""
    from loomspark.jobs.build import Registry, build

    rows = table(spark, sf_dir, "pages")
    pages = rows.select(_url().alias("url"), "html", F.col("page_id").alias("pos"))
    again = pages.filter("pos % 4 = 0").select("url", F.lit("<title>fetched again</title>").alias("html"), (F.col("pos") + 1_000_000_000).alias("pos"))
    return build(pages.unionByName(again), rows.filter("page_id % 3 = 0").select(_url().alias("source")), Registry(dict(_PREFIXES), dict(_HANDLERS)))


@query(
    _BUILT_SQL
    + """ SELECT 'text' AS kind, url AS source, t AS text, NULL::VARCHAR AS answer, handler = 'chats' AS ai_enhanced, NULL::VARCHAR AS error FROM g WHERE handler IN ('titles', 'chats') OR handler = 'half' AND NOT odd
UNION ALL SELECT 'chat', url, NULL, t, true, NULL FROM g WHERE handler = 'chats' UNION ALL SELECT 'text', url, NULL, NULL, false, 'odd' FROM g WHERE handler = 'half' AND odd
UNION ALL SELECT 'text', url, NULL, NULL, false, 'handler ' || handler || ' failed' FROM g WHERE handler IN ('broken', 'late')"""
)
def corpus_build_rows(spark, sf_dir):
    """All output rows of a build with six handlers, of which one fails when it is planned and one when it runs."""
    rows = _built(spark, sf_dir).outputs
    return rows.select("kind", "source", "text", F.col("messages")[1]["text"]["text"].alias("answer"), "ai_enhanced", F.substring_index("error", ":", 1).alias("error"))


@query(
    _BUILT_SQL
    + """ SELECT url, CASE WHEN handler IS NULL THEN 'skipped' WHEN handler IN ('broken', 'late') OR handler = 'half' AND odd THEN 'failed' ELSE 'processed' END AS status FROM g"""
)
def corpus_build_outcomes(spark, sf_dir):
    return _built(spark, sf_dir).outcomes


_INGESTED_SQL = f"""WITH g AS (SELECT {_URL_SQL} AS url, CASE WHEN page_id % 7 < 2 THEN 'site' ELSE 'host' END AS handler, page_id, regexp_extract(html, '<title>(.*?)</title>', 1, 's') AS t FROM pages WHERE page_id % 7 < 4)
SELECT 'text' AS kind, CASE WHEN page_id % 2 = 0 AND handler <> 'host' THEN 0 ELSE 1 END::BIGINT AS batch, url AS source, t AS text FROM g WHERE page_id % 2 = 1 OR handler <> 'host' OR page_id % 4 = 0
UNION ALL SELECT 'chat', 1, url, t FROM g WHERE handler = 'host' AND (page_id % 2 = 1 OR page_id % 4 = 0)
UNION ALL SELECT 'failed', 0, url, 'handler host failed' FROM g WHERE handler = 'host' AND page_id % 2 = 0
UNION ALL SELECT 'ledger', CASE WHEN page_id % 2 = 0 AND handler <> 'host' THEN 0 ELSE 1 END, url, NULL FROM g WHERE page_id % 2 = 1 OR handler <> 'host' OR page_id % 4 = 0"""


@query(_INGESTED_SQL)
def incremental_ingest(spark, sf_dir):
    """Two runs of a stream over pages as they come in. In the first the handler of hosts fails; in the second every fourth url comes again,
    twice, so those that failed are taken up with their first row and the others are not. All four tables, with their batches."""
    from loomspark.streaming.ingest import incremental_ingest as ingest

    root = scratch(spark)
    pages = table(spark, sf_dir, "pages").select(_url().alias("url"), "html", F.col("page_id").alias("pos"))
    registry = spark.createDataFrame([("org/h0", "site"), ("org/h1", "site"), ("org/h2", "host"), ("org/h3", "host")], "prefix string, handler string")
    schema, at = "url string, html string, pos long", {k: f"{root}/{k}" for k in ("in", "ledger", "text", "chat", "failed", "state")}
    later = [pages.filter("pos % 4 = 0").select("url", F.lit("<title>again</title>").alias("html"), (F.col("pos") + k * 1_000_000_000).alias("pos")) for k in (1, 2)]
    first = pages.filter("pos % 4 = 0").select("url", "html", F.col("pos"))
    drops = [(pages.filter("pos % 2 = 0"), _broken), (pages.filter("pos % 2 = 1").unionByName(first).unionByName(later[0]).unionByName(later[1]), _chats)]
    for rows, host in drops:
        rows.write.mode("append").parquet(at["in"])
        stream = spark.readStream.schema(schema).parquet(at["in"])
        handlers = {"site": _titles, "host": host}
        ingest(stream, registry, handlers, at["ledger"], at["text"], at["state"], at["chat"], at["failed"]).awaitTermination()
    answer = F.get_json_object("messages", "$.messages[1].text.text")
    read = lambda k, text: spark.read.parquet(at[k]).select(F.lit(k).alias("kind"), F.col("batch").cast("long").alias("batch"), "source", text.alias("text"))
    texts = read("text", F.col("text")).unionByName(read("chat", answer))
    return texts.unionByName(read("failed", F.substring_index("error", ":", 1))).unionByName(read("ledger", F.lit(None).cast("string")))


@query(
    """WITH c AS (SELECT conv_id, min(turn) AS lead, sum(100 + length(coalesce(text, '')) % 400) AS n FROM conversations WHERE conv_id % 3 = 0 GROUP BY conv_id)
SELECT conv_id::VARCHAR AS gen_id, CASE WHEN conv_id % 2 = 0 THEN 'thinking' ELSE 'response' END AS verdict, (CASE WHEN conv_id % 2 = 0 THEN 36 ELSE 29 END)::BIGINT AS pos, repeat(chr((97 + conv_id % 26)::INT), 30) AS "window"
FROM c WHERE n + CASE WHEN conv_id % 2 = 0 THEN 7 ELSE 0 END >= 900"""
)
def repetition_guard(spark, sf_dir):
    """Turns as tokens: of every third conversation each is one letter over and over, behind an opening tag for even ones. They come in two
    halves, in micro-batches of one file each, so most generations grow over several batches."""
    from loomspark.streaming.repetition import repetition_guard as guard

    root = scratch(spark)
    c = table(spark, sf_dir, "conversations")
    lead = c.groupBy("conv_id").agg(F.min("turn").alias("lead"))
    loop = F.repeat(F.char((97 + F.col("conv_id") % 26).cast("int")), (100 + F.length(F.coalesce("text", F.lit(""))) % 400).cast("int"))
    opened = F.when((F.col("conv_id") % 2 == 0) & (F.col("turn") == F.col("lead")), "<think>").otherwise("")
    token = F.when(F.col("conv_id") % 3 == 0, F.concat(opened, loop)).otherwise(F.col("text"))
    tokens = c.join(lead, "conv_id").select(F.col("conv_id").cast("string").alias("gen_id"), F.col("turn").cast("long").alias("seq"), token.alias("token"))
    for part in ("seq <= 2", "seq > 2"):
        tokens.filter(part).repartition(2, "gen_id").write.mode("append").parquet(f"{root}/in")
    stream = spark.readStream.schema("gen_id string, seq long, token string").option("maxFilesPerTrigger", 1).parquet(f"{root}/in")
    found = guard(stream, timeout=None).writeStream.format("parquet").option("path", f"{root}/out").option("checkpointLocation", f"{root}/state").outputMode("append")
    found.trigger(availableNow=True).start().awaitTermination()
    return spark.read.schema("gen_id string, verdict string, pos long, window string").parquet(f"{root}/out")


def _blobs(spark: SparkSession, sf_dir: str, least: int) -> DataFrame:
    """Documents as blobs, every third behind the mark of a picture; those of ids from ``least`` hundredths on."""
    mark = F.when(F.col("doc_id") % 3 == 0, F.unhex(F.lit("89504E470D0A1A0A"))).otherwise(F.lit(b""))
    return table(spark, sf_dir, "documents").filter(F.col("doc_id") % 100 >= least).select(F.concat(mark, F.encode("text", "utf-8")).alias("content"))


_BLOBS_SQL = "WITH b AS (SELECT doc_id % 3 = 0 AS png, CASE WHEN doc_id % 3 = 0 THEN unhex('89504E470D0A1A0A') || encode(text) ELSE encode(text) END AS content FROM documents WHERE text IS NOT NULL)"


@query(_BLOBS_SQL + " SELECT DISTINCT sha256(content) AS hash, CASE WHEN png THEN 'png' ELSE 'bin' END AS ext, CASE WHEN png THEN 'image' ELSE 'other_media' END AS media_type FROM b")
def media_written_twice(spark, sf_dir):
    """Media rows written in two runs that share most of their blobs, and read back."""
    place = scratch(spark)
    for least in (50, 0):
        sinks.write_media(_blobs(spark, sf_dir, least), place)
    return spark.read.schema("hash string, ext string, media_type string, content binary").parquet(place).select("hash", "ext", "media_type")


@query(
    _BLOBS_SQL + " SELECT DISTINCT CASE WHEN png THEN 'image/' ELSE 'other_media/' END || sha256(content) || CASE WHEN png THEN '.png' ELSE '.bin' END AS path, octet_length(content)::BIGINT AS size, sha256(content) AS hash FROM b"
)
def media_files(spark, sf_dir):
    """The same as files, listed and read by the reader of file trees."""
    place = scratch(spark)
    for least in (50, 0):
        sinks.write_media_files(_blobs(spark, sf_dir, least), place)
    return readers.read_file_tree(spark, place, ways=4).select("path", "size", F.sha2("content", 256).alias("hash"))


def _put_files(rows) -> None:
    import os

    for row in rows:
        os.makedirs(os.path.dirname(row.path), exist_ok=True)
        with open(row.path, "wb") as f:
            f.write(row.content)


_TREE = ["flat/%s.py", "flat/.%s", "flat/_%s.rst", "r1/.hid/%s.py", "r1/.git/%s.py", "r2/a/b/%s.txt"]


@query(
    f"""SELECT replace({_TREE!r}[doc_id % {len(_TREE)} + 1], '%s', doc_id::VARCHAR) AS path, octet_length(encode(text))::BIGINT AS size, sha256(text) AS hash FROM documents WHERE text IS NOT NULL AND doc_id % {len(_TREE)} <> 4"""
)
def file_tree(spark, sf_dir):
    """Documents as files of a tree, hidden ones and some in .git among them, written by tasks and read back."""
    import re

    place = re.sub("^file:(//)?(?=/)", "", scratch(spark))
    path = F.concat(F.lit(f"{place}/"), F.replace(F.element_at(F.array(*map(F.lit, _TREE)), (F.col("doc_id") % len(_TREE) + 1).cast("int")), F.lit("%s"), F.col("doc_id").cast("string")))
    table(spark, sf_dir, "documents").filter("text is not null").select(path.alias("path"), F.encode("text", "utf-8").alias("content")).foreachPartition(_put_files)
    return readers.read_file_tree(spark, place, ways=4).select("path", "size", F.sha2("content", 256).alias("hash"))


@query("SELECT DISTINCT source FROM documents WHERE source IS NOT NULL")
def ledger_runs(spark, sf_dir):
    """Three runs add the sources of their documents to a ledger; two of them overlap, one is made twice."""
    place, d = scratch(spark), table(spark, sf_dir, "documents").filter("source is not null")
    none = d.select("source").limit(0)
    for run, rest in (("a", 0), ("b", 1), ("b", 1)):
        sinks.write_ledger(d.filter(F.col("doc_id") % 2 == rest), none, place, run)
    sinks.write_ledger(d, sinks.ledger_sources(spark, place), place, "c")
    return sinks.ledger_sources(spark, place)


@query(
    "SELECT conv_id % 2 = 0 AS mistakes, count(*)::BIGINT AS n, string_agg(role || ':' || coalesce(text, ''), '|' ORDER BY turn) AS said, conv_id::VARCHAR AS ref FROM conversations GROUP BY conv_id"
)
def read_instruct(spark, sf_dir):
    """Conversations written as a published chat dataset and read by its schema."""
    from loomspark.operators.chats import ordered

    c = table(spark, sf_dir, "conversations")
    ref = F.array(F.struct(F.lit("note").alias("type"), F.col("conv_id").cast("string").alias("value")))
    turn = F.struct("role", F.coalesce("text", F.lit("")).alias("content"), ref.alias("attachments"))
    place = scratch(spark)
    c.groupBy("conv_id").agg(ordered(F.col("turn"), turn).alias("messages")).select("messages", (F.col("conv_id") % 2 == 0).alias("mistakes")).write.parquet(place)
    read = readers.read_instruct(spark, place)
    said = F.array_join(F.transform("messages", lambda m: F.concat(m["role"], F.lit(":"), m["content"])), "|")
    return read.select("mistakes", F.size("messages").cast("long").alias("n"), said.alias("said"), F.col("messages")[0]["attachments"][0]["value"].alias("ref"))


@query(
    """SELECT text, source, '2026' AS collected_at, false AS ai_enhanced, true AS numbered, true AS bounded FROM documents"""
)
def shard_by_size(spark, sf_dir):
    """Documents written in two runs to numbered files of at most 50,000 bytes of text, or one row, and read back with what holds of their
    file: its number is one of a row without gaps, and its texts are within the bound."""
    place, d = scratch(spark), table(spark, sf_dir, "documents").withColumn("ai_enhanced", F.lit(None).cast("boolean"))
    for rest in (0, 1):
        sinks.write_text(d.filter(F.col("doc_id") % 2 == rest), place, "2026", 50_000)
    rows = spark.read.schema("text string, source string, collected_at string, ai_enhanced boolean").parquet(place).withColumn("file", F.input_file_name())
    files = rows.groupBy("file").agg(F.sum(F.octet_length("text")).alias("bytes"), F.count("*").alias("n"))
    number = F.regexp_extract("file", r"(\d+)\.parquet$", 1).cast("long")
    files = files.select("file", number.between(1, files.count()).alias("numbered"), ((F.coalesce("bytes", F.lit(0)) <= 50_000) | (F.col("n") == 1)).alias("bounded"))
    return rows.join(files, "file").drop("file")


@query(
    """WITH d AS (SELECT doc_id, doc_id % 300 AS k, 'a/f' || doc_id || '.X' || (doc_id % 300) AS path FROM documents)
SELECT doc_id, CASE WHEN k % 5 = 4 THEN '# <!-- File: ' || path || ' | Repository: r -->'
    WHEN k % 3 = 0 THEN '#' || k || ' File: ' || path || chr(10) || '#' || k || ' Repository: r'
    ELSE '<' || k || ' File: ' || path || ' | Repository: r' || CASE WHEN k % 3 = 1 THEN ' ' || k || '>' ELSE '' END END || chr(10) || chr(10) AS header FROM d"""
)
def comment_styles_given(spark, sf_dir):
    """Headers by a table of marks that is written, read back and longer than the one that is built in."""
    k = F.col("doc_id") % 300
    docs = table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("a/f"), "doc_id", F.lit(".X"), k).alias("path"))
    n = k.cast("string")
    line = F.when(k % 3 == 0, F.concat(F.lit("#"), n))
    open_, close = F.when(k % 3 > 0, F.concat(F.lit("<"), n)), F.when(k % 3 == 1, F.concat(n, F.lit(">")))
    path = scratch(spark)
    docs.filter(k % 5 != 4).select(F.concat(F.lit(".X"), n).alias("key"), line.alias("line"), open_.alias("open"), close.alias("close")).distinct().write.json(path)
    styled = repofiles.comment_style(docs, suffixes=readers.read_comment_styles(spark, path))
    return styled.select("doc_id", repofiles.comment_header(F.col("path"), F.lit("r"), F.lit("main"), F.col("line"), F.col("open"), F.col("close")).alias("header"))
