"""Registered queries of readers, writers, chats, laws and generated text: each derives its input from the driver's tables with Spark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark.functions.urls import download_url, is_pdf_source, parse_repo_url
from loomspark.jobs.queries import _REPEATED_SQL, AT, SYSTEM, _answers, query
from loomspark.operators import chats, frontier, generated, law_jobs, repofiles
from loomspark.operators.html_jobs import law_html_chats as article_chats
from loomspark.session import scratch, table
from loomspark.sources import readers, sinks


@query(
    """SELECT url, handler, CASE WHEN handler IS NULL THEN 'failed' ELSE 'processed' END AS status
FROM (SELECT url, min(CASE WHEN page_id % 4 = 0 THEN 'h' || page_id % 3 END) AS handler FROM pages GROUP BY url)"""
)
def dispatch_exact(spark, sf_dir):
    pages = table(spark, sf_dir, "pages")
    handlers = pages.filter("page_id % 4 = 0").groupBy("url").agg(F.min(F.concat(F.lit("h"), (F.col("page_id") % 3).cast("string"))).alias("handler"))
    return frontier.dispatch_exact(pages.select("url").distinct(), handlers)


@query(
    """SELECT doc_id, CASE WHEN doc_id % 6 < 3 THEN source END AS owner, CASE WHEN doc_id % 6 < 3 THEN 'r' || doc_id END AS repo, CASE WHEN doc_id % 6 = 1 THEN 'b/' || doc_id END AS branch,
  CASE doc_id % 6 WHEN 3 THEN 'branch' WHEN 4 THEN 'owner or repository' WHEN 5 THEN 'host' END AS error FROM documents WHERE source IS NOT NULL"""
)
def repo_urls(spark, sf_dir):
    kind, tail = F.col("doc_id") % 6, F.concat(F.col("source"), F.lit("/r"), F.col("doc_id").cast("string"))
    url = F.when(kind == 0, F.concat(F.lit("https://GitHub.com/"), tail)).when(kind == 1, F.concat(F.lit("https://github.com/"), tail, F.lit("/tree/b/"), F.col("doc_id").cast("string")))
    url = url.when(kind == 2, F.concat(F.lit("https://github.com/"), tail, F.lit("/blob/x"))).when(kind == 3, F.concat(F.lit("https://github.com/"), tail, F.lit("/tree/")))
    url = url.when(kind == 4, F.concat(F.lit("https://github.com/"), F.col("source"))).otherwise(F.concat(F.lit("https://www.github.com/"), tail))
    return table(spark, sf_dir, "documents").filter("source is not null").select("doc_id", parse_repo_url(url).alias("p")).select("doc_id", "p.*")


@query(
    """SELECT page_id, 'https://x.org/dateien/dokumente/' || page_id || '/file.pdf' AS document, 'https://x.org/dateien/lernsets/' || page_id || '/file.json' AS learning_set,
  url || '?action=raw' AS wiki, replace(url, 'de', 'fr') AS law, page_id % 3 < 2 AS pdf FROM pages"""
)
def downloads(spark, sf_dir):
    n = F.col("page_id").cast("string")
    ending = F.when(F.col("page_id") % 3 == 0, ".pdf").when(F.col("page_id") % 3 == 1, ".pdf?x=1").otherwise(".pdf/x")
    return table(spark, sf_dir, "pages").select(
        "page_id", download_url(F.concat(F.lit("https://x.org/dokumente/vorschau/"), n), "document").alias("document"), download_url(F.concat(F.lit("https://x.org/lernsets/vorschau/"), n), "learning_set").alias("learning_set"),
        download_url(F.col("url"), "wiki").alias("wiki"), download_url(F.col("url"), "law", "fr").alias("law"), is_pdf_source(F.concat(F.lit("https://x.org/"), n, ending)).alias("pdf"),
    )


@query(
    """WITH s AS (SELECT conv_id, min(turn) FILTER (WHERE turn % 4 = 3) AS stop FROM conversations GROUP BY conv_id)
SELECT c.conv_id AS gen_id, coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE stop IS NULL OR turn <= stop), '') AS content, coalesce(max(stop), 0)::BIGINT AS input_tokens, coalesce(2 * max(stop), 0)::BIGINT AS output_tokens
FROM conversations c JOIN s ON c.conv_id = s.conv_id GROUP BY c.conv_id"""
)
def assemble_local(spark, sf_dir):
    """Turns as events of a local server; every fourth says that it is the last, and some go on after it."""
    timings = F.struct(F.col("turn").alias("prompt_n"), (2 * F.col("turn")).alias("predicted_n"))
    data = F.to_json(F.struct(F.col("text").alias("content"), (F.col("turn") % 4 == 3).alias("stop"), timings.alias("timings")))
    return generated.assemble_local(table(spark, sf_dir, "conversations").select(F.col("conv_id").alias("gen_id"), F.col("turn").alias("seq"), F.concat(F.lit("data: "), data).alias("line")))


@query(
    f"""WITH d AS (SELECT * FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL AND source IS NOT NULL AND doc_id % 3 = 0)
SELECT doc_id AS source, '{SYSTEM}' AS system, 'q ' || source AS question, text AS answer, true AS ai_enhanced FROM d UNION ALL SELECT doc_id, '{SYSTEM}', 'who?', lang, true FROM d"""
)
def qa_chats(spark, sf_dir):
    m = F.col("messages")
    made = generated.qa_chats(generated.qa_pairs(_answers(spark, sf_dir)), SYSTEM)
    return made.select("source", m[0]["content"][0]["text"].alias("system"), m[1]["content"][0]["text"].alias("question"), m[2]["text"]["text"].alias("answer"), "ai_enhanced")


@query("""SELECT conv_id, turn, 'f_' || role AS name, '{"turn":' || turn || '}' AS arguments, 'h' || conv_id AS hash FROM conversations""")
def tool_calls(spark, sf_dir):
    call = F.to_json(F.struct(F.struct(F.concat(F.lit("f_"), F.col("role")).alias("name"), F.struct("turn").alias("arguments")).alias("function")))
    given = F.array(F.struct(F.lit("text/plain").alias("type"), F.col("text").alias("value")), F.struct(F.lit("application/json/tool_call").alias("type"), call.alias("value")), F.struct(F.lit("image/png").alias("type"), F.concat(F.lit("sha256sum:h"), F.col("conv_id")).alias("value")))
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", chats.tool_calls(given)[0].alias("c"), chats.media_refs(given)[0].alias("hash"))
    return rows.select("conv_id", "turn", "c.name", "c.arguments", "hash")


@query(
    """WITH d AS (SELECT * FROM documents WHERE source IS NOT NULL AND lang IS NOT NULL)
SELECT source AS repo, 'b/' || doc_id AS branch FROM d WHERE doc_id % 7 > 0 UNION ALL SELECT DISTINCT 'lone ' || lang, 'main' FROM d
UNION ALL SELECT source, 'main' FROM d GROUP BY source HAVING count(*) FILTER (WHERE doc_id % 7 > 0) = 0"""
)
def list_branches(spark, sf_dir):
    d = table(spark, sf_dir, "documents").filter("source is not null and lang is not null")
    line = F.when(F.col("doc_id") % 7 > 0, F.concat(F.lit("  origin/b/"), F.col("doc_id").cast("string"))).otherwise(F.lit("  origin/HEAD -> origin/b"))
    lone = d.select(F.concat(F.lit("lone "), F.col("lang")).alias("repo"), F.lit(" ").alias("line"))
    return repofiles.list_branches(d.select(F.col("source").alias("repo"), line.alias("line")).unionByName(lone))


_PROMPTS = [("de", "Wie lautet Artikel %ID%?", "Achtung: "), ("fr", "Que dit l'article %ID% ?", "Attention: ")]


@query(
    """WITH p(lang, prompt, warning) AS (VALUES ('de', 'Wie lautet Artikel %ID%?', 'Achtung: '), ('fr', 'Que dit l''article %ID% ?', 'Attention: '))
, s AS (SELECT doc_id, lang, generate_subscripts(a, 1) - 1 AS i, unnest(a) AS html FROM (SELECT doc_id, lang, string_split(text, '.') AS a FROM documents WHERE doc_id % 5 > 0 AND text IS NOT NULL))
SELECT 'https://law/' || doc_id AS source, replace(prompt, '%ID%', 'a' || doc_id || '_' || i) AS question, warning || html AS answer, false AS ai_enhanced
FROM s JOIN p ON s.lang = p.lang WHERE length(html) < 100"""
)
def law_html_chats(spark, sf_dir):
    """The sentences of whole texts as articles, those of every fifth document without an id."""
    url = F.concat(F.lit("https://law/"), F.col("doc_id").cast("string"))
    ident = F.when(F.col("doc_id") % 5 > 0, F.concat_ws("_", F.concat(F.lit("a"), F.col("doc_id").cast("string")), F.col("pos").cast("string")))
    articles = table(spark, sf_dir, "documents").select("doc_id", "lang", F.posexplode(F.split("text", r"\.")).alias("pos", "html"))
    articles = articles.select(url.alias("url"), "lang", ident.alias("id"), "html")
    m = F.col("messages")
    made = article_chats(articles, spark.createDataFrame(_PROMPTS, "lang string, prompt string, warning string"))
    return made.select("source", m[0]["content"][0]["text"].alias("question"), m[1]["text"]["text"].alias("answer"), "ai_enhanced")


def _act(xml: str, title: str) -> dict:
    """A converter for acts that are one line each: heading and, behind a bar, the articles."""
    if not xml.startswith("<act>"):
        raise ValueError("no act")
    body = xml.removeprefix("<act>")
    return {"markdown": f"# {title}", "meta": {"language": "de", "titles": {}, "dates": {}}, "articles": [{"key": f"Art. {i}", "article_id": str(i), "eId": f"art_{i}", "heading": "", "markdown": f"{i} {body}", "path": title} for i in (1, 2)]}


def _law_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of a law table: other languages, junk and short rows among them; every fifth can't be converted."""
    xml = F.concat(F.when(F.col("doc_id") % 5 == 0, F.lit("<cut>")).otherwise(F.lit("<act>")), F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.concat(F.lit(" "), F.upper("lang"), F.lit(" ")).alias("language"), xml.alias("xml"))


_LAW_SQL = "d AS (SELECT doc_id, 'T' || doc_id AS title, lang, text, CASE WHEN doc_id % 5 = 0 THEN '<cut>' ELSE '<act>' END || text AS xml FROM documents WHERE lang IN ('de', 'fr') AND length(text) >= 11)"


@query(
    f"""WITH p(lang, prompt, warning) AS (VALUES ('de', 'Wie lautet Artikel %ID%?', 'Achtung: '), ('fr', 'Que dit l''article %ID% ?', 'Attention: ')), {_LAW_SQL}
SELECT 'text' AS kind, replace(xml, '>', '>' || chr(10)) AS text, NULL AS question, NULL AS answer, 'laws' AS source, false AS ai_enhanced FROM d
UNION ALL SELECT 'text', '# ' || title, NULL, NULL, 'laws', false FROM d WHERE doc_id % 5 > 0
UNION ALL SELECT 'chat', NULL, replace(prompt, '%ID%', 'Art. ' || i), '**' || warning || '**' || chr(10) || chr(10) || i || ' ' || text, 'laws', false FROM d JOIN p ON d.lang = p.lang, range(1, 3) AS t(i) WHERE doc_id % 5 > 0"""
)
def law_csv_rows(spark, sf_dir):
    prompts = spark.createDataFrame(_PROMPTS, "lang string, prompt string, warning string")
    rows = law_jobs.law_csv_rows(_law_table(spark, sf_dir), "laws", prompts, _act, lambda x: x.replace(">", ">\n"))
    m = F.col("messages")
    return rows.select("kind", "text", m[0]["content"][0]["text"].alias("question"), m[1]["text"]["text"].alias("answer"), "source", "ai_enhanced")


@query(f"""WITH {_LAW_SQL} SELECT doc_id AS row_id, '1 ' || text AS flat_first, '2 ' || text AS plain_second, 'de' AS language, 'art_2' AS rich_id, title AS rich_path FROM d WHERE doc_id % 5 > 0""")
def articles_payload(spark, sf_dir):
    acts = law_jobs.law_xml_convert(law_jobs.law_candidates(_law_table(spark, sf_dir)).withColumn("row_id", F.substring("title", 2, 20).cast("long")), _act, str).filter("error is null")
    flat, plain, rich = (law_jobs.articles_payload(acts, **how).withColumnRenamed("payload", name) for name, how in (("f", {"flat": True}), ("p", {}), ("r", {"rich": True})))
    get = F.get_json_object
    both = flat.join(plain, "row_id").join(rich, "row_id")
    return both.select("row_id", get("f", "$['Art. 1']").alias("flat_first"), get("p", "$.articles['Art. 2']").alias("plain_second"), get("p", "$.meta.language").alias("language"), get("r", "$.articles['Art. 2'].eId").alias("rich_id"), get("r", "$.articles['Art. 2'].path").alias("rich_path"))


def _sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as learning sets of one pair; every third is no JSON, every third an object."""
    pair = F.concat(F.lit('[{"question": "é'), F.col("conv_id").cast("string"), F.lit('", "answer": "'), F.col("turn").cast("string"), F.lit('"}]'))
    kind = (F.col("conv_id") + F.col("turn")) % 3
    json = F.when(kind == 0, pair).when(kind == 1, F.lit("oops")).otherwise(F.concat(F.lit('{"n": '), F.col("turn").cast("string"), F.lit("}")))
    return table(spark, sf_dir, "conversations").select(F.concat_ws("-", "conv_id", "turn").alias("url"), json.alias("json"))


@query(
    r"""WITH c AS (SELECT conv_id || '-' || turn AS source, (conv_id + turn) % 3 AS kind, conv_id, turn, unnest(['é', '\u00e9']) AS e FROM conversations)
SELECT source, false AS ai_enhanced, NULL AS error, CASE kind WHEN 0 THEN '[' || chr(10) || '  {' || chr(10) || '    "question": "' || e || conv_id || '",' || chr(10) || '    "answer": "' || turn || '"' || chr(10) || '  }' || chr(10) || ']'
  ELSE '{' || chr(10) || '  "n": ' || turn || chr(10) || '}' END AS text FROM c WHERE kind <> 1
UNION ALL SELECT DISTINCT source, false, 'Expecting value: line 1 column 1 (char 0)', NULL FROM c WHERE kind = 1"""
)
def learning_set_rows(spark, sf_dir):
    return readers.learning_set_rows(_sets(spark, sf_dir))


@query("SELECT conv_id || '-' || turn AS source, 'é' || conv_id AS question, turn::VARCHAR AS answer FROM conversations WHERE (conv_id + turn) % 3 = 0")
def learning_pairs(spark, sf_dir):
    return readers.learning_pairs(_sets(spark, sf_dir))


def _message(role: str, text: Column) -> Column:
    return chats.assistant(text) if role == "assistant" else chats.message(role, chats.text_content(text))


@query(
    f"""SELECT 'text' AS kind, text, NULL AS messages, source, '{AT}' AS collected_at, doc_id % 2 = 0 AS ai_enhanced FROM documents WHERE doc_id % 3 > 0
UNION ALL SELECT 'chat', NULL, json_object('messages', [json_object('role', 'user', 'content', [json_object('type', 'text', 'text', lang)]), json_object('role', 'assistant', 'text', json_object('type', 'text', 'text', source), 'tool_calls', []::VARCHAR[])])::VARCHAR, source, '{AT}', doc_id % 2 = 0
FROM documents WHERE doc_id % 3 = 0"""
)
def saved_rows(spark, sf_dir):
    """Rows of both kinds written to their places and read back."""
    kind = F.when(F.col("doc_id") % 3 > 0, "text").otherwise("chat")
    messages = F.array(_message("user", F.col("lang")), _message("assistant", F.col("source")))
    rows = table(spark, sf_dir, "documents").select(kind.alias("kind"), "text", F.when(kind == "chat", messages).alias("messages"), "source", (F.col("doc_id") % 2 == 0).alias("ai_enhanced"))
    place = scratch(spark)
    sinks.save(rows, f"{place}/text", f"{place}/chat", AT)
    schema = "source string, collected_at string, ai_enhanced boolean"
    text = spark.read.schema(f"text string, {schema}").parquet(f"{place}/text").withColumns({"kind": F.lit("text"), "messages": F.lit(None).cast("string")})
    return text.unionByName(spark.read.schema(f"messages string, {schema}").parquet(f"{place}/chat").withColumns({"kind": F.lit("chat"), "text": F.lit(None).cast("string")}))


def _lines_back(spark: SparkSession, lines: DataFrame) -> str:
    place = scratch(spark)
    lines.write.text(place)
    return place


@query("SELECT url FROM pages WHERE page_id % 4 < 2 UNION ALL SELECT '# ' || url FROM pages WHERE page_id % 4 = 3")
def url_list(spark, sf_dir):
    """Pages as lines: as they are, with blanks around, comments, comments behind a blank."""
    kind, url = F.col("page_id") % 4, F.col("url")
    line = F.when(kind == 0, url).when(kind == 1, F.concat(F.lit("  "), url, F.lit("\t "))).when(kind == 2, F.concat(F.lit("# "), url)).otherwise(F.concat(F.lit("  # "), url))
    return readers.read_url_list(spark, _lines_back(spark, table(spark, sf_dir, "pages").select(line))).select("url")


@query("SELECT DISTINCT source FROM documents WHERE trim(source) <> ''")
def ledger_file(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    return readers.read_ledger(spark, _lines_back(spark, d.select(F.concat(F.coalesce("source", F.lit("")), F.lit("  ")))))


@query("SELECT 'T' || doc_id AS title, lang AS language, replace(text, chr(13), '') || ' \"q\", ' || doc_id AS xml FROM documents WHERE text IS NOT NULL AND lang IS NOT NULL")
def law_csv_file(spark, sf_dir):
    """A law table written as CSV, with quotes, commas and line ends in its fields, and read by position."""
    d = table(spark, sf_dir, "documents").filter("text is not null and lang is not null")
    xml = F.concat(F.replace("text", F.lit("\r"), F.lit("")), F.lit(' "q", '), F.col("doc_id").cast("string"))
    place = scratch(spark)
    rows = d.select(F.lit("0").alias("c0"), F.concat(F.lit("T"), F.col("doc_id").cast("string")).alias("title"), F.lit("2").alias("c2"), F.col("lang").alias("language"), F.lit("4").alias("c4"), xml.alias("xml"))
    rows.write.csv(place, quoteAll=True, quote='"', escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    return readers.read_law_csv(spark, place).select("title", "language", "xml")


_KINDS = [("89504E470D0A1A0A", "png", "image"), ("FFD8FF", "jpg", "image"), ("52494646000000005745425000", "webp", "image"), ("494433", "mp3", "audio"), ("0000002066747970", "mp4", "video"), ("1A45DFA3", "webm", "video"), ("25504446", "pdf", "other_media"), ("1F8B08", "gz", "other_media"), ("00", "bin", "other_media")]


@query(
    f"""WITH k AS (SELECT doc_id, {[list(k) for k in _KINDS]!r}[doc_id % {len(_KINDS)} + 1] AS k, doc_id // {len(_KINDS)} AS n FROM documents)
SELECT DISTINCT sha256(unhex(k[1] || hex(encode((n % 50)::VARCHAR)))) AS hash, k[2] AS ext, k[3] AS media_type FROM k"""
)
def media_kinds(spark, sf_dir):
    """Blobs that begin with the marks of several formats, each more than once, as media rows."""
    mark = F.element_at(F.array(*[F.lit(k[0]) for k in _KINDS]), (F.col("doc_id") % len(_KINDS) + 1).cast("int"))
    n = (F.floor(F.col("doc_id") / len(_KINDS)) % 50).cast("string")
    return sinks.media_rows(table(spark, sf_dir, "documents").select(F.unhex(F.concat(mark, F.hex(F.encode(n, "utf-8")))).alias("content"))).drop("content")


@query(
    """SELECT conv_id, json_object('messages', list(CASE WHEN role = 'assistant' THEN json_object('role', role, 'text', json_object('type', 'text', 'text', coalesce(text, '')), 'tool_calls', []::VARCHAR[])
  ELSE json_object('role', role, 'content', [json_object('type', 'text', 'text', coalesce(text, ''))]) END ORDER BY turn))::VARCHAR AS json
FROM conversations WHERE role IN ('user', 'assistant', 'system', 'tool') GROUP BY conv_id"""
)
def chat_json_whole(spark, sf_dir):
    return chats.chat_rows(table(spark, sf_dir, "conversations")).select("conv_id", chats.chat_json(F.col("messages")).alias("json"))


@query(
    """WITH m AS (SELECT conv_id, turn, CASE WHEN role = 'assistant' THEN json_object('role', role, 'text', json_object('type', 'text', 'text', coalesce(text, '')), 'tool_calls', [json_object('name', 'f', 'arguments', json_object('a', turn))])
  WHEN role = 'user' AND turn % 2 = 0 THEN json_object('role', role, 'content', [json_object('type', 'text', 'text', coalesce(text, '')), json_object('type', 'image', 'hash', 'h' || conv_id)])
  ELSE json_object('role', role, 'content', [json_object('type', 'text', 'text', coalesce(text, ''))]) END AS m FROM conversations WHERE role IN ('user', 'assistant', 'system', 'tool'))
SELECT conv_id, json_object('messages', list(m ORDER BY turn))::VARCHAR AS json, conv_id % 2 = 0 AS ai_enhanced FROM m GROUP BY conv_id"""
)
def instruct_chats_whole(spark, sf_dir):
    """Conversations as published chats with attachments and tool calls, every column compared."""
    c = table(spark, sf_dir, "conversations")
    ref = F.struct(F.lit("image/png").alias("type"), F.when(F.col("turn") % 2 == 0, F.concat(F.lit("sha256sum:h"), F.col("conv_id"))).otherwise(F.lit("sha256sum:gone")).alias("value"))
    call = F.struct(F.lit("application/json/tool_call").alias("type"), F.concat(F.lit('{"function":{"name":"f","arguments":{"a":'), F.col("turn").cast("string"), F.lit("}}}")).alias("value"))
    one = F.struct("role", F.coalesce("text", F.lit("")).alias("content"), F.array(ref, call).alias("attachments"))
    published = c.groupBy("conv_id").agg(chats.ordered(F.col("turn"), one).alias("messages")).withColumn("mistakes", F.col("conv_id") % 2 == 0)
    blobs = c.select(F.concat(F.lit("h"), F.col("conv_id")).alias("hash")).distinct().withColumn("content", F.unhex(F.lit("89504E470D0A1A0A00")))
    made = chats.instruct_chats(published, blobs)
    return made.select("conv_id", chats.chat_json(F.col("messages")).alias("json"), "ai_enhanced")


def _looped(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents, some with a loop at their end, some of one letter around the shortest length that counts."""
    n = (850 + F.col("doc_id") % 100).cast("int")
    text = F.when(F.col("doc_id") % 4 == 0, F.concat("text", F.repeat(F.lit("over and over "), 60))).when(F.col("doc_id") % 4 == 1, F.repeat(F.lit("z"), n)).otherwise(F.col("text"))
    return table(spark, sf_dir, "documents").select("doc_id", text.alias("text"))


_LOOPED_SQL = """l AS (SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN text || repeat('over and over ', 60) WHEN 1 THEN repeat('z', (850 + doc_id % 100)::INT) ELSE text END AS text FROM documents)"""


@query(f"WITH {_LOOPED_SQL}, {_REPEATED_SQL.format('l')} SELECT l.doc_id, f.doc_id IS NOT NULL AS repetitive FROM l LEFT JOIN f ON l.doc_id = f.doc_id")
def is_repetitive(spark, sf_dir):
    return _looped(spark, sf_dir).select("doc_id", generated.is_repetitive(F.col("text")).alias("repetitive"))
