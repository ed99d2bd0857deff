"""The library's operators against plain Python on small inputs."""

import json
import random
from urllib.parse import urlparse

import pytest
from pyspark.sql import functions as F

import __spark_entry__
from loomspark.functions import text as T
from loomspark.functions import urls as U
from loomspark.functions import page_html, wiki_html
from loomspark.functions.html_tree import markup, parse, prettify
from loomspark.operators import chats, documents, frontier, generated, html_jobs, repofiles
from loomspark.session import with_rank
from loomspark.sources import readers, sinks
from loomspark.streaming.ingest import incremental_ingest
from loomspark.streaming.repetition import repetition_guard


def urls(n=300):
    r = random.Random(1)
    hosts = ["a.org", "b.org:8080", "user@c.net", "A.org", "d.e.f"]
    return [f"https://{'a.org' if r.random() < 0.4 else r.choice(hosts)}/{'/'.join(r.choice('xyz.') + str(r.randrange(9)) for _ in range(r.randrange(4)))}?q={i}" for i in range(n)] + ["no scheme", "http://p.q/a b|c", "https://x.y"]


def test_order_is_round_robin(spark):
    all_urls = urls()
    got = [r.url for r in frontier.order_urls(spark.createDataFrame([(u,) for u in all_urls], "url string")).orderBy("ordinal").collect()]
    groups = {}
    for u in sorted(all_urls):
        groups.setdefault(urlparse(u).netloc, []).append(u)
    want = []
    while len(want) < len(all_urls):
        for held in groups.values():
            if held:
                want.append(held.pop(0))
    assert got == want


def test_rank_of_a_hot_key(spark):
    df = spark.range(5000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("v"))
    got = with_rank(df, ["k"], ["v"], "i").filter("k = 'hot'").orderBy("v").collect()
    assert [r.i for r in got] == list(range(len(got)))


def test_candidates_and_routes(spark):
    df = spark.createDataFrame([("https://huggingface.co/datasets/a.b/C;p?x#y",), ("http://w.x",)], "url string")
    got = [r[0] for r in df.select(U.candidate_prefixes(F.col("url"))).collect()]
    assert got == [["co/huggingface/datasets/a/b/C", "co/huggingface/datasets/a/b", "co/huggingface/datasets", "co/huggingface"], ["x/w"]]
    registry = spark.createDataFrame([("co/huggingface", "short"), ("co/huggingface/datasets", "long")], "prefix string, handler string")
    assert {r.url: r.handler for r in frontier.route_urls(df, registry).collect()} == {"https://huggingface.co/datasets/a.b/C;p?x#y": "long", "http://w.x": None}


def test_repository_urls(spark):
    cases = {
        "https://GitHub.com/o/r": ("o", "r", None, None),
        "https://github.com/o/r/tree/a/b": ("o", "r", "a/b", None),
        "https://github.com/o/r/blob/x": ("o", "r", None, None),
        "https://github.com/o/r/tree/": (None, None, None, "branch"),
        "https://github.com/o": (None, None, None, "owner or repository"),
        "https://www.github.com/o/r": (None, None, None, "host"),
    }
    df = spark.createDataFrame([(u,) for u in cases], "url string")
    assert {r.url: tuple(r.p) for r in df.select("url", U.parse_repo_url(F.col("url")).alias("p")).collect()} == cases


def test_downloads(spark):
    df = spark.createDataFrame([("https://x/dokumente/vorschau/7", "https://x/de/de")], "a string, b string")
    r = df.select(U.download_url(F.col("a"), "document").alias("d"), U.download_url(F.col("b"), "law", "fr").alias("l"), U.download_url(F.col("b"), "wiki").alias("w"), U.is_pdf_source(F.lit("x.pdf?y=1")).alias("p")).first()
    assert tuple(r) == ("https://x/dateien/dokumente/7/file.pdf", "https://x/fr/fr", "https://x/de/de?action=raw", True)


def test_white_space_and_names(spark):
    odd = "\x1c a  b\x85 \n"
    names = {"Iron Sword": True, "File:x": False, "ends.": False, "a.png shown": False, "": False, "x" * 41: False, " two  words ": True}
    df = spark.createDataFrame([(k,) for k in names], "t string")
    assert spark.createDataFrame([(odd,)], "t string").select(T.collapse_ws(F.col("t"))).first()[0] == "a b"
    assert {r.t: r.n for r in df.select("t", T.looks_like_item_name(F.col("t")).alias("n")).collect()} == names
    assert all(wiki_html.item_name(k) == v for k, v in names.items())
    titles = {"Ab": True, "a": False, "abཀ": False, "日本ab": False, "é" * 100: True, "x" * 101: False}
    df = spark.createDataFrame([(k,) for k in titles], "t string")
    assert {r.t: r.v for r in df.select("t", T.is_valid_title(F.col("t")).alias("v")).collect()} == titles
    assert all(wiki_html.valid_title(k) == v for k, v in titles.items())
    paths = {"a/.gitignore": "", "a/b.tar.GZ": ".gz", "Makefile": "", "x.y/z": "", "a.": ""}
    df = spark.createDataFrame([(k,) for k in paths], "t string")
    assert {r.t: r.s for r in df.select("t", T.file_suffix(F.col("t")).alias("s")).collect()} == paths


def test_files(spark, tmp_path):
    for name, content in {".gitignore": b"x", "_p.py": b"a = 1", "sub/.git/config": b"no", "a.obj": b"text", "bad.txt": b"\xff\xfe", "nul.c": b"a\0", "x.rst": b"t", "Makefile": b"all:", "k.unknown": b"u", "q.graphql": b"g", "m.m4": b"d", ".h/i.jinja": b"j"}.items():
        p = tmp_path / name
        p.parent.mkdir(parents=True, exist_ok=True)
        p.write_bytes(content)
    tree = readers.read_file_tree(spark, str(tmp_path))
    assert tree.count() == 11
    files = repofiles.read_text_files(tree).select("*", F.lit("https://github.com/o/r").alias("url"), F.lit("o/r").alias("repo"), F.when(F.col("path") == "x.rst", "dev").otherwise("main").alias("branch"))
    got = {r.text for r in repofiles.repo_text_rows(files).collect()}
    block = lambda a, p, z: f"{a} File: {p} | Repository: o/r{z}\n\n"
    assert got == {"x", "a = 1", "t", "all:", "u", "g", "d", "j"} | {
        "# File: .gitignore\n# Repository: o/r\n\nx", "# File: _p.py\n# Repository: o/r\n\na = 1", block("..", "x.rst", " | Branch: dev") + "t", "# File: Makefile\n# Repository: o/r\n\nall:",
        block("# <!--", "k.unknown", " -->") + "u", block("#", "q.graphql", "") + "g", "dnl  File: m.m4\ndnl  Repository: o/r\n\nd", block("{#", ".h/i.jinja", " #}") + "j",
    }
    listing = spark.createDataFrame([("r", "  origin/HEAD -> origin/main"), ("r", "  origin/a/b"), ("s", " ")], "repo string, line string")
    assert {tuple(r) for r in repofiles.list_branches(listing).collect()} == {("r", "a/b"), ("s", "main")}


def test_lists(spark, tmp_path):
    (tmp_path / "u.txt").write_text("# no\n https://a \n\n #kept\nhttps://b\n")
    assert [r.url for r in readers.read_url_list(spark, str(tmp_path / "u.txt")).orderBy("pos").collect()] == ["https://a", "#kept", "https://b"]
    assert readers.read_ledger(spark, str(tmp_path / "none")).count() == 0
    (tmp_path / "l.txt").write_text(" a \n\na\nb\n")
    assert {r.source for r in readers.read_ledger(spark, str(tmp_path / "l.txt")).collect()} == {"a", "b"}
    (tmp_path / "law.csv").write_text('i,Title,x,DE,y,"<a>\n""q""</a>"\n')
    assert [(r.title, r.language, r.xml) for r in readers.read_law_csv(spark, str(tmp_path / "law.csv")).collect()] == [("Title", "DE", '<a>\n"q"</a>')]
    sets = spark.createDataFrame([("u", '[{"question": "hallo", "answer": "hello"}, {"question": "x"}]'), ("v", '{"question": "a", "answer": "b"}'), ("w", "oops")], "url string, json string")
    assert [tuple(r) for r in readers.learning_pairs(sets).collect()] == [("u", "hallo", "hello")]
    texts = readers.learning_set_rows(spark.createDataFrame([("u", '{"a": "é"}'), ("w", "oops"), ("n", None)], "url string, json string")).collect()
    assert [r.text for r in texts if r.source == "u"] == ['{\n  "a": "é"\n}', '{\n  "a": "\\u00e9"\n}']
    assert all(r.text is None and r.error for r in texts if r.source != "u") and len(texts) == 4


def naive_repetition(text):
    base = max(0, len(text) - 10_000)
    end = text[base:]
    for w, k in generated.RULES:
        seen = {}
        if len(end) >= w * k:
            for i in range(len(end) - w + 1):
                x = end[i : i + w]
                seen[x] = seen.get(x, 0) + 1
                if seen[x] >= k:
                    return base + i, x
    return None


def test_repetition(spark):
    r = random.Random(7)
    noise = lambda n: "".join(r.choice("abcdefgh ") for _ in range(n))
    block = noise(320)
    texts = ["x" * 899, "x" * 900, ("y" * 950) + noise(10_000), noise(12_000), noise(3000) + "abc" * 400, noise(200) + (block + noise(40)) * 7 + noise(50), None, "", noise(9_000) + ("é" * 31 + "z") * 60]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    got = {r.i: tuple(r.repetition) if r.repetition else None for r in generated.find_repetition(df).collect()}
    assert got == {i: naive_repetition(t or "") for i, t in enumerate(texts)}


def test_reasoning(spark):
    def last_tag(t):
        thinking = ""
        for tag in ("</think>", "<channel|>"):
            if tag in t:
                thinking, t = t.rsplit(tag, 1)
        return thinking, t if t.strip() else "No Response"

    texts = ["plain", "a</think>b", "a</think>b</think>c<channel|>d", "x<channel|>y</think>z", "</think>", "", "a<channel|> \n"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    assert [tuple(r[0]) for r in df.select(generated.split_reasoning("last_tag", F.col("t"))).collect()] == [last_tag(t) for t in texts]
    got = df.select(generated.split_reasoning("first_last", F.col("t"), F.lit("r"))).collect()
    assert tuple(got[2][0]) == ("ar", "c<channel|>d") and tuple(got[5][0]) == ("r", "r")
    checks = [("a", "p", "response", "a"), ("<think>x", "p", "thinking", "<think>x"), ("<think>x</think>y", "p", "response", "y"), ("q", "…<think>", "thinking", "q"), ("q", "<think>" + "." * 40, "response", "q")]
    df = spark.createDataFrame(checks, "t string, p string, v string, part string")
    assert all((r.c.verdict, r.c.part) == (r.v, r.part) for r in df.select("*", generated.needs_answer_check(F.col("t"), F.col("p")).alias("c")).collect())


def test_completions(spark):
    say = lambda **d: "data: " + json.dumps({"choices": [{"delta": d}]})
    lines = [": c", say(content="a"), "", "data: {bad", say(reasoning="r", content=None), say(content="b") + "\r", 'data: {"usage": {"prompt_tokens": 3, "completion_tokens": 4}}', "data: [DONE]", say(content="late")]
    rows = [("g", i, x) for i, x in enumerate(lines)] + [("e", 0, say(content="x")), ("e", 1, 'data: {"error": {"message": "m"}}'), ("e", 2, say(content="y")), ("n", 0, ": only")]
    got = {r.gen_id: tuple(r)[1:] for r in generated.assemble_completions(spark.createDataFrame(rows, "gen_id string, seq long, line string")).collect()}
    assert got == {"g": ("ab", "r", 3, 4), "e": ("x", "", 0, 0), "n": ("", "", 0, 0)}
    local = [("l", 0, 'data: {"content": "a"}'), ("l", 1, "noise"), ("l", 2, 'data: {"content": "b", "stop": true, "timings": {"prompt_n": 5, "predicted_n": 2}}'), ("l", 3, 'data: {"content": "c"}')]
    assert tuple(generated.assemble_local(spark.createDataFrame(local, "gen_id string, seq long, line string")).first()) == ("l", "ab", 5, 2)


def test_pairs(spark):
    good = '```json\nx\n```\n```json\n[{"question": "q", "answer": "a"}, {"question": "only"}]\n```'
    rows = [("1", good), ("2", "none"), ("3", '```json\n{"question": "q", "answer": "a"}\n```'), ("4", "```json\n[oops\n```"), ("5", None)]
    got = {(r.url, r.question, r.answer, r.error) for r in generated.qa_pairs(spark.createDataFrame(rows, "url string, response string")).collect()}
    assert got == {("1", "q", "a", None), ("1", "only", None, "no pair"), ("2", None, None, "no fence"), ("3", None, None, "no list"), ("4", None, None, "no list"), ("5", None, None, "no fence")}


def test_published_chats(spark):
    call = json.dumps({"function": {"name": "f", "arguments": {"x": 1}}})
    chat = [("system", "s", []), ("user", "", [("application/pdf/sha256sum", "h1"), ("t", "sha256sum:gone"), ("t", "sha256sum:h2")]), ("odd", "no", []), ("assistant", "", [("application/json/tool_call", call)])]
    df = spark.createDataFrame([(1, chat, True), (2, [("user", "hi", None)], None)], "conv_id long, messages array<struct<role:string,content:string,attachments:array<struct<type:string,value:string>>>>, mistakes boolean")
    blobs = spark.createDataFrame([("h1", b"%PDF-1"), ("h2", b"\x89PNG\r\n\x1a\n")], "hash string, content binary")
    rows = {r.conv_id: r for r in chats.instruct_chats(df, blobs).select("*", chats.chat_json(F.col("messages")).alias("j")).collect()}
    one = json.loads(rows[1].j)["messages"]
    assert one == [
        {"role": "system", "content": [{"type": "text", "text": "s"}]},
        {"role": "user", "content": [{"type": "other_media", "hash": "h1"}, {"type": "image", "hash": "h2"}]},
        {"role": "assistant", "text": {"type": "text", "text": ""}, "tool_calls": [{"name": "f", "arguments": {"x": 1}}]},
    ]
    assert rows[1].ai_enhanced and not rows[2].ai_enhanced
    assert json.loads(rows[2].j)["messages"] == [{"role": "user", "content": [{"type": "text", "text": "hi"}]}]


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("u1", 1, "b"), ("u1", 0, "a"), ("u2", 0, None)], "url string, page_no int, markdown string")
    docs = documents.joined_pages(rows).withColumn("content", F.encode("url", "utf-8"))
    out = documents.pdf_rows(docs, "summarise")
    sinks.save(out, f"{tmp_path}/t", f"{tmp_path}/c", "2026-01-01T00:00:00")
    assert {(r.text, r.source, r.ai_enhanced) for r in spark.read.parquet(f"{tmp_path}/t").collect()} == {("a\n\nb", "u1", True), ("", "u2", True)}
    chat = json.loads(spark.read.parquet(f"{tmp_path}/c").filter("source = 'u1'").first().messages)
    assert chat["messages"][0]["content"][1]["type"] == "other_media" and chat["messages"][1]["text"]["text"] == "a\n\nb"
    with pytest.raises(ValueError):
        documents.select_pages(rows, 0, 0)
    media = sinks.media_rows(spark.createDataFrame([(b"GIF89a",), (b"GIF89a",), (b"?",), (None,)], "content binary"))
    assert {(r.ext, r.media_type) for r in media.collect()} == {("gif", "image"), ("bin", "other_media")} and media.count() == 2


PAGE = """<!DOCTYPE html><html><body><h1 id="firstHeading">Iron</h1><div class="mw-parser-output"><!-- c --><div id="toc">toc</div>
<p>Iron is a <a href="/x">metal</a>. It<br> melts.<span style="display:none">hidden</span></p><p><br>lead</p><p></p>
<table class="t"><tr><td colspan="2" rowspan="1"><span class="invslot"><img title="x" alt="Iron Ingot"></span></td><td></td></tr></table>
<div><h2>See also</h2></div><ul><li>gone</li></ul><h3>sub</h3><p>gone</p><h2>Use</h2><pre>a  b</pre><div>26.20<div>Experiment</div></div></div></body></html>"""


def test_wiki_page(spark):
    want = '<h1>Iron</h1>\n<p>Iron is a metal. It<br/> melts.\n</p>\n<p>lead\n</p>\n<table>\n<tr>\n<td colspan="2"> Iron Ingot </td><td></td>\n</tr>\n</table>\n<h2>Use\n</h2>\n<pre>a  b\n</pre> 26.20 Experiment'
    got = wiki_html.plain_html(PAGE)
    squeeze = lambda t: "".join(t.split())
    assert squeeze(got) == squeeze(want)
    assert not any(x in got for x in ("<a", "<img", "class=", "hidden", "gone", "toc"))
    df = spark.createDataFrame([("u", PAGE, "raw"), ("v", None, "r2")], "url string, html string, raw string")
    rows = html_jobs.wiki_text_rows(df, "<!-- v -->\n").collect()
    assert len(rows) == 4 and all(r.text.startswith("<!-- v -->\n") for r in rows)


def test_tree():
    doc = parse("<p>a<p>b</i></p>c<br>d<pre> x\n y </pre>&lt;")
    assert markup(doc) == "<p>a<p>b</p>c<br/>d<pre> x\n y </pre>&lt;</p>"
    assert prettify(parse("<div><p>t &amp; u</p><br></div>")) == "<div>\n <p>\n  t &amp; u\n </p>\n <br/>\n</div>\n"


LAW = """<html><head><title>t</title></head><body><div id="dispositions">no</div><article id="a"><a name="a5a"></a><h6>Art. 5a</h6>
<div>text<sup><a href="#fn-1">1</a></sup></div><div class="footnotes"><p>note</p></div></article><article><p>no anchor</p></article></body></html>"""


def test_law(spark):
    df = spark.createDataFrame([("u", "de", LAW)], "url string, lang string, html string")
    laws = html_jobs.law_html_rows(df)
    plain = laws.first().plain_html
    assert "Art. 5a" in plain and not any(x in plain for x in ("no\n ", "title", "article", "<a"))
    articles = {r.id: r.html for r in html_jobs.law_html_articles(laws).collect()}
    assert set(articles) == {"5a", None} and articles["5a"] == "<h6>\n Art. 5a\n</h6>\ntext\n"
    prompts = spark.createDataFrame([("de", "Was sagt Artikel %ID%?", "W ")], "lang string, prompt string, warning string")
    chat = html_jobs.law_html_chats(html_jobs.law_html_articles(laws), prompts).first().messages
    assert chat[0].content[0].text == "Was sagt Artikel 5a?" and chat[1].text.text.startswith("W <h6>")


def rising(text):
    """The text thrice, behind the MB that the worker holds by now."""
    with open("/proc/self/statm") as f:
        return f"{int(f.read().split()[1]) * 4096 >> 20}|" + text * 3


def test_a_worker_holds_what_a_few_pages_become(spark):
    """Forty pages of a million letters, each made into six million, in one task."""
    pages = spark.range(40).coalesce(1).selectExpr("concat('u', id) url", "repeat('x', 1000000) html")
    rows = html_jobs._converted(pages, ["url"], "page_html string, plain_html string", lambda t: {"page_html": rising(t), "plain_html": t * 3})
    got = rows.select(F.substring_index("page_html", "|", 1).cast("int").alias("mb"), F.length("plain_html").alias("n"), "error").collect()
    assert len(got) == 40 and {r.n for r in got} == {3_000_000} and {r.error for r in got} == {None}
    assert max(r.mb for r in got) - min(r.mb for r in got) < 90


def test_a_worker_holds_little_of_pages_that_become_many_times_their_size(spark):
    """A hundred pages of three thousand letters, less than a piece together, each made into 2.7 million, in one task."""
    pages = spark.range(100).coalesce(1).selectExpr("concat('u', id) url", "repeat('x', 3000) html")
    rows = html_jobs._converted(pages, ["url"], "text string", lambda t: {"text": rising(t * 300)})
    got = rows.select("url", F.substring_index("text", "|", 1).cast("int").alias("mb"), F.length("text").alias("n"), "error").collect()
    assert [r.url for r in got] == [f"u{i}" for i in range(100)] and all(r.n > 2_700_000 and r.error is None for r in got)
    assert max(r.mb for r in got) - min(r.mb for r in got) < 90


def test_deep_pages_are_laid_out_whole_and_in_order(spark):
    """Nested tags are laid out with a space for each level: 58 times the page at a depth of 400. Of a failure only the error stays."""
    deep = [None if i == 7 else "<b>" * (5000 if i == 9 else 10 * i) + f"x{i}" + "</b>" * (10 * i) for i in range(41)]
    df = spark.createDataFrame([(f"u{i}", t) for i, t in enumerate(deep)], "url string, html string").coalesce(1)
    got = html_jobs.wiki_plain_html(df).collect()
    assert [r.url for r in got] == [f"u{i}" for i in range(41)]
    assert {i for i, r in enumerate(got) if r.error} == {9} and got[9].plain is None and got[9].pretty is None and got[7].plain == ""
    for i in (0, 1, 8, 20, 40):
        assert got[i].plain == wiki_html.plain_html(deep[i]) and got[i].pretty == wiki_html.pretty(got[i].plain) and f"x{i}" in got[i].pretty
    assert len(got[40].pretty) > 50 * len(deep[40])


def test_articles(spark):
    news = """<article><header class="entry-header"><h1 class="entry-title">T <b>x</b></h1><time class="entry-date published">1. Mai</time></header>
<div class="entry-content"><p>A <a href="u">link</a> <strong>b</strong><br>c<img></p><div>skip</div><h3>H</h3><ol><li>one</li><li><em>two</em></li></ol></div></article>"""
    assert page_html.article_markdown(news) == "*1. Mai*\n\n# T x\n\nA link **b**\nc\n\n### H\n\n1. one\n2. *two*"
    page = """<main id="content"><nav class="breadcrumb"><li><span itemprop="name">Home</span></li><li><span itemprop="name">Sub</span></li></nav>
<section><div class="section__title"><h2>Why</h2></div><div class="section__text"><p>See <a href="/a">this</a><a class="source">[1]</a></p></div><div class="info_box"><p>note</p></div></section>
<section><div class="section__cross_links"><div class="tile"><h3>Tile</h3><a href="/t">x</a></div></div><div class="list_of_sources"><div class="source_item"><sup class="item">1</sup><div class="list_of_sources__item"><span>Book</span></div><a href="/b">l</a></div></div></section></main>"""
    assert page_html.section_markdown(page) == "> Home / Sub\n\n## Why\n\nSee [this](/a)[1]\n\n> ℹ️ note\n\n- [Tile](/t)\n\n## Quellenverzeichnis\n\n1. Book </b>\n"
    df = spark.createDataFrame([("u", "<div class='text'>a<b>c</b></div>"), ("v", "none")], "url string, html string")
    assert {r.url: (r.text, r.error) for r in html_jobs.first_inner_html(df).collect()} == {"u": ("a<b>c</b>", None), "v": (None, "no match")}
    assert {r.error for r in html_jobs.section_markdown(df).collect()} == {"no main content"}


def test_ingest_twice(spark, tmp_path):
    pages = [(f"https://a.org/{i}", f"<div class='text'>{i}</div>") for i in range(6)] + [("https://b.org/", "x")]
    write = lambda rows: spark.createDataFrame(rows, "url string, html string").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    registry = spark.createDataFrame([("org/a", "text")], "prefix string, handler string")
    handlers = {"text": lambda df: html_jobs.first_inner_html(df).filter("error is null").select("text", F.col("url").alias("source"), F.lit(False).alias("ai_enhanced"))}

    def run():
        stream = spark.readStream.schema("url string, html string").parquet(f"{tmp_path}/in")
        q = incremental_ingest(stream, registry, handlers, f"{tmp_path}/ledger", f"{tmp_path}/text", f"{tmp_path}/cp")
        q.awaitTermination(120)
        return sorted(r.source for r in spark.read.parquet(f"{tmp_path}/text").collect()), sorted(r.source for r in spark.read.parquet(f"{tmp_path}/ledger").collect())

    write(pages)
    first = run()
    assert first[0] == first[1] == sorted(u for u, _ in pages[:6])
    assert run() == first
    write([pages[2], ("https://a.org/new", "<div class='text'>n</div>")])
    text, ledger = run()
    assert text == ledger == sorted([u for u, _ in pages[:6]] + ["https://a.org/new"])


def test_repetition_guard(spark, tmp_path):
    rows = [("loop", i, "again and again the same. ") for i in range(60)] + [("think", 0, "<think>")] + [("think", i, "z" * 40) for i in range(1, 40)] + [("fine", i, f"word{i} ") for i in range(400)]
    rows += [("after", 0, "<think>" + "q" * 600 + "</thi"), ("after", 1, "nk>")] + [("after", i, f"ok{i} ") for i in range(2, 100)]
    spark.createDataFrame(rows, "gen_id string, seq long, token string").repartition(3).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("gen_id string, seq long, token string").parquet(f"{tmp_path}/in")
    q = repetition_guard(stream, timeout=None).writeStream.format("memory").queryName("guard").outputMode("append").trigger(availableNow=True).option("checkpointLocation", f"{tmp_path}/cp").start()
    assert q.awaitTermination(120)
    got = {r.gen_id: (r.verdict, r.pos) for r in spark.sql("select * from guard").collect()}
    assert set(got) == {"loop", "think"} and got["loop"][0] == "response" and got["think"][0] == "thinking"
    whole = "".join(t for _, _, t in sorted(x for x in rows if x[0] == "loop"))
    assert got["loop"][1] == naive_repetition(whole)[0]


def test_guard_does_not_depend_on_batches():
    import random

    from loomspark.operators.generated import repeated_window
    from loomspark.streaming.repetition import first_repetition

    r = random.Random(3)
    streams = [["again and again the same. "] * 60, ["<think>", *["z" * 40] * 39], ["<think>" + "q" * 1200 + "</thi", "nk>", *[f"ok{i} " for i in range(50)]], ["ab" * 5] * 3 + [f"w{r.random()}" for _ in range(900)]]
    streams.append([*["<think>"], *["loop it. "] * 200, "</think>", *[f"fine{i} " for i in range(30)]])
    for tokens in streams:
        pairs = [(t, "") for t in tokens]
        outcomes = set()
        for parts in (1, 2, 7, len(pairs)):
            state, found = ("", "", 0, False, False), None
            size = -(-len(pairs) // parts)
            for k in range(0, len(pairs), size):
                state, found = first_repetition(state, iter(pairs[k : k + size]), "tags")
                if found:
                    break
            outcomes.add((found, state[3:] if found else None))
        assert len(outcomes) == 1
        want = None
        for n in range(1, len(tokens) + 1):  # what a look at the whole text after each token says
            text = "".join(tokens[:n])
            part = text.rpartition("</think>")[2]
            got = repeated_window(part)
            if got:
                want = (len(text) - len(part) + got[0], got[1])
                break
        assert next(iter(outcomes))[0] == want


def test_guard_over_two_fields():
    from loomspark.operators.generated import repeated_window
    from loomspark.streaming.repetition import first_repetition

    for pairs in ([("", "think ")] * 20 + [("say it. ", "")] * 300, [("a b c d. ", "x y. ")] * 300, [(f"c{i} ", f"r{i} ") for i in range(300)]):
        want = None
        for n in range(1, len(pairs) + 1):
            whole = "".join(x for _, x in pairs[:n]) + "".join(x for x, _ in pairs[:n])
            want = repeated_window(whole)
            if want:
                break
        assert first_repetition(("", "", 0, False, False), iter(pairs), "fields")[1] == want


def test_writers_bound_their_files(spark, tmp_path):
    import glob

    import pyarrow.parquet as pq

    rows = spark.createDataFrame([("text", f"{i} " + "x" * 2000, f"s{i}") for i in range(500)], "kind string, text string, source string").withColumn("ai_enhanced", F.lit(None).cast("boolean"))
    rows = rows.withColumn("messages", F.array(chats.message("user", chats.text_content(F.col("text")))))
    sinks.save(rows, f"{tmp_path}/t", f"{tmp_path}/c", "now", target=100_000)
    sizes = [pq.read_metadata(f).num_rows for f in glob.glob(f"{tmp_path}/t/*.parquet")]
    assert sum(sizes) == 500 and max(sizes) <= 50
    assert spark.read.parquet(f"{tmp_path}/t").columns == ["text", "source", "collected_at", "ai_enhanced"]
    sinks.write_text(rows, f"{tmp_path}/t", "now", target=100_000)
    assert spark.read.parquet(f"{tmp_path}/t").count() == 1000


def test_is_repetitive(spark):
    texts = ["again and again the same. " * 60, "short", None, "z" * 900, "z" * 899, "ok " * 20 + "".join(chr(97 + i % 26) + str(i) for i in range(4000))]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, text string")
    got = {r.i: r.bad for r in df.select("i", generated.is_repetitive(F.col("text")).alias("bad")).collect()}
    assert got == {i: naive_repetition(t) is not None if t else False for i, t in enumerate(texts)}


def test_one_row_of_each_url_is_built(spark):
    from loomspark.jobs.build import Registry, build

    seen = spark.createDataFrame([("https://a.org/3",)], "source string")
    pages = spark.createDataFrame([("https://a.org/1", "first", 1), ("https://a.org/1", "second", 2), ("https://a.org/2", "only", 3), ("https://a.org/3", "old", 4), ("https://b.org/1", "none", 5)], "url string, html string, pos long")
    upper = lambda p: p.select(F.col("url").alias("source"), F.upper("html").alias("text"), F.lit(False).alias("ai_enhanced"), F.lit(None).cast("string").alias("error"))
    outputs, outcomes = build(pages, seen, Registry().register("org/a", upper, "upper"))
    assert sorted((r.source, r.text) for r in outputs.collect()) == [("https://a.org/1", "FIRST"), ("https://a.org/2", "ONLY")]
    assert sorted(map(tuple, outcomes.collect())) == [("https://a.org/1", "processed"), ("https://a.org/2", "processed"), ("https://b.org/1", "skipped")]


def test_no_machine_local_scratch_on_a_cluster(spark):
    from types import SimpleNamespace

    from loomspark import session

    away = SimpleNamespace(conf={}, sparkContext=SimpleNamespace(master="spark://host:7077", applicationId="app"))
    with pytest.raises(ValueError, match="checkpoint"):
        session.scratch(away)
    away.conf["spark.checkpoint.dir"] = "hdfs://x/y/"
    assert session.scratch(away).startswith("hdfs://x/y/loomspark/app/")


def test_arrow_batches_are_bounded(spark):
    from loomspark.session import bounded

    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        rows = bounded(spark.range(64).selectExpr("repeat('x', 1000000) t").coalesce(1), 4 << 20)
        assert spark.conf.get(key) == str(4 << 20)
        sizes = rows.mapInArrow(lambda it: (__import__("pyarrow").RecordBatch.from_pydict({"n": [b.nbytes]}) for b in it), "n long").collect()
        assert max(r.n for r in sizes) < 8 << 20
        spark.conf.set(key, "1m")
        bounded(rows)
        assert spark.conf.get(key) == "1m"
    finally:
        spark.conf.set(key, before)


def test_pieces_keep_every_row_in_order():
    import pandas as pd

    from loomspark.session import pieces

    texts = ["aaaa", None, "bb", "c" * 20, "", "dd", "eeeee", "f"]
    batches = [pd.DataFrame({"k": range(8), "t": texts}), pd.DataFrame({"k": [], "t": []}), pd.DataFrame({"k": [8, 9], "t": [None, None]})]
    got = list(pieces(iter(batches), "t", 6))
    assert [list(p.k) for p in got] == [[0, 1, 2], [3], [4, 5], [6, 7], [], [8, 9]]
    assert [k for p in got for k in p.k] == list(range(10))


def test_rows_go_on_with_what_was_made_of_them():
    import pandas as pd

    from loomspark.session import beside, letters

    batch = pd.DataFrame({"k": range(10, 16)}, index=[3, 4, 5, 6, 7, 8])
    made = [{"a": "xx", "b": None}, {"a": "yy", "b": [{"c": "zz", "d": None}]}, {"a": None, "b": None}, {"a": "x" * 50, "b": []}, {"a": "", "b": None}, {"a": "e", "b": None}]
    assert [letters(r) for r in made] == [2, 4, 0, 50, 0, 1]
    parts = list(beside(batch, iter(made), ["a", "b"], 5))
    assert [list(p.k) for p in parts] == [[10, 11], [12, 13], [14, 15]] and [a for p in parts for a in p.a] == [r["a"] for r in made]
    assert list(beside(batch[:0], iter([]), ["a", "b"], 5)) == []


def test_every_query_agrees_with_its_sql(spark, sf):
    import os

    import duckdb

    con = duckdb.connect()
    for f in os.listdir(sf):
        con.execute(f"create view {f.split('.')[0]} as select * from '{sf}/{f}'")
    from loomspark.jobs import more_queries  # noqa: F401
    from loomspark.jobs.queries import ORACLES, QUERIES

    show = lambda v: "-" if v is None or v != v else str(int(v)) if isinstance(v, float) and v.is_integer() else str(v)
    for name, f in QUERIES.items():
        got = f(spark, sf).toPandas()
        assert len(got)
        if name in ORACLES:
            want = con.sql(ORACLES[name]).df()
            c = sorted(got.columns)
            assert c == sorted(want.columns), name
            rows = [sorted(tuple(map(show, r)) for r in x[c].astype(object).where(x[c].notna(), None).itertuples(index=False)) for x in (got, want)]
            assert rows[0] == rows[1], name


def test_entry(spark):
    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
