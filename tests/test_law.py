"""Law tables: candidates, fan-out to text rows and chats, payloads; the converter is the caller's."""

import json
import xml.etree.ElementTree as ET

from pyspark.sql import functions as F

from loomspark.operators import law_jobs


def act(*articles):
    return "<act>" + "".join(f"<article id='{i}'>{t}</article>" for i, t in articles) + "</act>"


def convert(xml, title):
    found = [{"key": f"Art. {a.get('id')}", "article_id": a.get("id"), "eId": f"art_{a.get('id')}", "heading": "", "markdown": f"### {a.text}", "path": title} for a in ET.fromstring(xml)]
    return {"markdown": f"# {title}", "meta": {"language": "de", "titles": {}, "dates": {}}, "articles": found}


def pretty(xml):
    return xml.replace("><", ">\n<")


def test_law_rows(spark):
    good = act((1, "Zweck"), (2, "Ort"), ("2a", "Zeit"))
    table = spark.createDataFrame([("T", " DE ", good), ("U", "fr", "<a><b>cut without an end"), ("V", "en", good), ("W", "it", "short"), ("X", "fr", "<no-script></no-script><!DOCTYPE html>"), ("title", "language", "xml of the header row"), ("Y", "de", None)], "title string, language string, xml string")
    prompts = spark.createDataFrame([("de", "Artikel %ID% von `%TITLE%`?", "Achtung"), ("fr", "Article %ID%?", "Attention")], "lang string, prompt string, warning string")
    rows = law_jobs.law_csv_rows(table, "src", prompts, convert, pretty).collect()
    assert [r.kind for r in rows].count("text") == 3 and [r.kind for r in rows].count("chat") == 3
    assert {r.text for r in rows if r.kind == "text"} == {pretty(good), "# T", "<a>\n<b>cut without an end"}
    chats = {r.messages[0].content[0].text: r.messages[1].text.text for r in rows if r.kind == "chat"}
    assert chats["Artikel Art. 1 von `T`?"] == "**Achtung**\n\n### Zweck" and len(chats) == 3
    acts = law_jobs.law_xml_convert(spark.createDataFrame([(1, "T", "de", good), (2, "U", "fr", "<a><b>cut"), (3, None, "de", None)], "row_id long, title string, lang string, xml string"), convert, pretty)
    assert {r.row_id: r.error is None for r in acts.collect()} == {1: True, 2: False, 3: False}
    one = acts.filter("row_id = 1")
    assert set(json.loads(law_jobs.articles_payload(one, flat=True).first().payload)) == {"Art. 1", "Art. 2", "Art. 2a"}
    rich = json.loads(law_jobs.articles_payload(one, rich=True).first().payload)
    assert rich["meta"]["language"] == "de" and rich["articles"]["Art. 2a"]["eId"] == "art_2a"


def held(xml):
    """The xml thrice, behind the MB that the worker holds by now."""
    with open("/proc/self/statm") as f:
        return f"{int(f.read().split()[1]) * 4096 >> 20}|" + xml * 3


def test_a_worker_holds_what_a_few_acts_become(spark):
    """Forty acts of a million letters, each made into some ten million, in one task."""
    rows = spark.range(40).coalesce(1).selectExpr("id row_id", "'T' title", "'de' lang", "repeat('x', 1000000) xml")
    articles = lambda xml, _: {"markdown": xml * 3, "articles": [{"key": str(i), "markdown": xml + str(i)} for i in range(4)]}
    got = law_jobs.law_xml_convert(rows, articles, held).select(F.substring_index("pretty_xml", "|", 1).cast("int").alias("mb"), F.length("pretty_xml").alias("n"), F.size("articles").alias("a"))
    got = got.collect()
    assert len(got) == 40 and {r.a for r in got} == {4} and min(r.n for r in got) > 3_000_000
    assert max(r.mb for r in got) - min(r.mb for r in got) < 110
