"""Law tables to text rows and chats: one parse of each act, everything else built in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from loomspark.functions.text import strip_ws
from loomspark.operators.chats import assistant, message, text_content
from loomspark.session import bounded, lookup, pieces

LANGUAGES = ("de", "fr", "it")
_ARTICLES = "array<struct<key:string,article_id:string,eId:string,heading:string,markdown:string,path:string>>"
_META = "struct<sr_number:string,country:string,eli:string,eli_expression:string,language:string,title:string,short_title:string,titles:map<string,string>,dates:map<string,string>>"


def law_xml_convert(rows: DataFrame, convert: Callable[[str, str], dict], pretty: Callable[[str], str]) -> DataFrame:
    """Rows (row_id, title, lang, xml) with pretty_xml, markdown, meta, articles and error instead of xml. A bad act ends no job.

    pretty(xml) lays the XML out; convert(xml, title) gives markdown, meta and articles. Which converter suits a publisher's schema is
    the caller's choice; an act that fails in the second keeps what the first made of it.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches, "xml"):
            made = []
            for title, xml in zip(batch["title"], batch["xml"], strict=True):
                row = dict.fromkeys(("pretty_xml", "markdown", "meta", "articles", "error"))
                try:
                    row["pretty_xml"] = pretty(xml or "")
                    row |= {k: v for k, v in convert(xml or "", title or "").items() if v}
                except Exception as e:  # noqa: BLE001
                    row["error"] = str(e) or type(e).__name__
                made.append(row)
            yield pd.concat([batch[["row_id", "title", "lang"]], pd.DataFrame(made, columns=["pretty_xml", "markdown", "meta", "articles", "error"], index=batch.index)], axis=1)

    kind = dict(rows.dtypes)["row_id"]
    return bounded(rows).select("row_id", "title", "lang", "xml").mapInPandas(run, f"row_id {kind}, title string, lang string, pretty_xml string, markdown string, meta {_META}, articles {_ARTICLES}, error string")


def law_candidates(table: DataFrame) -> DataFrame:
    """Rows (title, language, xml) in a known language that hold an act: title, lang, xml."""
    lang = strip_ws(F.lower("language"))
    junk = F.contains("xml", F.lit("<no-script>")) & F.contains("xml", F.lit("<!DOCTYPE html>")) | (F.length("xml") < 16)
    return table.select("title", lang.alias("lang"), "xml").filter(F.col("lang").isin(*LANGUAGES) & ~F.coalesce(junk, F.lit(True)))


def law_csv_rows(table: DataFrame, source: str, prompts: DataFrame, convert: Callable[[str, str], dict], pretty: Callable[[str], str]) -> DataFrame:
    """Law table to kind, text, messages, source, ai_enhanced: the XML, the Markdown, and a chat for each article.

    prompts: lang, prompt with %TITLE% and %ID%, warning. Of an act that fails midway the XML row stays.
    """
    acts = law_xml_convert(law_candidates(table).withColumn("row_id", F.lit(0)), convert, pretty)
    acts = acts.join(lookup(prompts), "lang")
    asked = F.replace(F.replace("prompt", F.lit("%TITLE%"), F.coalesce("title", F.lit(""))), F.lit("%ID%"), F.col("a.key"))
    return _fan_out(acts, asked, source)


def _fan_out(acts: DataFrame, asked: Column, source: str) -> DataFrame:
    """One pass over the converted acts: each gives its two texts and its articles' chats."""
    none = F.lit(None).cast(_ARTICLES.removeprefix("array<").removesuffix(">"))
    texts = F.array(F.struct(F.lit("text").alias("kind"), F.col("pretty_xml").alias("text"), none.alias("a")), F.struct(F.lit("text").alias("kind"), F.col("markdown").alias("text"), none.alias("a")))
    each = F.transform(F.coalesce("articles", F.array().cast(_ARTICLES)), lambda a: F.struct(F.lit("chat").alias("kind"), F.lit(None).cast("string").alias("text"), a.alias("a")))
    rows = acts.select("title", "prompt", "warning", F.explode(F.concat(texts, each)).alias("r")).select("title", "prompt", "warning", "r.*")
    rows = rows.filter("kind = 'chat' or text is not null")
    chat = F.array(message("user", text_content(asked)), assistant(F.concat(F.lit("**"), F.col("warning"), F.lit("**\n\n"), F.col("a.markdown"))))
    return rows.select("kind", "text", F.when(F.col("kind") == "chat", chat).alias("messages"), F.lit(source).alias("source"), F.lit(False).alias("ai_enhanced"))


def articles_payload(acts: DataFrame, flat: bool = False, rich: bool = False) -> DataFrame:
    """row_id, payload: JSON of the map of articles, plain Markdown or whole records; with the metadata around it unless flat."""
    pairs = F.transform("articles", lambda a: F.struct(a["key"], a if rich else a["markdown"]))
    articles = F.map_from_entries(pairs)
    return acts.select("row_id", F.to_json(articles if flat else F.struct("meta", articles.alias("articles"))).alias("payload"))
