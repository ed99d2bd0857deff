"""Pages to text rows and chats. The tree work of a page is one vectorised helper for each job; the rest is built in."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loomspark.functions import page_html, wiki_html
from loomspark.operators.chats import assistant, message, text_content
from loomspark.session import beside, bounded, lookup, pieces

#: Plain HTML of an article that makes a chat is shorter than this. Fixed value.
ARTICLE_MOST = 100


def _converted(pages: DataFrame, keep: list[str], made: str, convert: Callable[[str], dict]) -> DataFrame:
    """pages (keep, html) with the fields that convert makes of each html, and error where it can't. A failure ends no job."""
    names = [x.split()[0] for x in made.split(", ")]

    def one(text: str | None) -> dict:
        try:
            return convert(text or "") | {"error": None}
        except Exception as e:  # noqa: BLE001
            return dict.fromkeys(names) | {"error": str(e) or type(e).__name__}

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in pieces(batches, "html"):
            yield from beside(batch[keep], map(one, batch["html"]), [*names, "error"])

    kinds = dict(pages.dtypes)
    schema = ", ".join(f"`{c}` {kinds[c]}" for c in keep) + f", {made}, error string"
    return bounded(pages).select(*keep, "html").mapInPandas(run, schema)


def wiki_plain_html(pages: DataFrame, keep: list[str] | None = None) -> DataFrame:
    """Pages (url, html) to url (or the columns to keep), plain, pretty, error."""

    def convert(text: str) -> dict:
        plain = wiki_html.plain_html(text)
        return {"plain": plain, "pretty": wiki_html.pretty(plain)}

    return _converted(pages, keep or ["url"], "plain string, pretty string", convert)


def wiki_text_rows(pages: DataFrame, version: str) -> DataFrame:
    """Pages (url, html, raw) to text, source, ai_enhanced: the raw text and the plain HTML, each behind a line on the version.

    Where the HTML can't be converted the raw row is there all the same.
    """
    both = wiki_plain_html(pages, keep=["url", "raw"])
    texts = F.when(F.col("error").isNull(), F.array("raw", "pretty")).otherwise(F.array("raw"))
    texts = F.transform(texts, lambda t: F.concat(F.lit(version), t))
    return both.select(F.explode(texts).alias("text"), F.col("url").alias("source"), F.lit(False).alias("ai_enhanced"))


def law_html_rows(pages: DataFrame) -> DataFrame:
    """Pages (url, lang, html) to url, lang, page_html, plain_html, articles array<struct<id, html>>, error."""

    def convert(text: str) -> dict:
        page, plain, articles = page_html.law_page(text)
        return {"page_html": page, "plain_html": plain, "articles": articles}

    return _converted(pages, ["url", "lang"], "page_html string, plain_html string, articles array<struct<id:string,html:string>>", convert)


def law_html_articles(laws: DataFrame) -> DataFrame:
    """Rows of law_html_rows to url, lang, id, html; articles without an anchor have a null id."""
    return laws.select("url", "lang", F.explode("articles").alias("a")).select("url", "lang", "a.*")


def law_html_chats(articles: DataFrame, prompts: DataFrame, most: int = ARTICLE_MOST) -> DataFrame:
    """Short articles to messages, source, ai_enhanced. prompts: lang, prompt with %ID%, warning."""
    short = articles.filter((F.length("html") < most) & F.col("id").isNotNull()).join(lookup(prompts), "lang")
    made = F.array(message("user", text_content(F.replace("prompt", F.lit("%ID%"), F.col("id")))), assistant(F.concat("warning", "html")))
    return short.select(made.alias("messages"), F.col("url").alias("source"), F.lit(False).alias("ai_enhanced"))


def article_markdown(pages: DataFrame) -> DataFrame:
    return _converted(pages, ["url"], "text string", lambda t: {"text": page_html.article_markdown(t)})


def section_markdown(pages: DataFrame) -> DataFrame:
    return _converted(pages, ["url"], "text string", lambda t: {"text": page_html.section_markdown(t)})


def first_inner_html(pages: DataFrame, where: str = "div.text") -> DataFrame:
    """Inner HTML of the first match of ``tag``, ``tag.class`` or ``tag#id``: url, text, error."""
    return _converted(pages, ["url"], "text string", lambda t: {"text": page_html.inner_html(t, where)})
