"""Column functions on URLs, lenient where a URL is not well formed."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_START = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?"


def url_netloc(url: Column) -> Column:
    """Authority with user and port, case kept; empty where there is none."""
    return F.regexp_extract(url, _START + r"//([^/?#]*)", 1)


def url_path(url: Column) -> Column:
    """Path up to ? or #, without parameters of the last segment."""
    return F.regexp_replace(F.regexp_extract(url, _START + r"(?://[^/?#]*)?([^?#]*)", 1), r";[^/]*$", "")


def path_segments(url: Column) -> Column:
    return F.array_remove(F.split(url_path(url), "/"), "")


def candidate_prefixes(url: Column) -> Column:
    """Reversed host labels with the first n, n - 1, ... 0 path segments; dots count as separators."""
    host = F.array_join(F.reverse(F.split(url_netloc(url), r"\.")), "/")
    parts = path_segments(url)
    steps = F.sequence(F.size(parts), F.lit(0), F.lit(-1))
    return F.transform(steps, lambda i: F.translate(F.array_join(F.concat(F.array(host), F.slice(parts, 1, i)), "/"), ".", "/"))


def is_pdf_source(url: Column) -> Column:
    return F.endswith(F.substring_index(url, "?", 1), F.lit(".pdf"))


def parse_repo_url(url: Column, host: str = "github.com") -> Column:
    """struct(owner, repo, branch, error): branch is what follows /tree/, null for the whole repository."""
    parts = path_segments(url)
    branch = F.array_join(F.slice(parts, 4, F.greatest(F.size(parts) - 3, F.lit(0))), "/")
    is_tree = (F.size(parts) > 2) & (F.get(parts, F.lit(2)) == "tree")
    error = F.when(F.lower(url_netloc(url)) != host, F.lit("host")).when(F.size(parts) < 2, F.lit("owner or repository")).when(is_tree & (branch == ""), F.lit("branch"))
    ok = error.isNull()
    return F.struct(F.when(ok, F.get(parts, F.lit(0))).alias("owner"), F.when(ok, F.get(parts, F.lit(1))).alias("repo"), F.when(ok & is_tree, branch).alias("branch"), error.alias("error"))


def download_url(url: Column, kind: str, lang: str | None = None) -> Column:
    """Where the content of a source lies: preview pages of files and sets, raw wiki text, another language of a law."""
    if kind == "document":
        return F.concat(F.replace(url, F.lit("dokumente/vorschau"), F.lit("dateien/dokumente")), F.lit("/file.pdf"))
    if kind == "learning_set":
        return F.concat(F.replace(url, F.lit("lernsets/vorschau"), F.lit("dateien/lernsets")), F.lit("/file.json"))
    if kind == "wiki":
        return F.concat(url, F.lit("?action=raw"))
    if kind == "law":
        return F.replace(url, F.lit("de"), F.lit(lang))
    raise ValueError(f"unknown kind {kind!r}")
