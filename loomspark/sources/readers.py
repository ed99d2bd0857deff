"""Readers of url lists, ledgers, file trees, law tables, published chats, learning sets."""

from __future__ import annotations

import json
import os
import re
import zlib
from collections.abc import Iterable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, Filter, InputPartition, LessThan, LessThanOrEqual, StringEndsWith, StringStartsWith
from pyspark.sql.types import StructType

from loomspark.functions.text import strip_ws


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """url, pos: a line counts unless it is blank or starts with #; pos grows within a file."""
    lines = spark.read.text(path).withColumn("pos", F.monotonically_increasing_id())
    return lines.filter(~F.startswith("value", F.lit("#"))).select(strip_ws(F.col("value")).alias("url"), "pos").filter("url != ''")


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """source: the distinct lines of a ledger; none where the file is missing."""
    try:
        lines = spark.read.text(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], "source string")
    return lines.select(strip_ws(F.col("value")).alias("source")).filter("source != ''").distinct()


def read_comment_styles(spark: SparkSession, path: str) -> DataFrame:
    """key, line, open, close: comment marks for suffixes (``.x``) or whole names, from lines of JSON with these fields.

    Keys come in lower case, each once: of lines of one key the least (line, open, close), nulls first. Lines without a key, or with neither
    line nor open, say nothing. A block mark without close has an empty one.
    """
    rows = spark.read.schema("key string, line string, open string, close string").json(path)
    rows = rows.filter(F.col("key").isNotNull() & F.coalesce("line", "open").isNotNull())
    close = F.when(F.col("line").isNull(), F.coalesce("close", F.lit("")))
    style = F.struct("line", "open", close.alias("close"))
    return rows.groupBy(F.lower("key").alias("key")).agg(F.min(style).alias("s")).select("key", "s.*")


class _Part(InputPartition):
    """One of ``ways`` shares of a folder's files: of all below it, or only of those that lie in it."""

    def __init__(self, folder: str, deep: bool, share: int, ways: int):
        self.folder, self.deep, self.share, self.ways = folder, deep, share, ways


class _TreeReader(DataSourceReader):
    def __init__(self, root: str, depth: int, ways: int, with_content: bool):
        self.root, self.depth, self.ways, self.with_content = root, depth, ways, with_content
        self.endings: list[str] = []
        self.starts: list[str] = []
        self.most: list[float] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Endings and beginnings of paths, and bounds on sizes, are judged before a file is opened."""
        for f in filters:
            if isinstance(f, StringEndsWith) and f.attribute == ("path",):
                self.endings.append(f.value)
            elif isinstance(f, StringStartsWith) and f.attribute == ("path",):
                self.starts.append(f.value)
            elif isinstance(f, (LessThan, LessThanOrEqual)) and f.attribute == ("size",):
                self.most.append(f.value - isinstance(f, LessThan))
            else:
                yield f

    def partitions(self) -> list[InputPartition]:
        """``ways`` for each folder ``depth`` levels down, and as many for the files of each folder above. The driver lists these levels
        alone and asks for no file; tasks walk the rest, and of one folder, however many files lie in it, each opens its share."""
        parts, level = [], [self.root]
        for _ in range(self.depth):
            parts += [(folder, False) for folder in level]
            level = [e.path for folder in level for e in os.scandir(folder) if e.name != ".git" and e.is_dir(follow_symlinks=False)]
        return [_Part(folder, deep, k, self.ways) for folder, deep in [*parts, *((folder, True) for folder in level)] for k in range(self.ways)]

    def read(self, partition: _Part) -> Iterator[tuple]:
        for folder, names, files in os.walk(partition.folder):
            names[:] = sorted(n for n in names if n != ".git") if partition.deep else []
            for name in sorted(files):
                path = os.path.join(folder, name)
                inner = os.path.relpath(path, self.root)
                if name == ".git" or zlib.crc32(inner.encode("utf-8", "surrogateescape")) % partition.ways != partition.share:
                    continue
                if not all(inner.endswith(x) for x in self.endings) or not all(inner.startswith(x) for x in self.starts) or not os.path.isfile(path):
                    continue
                size = os.path.getsize(path)
                if any(size > most for most in self.most):
                    continue
                if not self.with_content:
                    yield inner, size
                    continue
                with open(path, "rb") as f:
                    yield inner, size, f.read()


class FileTree(DataSource):
    """Format ``file_tree``: path (relative), size, content of all regular files below ``path`` but those in .git. Hidden files and those
    with a leading underscore are there, which Spark's own file sources leave out. ``depth``: levels of folders that become partitions, 1
    for a folder of repositories; ``ways``: tasks that share a folder's files; ``listing``: no content. The tree must be mounted on every
    node."""

    @classmethod
    def name(cls) -> str:
        return "file_tree"

    def _listing(self) -> bool:
        return self.options.get("listing", "false").lower() == "true"

    def schema(self) -> str:
        return "path string, size long" + ", content binary" * (not self._listing())

    def reader(self, schema: StructType) -> DataSourceReader:
        root = re.sub("^file:(//)?(?=/)", "", self.options["path"])
        return _TreeReader(root, int(self.options.get("depth", 1)), int(self.options.get("ways", 1)), not self._listing())


def read_file_tree(spark: SparkSession, root: str, depth: int = 1, ways: int | None = None, listing: bool = False) -> DataFrame:
    """path, size, content (none for a listing) of the files below root. Filters on how a path begins or ends and on a greatest size keep files
    from being opened. ways: tasks for each folder, as many as the cluster has cores unless told."""
    spark.dataSource.register(FileTree)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")  # off by default; of use to data sources in Python alone
    options = {"depth": depth, "ways": ways or spark.sparkContext.defaultParallelism, "listing": listing}
    return spark.read.format("file_tree").options(**options).load(root)


def read_law_csv(spark: SparkSession, path: str) -> DataFrame:
    """c0, title, c2, language, c4, xml by position; fields may span lines; no line is taken for a header."""
    schema = "c0 string, title string, c2 string, language string, c4 string, xml string"
    return spark.read.csv(path, schema=schema, multiLine=True, quote='"', escape='"', header=False, maxCharsPerColumn=10 << 20)


def read_instruct(spark: SparkSession, path: str) -> DataFrame:
    schema = "messages array<struct<role:string,content:string,attachments:array<struct<type:string,value:string>>>>, mistakes boolean"
    return spark.read.schema(schema).parquet(path)


def read_learning_sets(spark: SparkSession, path: str) -> DataFrame:
    """url (the file), json (its whole text)."""
    return spark.read.text(path, wholetext=True).select(F.input_file_name().alias("url"), F.col("value").alias("json"))


def learning_pairs(sets: DataFrame) -> DataFrame:
    """Sets (url, json) that are lists to source, question, answer; others give no row."""
    items = F.when(F.startswith(F.ltrim("json"), F.lit("[")) & F.try_parse_json("json").isNotNull(), F.from_json("json", "array<struct<question:string,answer:string>>"))
    pairs = sets.select(F.col("url").alias("source"), F.explode(items).alias("p")).select("source", "p.*")
    return pairs.filter("question is not null and answer is not null")


def learning_set_rows(sets: DataFrame) -> DataFrame:
    """Sets (url, json) to text, source, ai_enhanced, error: the JSON twice, with letters as they are and escaped to ASCII; one row
    with an error where it can't be read."""

    def lay_out(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = []
            for text in batch:
                try:
                    value = json.loads(text or "")
                    rows.append(([json.dumps(value, indent=2, ensure_ascii=ascii_only) for ascii_only in (False, True)], None))
                except ValueError as e:
                    rows.append(([None], str(e)))
            yield pd.DataFrame(rows, columns=["texts", "error"])

    made = sets.select("url", F.pandas_udf(lay_out, "texts array<string>, error string")("json").alias("r"))
    return made.select(F.explode("r.texts").alias("text"), F.col("url").alias("source"), F.lit(False).alias("ai_enhanced"), "r.error")
