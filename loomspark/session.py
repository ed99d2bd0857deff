"""Session helpers: the folder that a cluster shares, tables written there, partition counts, checked broadcasts."""

from __future__ import annotations

import atexit
import functools
import re
import shutil
import tempfile
import uuid
from collections.abc import Iterable, Iterator
from typing import TYPE_CHECKING

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

if TYPE_CHECKING:
    import pandas as pd

#: Rows up to which a lookup table is broadcast.
SMALL = 100_000
#: Bytes of the Arrow batches that go to Python workers, about, and characters of text that one step there holds, and of what it makes of them.
BATCH_BYTES, PIECE = 8 << 20, 1 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@functools.lru_cache(maxsize=1)
def _temporary() -> str:
    root = tempfile.mkdtemp(prefix="loomspark-")
    atexit.register(shutil.rmtree, root, ignore_errors=True)
    return root


def scratch(spark: SparkSession) -> str:
    """A new folder of this application under the one that the cluster shares, spark.checkpoint.dir.

    Without that setting only a local master has a temporary folder to write to; elsewhere executors would not see each other's files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.split("[")[0] == "local":
            raise ValueError("set spark.checkpoint.dir to a folder that all nodes share")
        root = _temporary()
    return f"{root.rstrip('/')}/loomspark/{spark.sparkContext.applicationId}/{uuid.uuid4().hex}"


def clear_scratch(spark: SparkSession) -> None:
    """Delete this application's scratch tables. Results that were read from them and not written yet are lost: call it at the end."""
    root = scratch(spark).rsplit("/", 1)[0]
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(root)
    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, by: str | None = None) -> DataFrame:
    """Write to the shared folder and read back; by: a column whose values are folders, so that a filter on it reads only these."""
    path = scratch(df.sparkSession)
    (df.write.partitionBy(by) if by else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def bounded(df: DataFrame, most: int = BATCH_BYTES) -> DataFrame:
    """df, with the session's bound on the bytes of the Arrow batches that go to Python lowered to ``most`` unless it is lower already."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    number, unit = re.fullmatch(r"(-?\d+)\s*([kmgtp]?)i?b?", df.sparkSession.conf.get(key).lower()).groups()
    if not 0 < int(number) << 10 * " kmgtp".index(unit or " ") <= most:
        df.sparkSession.conf.set(key, str(most))
    return df


def pieces(batches: Iterator[pd.DataFrame], column: str, most: int = PIECE) -> Iterator[pd.DataFrame]:
    """The rows of each batch a few at a time: as many as have about ``most`` characters in a text column, one at least.

    A worker that makes several times its input then holds that for a piece, not for a batch.
    """
    for batch in batches:
        start = held = 0
        for i, text in enumerate(batch[column]):
            held += len(text or "")
            if held > most and i > start:
                yield batch.iloc[start:i]
                start, held = i, len(text or "")
        yield batch.iloc[start:]


def letters(value: object) -> int:
    """Characters of a text, or of all texts in a list or dict."""
    if isinstance(value, dict):
        return sum(map(letters, value.values()))
    if isinstance(value, list):
        return sum(map(letters, value))
    return len(value) if isinstance(value, str) else 0


def beside(batch: pd.DataFrame, made: Iterable[dict], columns: list[str], most: int = PIECE) -> Iterator[pd.DataFrame]:
    """The rows of a batch, each with the columns made of it, handed on as soon as what was made has more than ``most`` characters.

    So a worker holds no more than that and one row's, however many times its input a row becomes (deep trees, laid out, grow with their depth squared).
    """
    import pandas as pd

    rows, start, held = [], 0, 0
    for end, row in enumerate(made, 1):
        rows.append(row)
        held += letters(row)
        if held > most or end == len(batch):
            part = batch.iloc[start:end]
            yield pd.concat([part, pd.DataFrame(rows, columns=columns, index=part.index)], axis=1)
            rows, start, held = [], end, 0


def lookup(df: DataFrame, limit: int = SMALL) -> DataFrame:
    """df marked for broadcast if it has at most ``limit`` rows; a larger one is joined by shuffle."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def with_rank(df: DataFrame, by: list[str], order: list[str], name: str) -> DataFrame:
    """Number the rows of each key 0, 1, ... in an order, without gathering a key in one task.

    Rows are range-sorted by key and order, so a large key spans many partitions; each partition then needs only the number of
    rows of that key in the partitions ahead of it.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    keys = [*by, *order]
    rows = df.repartitionByRange(n, *keys).sortWithinPartitions(*keys)
    rows = materialize(rows.withColumns({"__part": F.spark_partition_id(), "__seq": F.monotonically_increasing_id()}))
    runs = rows.groupBy("__part", *by).agg(F.min("__seq").alias("__first"), F.count("*").alias("__n"))
    ahead = W.partitionBy(*by).orderBy("__part").rowsBetween(W.unboundedPreceding, -1) if by else W.partitionBy(F.lit(0)).orderBy("__part").rowsBetween(W.unboundedPreceding, -1)
    runs = runs.withColumn("__ahead", F.coalesce(F.sum("__n").over(ahead), F.lit(0)))
    runs = runs.select(F.col("__part").alias("__p"), *[F.col(c).alias(f"__k{i}") for i, c in enumerate(by)], "__first", "__ahead")
    same = F.col("__part") == F.col("__p")
    for i, c in enumerate(by):
        same &= F.col(c).eqNullSafe(F.col(f"__k{i}"))
    if not by:  # one row for each partition
        runs = F.broadcast(runs)
    return rows.join(runs, same).select(*df.columns, (F.col("__seq") - F.col("__first") + F.col("__ahead")).alias(name))
