"""What the operators share: tables, scratch tables, partition counts, Arrow batches bounded by bytes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loomspark import session
from loomspark.session import materialize, table
from loomspark.session import scratch as shared_dir

__all__ = ["bounded", "materialize", "partitions", "shared_dir", "sieve", "spread", "table"]

#: Bytes of the Arrow batches that go to Python workers, about; one row at least.
BATCH_BYTES = 8 << 20
#: Bits of a sieve for each id, at least while that is not more than so many in all (8 MB).
SIEVE, SIEVE_MOST = 32, 1 << 26


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def spread(df: DataFrame) -> DataFrame:
    """df over all cores, where its files give fewer partitions than there are: one small file is one task otherwise."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df if df.rdd.getNumPartitions() >= cores else df.repartition(cores)


def bounded(df: DataFrame) -> DataFrame:
    """df, with the session's bound on the bytes of an Arrow batch lowered: rows are counted by thousands otherwise, and ten thousand long
    texts are more than a worker may hold."""
    return session.bounded(df, BATCH_BYTES)


def sieve(rows: DataFrame, ids: DataFrame, by: str) -> DataFrame:
    """Every row whose ``by``, never null, is among those of ids, and a few others: one in 32 or so, more beyond 2 million ids.

    For large rows of which few are then joined: bitmaps of hashes, of a size that the corpus can't move, are broadcast, and the rows that
    can't match are not shuffled.
    """
    bits = 1 << 15
    wanted = min(SIEVE * ids.count(), SIEVE_MOST)
    while bits < wanted:
        bits *= 2
    slot = F.pmod(F.xxhash64(by), F.lit(bits))
    bitmap, bit = F.bitmap_bucket_number(slot), F.bitmap_bit_position(slot)
    made = ids.groupBy(bitmap.alias("__bitmap")).agg(F.bitmap_construct_agg(bit).alias("__bits"))
    byte = F.conv(F.hex(F.substring("__bits", (F.shiftright(bit, 3) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    found = rows.join(F.broadcast(made), bitmap == F.col("__bitmap")).filter(F.getbit(byte, (bit % 8).cast("int")) == 1)
    return found.select(*rows.columns)
