"""Helpers shared by the training-data operators."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.session import scratch_path

#: A word, everywhere in this subpackage: a run of characters other than the
#: six ASCII white-space characters.
WORD = r"[^\x20\x09-\x0D]+"
WORD_RE = re.compile(WORD)

DOCUMENT_COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet under the shared work folder and read
    back: cuts the lineage, survives lost executors, and keeps columns."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def few(df: DataFrame) -> DataFrame:
    """``df`` in at most four partitions a core, without a shuffle: for tables of
    links and pairs, which are small beside the texts and would otherwise be
    written as a file for each shuffle partition."""
    return df.coalesce(4 * df.sparkSession.sparkContext.defaultParallelism)


#: Bytes of rows that go to a Python worker at a time.
BATCH_BYTES = 4 << 20


def small_batches(spark: SparkSession) -> None:
    """Bounds what goes to a Python worker at a time by its bytes, where the
    session has no such bound of its own.  Spark's 10,000 rows are tens of MB of
    texts, which each worker and its executor hold several times over; rows of
    numbers still go 10,000 at a time.  The setting stays, as results are lazy."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def crc32_of(col) -> F.Column:
    """crc32 of a column's text (null: of the empty text)."""
    return F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary"))


def bit_table(keys: DataFrame, bits: int, name: str) -> DataFrame:
    """A one-row table with the bits (in 64-bit words) of the keys' (column
    ``key``, long) cells, stored; its size, 2^bits bits, is fixed whatever the keys.
    Use with :func:`has_bit`: a key of the table always has its bit, others may."""
    words = (keys.select(F.pmod("key", F.lit(1 << bits)).alias("b"))
             .groupBy(F.floor(F.col("b") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")))
    every = keys.sparkSession.range((1 << bits) // 64).select(F.col("id").cast("int").alias("w")).join(words, "w", "left")
    cells = F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))))
    return stored(every.agg(F.transform(cells, lambda x: x["bits"]).alias("bits")), name)


def has_bit(table: DataFrame, key, bits: int) -> F.Column:
    cell = F.pmod(key, F.lit(1 << bits))
    word = F.element_at(table.scalar(), (F.floor(cell / 64) + 1).cast("int"))
    return F.getbit(word, (cell % 64).cast("int")) == 1
