"""Token counts through a digest cache.

Each text has a digest of its normalised content (null becomes the empty text;
nothing else, as any other change could change a count).  A Parquet table keyed
by that digest and by the digest of the tokenizer (its file's bytes and the
library's version) holds the counts found so far.  Only digests that the table
lacks are encoded, once each however many rows share them, and appended to it.

Defined results: a null text counts as empty (0 bytes, 0 tokens); repeated
rows and null ids each keep their row; an empty table gives an empty result;
other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.llm.common import stored, table
from tidemark.llm.encode import encoder, public_tokenizer
from tidemark.session import scratch_path

CACHE_SCHEMA = T.StructType([
    T.StructField("digest", T.BinaryType()),
    T.StructField("n_tokens", T.LongType()),
])


def tokenizer_digest(path: str) -> str:
    """Of the tokenizer's version: its file and the library that reads it."""
    import tokenizers

    with open(path, "rb") as f:
        return hashlib.sha256(f.read() + tokenizers.__version__.encode()).hexdigest()[:32]


def content_digest(text) -> F.Column:
    return F.unhex(F.sha2(F.coalesce(text, F.lit("")), 256))


def _cache(spark: SparkSession, folder: str) -> DataFrame:
    """The stored counts; empty before the first append.  A digest that two
    jobs have appended counts once."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return spark.createDataFrame([], CACHE_SCHEMA)
    return spark.read.schema(CACHE_SCHEMA).parquet(folder).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def token_counts(docs: DataFrame, cache: str, tokenizer: str | None = None,
                 id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_bytes, n_tokens of every row.  ``cache``: a folder that all
    executors share; it gets one subfolder per tokenizer version."""
    spark = docs.sparkSession
    tokenizer = tokenizer or public_tokenizer()
    folder = f"{cache.rstrip('/')}/tokenizer={tokenizer_digest(tokenizer)}"
    text = F.coalesce(F.col(text_col), F.lit(""))
    keyed = docs.select(F.col(id_col).alias("doc_id"), text.alias("text")).withColumn("digest", content_digest(F.col("text")))
    narrow = keyed.select("doc_id", "digest", F.octet_length("text").cast("long").alias("n_bytes"))

    # one row per missing digest, found without its text: a group of copies,
    # however large, reaches the shuffle as one row per task
    missing = (narrow.groupBy("digest").agg(F.min("doc_id").alias("doc_id"))
               .join(_cache(spark, folder), "digest", "left_anti"))
    # its text: a join on both columns, so that copies spread over the tasks
    to_encode = keyed.hint("merge").join(
        missing.select(F.col("digest").alias("d"), F.col("doc_id").alias("i")),
        (F.col("digest") == F.col("d")) & F.col("doc_id").eqNullSafe(F.col("i")), "left_semi").select("digest", "text")

    def encode(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(tokenizer)
        for b in batches:
            own = b.drop_duplicates("digest")  # repeated rows of one id
            yield pd.DataFrame({"digest": own["digest"],
                                "n_tokens": [len(x) // 4 for x in e.ids(own["text"].tolist())]})

    to_encode.mapInPandas(encode, CACHE_SCHEMA).write.mode("append").parquet(folder)
    # the counts of these digests, stored: a join of two plain scans, in which
    # Spark splits the rows of a digest that many documents share
    counts = stored(_cache(spark, folder).join(narrow.select("digest").distinct(), "digest", "left_semi"), "counts")
    return narrow.hint("merge").join(counts, "digest", "left").select("doc_id", "n_bytes", "n_tokens")


def op4_token_counts(spark: SparkSession, sf_dir: str, limit: int = 1024) -> DataFrame:
    """The query starts from an empty cache of its own, so that each run counts
    the whole table itself; jobs keep one cache and pass its folder."""
    counts = token_counts(table(spark, sf_dir, "documents"), scratch_path(spark, "token-cache"))
    return counts.withColumn("over_limit", F.col("n_tokens") > limit)
