"""Packing by first-fit decreasing, in randomised groups of pieces.

Each document (its ids, then the end id) is cut into pieces of the sequence
length and one remainder.  Documents are dealt at random into groups of bounded
size (one longer than a group is dealt in parts); in each group, first-fit decreasing places the pieces, longest first,
into the first sequence with room, found through a tournament tree over the
sequences' free capacities.  Only lengths and digests are shuffled, never ids.

Defined results: a null or empty text is the end id alone; repeated rows and
null ids are packed row by row; an empty table gives an empty result; other
columns of the input are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import small_batches, stored, table
from tidemark.llm.encode import encoder, public_tokenizer

SEQUENCE = 2048
END_ID = 1
#: Pieces per group, on average, and of one document in a group at most: bounds
#: a task's work; a group leaves at most about one sequence part empty.
GROUP_PIECES = 2000
_PIECES = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long"


def first_fit_decreasing(lengths, capacity: int) -> tuple[np.ndarray, np.ndarray]:
    """(bin, offset) of each length.  The tournament tree's leaves are the
    bins' free capacities and each inner node holds the larger of its two, so
    the first bin with room is found by one descent."""
    lengths = np.asarray(lengths, np.int64)
    n = len(lengths)
    size = 1
    while size < max(1, n):
        size *= 2
    tree = [capacity] * (2 * size)
    bins, offsets = np.empty(n, np.int64), np.empty(n, np.int64)
    for i in np.argsort(-lengths, kind="stable").tolist():
        need, node = int(lengths[i]), 1
        while node < size:
            node *= 2
            if tree[node] < need:
                node += 1
        bins[i], offsets[i] = node - size, capacity - tree[node]
        tree[node] -= need
        while node > 1:
            node //= 2
            a, b = tree[2 * node], tree[2 * node + 1]
            top = a if a > b else b
            if tree[node] == top:
                break
            tree[node] = top
    return bins, offsets


def pieces(docs: DataFrame, tokenizer: str, sequence: int = SEQUENCE, end_id: int = END_ID) -> DataFrame:
    """Every piece of every document, with the digest of its ids and the
    number of the document's row."""
    end = int(end_id).to_bytes(4, "little")

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        e = encoder(tokenizer)
        for b in batches:
            rows = []
            for doc_id, row, ids in zip(b["doc_id"].tolist(), b["row"].tolist(), e.ids(b["text"].tolist())):
                ids += end
                n = len(ids) // 4
                rows += [(doc_id, at, min(sequence, n - at), zlib.crc32(ids[4 * at : 4 * (at + sequence)]), n, row)
                         for at in range(0, n, sequence)]
            out = pd.DataFrame(rows, columns=["doc_id", "start", "length", "ids_crc32", "doc_tokens", "row"])
            yield out.astype({"doc_id": "Int64"})

    small_batches(docs.sparkSession)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("row"))
    return rows.mapInPandas(cut, f"{_PIECES}, row long")


def packed(docs: DataFrame, tokenizer: str | None = None, sequence: int = SEQUENCE,
           group_pieces: int = GROUP_PIECES, seed: int = 5) -> DataFrame:
    """One row per piece with its sequence and its offset there.

    Groups are dealt by a hash of the document's row number, so neither a
    repeated document nor a hot source makes a group large; the pieces are
    stored with it, so a retried task deals the same groups.
    """
    cut = stored(pieces(docs, tokenizer or public_tokenizer(), sequence), "pieces")
    groups = max(1, -(-cut.count() // group_pieces))
    part = F.floor(F.col("start") / F.lit(sequence * group_pieces))
    dealt = cut.withColumn("group", F.pmod(F.xxhash64("row", part, F.lit(seed)), F.lit(groups))).drop("row")

    def pack(pdf: pd.DataFrame) -> pd.DataFrame:
        # an order of its own, so that the result doesn't hang on arrival
        pdf = pdf.sort_values(["length", "doc_id", "start", "ids_crc32"], ascending=[False, True, True, True])
        bins, offsets = first_fit_decreasing(pdf["length"].to_numpy(), sequence)
        out = pdf.drop(columns="group").astype({"doc_id": "Int64"})
        return out.assign(sequence_id=bins + (int(pdf["group"].iloc[0]) << 32), offset=offsets)

    return dealt.groupBy("group").applyInPandas(pack, f"{_PIECES}, sequence_id long, offset long")


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: pack all that is left."""
    return packed(docs)
