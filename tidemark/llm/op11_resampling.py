"""Target-distribution importance resampling over hashed word features.

An untrained ``tokenizers`` pre-tokeniser (a regular-expression ``Split`` over
the text with A-Z lowered) returns a text's words with their offsets.  A feature
is a window over these offset pairs: the words from the first pair to the last,
joined by one space, for every window length up to ``Resampling.words``.
Features fall into buckets by the crc32 of their bytes.  Two histograms, of all
documents and of the target's texts, give every bucket a gain (the logarithm of
the smoothed ratio); a document's weight is the sum of its features' gains, its
score the weight plus a Gumbel draw that is fixed by its id, and the documents
of the highest scores are drawn: a sample without replacement in which a
document's chance grows with its likeness to the target.

The texts are read and split once: the features of each document are stored as
buckets and counts, from which both the histogram and the weights are made.
What goes through the driver is the histogram of ``buckets`` numbers, whatever
the corpus.  Ranks come from a range partitioning by score and one count per
partition, so no task orders more than its own range.

Defined results: a null text has no features (weight 0); a null id counts as the
empty text in its draw and comes last among ties; repeated rows each keep their
row and their own rank; empty tables give an empty result, and an empty target
the gains of zero counts; other columns of the input are ignored.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import stored, table

#: Fixed value: a word, after lowering A-Z, is a run of these characters
#: (digits, a-z, and everything beyond ASCII).
WORD_CLASS = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


@dataclass(frozen=True)
class Resampling:
    words: int = 1  # the longest window, in words
    buckets: int = 10_000
    percent: int = 10  # of the eligible documents
    min_words: int = 20
    seed: int = 2024


def splitter():
    """The pre-tokeniser; it has no vocabulary and nothing to train."""
    from tokenizers import Regex
    from tokenizers.pre_tokenizers import Split

    return Split(Regex(WORD_CLASS), behavior="removed", invert=True)


def lowered(text: str) -> str:
    """A-Z to a-z and nothing else (``bytes.lower`` knows ASCII only)."""
    return text.encode().lower().decode()


def features(found: list, longest: int) -> list[str]:
    """The features of a text's (word, offset pair) list: the windows of one
    to ``longest`` consecutive pairs."""
    words = [w for w, _ in found]
    out = list(words)
    for k in range(2, longest + 1):
        out += [" ".join(words[i : i + k]) for i in range(len(words) - k + 1)]
    return out


_COLUMNS = "doc_id long, n_words long, n_features long, bins binary, counts binary"


def bucketed(docs: DataFrame, p: Resampling, id_col: str = "doc_id") -> DataFrame:
    """Per row of ``docs`` (``id_col``, text): n_words, n_features, and its distinct
    features' buckets and counts (little-endian unsigned 32-bit)."""
    longest, buckets = p.words, p.buckets

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        split = splitter()
        for b in batches:
            rows = []
            for text in b["text"].tolist():
                found = split.pre_tokenize_str(lowered(text)) if text else []
                own = Counter(features(found, longest))
                bins = np.array([zlib.crc32(f.encode()) % buckets for f in own], "<u4")
                rows.append((len(found), own.total(), bins.tobytes(), np.array(list(own.values()), "<u4").tobytes()))
            out = pd.DataFrame(rows, columns=["n_words", "n_features", "bins", "counts"])
            yield out.assign(doc_id=b["doc_id"].to_numpy())[["doc_id", *out.columns]].astype({"doc_id": "Int64"})

    # ids as text on the way in: pandas would turn longs with nulls into floats
    rows = docs.select(F.col(id_col).cast("long").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(_ids_from_text(run), _COLUMNS)


def _ids_from_text(run):
    def inner(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        return run(b.assign(doc_id=pd.array([None if x is None else int(x) for x in b["doc_id"]], "Int64")) for b in batches)

    return inner


def histogram(rows: DataFrame, buckets: int) -> np.ndarray:
    """The features in every bucket over all rows: each task adds up its own,
    ``buckets`` numbers reach the driver."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros(buckets, np.int64)
        for b in batches:
            bins = np.frombuffer(b"".join(b["bins"]), "<u4")
            counts = np.frombuffer(b"".join(b["counts"]), "<u4")
            np.add.at(total, bins, counts.astype(np.int64))
        hit = np.flatnonzero(total)
        yield pd.DataFrame({"bin": hit, "n": total[hit]})

    out = np.zeros(buckets, np.int64)
    for r in rows.select("bins", "counts").mapInPandas(add, "bin long, n long").groupBy("bin").agg(F.sum("n").alias("n")).collect():
        out[r["bin"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 ln of the ratio of the smoothed shares), per bucket."""
    n = len(source)
    a, b = float(source.sum() + n), float(target.sum() + n)
    return np.array([math.floor(1000 * math.log((float(t) + 1) * a / ((float(s) + 1) * b)))
                     for s, t in zip(source, target)], np.int64)


def gumbel(doc_id, seed: int):
    """floor(-1000 ln(-ln u)), u from the id's digest."""
    key = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(key, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


def weighted(rows: DataFrame, gain: np.ndarray, p: Resampling) -> DataFrame:
    """doc_id, n_words, n_features, weight and score of every row."""

    def weigh(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            w = [int(gain[np.frombuffer(i, "<u4")] @ np.frombuffer(c, "<u4").astype(np.int64))
                 for i, c in zip(b["bins"], b["counts"])]
            yield pd.DataFrame({"doc_id": b["doc_id"], "n_words": b["n_words"], "n_features": b["n_features"],
                                "weight": np.array(w, np.int64)})

    text_id = rows.withColumn("doc_id", F.col("doc_id").cast("string"))
    out = text_id.mapInPandas(weigh, "doc_id string, n_words long, n_features long, weight long")
    out = out.withColumn("doc_id", F.col("doc_id").cast("long"))
    return out.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), p.seed))


def ranked(scored: DataFrame, p: Resampling, name: str = "resampling") -> DataFrame:
    """``scored`` with ``rank`` (from 1) where a row is drawn.  The rows are
    range partitioned in the order of the draw and numbered within their
    partition; what stands before a partition is a sum over its predecessors'
    counts, one row each."""
    fit = F.col("n_words") >= p.min_words
    # the row's number parts equal rows, so that even they spread over ranges
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last(), F.col("__row").asc()]
    keyed = stored(scored.where(fit), f"{name}-scored").withColumn("__row", F.monotonically_increasing_id())
    parts = keyed.sparkSession.sparkContext.defaultParallelism
    placed = stored(keyed.repartitionByRange(max(8, parts), *order).sortWithinPartitions(*order)
                    .withColumn("__at", F.monotonically_increasing_id()).drop("__row"), f"{name}-placed")
    part = F.shiftright("__at", 33)
    counts = sorted((r["p"], r["n"]) for r in placed.groupBy(part.alias("p")).agg(F.count("*").alias("n")).collect())
    drawn = sum(n for _, n in counts) * p.percent // 100
    before, rows = 0, []
    for q, n in counts:
        rows.append((q, before))
        before += n
    base = placed.sparkSession.createDataFrame(rows, "p long, before long")
    at = F.col("before") + F.col("__at").bitwiseAND(F.lit((1 << 33) - 1)) + 1
    inside = (placed.join(F.broadcast(base), part == F.col("p"))  # one row per range partition
              .withColumn("rank", F.when(at <= drawn, at)).drop("__at", "p", "before"))
    return inside.unionByName(scored.where(~fit).withColumn("rank", F.lit(None).cast("long")))


def resampled(docs: DataFrame, target: DataFrame, p: Resampling = Resampling(), name: str = "resampling") -> DataFrame:
    """doc_id, n_words, n_features, weight, score and rank of every row of
    ``docs`` (doc_id, text); ``target``: the texts to come near to."""
    rows = stored(bucketed(docs.select("doc_id", "text"), p), f"{name}-features")
    wanted = bucketed(target.select(F.lit(None).cast("long").alias("doc_id"), "text"), p)
    gain = gains(histogram(rows, p.buckets), histogram(wanted, p.buckets))
    return ranked(stored(weighted(rows, gain, p), f"{name}-weights"), p, name)


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return out.select("doc_id", "n_features", "weight", "score", "rank")


# The crc32 of a feature, byte by byte: eight shifts of the reversed polynomial
# make the table's 256 entries.
SQL = r"""
WITH tab AS (SELECT list(v ORDER BY i) AS tab FROM (
  SELECT i, list_reduce(list_prepend(i, range(8)), lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS v
  FROM (SELECT unnest(range(256)) AS i))),
f AS (SELECT 's' AS side, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
  UNION ALL SELECT 't', NULL, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') FROM benchmark),
w AS (SELECT side, unnest(ws) AS word FROM f),
n AS (SELECT word, count(*) FILTER (side = 's') AS s, count(*) FILTER (side = 't') AS t FROM w GROUP BY word),
c AS (SELECT word, s, t, list_reduce(list_prepend(4294967295, list_transform(range(length(hex(word)) // 2),
    lambda i: ('0x' || substr(hex(word), 2 * i + 1, 2))::BIGINT)),
    lambda a, b: xor(a // 256, tab[xor(a % 256, b) + 1])) AS crc FROM n, tab),
b AS (SELECT word, s, t, xor(crc, 4294967295) % 10000 AS bin FROM c),
h AS (SELECT bin, sum(s)::BIGINT AS s, sum(t)::BIGINT AS t FROM b GROUP BY bin),
tot AS (SELECT coalesce(sum(s), 0)::BIGINT AS sa, coalesce(sum(t), 0)::BIGINT AS ta FROM h),
g AS (SELECT bin, floor(1000 * ln(((t + 1) * (sa + 10000))::DOUBLE / ((s + 1) * (ta + 10000))::DOUBLE))::BIGINT AS gain FROM h, tot),
x AS (SELECT doc_id, len(ws)::BIGINT AS n_features, ws FROM f WHERE side = 's'),
y AS (SELECT doc_id, sum(gain)::BIGINT AS weight FROM (SELECT doc_id, unnest(ws) AS word FROM x) JOIN b USING (word) JOIN g USING (bin) GROUP BY doc_id),
z AS (SELECT doc_id, n_features, coalesce(weight, 0) AS weight, coalesce(weight, 0) + floor(-1000 * ln(-ln(
    (('0x' || substr(sha256('2024:' || doc_id), 1, 8))::BIGINT + 0.5) / 4294967296)))::BIGINT AS score FROM x LEFT JOIN y USING (doc_id)),
r AS (SELECT *, row_number() OVER (PARTITION BY n_features >= 20 ORDER BY score DESC, doc_id) AS k,
    10 * count(*) OVER (PARTITION BY n_features >= 20) // 100 AS d FROM z)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 20 AND k <= d THEN k END AS rank FROM r
"""
