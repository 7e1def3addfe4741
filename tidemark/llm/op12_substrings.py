"""Removal of repeated passages, by compressed FM-indexes.

A window is ``window`` consecutive words of one document; a word is removed if a
window over it also starts earlier in the corpus (by document id, then by place).

Windows meet by content.  A window's anchor is its ``anchor``-word run of the
smallest digest, the first of equals; equal windows have equal anchors at the
same place.  A segment is the stretch of a document's consecutive windows that
share one anchor (at most ``2 * window - anchor`` words), so no segment holds a window
twice, and windows repeat only between segments of one anchor.  Anchors that
occur once are left aside; of the others, equal segments are joined first, so a
passage or a document that stands in very many places is one row from there on,
and its later places are removed whole.  Anchors under which different segments
are left are dealt into shards of bounded size.  Each shard is one FM-index
(:mod:`tidemark.llm.fm_index`) over its segments in corpus order; the segments
are streamed against it, backward search gives their matching statistics, and
the stretches of ``window`` words or more that also occur at an earlier place
are reported as intervals of the document.

An anchor with more than ``route_segments`` different segments (a passage with as many
different surroundings) is not sent to one shard: its segments' windows are
joined by their digests, the earliest of each by one aggregation.

Documents of equal text are settled before: the first one stays, the others lose
every word that a window covers.  Texts are shuffled only where they must meet:
tables of bits of fixed size keep others out, whose false hits cost work, never
results.  Words are compared by 64-bit digests, segments by 128 bits.

Defined results: a null text has no words; a null id comes last, and rows of one
id with different texts are ordered by a digest of the text; rows of the same id
and text are one document (each keeps its row); an empty table gives an empty
result; other columns of the input are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bit_table, has_bit, stored, table
from tidemark.llm.fm_index import FMIndex


@dataclass(frozen=True)
class Repeats:
    window: int = 20
    anchor: int = 6
    #: Words of a shard's index, on average.
    shard_words: int = 300_000
    #: Different segments of one anchor that one shard takes.
    route_segments: int = 4000
    #: The tables of bits have 2^table_bits bits.
    table_bits: int = 23

    def __post_init__(self):
        if not 1 <= self.anchor <= self.window:
            raise ValueError("an anchor has at least one word and at most a window's")


# ------------------------------------------------------------- words, anchors
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_HEAD = np.array([(1 << (8 * k)) - 1 for k in range(8)] + [(1 << 64) - 1], np.uint64)
_ODD, _MIX1, _MIX2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_BACK = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Texts are taken apart in blocks of about this many bytes.
_BLOCK = 4 << 20


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _MIX1
    x = (x ^ (x >> np.uint64(27))) * _MIX2
    return x ^ (x >> np.uint64(31))


class Words:
    """The words of a block of texts: begin and end in ``raw``, text number, digest."""

    def __init__(self, texts: list[bytes]):
        self.raw = raw = b"\n".join(texts) + b"\n" + b" " * 8
        space = _SPACE[np.frombuffer(raw, np.uint8)]
        edges = np.flatnonzero(space[1:] != space[:-1]) + 1
        if not space[0]:
            edges = np.concatenate([[0], edges])
        self.begin, self.end = edges[0::2], edges[1::2]
        self.bounds = np.cumsum([0] + [len(t) + 1 for t in texts])
        self.text = np.searchsorted(self.bounds, self.begin, "right") - 1
        size = self.end - self.begin
        eight = np.ndarray((len(raw) - 7,), "<u8", raw, 0, (1,))  # eight bytes from any place
        h = _mixed(size.astype(np.uint64) * _ODD + _MIX1)
        live = np.arange(len(size))
        for k in range(0, 256, 8):
            live = live[size[live] > k]
            if not len(live):
                break
            part = eight[self.begin[live] + k] & _HEAD[np.minimum(size[live] - k, 8)]
            h[live] = _mixed((h[live] ^ part) * _ODD)
        for i in live[size[live] > 256].tolist():  # very long words
            h[i] = int.from_bytes(hashlib.blake2b(raw[self.begin[i] : self.end[i]], digest_size=8).digest(), "little")
        self.digest = h

    def __len__(self) -> int:
        return len(self.begin)


def _least(g: np.ndarray, width: int) -> np.ndarray:
    """The place of the smallest of every ``width`` neighbours, the first of equals."""
    at, size = np.arange(len(g)), 1
    while size < width:
        step = min(size, width - size)
        a, b = at[:-step], at[step:]
        at = np.where(g[b] < g[a], b, a)
        size += step
    return at


class Segments:
    """The segments of a block of texts: first word, number of words, anchor
    digest, digest of all words."""

    def __init__(self, w: Words, p: Repeats):
        n = len(w)
        self.begin = self.words = np.zeros(0, np.int64)
        self.key = self.digest = np.zeros(0, np.int64)
        if n < p.window:
            return
        g = np.zeros(n - p.anchor + 1, np.uint64)
        for j in range(p.anchor):
            g = g * _ODD + w.digest[j : j + len(g)]
        g = _mixed(g)
        at = _least(g, p.window - p.anchor + 1)  # per window
        whole = w.text[: len(at)] == w.text[p.window - 1 :]
        same = np.concatenate([[False], (at[1:] == at[:-1]) & whole[:-1]])
        head = np.flatnonzero(whole & ~same)
        goes_on = np.concatenate([same[1:], [False]]) & np.concatenate([whole[1:], [False]])
        last = np.flatnonzero(whole & ~goes_on)
        self.begin, self.words = head, last - head + p.window
        self.key = g[at[head]].view(np.int64)
        # digest of a stretch: a difference of prefix sums, turned back to 0
        power = np.cumprod(np.full(n, _ODD))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(_mixed(w.digest + _MIX2) * power)])
        back = np.cumprod(np.full(n, _BACK))
        own = (sums[self.begin + self.words] - sums[self.begin]) * back[self.begin]
        self.digest = _mixed(own + self.words.astype(np.uint64)).view(np.int64)


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Slices of the batches whose texts make up about one block."""
    for b in batches:
        texts = [t or b"" for t in b.column("text").to_pylist()]
        at = 0
        while at < len(texts):
            stop, size = at, 0
            while stop < len(texts) and (stop == at or size + len(texts[stop]) <= _BLOCK):
                size += len(texts[stop])
                stop += 1
            yield b.slice(at, stop - at), texts[at:stop]
            at = stop


# -------------------------------------------------------------- Spark pipeline
NAME = ["none", "doc", "h"]  # what names a document here
_LAST = (1 << 63) - 1


def named(docs: DataFrame) -> DataFrame:
    """none, doc (a null id: none and the largest number), h, text as bytes."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").isNull().alias("none"), F.coalesce(F.col("doc_id").cast("long"), F.lit(_LAST)).alias("doc"),
                       F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))


def _name_key(*more: str):
    return F.xxhash64(*NAME, *more)


def first_documents(docs: DataFrame, p: Repeats, name: str) -> tuple[DataFrame, DataFrame]:
    """(one row of every document that is the first of its text, the names of
    the others).  Most texts are passed on where they are; only those of
    repeated names or texts, and few more, are joined."""
    narrow = stored(docs.select(*NAME, F.unhex(F.md5("text")).alias("md5")), f"{name}-names")
    own = F.struct(*NAME)
    firsts = narrow.groupBy("md5").agg(F.min(own).alias("f"), F.count("*").alias("c")).where("c > 1").drop("c")
    some = stored(narrow.hint("merge").join(firsts, "md5").select(*NAME, (own != F.col("f")).alias("later")), f"{name}-copies")
    copies = some.where("later").select(*NAME).distinct()
    bits = bit_table(some.select(_name_key().alias("key")), p.table_bits, f"{name}-copy-bits")
    hit = has_bit(bits, _name_key(), p.table_bits)
    once = docs.where(hit).dropDuplicates(NAME).join(copies.hint("merge"), NAME, "left_anti")
    return docs.where(~hit).unionByName(stored(once, f"{name}-firsts")), copies


def repeated_anchors(docs: DataFrame, p: Repeats) -> DataFrame:
    """key of every anchor with two segments or more."""

    def run(batches):
        for _, texts in _blocks(batches):
            key, n = np.unique(Segments(Words(texts), p).key, return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], names=["key", "n"])

    return docs.select("text").mapInArrow(run, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).where("n > 1").select("key")


def candidate_segments(docs: DataFrame, bits: DataFrame, p: Repeats) -> DataFrame:
    """The segments whose anchor has its bit, with their words."""
    mask = np.uint64((1 << p.table_bits) - 1)
    # a table of fixed size (2^table_bits bits)
    words = docs.sparkSession.sparkContext.broadcast(np.array(bits.first()["bits"], np.int64).view(np.uint64))

    def run(batches):
        cells = words.value
        for rows, texts in _blocks(batches):
            w = Words(texts)
            s = Segments(w, p)
            cell = s.key.view(np.uint64) & mask
            hit = np.flatnonzero((cells[cell >> np.uint64(6)] >> (cell & np.uint64(63))) & np.uint64(1))
            begin, n = s.begin[hit], s.words[hit]
            of = w.text[begin]
            zero = np.searchsorted(w.begin, w.bounds)[of]  # the text's first word
            raw, ends = w.raw, w.end[begin + n - 1]
            texts_of = [raw[a:b] for a, b in zip(w.begin[begin].tolist(), ends.tolist())]
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays(
                [*(rows.column(c).take(take) for c in NAME), pa.array(begin - zero), pa.array(n),
                 pa.array(s.key[hit]), pa.array(s.digest[hit]), pa.array(texts_of, pa.binary())],
                names=[*NAME, "start", "n", "key", "digest", "text"])

    return docs.mapInArrow(run, "none boolean, doc long, h long, start long, n long, key long, digest long, text binary")


def _intervals(flags: np.ndarray, window: int) -> list[tuple[int, int]]:
    """Stretches of words under the flagged windows (numbers, rising)."""
    if not len(flags):
        return []
    cut = np.flatnonzero(np.diff(flags) > window)
    return list(zip(flags[np.concatenate([[0], cut + 1])].tolist(), (flags[np.concatenate([cut, [len(flags) - 1]])] + window).tolist()))


def repeats_in_shard(pdf: pd.DataFrame, p: Repeats) -> pd.DataFrame:
    """The intervals of a shard's segments that also occur earlier in it."""
    pdf = pdf.drop_duplicates(["key", "digest"]).sort_values([*NAME, "start"])
    vocab: dict[bytes, int] = {}
    rows = [np.array([vocab.setdefault(x, len(vocab) + 1) for x in t.split()], np.int64) for t in pdf["text"]]
    index = FMIndex(rows, len(vocab) + 1, p.window)
    _, first = index.matching_statistics(rows)
    out, at = [], 0
    names = zip(*(pdf[c].tolist() for c in [*NAME, "start"]))
    for r, begin, (none, doc, h, start) in zip(rows, index.begins.tolist(), names):
        own = first[at : at + len(r)]
        at += len(r)
        flags = np.flatnonzero((own >= 0) & (own < begin + np.arange(len(r))))
        out += [(none, doc, h, start + a, start + b) for a, b in _intervals(flags, p.window)]
    return pd.DataFrame(out, columns=[*NAME, "start", "stop"])


_SPAN = "none boolean, doc long, h long, start long, stop long"


def repeated_spans(docs: DataFrame, p: Repeats, name: str) -> DataFrame:
    """none, doc, h, start, stop: stretches of words that occur earlier, of
    documents with different texts."""
    keys = repeated_anchors(docs, p)
    bits = bit_table(keys, p.table_bits, f"{name}-anchor-bits")
    found = stored(candidate_segments(docs, bits, p), f"{name}-segments")

    place = F.struct(*NAME, "start")
    units = stored(found.groupBy("key", "digest").agg(F.min(place).alias("f"), F.count("*").alias("c"), F.max("n").alias("n")), f"{name}-units")
    # later places of equal segments
    copied = (found.select(*NAME, "start", "n", "key", "digest").hint("merge")
              .join(units.where("c > 1").select("key", "digest", "f"), ["key", "digest"])
              .where(place != F.col("f")).select(*NAME, "start", (F.col("start") + F.col("n")).alias("stop")))

    # anchors with different segments: these meet in a shard
    routes = units.groupBy("key").agg(F.count("*").alias("u")).where("u > 1")
    asked = stored(units.join(routes, "key").select("key", "digest", "f.*", "n", "u"), f"{name}-asked")
    total = asked.where(F.col("u") <= p.route_segments).agg(F.sum("n")).first()[0] or 0
    shards = max(1, -(-total // p.shard_words))
    near = bit_table(asked.select(_name_key("start").alias("key")), p.table_bits, f"{name}-place-bits")
    texts = stored(found.where(has_bit(near, _name_key("start"), p.table_bits)).hint("merge")
                   .join(asked.drop("key", "digest", "n"), [*NAME, "start"]), f"{name}-texts")
    # a number of its own per key and shard count, so that shards are even
    dealt = texts.where(F.col("u") <= p.route_segments).withColumn("shard", F.pmod(F.xxhash64("key"), F.lit(shards)))
    indexed = dealt.groupBy("shard").applyInPandas(lambda pdf: repeats_in_shard(pdf, p), _SPAN)
    crowded = crowded_spans(texts.where(F.col("u") > p.route_segments), p, name)
    return copied.unionByName(indexed).unionByName(crowded)


def crowded_spans(texts: DataFrame, p: Repeats, name: str) -> DataFrame:
    """The same for segments of anchors with very many: window by window."""

    def run(batches):
        for rows, raw in _blocks(batches):
            w = Words(raw)
            n = len(w) - p.window + 1
            ok = np.flatnonzero(w.text[:n] == w.text[p.window - 1 :]) if n > 0 else np.zeros(0, np.int64)
            d = [np.zeros(max(n, 0), np.uint64), np.zeros(max(n, 0), np.uint64)]
            for j in range(p.window if n > 0 else 0):
                d[0] = d[0] * _ODD + w.digest[j : j + n]
                d[1] = d[1] * _MIX1 + _mixed(w.digest[j : j + n] + _MIX2)
            of = w.text[ok]
            begin = np.asarray(rows.column("start"))[of] + ok - np.searchsorted(w.begin, w.bounds)[of]
            take = pa.array(of)
            yield pa.RecordBatch.from_arrays([*(rows.column(c).take(take) for c in NAME), pa.array(begin),
                                              *(pa.array(_mixed(x[ok]).view(np.int64)) for x in d)], names=[*NAME, "start", "d", "e"])

    windows = stored(texts.select(*NAME, "start", "text").mapInArrow(run, "none boolean, doc long, h long, start long, d long, e long"),
                     f"{name}-windows")
    place = F.struct(*NAME, "start")
    firsts = windows.groupBy("d", "e").agg(F.min(place).alias("f"), F.count("*").alias("c")).where("c > 1").drop("c")
    return (windows.hint("merge").join(firsts, ["d", "e"]).where(place != F.col("f"))
            .select(*NAME, "start", (F.col("start") + p.window).alias("stop")))


def _kept(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    """n_words, the words left and their digest, for rows with ``spans``
    (start, stop) and ``whole`` (every word, if there is a window)."""
    for b in batches:
        out = []
        for text, spans, whole in zip(b.column("text").to_pylist(), b.column("spans").to_pylist(), b.column("whole").to_pylist()):
            words = (text or b"").split()
            n, left = len(words), words
            if whole and n >= window:
                left = []
            elif spans:
                left, at = [], 0
                for s in sorted((x["start"], x["stop"]) for x in spans):
                    left += words[at : max(at, s[0])]
                    at = max(at, s[1])
                left += words[at:]
            kept = b" ".join(left)
            out.append((n, n - len(left), hashlib.sha256(kept).hexdigest(), kept.decode()))
        cols = list(zip(*out)) if out else [[], [], [], []]
        yield pa.RecordBatch.from_arrays(
            [b.column("none"), b.column("doc"), pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()),
             pa.array(cols[2], pa.string()), pa.array(cols[3], pa.string())],
            names=["none", "doc", "n_words", "n_removed", "kept_sha256", "kept"])


def without_repeats(docs: DataFrame, p: Repeats = Repeats(), name: str = "substrings") -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256 and kept (the words left, joined
    by one space) of every row of ``docs`` (doc_id, text)."""
    all_docs = named(docs)
    firsts, copies = first_documents(all_docs, p, name)
    spans = repeated_spans(firsts, p, name)
    per_doc = spans.groupBy(*NAME).agg(F.collect_list(F.struct("start", "stop")).alias("spans"))
    fate = stored(per_doc.withColumn("whole", F.lit(False)).unionByName(
        copies.withColumns({"spans": F.lit(None).cast("array<struct<start:long,stop:long>>"), "whole": F.lit(True)})), f"{name}-fate")
    bits = bit_table(fate.select(_name_key().alias("key")), p.table_bits, f"{name}-fate-bits")
    hit = has_bit(bits, _name_key(), p.table_bits)
    none = {"spans": F.lit(None).cast("array<struct<start:long,stop:long>>"), "whole": F.lit(False)}
    left = all_docs.where(hit).hint("merge").join(fate, NAME, "left").withColumn("whole", F.coalesce("whole", F.lit(False)))
    rows = all_docs.where(~hit).withColumns(none).unionByName(left)
    out = rows.select("none", "doc", "text", "spans", "whole").mapInArrow(
        lambda b: _kept(b, p.window), "none boolean, doc long, n_words long, n_removed long, kept_sha256 string, kept string")
    return out.select(F.when(~F.col("none"), F.col("doc")).alias("doc_id"), "n_words", "n_removed", "kept_sha256", "kept")


def op12_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    return without_repeats(table(spark, sf_dir, "documents")).drop("kept")


SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents),
w AS (SELECT doc_id, i, array_to_string(ws[i : i + 19], ' ') AS s FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS i FROM d WHERE len(ws) >= 20)),
f AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS k FROM w) WHERE k > 1),
g AS (SELECT DISTINCT doc_id, i + unnest(range(20)) AS i FROM f),
r AS (SELECT doc_id, list(i) AS gone FROM g GROUP BY doc_id),
k AS (SELECT d.doc_id, ws, CASE WHEN gone IS NULL THEN ws ELSE list_filter(ws, lambda x, i: NOT list_contains(gone, i)) END AS kept
  FROM d LEFT JOIN r ON r.doc_id = d.doc_id)
SELECT doc_id, len(ws)::BIGINT AS n_words, (len(ws) - len(kept))::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(kept, ' '), '')) AS kept_sha256 FROM k
"""
