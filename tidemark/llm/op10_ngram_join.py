"""Exact Jaccard join of documents on word shingles, by universe partition.

A document is the set of its distinct word shingles.  Sets of a pair with
Jaccard similarity of at least s differ in few elements: their symmetric
difference is at most H = (1 - s) / (1 + s) * (sum of the sizes).  The universe
of shingles is hashed into segments.  A pair can differ in at most H segments,
so among any H + 1 segments at least one holds the same subset of both sets; a
segment in which subsets with one element more or less are also compared (its
one-deletion neighbourhood) counts twice.

Sets are put into bands by size.  The number of segments of a band, and how
many of them carry one-deletion neighbours, is the cheapest allocation whose
units still exceed H.  Every set is indexed in its own band under the keys of
all its segments; it probes its own band and the next with the cheapest units
that exceed H: its largest segments, as those are shared by the fewest
unrelated sets.  Subsets that hold nothing are used only where a set has too
few others.

Large groups of similar sets never become all pairs.  Equal sets are joined
first, by digest.  Then each key ties its probes to one member of its index
(the smallest), which is as many candidates as there are probes; verified ones
are links, and links are merged into components.  While that links
many of the sets whose keys are not yet in one component, it is done again, a few
times, with another member each time.  Only pairs under a key that are still in different
components are then verified, so no link between different components is lost; a
pair that shares many keys is joined under the first of them.

Verification compares the sets themselves (64-bit digests of their shingles),
exactly, in integers: 100 * intersection >= percent * union.

Defined results: a null text or one without words has an empty set, is linked
with nothing and is its own component; with fewer words than a shingle, the
whole sequence is one shingle; repeated rows of an id count once, and an id with
several texts is linked through each of them; rows with a null id are left out, as they name no document; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import few, fresh, small_batches, stored, table
from tidemark.llm.components import components

_U = np.uint64


@dataclass(frozen=True)
class Join:
    shingle: int = 4
    percent: int = 85


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads all bits."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class WordHash(dict):
    """64-bit digests of words, kept for a bounded number of them."""

    def __missing__(self, word: bytes) -> int:
        if len(self) > 300_000:
            self.clear()
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h


def shingle_set(text: str | None, size: int, digest: WordHash) -> np.ndarray:
    """The sorted digests of a text's distinct shingles."""
    # of bytes, lower() takes A-Z only and split() the six white-space characters
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, _U)
    w = np.fromiter(map(digest.__getitem__, words), _U, len(words))
    n = max(1, len(w) - size + 1)
    key = np.full(n, min(len(w), size), _U)
    for i in range(min(len(w), size)):
        key = mixed(key * _U(0x9E3779B97F4A7C15) + w[i : i + n])
    return np.unique(key)


#: Words of 64 bits in a set's parity sketch.
SKETCH = 8


def sketch_of(s: np.ndarray) -> np.ndarray:
    """Parities of the counts of elements in 512 cells.  An element that only
    one of two sets holds flips one bit, so sketches differ in no more bits than
    the sets do in elements."""
    at = (mixed(s ^ _U(0xA0761D6478BD642F)) & _U(64 * SKETCH - 1)).astype(np.int64)
    odd = (np.bincount(at, minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64)


def longest(n: int, percent: int) -> int:
    """The largest size that a set of ``n`` can be linked with."""
    return n * 100 // percent


def difference(n: int, m: int, percent: int) -> int:
    """A bound of the symmetric difference of linked sets of sizes up to n and
    m, that grows with both."""
    return (n + m) * (100 - percent) // (100 + percent)


@dataclass(frozen=True)
class Band:
    number: int
    low: int
    high: int  # sizes low..high
    units: int  # H + 1 for any pair of sizes up to high
    segments: int
    deleting: int  # the first so many segments carry one-deletion neighbours


@lru_cache(maxsize=None)
def band_of(n: int, percent: int) -> Band:
    """The band that sizes of ``n`` fall into: 1, then as long as a set of the
    band's first size can be linked with its last."""
    low, number = 1, 0
    while n > longest(low, percent):
        low, number = longest(low, percent) + 1, number + 1
    high = longest(low, percent)
    units = difference(high, high, percent) + 1
    segments, deleting = allocated(low, units)
    return Band(number, low, high, units, segments, deleting)


def allocated(size: int, units: int) -> tuple[int, int]:
    """(segments, those with one-deletion neighbours): the cheapest by the keys
    that a set writes and the unrelated sets it is expected to meet.

    A segment of mean size f is empty in about exp(-f) of the sets, and its
    subset is shared with unrelated sets the more often the smaller it is; so
    the units must be reached by segments that hold something, with a margin.
    """
    best = None
    for share in (0.0, 0.1, 0.25, 0.5, 1.0):
        for slack in (1.0, 1.04, 1.08, 1.15, 1.3):
            segments = max(1, int(np.ceil(units * slack / (1 + share))))
            deleting = int(np.ceil(share * segments))
            f = size / segments
            full = 1 - np.exp(-f)
            reach = (segments - deleting) * full + 2 * deleting * (1 - np.exp(-f) * (1 + f))
            short = max(0.0, units + 2 * np.sqrt(units * (1 - full)) - reach)
            keys = segments + deleting * f
            cost = keys + 40.0 * short + 400.0 * segments * np.exp(-2 * f)
            if best is None or cost < best[0] - 1e-9:
                best = (cost, segments, deleting)
    return best[1], best[2]


def spread(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Of every element, the number that keys add up and the one that picks its
    segment."""
    return mixed(s + _U(0x632BE59BD9B4E019)), mixed(s ^ _U(0xD6E8FEB86659FD93))


def segment_keys(spread_: tuple, b: Band) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """(size of each segment, its key, the keys of its one-deletion
    neighbours).  A subset's key is a sum, so an element is deleted by
    subtracting it."""
    h, pick = spread_
    seg = (pick % _U(b.segments)).astype(np.int64)
    size = np.bincount(seg, minlength=b.segments)
    order = np.argsort(seg, kind="stable")
    h = h[order]
    ends = np.cumsum(size)
    sums = np.concatenate([np.zeros(1, _U), np.cumsum(h, dtype=_U)])
    total = sums[ends] - sums[ends - size]
    salt = mixed(np.arange(b.segments, dtype=_U) + _U((b.number + 1) * 1_000_003))
    key = mixed(total + salt)
    less = [mixed(total[i] - h[ends[i] - size[i] : ends[i]] + salt[i]) for i in range(b.deleting)]
    return size, key, less


#: Kinds of keys: a subset as it is, and a subset less one element.
WHOLE, LESS = _U(0x243F6A8885A308D3), _U(0x13198A2E03707344)


def index_keys(parts, b: Band) -> np.ndarray:
    """The keys a set is found under in its own band."""
    _, key, less = parts
    return np.concatenate([key ^ WHOLE, *(x ^ LESS for x in less)])


def probes(n: int, parts, b: Band, percent: int) -> tuple[np.ndarray, list[np.ndarray]]:
    """The segments whose whole subsets a set looks up in band ``b``, and the
    further keys it looks under: units enough for the largest difference
    possible, the cheapest first."""
    top = min(b.high, longest(n, percent))
    need = difference(n, top, percent) + 1
    size, key, less = parts
    # one unit of each segment that holds something, the largest first; then the
    # second unit of those that stay non-empty; then what is left
    order = np.argsort(-size, kind="stable")
    take = order[:need]
    if size[take[-1]] > 0 and len(take) == need:
        return take, []
    take, more = order[size[order] > 0], []
    got = len(take)
    second = [i for i in range(b.deleting) if size[i] >= 2]
    empty = order[size[order] == 0]
    for i in second[: max(0, need - got)]:
        more += [key[i : i + 1] ^ LESS, less[i] ^ WHOLE]
        got += 1
    if got < need:
        take, got = np.concatenate([take, empty]), got + len(empty)
    for i in range(b.deleting):
        if got < need and size[i] < 2:
            more += [key[i : i + 1] ^ LESS, less[i] ^ WHOLE]
            got += 1
    if got < need:
        raise AssertionError("a band allocates too few units")
    return take, more


def class_of(s: np.ndarray) -> int:
    """A set's class: 61 bits of its digest; the empty set's is 0."""
    return (xxhash.xxh3_64_intdigest(s.tobytes()) >> 3) | 1 if len(s) else 0


#: A key's row beside the key is one number: the class above the lowest bit
#: (set if it looks under the key), and above it whether it only looks.
ONLY = 1 << 62
#: A document's own row has the class as that number, less this one.
MEMBER = -(1 << 63)


def rows_of(docs: DataFrame, j: Join) -> DataFrame:
    """key, val, body.  Of every set, under which keys it is found (index),
    looks (probe), or both; copies write equal rows, and sets so small that only
    an equal one can be linked write none.  Of every document one row with a
    body: its id, its text's digest, its set's size and sketch."""
    least = next(n for n in range(1, 1000) if longest(n, j.percent) > n)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = WordHash()
        for batch in batches:
            seen: set[int] = set()
            for at in range(0, len(batch), 500):
                part = batch.iloc[at : at + 500]
                keys, vals, own_keys, own_vals, bodies = [], [], [], [], []
                for doc_id, h, text in zip(part["doc_id"].tolist(), part["h"].tolist(), part["text"]):
                    s = shingle_set(text, j.shingle, digest)
                    cls = class_of(s)
                    own_keys.append(h)
                    own_vals.append(MEMBER + cls)
                    bodies.append(np.concatenate([np.array([doc_id, h, len(s)], np.int64), sketch_of(s)]).tobytes())
                    if len(s) < least or cls in seen:
                        continue
                    seen.add(cls)
                    cls <<= 1
                    apart = spread(s)
                    own = band_of(len(s), j.percent)
                    parts = segment_keys(apart, own)
                    looks, more = probes(len(s), parts, own, j.percent)
                    index = index_keys(parts, own)
                    flags = np.full(len(index), cls, np.int64)
                    flags[looks] += 1
                    keys.append(index)
                    vals.append(flags)
                    if longest(len(s), j.percent) > own.high:
                        up = band_of(own.high + 1, j.percent)
                        parts = segment_keys(apart, up)
                        looks, further = probes(len(s), parts, up, j.percent)
                        more = [*more, parts[1][looks] ^ WHOLE, *further]
                    if more:
                        keys += more
                        vals.append(np.full(sum(map(len, more)), cls + 1 + ONLY, np.int64))
                key = np.concatenate([np.array(own_keys, np.int64), *(k.view(np.int64) for k in keys)])
                yield pd.DataFrame({"key": key, "val": np.concatenate([np.array(own_vals, np.int64), *vals]),
                                    "body": np.array(bodies + [None] * (len(key) - len(bodies)), object)})

    small_batches(docs.sparkSession)
    return docs.mapInPandas(run, "key long, val long, body binary")


_LIVE = "key long, cls long, found boolean, probe boolean, rep long"


def shared_keys(rows: DataFrame) -> DataFrame:
    """key, cls, found, probe, rep: the distinct rows of the keys under which
    some class is found and another one is found or looks, with the smallest
    class found there.  The documents' own rows pass, with their body.

    One shuffle and sort by key; a key's rows stream past, so a key that very
    many classes share needs no memory of its own.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held_key = held_val = np.empty(0, np.int64)  # the last key's rows, while they are of one class
        shared: tuple | None = None  # or the last key, its smallest class and its last row, once it is known to be shared
        for b in batches:
            own = b["body"].notna()
            if own.any():
                yield pd.DataFrame({"key": None, "cls": b["val"][own] - MEMBER, "found": None, "probe": None, "rep": None,
                                    "body": b["body"][own]}).astype({"key": "Int64", "rep": "Int64"})
                b = b[~own]
            key, val = np.append(held_key, b["key"].to_numpy()), np.append(held_val, b["val"].to_numpy())
            held_key = held_val = key[:0]
            if not len(key):
                continue
            fresh = np.concatenate([[True], (key[1:] != key[:-1]) | (val[1:] != val[:-1])])
            goes_on = shared is not None and shared[0] == key[0]
            if goes_on and shared[2] == val[0]:
                fresh[0] = False
                if not fresh.any():
                    continue
            key, val = key[fresh], val[fresh]
            cls = (val & (ONLY - 1)) >> 1
            first = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
            group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(key))))
            rep, found = cls[first].copy(), val[first] < ONLY
            goes_on = shared is not None and shared[0] == key[0]
            if goes_on:
                rep[0], found[0] = shared[1], True
            has = np.logical_or.reduceat(cls != rep[group], first)
            has[0] |= goes_on
            shared = None
            if found[-1]:
                if has[-1]:
                    shared = (key[-1], rep[-1], val[-1])
                else:
                    held_key, held_val = key[first[-1]:], val[first[-1]:]
            keep = (has & found)[group]
            yield pd.DataFrame({"key": key[keep], "cls": cls[keep], "found": val[keep] < ONLY,
                                "probe": (val[keep] & 1) == 1, "rep": rep[group[keep]], "body": None})

    n = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return rows.repartition(n, "key").sortWithinPartitions("key", "val").mapInPandas(run, f"{_LIVE}, body binary")


def unpacked(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for b in batches:
        x = np.frombuffer(b"".join(b["body"]), np.int64).reshape(len(b), 3 + SKETCH)
        yield pd.DataFrame({"cls": b["cls"].to_numpy(), "doc_id": x[:, 0], "h": x[:, 1], "n_shingles": x[:, 2]}
                           | {f"k{i}": x[:, 3 + i] for i in range(SKETCH)})


_KS = [f"k{i}" for i in range(SKETCH)]
_MEMBERS = "cls long, doc_id long, h long, n_shingles long, " + ", ".join(f"{k} long" for k in _KS)


def may_link(x: str, y: str, percent: int) -> F.Column:
    """Whether sets of sizes x_n and y_n with sketches x_k0 ... can be linked."""
    n, m = F.col(f"{x}_n"), F.col(f"{y}_n")
    apart = sum((F.bit_count(F.col(f"{x}_{k}").bitwiseXOR(F.col(f"{y}_{k}"))) for k in _KS), F.lit(0))
    return (percent * F.greatest(n, m) <= 100 * F.least(n, m)) & ((100 + percent) * apart <= (100 - percent) * (n + m))


def shaped(ids: DataFrame, x: str, *more: str) -> DataFrame:
    """A class, its size and sketch, under the names of side ``x`` of a pair."""
    return ids.select(F.col("cls").alias(x), *more, F.col("n").alias(f"{x}_n"), *(F.col(k).alias(f"{x}_{k}") for k in _KS))


#: Rounds of tying each key's members to one of them, at most.  They end when a
#: round finds fewer links than one for so many classes under keys of several
#: components.
STARS, LINKING = 4, 4
#: A pair is joined under the first of its keys, as far as it is among so many
#: first keys of both classes.
FIRSTS = 16
#: Bits of the table that keeps texts out of a shuffle for which no pair asks:
#: 1 MB, whatever the number of documents.
BITS = 1 << 23


def asked_only(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """``docs`` without most rows whose doc_id is not in ``ids``: a bit table of
    fixed size, which passes all of ``ids`` and a few others."""
    bit = lambda c: F.pmod(F.xxhash64(c), F.lit(BITS))
    words = (ids.select(bit(F.col("doc_id")).alias("b"))
             .groupBy(F.floor(F.col("b") / 64).cast("int").alias("w"))
             .agg(F.bit_or(F.expr("shiftleft(1L, cast(b % 64 as int))")).alias("bits")))
    every = ids.sparkSession.range(BITS // 64).select(F.col("id").cast("int").alias("w")).join(F.broadcast(words), "w", "left")
    one = stored(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("w", F.coalesce("bits", F.lit(0)).alias("bits")))),
                                       lambda x: x["bits"]).alias("table")), "bits")
    at = bit(F.col("doc_id"))
    return (docs.crossJoin(F.broadcast(one))
            .where(F.getbit(F.element_at("table", (F.floor(at / 64) + 1).cast("int")), (at % 64).cast("int")) == 1).drop("table"))


def verified(pairs: DataFrame, docs: DataFrame, ids: DataFrame, j: Join, name: str) -> DataFrame:
    """The pairs (a, b) of classes that are linked, by their documents' texts."""
    asked = pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct()
    wanted = stored(few(ids.join(asked, "cls", "left_semi").select("cls", "doc_id", "h")), f"{name}-wanted")
    # repeated rows of a document stand in the same task already
    texts = stored(asked_only(docs, wanted).hint("merge").join(wanted, ["doc_id", "h"])
                   .groupBy("doc_id", "h", "cls").agg(F.min("text").alias("text")).select("cls", "text"), f"{name}-texts")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        digest = WordHash()
        for p in batches:
            keep = []
            known: dict[int, np.ndarray] = {}
            for a, x, b, y in zip(p["a"].tolist(), p["ta"], p["b"].tolist(), p["tb"]):
                for c, t in ((a, x), (b, y)):
                    if c not in known:
                        known[c] = shingle_set(t, j.shingle, digest)
                x, y = sorted((known[a], known[b]), key=len)
                at = np.searchsorted(y, x)
                at[at == len(y)] = 0
                both = int(np.count_nonzero(y[at] == x))
                keep.append(100 * both >= j.percent * (len(x) + len(y) - both))
                if len(known) > 2000:
                    known.clear()
            yield p.loc[np.array(keep, bool), ["a", "b"]]

    both = (pairs.hint("merge").join(texts.select(F.col("cls").alias("a"), F.col("text").alias("ta")), "a")
            .hint("merge").join(texts.select(F.col("cls").alias("b"), F.col("text").alias("tb")), "b"))
    return few(both.select("a", "ta", "b", "tb")).mapInPandas(run, "a long, b long")


def pairs_apart(rest: DataFrame, ids: DataFrame, j: Join, name: str) -> DataFrame:
    """x, y: classes of different components of which x looks under a key where y
    is found, where they may be linked.  Similar texts share many keys; a pair
    comes up under the smallest one, and under no key beyond a smaller one that
    is among the first of both."""

    def first_keys(kind: str) -> F.Column:
        return F.slice(F.sort_array(F.collect_set(F.when(F.col(kind), F.col("key")))), 1, FIRSTS)

    firsts = rest.groupBy("cls").agg(first_keys("probe").alias("looked"), first_keys("found").alias("held"))
    sides = stored(few(firsts.join(ids, "cls").select("cls", "looked", "held", "n", *_KS)), f"{name}-sides")

    def side(kind: str, x: str, keys: str) -> DataFrame:
        shape = shaped(sides, x, keys)
        return rest.where(kind).select(F.col("key").alias(f"{x}_key"), F.col("cls").alias(x), F.col("root").alias(f"r{x}")).join(shape, x)

    earlier = F.array_min(F.array_intersect("looked", "held"))
    return side("probe", "x", "looked").hint("merge").join(
        side("found", "y", "held"),
        (F.col("x_key") == F.col("y_key")) & (F.col("rx") != F.col("ry")) & may_link("x", "y", j.percent)
        & (F.coalesce(earlier, F.col("x_key")) >= F.col("x_key")))


def linked(docs: DataFrame, j: Join = Join(), name: str = "ngram") -> DataFrame:
    """doc_id, n_shingles, component_id of every document."""
    out = linked_rows(docs, j, name, tie_ids=True)
    return out.groupBy("doc_id").agg(F.max("n_shingles").alias("n_shingles"), F.min("component_id").alias("component_id"))


def linked_rows(docs: DataFrame, j: Join, name: str, tie_ids: bool) -> DataFrame:
    """doc_id, h (digest of the text), n_shingles, component_id of every text of
    every document; with ``tie_ids`` the texts of one id are linked."""
    docs = docs.where(F.col("doc_id").isNotNull()).select(
        F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    rows = stored(shared_keys(rows_of(docs, j)), f"{name}-rows")
    members = stored(rows.where("body is not null").select("cls", "body").mapInPandas(unpacked, _MEMBERS), f"{name}-members")
    # equal sets are one class; its smallest document stands for it
    ids = stored(members.where("cls <> 0").groupBy("cls").agg(
        F.min(F.struct("doc_id", "h")).alias("r"), F.max("n_shingles").alias("n"), *(F.max(k).alias(k) for k in _KS))
        .select("cls", F.col("r.doc_id").alias("doc_id"), F.col("r.h").alias("h"), "n", *_KS), f"{name}-classes")
    live = rows.where("body is null").select("key", "cls", "found", "probe", "rep")

    # each probe with one member of the key's index: no more candidates than probes
    pair = (F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"))
    tied = live.where(F.col("probe") & (F.col("cls") != F.col("rep"))).select(F.col("cls").alias("x"), F.col("rep").alias("y"))
    star = stored(few(tied.select(*pair).distinct().join(shaped(ids, "a"), "a").join(shaped(ids, "b"), "b")
                      .where(may_link("a", "b", j.percent)).select("a", "b")), f"{name}-star-pairs")
    first = stored(verified(star, docs, ids, j, name), f"{name}-star")
    # again with other members, under keys that are not yet in one component,
    # while that links many of them
    links, newest, rest = first, first, live.select("key", "cls", "found", "probe")
    for again in range(1, STARS + 1):
        comp = components(links, f"{name}-components")
        links = comp.where("node <> root").select(F.col("root").alias("a"), F.col("node").alias("b"))
        named = (rest.select("key", "cls", "found", "probe").join(comp, F.col("cls") == F.col("node"), "left")
                 .select("key", "cls", "found", "probe", F.coalesce("root", "cls").alias("root")))
        apart = named.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 < r1").select("key")
        rest = stored(named.join(apart, "key", "left_semi"), f"{name}-rest")
        if again == STARS or LINKING * newest.count() < rest.select("cls").distinct().count():
            break
        order = F.xxhash64("cls", F.lit(again))
        rep = rest.where("found").groupBy("key").agg(F.min_by("cls", order).alias("y"), F.min_by("root", order).alias("ry"))
        tied = rest.where("probe").join(rep, "key").where("root <> ry").select(F.col("cls").alias("x"), "y")
        tied = stored(few(tied.select(*pair).distinct().join(shaped(ids, "a"), "a").join(shaped(ids, "b"), "b")
                          .where(may_link("a", "b", j.percent)).select("a", "b")), f"{name}-star-pairs")
        newest = stored(verified(tied, docs, ids, j, name), f"{name}-star")
        links = links.unionAll(newest)

    more = stored(few(pairs_apart(rest, ids, j, name).select(*pair).distinct().join(star, ["a", "b"], "left_anti")), f"{name}-pairs")
    second = stored(verified(more, docs, ids, j, name), f"{name}-more")
    links = links.unionAll(second)
    if tie_ids:
        # the classes of an id with several, each tied to the smallest
        several = (members.where("cls <> 0").groupBy("doc_id").agg(F.min("cls").alias("a"), F.max("cls").alias("z"))
                   .where("a < z").select("doc_id", "a"))
        links = links.unionAll(members.hint("merge").join(several, "doc_id").where("cls <> 0 and cls <> a")
                               .select("a", F.col("cls").alias("b")).distinct())
    root = components(links, f"{name}-components")

    placed = stored(few(ids.select("cls", "doc_id").join(root, F.col("cls") == F.col("node"), "left")
                        .select("cls", "doc_id", F.coalesce("root", "cls").alias("root"))), f"{name}-roots")
    smallest = stored(few(placed.groupBy("root").agg(F.min("doc_id").alias("component_id"))), f"{name}-smallest")
    named = stored(few(placed.hint("merge").join(smallest, "root").select("cls", "component_id")), f"{name}-named")
    return (members.hint("merge").join(named, "cls", "left")
            .select("doc_id", "h", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linked(table(spark, sf_dir, "documents"))


#: The pipeline's stage takes five words and a similarity of 0.8.
STAGE_JOIN = Join(shingle=5, percent=80)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each component the document with the smallest id
    stays; rows with a null id stay, as they are in no component.  Texts of one
    id are judged by themselves, so a copy takes no other text with it."""
    group = linked_rows(docs, STAGE_JOIN, "stage-ngram", tie_ids=False)
    own = fresh(docs, "own")
    gone = group.where("doc_id <> component_id").select(F.col("doc_id").alias("gone_id"), F.col("h").alias("gone_h")).distinct()
    keyed = docs.select(F.struct("doc_id", F.xxhash64("text").alias("h")).alias(own), *[F.col(f"`{c}`") for c in docs.columns])
    same = (F.col(own)["doc_id"] == gone["gone_id"]) & (F.col(own)["h"] == gone["gone_h"])
    return keyed.join(gone, same, "left_anti").drop(own)


SQL = r"""
WITH d AS (SELECT DISTINCT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, CASE WHEN len(w) < 4 THEN array_to_string(w, ' ') ELSE array_to_string(w[i:i + 3], ' ') END AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS i FROM s x JOIN s y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 85 * (na.n + nb.n - i)),
r AS (WITH RECURSIVE reach(a, b) AS (SELECT doc_id, doc_id FROM d UNION SELECT reach.a, l.b FROM reach JOIN l ON reach.b = l.a)
  SELECT a, min(b) AS c FROM reach GROUP BY a)
SELECT d.doc_id, coalesce(n, 0)::BIGINT AS n_shingles, c AS component_id FROM d JOIN r ON r.a = d.doc_id LEFT JOIN n USING (doc_id)
"""
