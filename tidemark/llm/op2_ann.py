"""Approximate nearest neighbours with a hierarchical k-means tree.

The tree is grown on a bounded sample; every row is then put into its leaf.  A
query walks the tree best bin first: a priority queue holds the open nodes by
the inner product of their centre with the query, and yields leaves in that
order.  On a calibration set of queries with known exact neighbours, the number
of leaves visited is widened until the wanted recall is reached; all queries
then visit that many leaves.  Rows of a leaf are split into blocks of bounded
size, and the queries that visit it into parts of bounded size; each block meets
each part in a group of its own, so no leaf is ever one task's work.

Nearness is the inner product in double precision.

Defined results: vectors that are null, zero, or hold a null or non-finite
component take no part, as queries or candidates, and neither do vectors of
another length than the most common one; equal vectors of several ids are separate
candidates (ties go to the smaller id), repeated rows of one id are one; rows with a null id are candidates of
nobody; an empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import bit_table, crc32_of, has_bit, stored, table


#: Lists of ``k`` rows that one aggregation joins.
FAN = 64


@dataclass(frozen=True)
class Ann:
    k: int = 20
    #: The tree is grown on at most so many vectors, the first by hash of the id.
    sample_rows: int = 16_384
    branch: int = 8
    leaf_rows: int = 64  # of the sample
    #: Queries whose exact neighbours calibrate the number of leaves.
    calibration: int = 200
    recall: float = 0.97
    #: Rows of a leaf in one block, queries of a leaf in one part, and queries
    #: joined with a block at a time.
    block_rows: int = 4096
    part_rows: int = 4096
    query_rows: int = 1024
    seed: int = 2


@dataclass
class Tree:
    """Node n has the centre centers[n] and the children kids[n]; without
    children it is the leaf number leaf[n]."""

    centers: np.ndarray
    kids: list[list[int]]
    leaf: list[int]
    leaves: int

    def leaf_of(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row: at each level the nearest centre's child."""
        out = np.empty(len(x), np.int64)
        todo = [(0, np.arange(len(x)))]
        while todo:
            node, rows = todo.pop()
            if not len(rows):
                continue
            if not self.kids[node]:
                out[rows] = self.leaf[node]
                continue
            near = nearest(x[rows], self.centers[self.kids[node]])
            todo += [(kid, rows[near == i]) for i, kid in enumerate(self.kids[node])]
        return out

    def walk(self, q: np.ndarray, most: int) -> list[int]:
        """The first ``most`` leaves, best bin first."""
        score = self.centers @ q
        heap, out = [(0.0, 0)], []
        while heap and len(out) < most:
            _, node = heapq.heappop(heap)
            while self.kids[node]:  # go down to the best child; the others wait
                best, *rest = sorted(self.kids[node], key=lambda n: (-score[n], n))
                for other in rest:
                    heapq.heappush(heap, (-score[other], other))
                node = best
            out.append(self.leaf[node])
        return out


def nearest(x: np.ndarray, centers: np.ndarray) -> np.ndarray:
    return np.argmin((centers**2).sum(1) - 2 * (x @ centers.T), axis=1)


def grow(x: np.ndarray, p: Ann) -> Tree:
    """Hierarchical k-means, node by node."""
    rng = np.random.default_rng(p.seed)
    centers, kids, leaf, leaves = [x.mean(0)], [[]], [-1], 0
    todo = [(0, np.arange(len(x)))]
    while todo:
        node, rows = todo.pop(0)
        own = x[rows]
        if len(rows) > p.leaf_rows and (own != own[0]).any():
            c = own[rng.choice(len(own), min(p.branch, len(own)), replace=False)]
            for _ in range(8):
                near = nearest(own, c)
                c = np.array([own[near == i].mean(0) if (near == i).any() else c[i] for i in range(len(c))])
            near = nearest(own, c)
            parts = [rows[near == i] for i in range(len(c)) if (near == i).any()]
            if len(parts) > 1:
                for i in range(len(c)):
                    if (near == i).any():
                        kids[node].append(len(centers))
                        centers.append(c[i])
                        kids.append([])
                        leaf.append(-1)
                todo += list(zip(kids[node], parts))
                continue
        leaf[node] = leaves
        leaves += 1
    return Tree(np.array(centers), kids, leaf, leaves)


def usable(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """vec_id and v (array of double) of the vectors that take part."""
    v = F.col("v")
    out = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vec_col).cast("array<double>").alias("v")).where(
        F.col("vec_id").isNotNull() & v.isNotNull()
        & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
        & F.exists(v, lambda x: x != 0))
    size = out.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return out.where(F.size("v") == (size[0]["n"] if size else 0))


def distinct(rows: DataFrame, name: str, bits: int = 23) -> DataFrame:
    """``rows`` (vec_id, v) without repeated ones.  Only rows of ids that occur
    twice, and few more, are shuffled for it."""
    ids = rows.groupBy("vec_id").agg(F.count("*").alias("n")).where("n > 1")
    table_ = bit_table(ids.select(F.xxhash64("vec_id").alias("key")), bits, f"{name}-ids")
    twice = has_bit(table_, F.xxhash64("vec_id"), bits)
    return rows.where(~twice).unionByName(rows.where(twice).dropDuplicates(["vec_id", "v"]))


def nearest_of(found: DataFrame, key: str, lists: int, k: int) -> DataFrame:
    """key, all: the ``k`` best (smallest) ``hit`` of every key, in order, of
    the ``lists`` lists of ``k`` that each key has at most (``bin`` tells them
    apart).  Lists are joined ``FAN`` at a time, so that none grows with the table."""
    while lists > FAN:
        lists = -(-lists // FAN)
        part = F.pmod(F.xxhash64("bin", F.lit(lists)), F.lit(lists))
        found = (found.groupBy(key, part.alias("bin")).agg(F.slice(F.array_sort(F.collect_set("hit")), 1, k).alias("all"))
                 .select(key, "bin", F.explode("all").alias("hit")))
    return found.groupBy(key).agg(F.slice(F.array_sort(F.collect_set("hit")), 1, k).alias("all"))


def exact_scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Inner products, each summed in the same order wherever it is computed."""
    return (x * q).sum(axis=1)


def top_of(q_ids: np.ndarray, q: np.ndarray, ids: np.ndarray, x: np.ndarray, k: int):
    """(query position, id, score) of each query's k best rows of ``x`` other
    than itself.  A matrix product finds them, with a margin for its rounding;
    their scores are then computed one by one, so equal vectors tie."""
    out = []
    prod = q @ x.T
    margin = 1e-9 * (1 + np.abs(prod).max())
    own = (ids[None, :] == q_ids[:, None]).sum(axis=1)
    for i in range(len(q)):
        row = prod[i]
        n = k + own[i]  # the query itself may be among them
        floor = np.partition(row, len(row) - n)[len(row) - n] - margin if len(row) > n else -np.inf
        c = np.flatnonzero(row >= floor)
        c = c[ids[c] != q_ids[i]]
        s = exact_scores(q[i], x[c])
        best = np.lexsort((ids[c], -s))[:k]
        out.append((np.full(len(best), i), ids[c][best], s[best]))
    return tuple(np.concatenate(z) for z in zip(*out)) if out else (np.empty(0, int),) * 3


def search(vectors: DataFrame, queries: DataFrame, p: Ann = Ann(), id_col: str = "vec_id",
           vec_col: str = "embedding", name: str = "ann") -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``k`` nearest found.
    ``queries`` has the same columns as ``vectors``."""
    base = distinct(usable(vectors, id_col, vec_col), name)
    sample = base.orderBy(crc32_of(F.col("vec_id")), "vec_id").limit(p.sample_rows).collect()
    if not sample:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    x = np.array([r["v"] for r in sample])
    tree = grow(x, p)

    def place(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            if len(b):
                yield b.assign(leaf=tree.leaf_of(np.vstack(b["v"].to_numpy())))

    index = stored(base.mapInPandas(place, "vec_id long, v array<double>, leaf long"), f"{name}-index")
    asked = stored(distinct(usable(queries, id_col, vec_col), f"{name}-asked"), f"{name}-queries")
    visits = calibrated(index, asked, tree, p)

    rows, asks = dealt(index, asked, tree, visits, p, name)
    blocks = visits + index.count() // p.block_rows  # that a query meets, at most

    def match(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        out = []
        here = (int(key[0]) << 32) | int(key[1])
        if len(left) and len(right):
            ids, own = left["vec_id"].to_numpy(), np.vstack(left["v"].to_numpy())
            for a in range(0, len(right), p.query_rows):
                part = right.iloc[a : a + p.query_rows]
                q_ids = part["vec_id"].to_numpy()
                i, found, s = top_of(q_ids, np.vstack(part["v"].to_numpy()), ids, own, p.k)
                out.append(pd.DataFrame({"query_id": q_ids[i], "vec_id": found, "score": s, "bin": here}))
        return pd.concat(out) if out else pd.DataFrame({"query_id": [], "vec_id": [], "score": [], "bin": []})

    found = (rows.groupBy("leaf", "block", "part").cogroup(asks.groupBy("leaf", "block", "part"))
             .applyInPandas(match, "query_id long, vec_id long, score double, bin long"))
    # at most k rows of a query from each block it visits
    best = nearest_of(found.select("query_id", "bin", F.struct((-F.col("score")).alias("s"), "vec_id").alias("hit")), "query_id", blocks, p.k)
    return best.select("query_id", F.posexplode("all").alias("pos", "hit")).select(
        "query_id", (F.col("pos") + 1).cast("int").alias("rank"), F.col("hit.vec_id").alias("vec_id"),
        (-F.col("hit.s")).alias("score"))


def dealt(index: DataFrame, asked: DataFrame, tree: Tree, visits: int, p: Ann, name: str) -> tuple[DataFrame, DataFrame]:
    """The rows of every leaf, and the queries that visit it, with leaf, block
    and part: blocks of rows and parts of queries, each of bounded size, every
    block beside every part."""

    def walk(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for b in batches:
            yield b[["vec_id", "v"]].assign(leaves=[tree.walk(np.asarray(v), visits) for v in b["v"]])

    walked = stored(asked.select("vec_id", "v").mapInPandas(walk, "vec_id long, v array<double>, leaves array<long>"), f"{name}-walks")
    asks = walked.select("vec_id", "v", F.explode("leaves").alias("leaf"))

    # the number of leaves is bounded by the sample, and so are these lists
    def counted(df: DataFrame, most: int):
        n = {r["leaf"]: -(-r["n"] // most) for r in df.groupBy("leaf").agg(F.count("*").alias("n")).collect()}
        return F.element_at(F.array(*[F.lit(n.get(i, 0)) for i in range(tree.leaves)]), (F.col("leaf") + 1).cast("int"))

    def side(df: DataFrame, own: str, n_own, salt: int, other: str, n_other) -> DataFrame:
        """Dealt by ``own``, and repeated for each ``other``."""
        return (df.withColumn(own, F.pmod(F.xxhash64("vec_id", F.lit(salt)), n_own)).where(n_other > 0)
                .withColumn(other, F.explode(F.sequence(F.lit(0).cast("long"), (n_other - 1).cast("long")))).select("vec_id", "v", "leaf", "block", "part"))

    blocks, parts = counted(index, p.block_rows), counted(asks.select("leaf"), p.part_rows)
    return side(index, "block", blocks, p.seed, "part", parts), side(asks, "part", parts, p.seed + 1, "block", blocks)


def calibrated(index: DataFrame, asked: DataFrame, tree: Tree, p: Ann) -> int:
    """Leaves to visit: widened from 1 until the calibration queries find the
    wanted share of their exact neighbours.

    The exact neighbours come from one pass over all rows, in which each task
    keeps its ``k`` best rows of each calibration query.
    """
    got = asked.orderBy(crc32_of(F.col("vec_id")), "vec_id").limit(p.calibration).collect()
    if not got:
        return 1
    q_ids, q = np.array([r["vec_id"] for r in got]), np.array([r["v"] for r in got])

    def best(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top, task = None, TaskContext.get().partitionId()
        for b in batches:
            if len(b):
                ids, leaf = b["vec_id"].to_numpy(), b["leaf"].to_numpy()
                i, found, s = top_of(q_ids, q, ids, np.vstack(b["v"].to_numpy()), p.k)
                by_id = dict(zip(ids.tolist(), leaf.tolist()))
                own = pd.DataFrame({"q": i, "vec_id": found, "score": s, "leaf": [by_id[f] for f in found.tolist()]})
                top = own if top is None else pd.concat([top, own])
                top = top.sort_values(["q", "score", "vec_id"], ascending=[True, False, True]).groupby("q").head(p.k)
        if top is not None:
            yield top.assign(bin=task)

    hits = index.mapInPandas(best, "q int, vec_id long, score double, leaf long, bin long")
    hits = hits.select("q", "bin", F.struct((-F.col("score")).alias("s"), "vec_id", "leaf").alias("hit"))
    tasks = index.select(F.spark_partition_id()).distinct().count()
    near = nearest_of(hits, "q", tasks, p.k).collect()  # k rows of each calibration query
    place = []  # the visit in which each exact neighbour is met
    for r in near:
        order = {leaf: i + 1 for i, leaf in enumerate(tree.walk(q[r["q"]], tree.leaves))}
        place += [order[n["leaf"]] for n in r["all"]]
    place = np.array(place)
    visits = 1
    while visits < tree.leaves and (place <= visits).mean() < p.recall:
        visits = min(tree.leaves, max(visits + 1, visits * 5 // 4))
    return visits


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return search(rows, rows.where(F.col("vec_id") % 20 == 0))
