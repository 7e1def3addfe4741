"""Connected components of a graph of links, as joins and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import few, stored


def components(links: DataFrame, name: str = "components", rounds: int = 60) -> DataFrame:
    """node, root (the smallest node reachable) of every node of ``links``
    (columns a, b; any order, repeats allowed).

    Alternates the large-star and small-star steps, each one aggregation per
    node; the number of links never grows, and a node with very many links is
    spread by attaching them to its smallest neighbour.  Each round's links are
    a stored table.  Ends when every node is tied to one smaller node that is
    tied to no other, its component's smallest.
    """
    e = stored(few(links.select(F.least("a", "b").cast("long").alias("a"), F.greatest("a", "b").cast("long").alias("b"))
               .where("a < b")), name)
    for _ in range(rounds):
        # large star: every larger neighbour of a node is tied to the smallest
        # node of its neighbourhood (itself included)
        both = e.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(e.select(F.col("b").alias("u"), F.col("a").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")
        # small star: smaller neighbours and the node are tied to the smallest
        lows = large.groupBy(F.col("b").alias("u")).agg(F.min("a").alias("m"))
        small = (large.select(F.col("b").alias("u"), F.col("a").alias("v")).join(lows, "u")
                 .select(F.col("m").alias("a"), F.col("v").alias("b")).where("a < b")
                 .unionAll(lows.select(F.col("m").alias("a"), F.col("u").alias("b"))).distinct())
        e = stored(few(small), name)
        ends = e.select(F.col("a").alias("u"), F.lit(True).alias("low")).unionAll(e.select(F.col("b").alias("u"), F.lit(False).alias("low")))
        tied = ends.groupBy("u").agg(F.count_if("low").alias("lows"), F.count_if(~F.col("low")).alias("ups"))
        if tied.agg(F.count_if(F.expr("ups > 1 or (ups > 0 and lows > 0)"))).first()[0] == 0:
            break
    else:
        raise RuntimeError("components did not settle")
    return stored(few(e.select(F.col("b").alias("node"), F.col("a").alias("root"))
                      .unionAll(e.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())), name)
