"""

    python tools/measure.py [sf_dir]

The window-max form of latest-per-key below is the reference job's own
formulation, kept here only as the comparison point: it sends every row of a
key to one task, so the library uses the aggregate + join form instead.
"""

from __future__ import annotations

import json
import statistics
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from tidemark.contract import ChangeContract  # noqa: E402
from tidemark.functions.expr import valid_op  # noqa: E402
from tidemark.operators.diff import reconcile, snapshot_diff  # noqa: E402
from tidemark.operators.digest_tree import differing_rows, reconcile_by_digest  # noqa: E402
from tidemark.operators.latest import latest_one, latest_with_ties  # noqa: E402
from tidemark.operators.merge import merge  # noqa: E402
from tidemark.session import local_session, scratch_path  # noqa: E402
from tidemark.sources import feeds  # noqa: E402
from tidemark.sources.feeds import FEED_CONTRACT, LINEITEM_CONTRACT, ORDERS_CONTRACT  # noqa: E402
from tidemark.sources.landing import read_landing, write_landing  # noqa: E402
from tidemark.sources.table import VersionedTable  # noqa: E402
from tidemark.streaming.upsert import start_upsert  # noqa: E402


def timed(fn, runs=3):
    fn()
    out = []
    for _ in range(runs):
        t0 = time.perf_counter()
        fn()
        out.append(time.perf_counter() - t0)
    return round(statistics.median(out), 3)


def run(df_fn):
    return lambda: df_fn().write.format("noop").mode("overwrite").save()


def window_ties(changes, c):
    w = Window.partitionBy(*c.key_cols)
    m = changes.withColumn("_m", F.max(c.ts_col).over(w))
    return m.where((F.col(c.ts_col) == F.col("_m")) & valid_op(c.op_col)).drop("_m")


ORDERS_TARGET = ChangeContract(columns=ORDERS_CONTRACT.columns, key_cols=("o_orderkey",), ts_col="o_orderdate")


def orders_batch(spark, sf_dir, small: bool):
    od = feeds.table(spark, sf_dir, "orders")
    if small:  # orders of one month (about 1% of the table) repriced
        od = od.where((F.year("o_orderdate") == 1998) & (F.month("o_orderdate") == 1))
    return od.select(F.lit("U").alias("op"), "o_orderkey", "o_custkey", "o_orderstatus",
                     (F.col("o_totalprice") + 1).alias("o_totalprice"),
                     F.expr("o_orderdate + INTERVAL 1 DAY").alias("o_orderdate"), "o_orderpriority")


def validation(spark, sf_dir: str, copies: int = 20) -> dict:
    """Full outer join against digest tree over ``copies`` times the orders
    (keys moved apart), with no, few and many rows changed in the second table."""
    od = feeds.table(spark, sf_dir, "orders").select(*ORDERS_CONTRACT.columns)
    most = od.agg(F.max("o_orderkey")).first()[0] + 1
    many = od.withColumn("c", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    path = scratch_path(spark, "measure_orders")
    many.withColumn("o_orderkey", F.col("o_orderkey") + F.col("c") * most).drop("c").write.parquet(path)
    a = spark.read.parquet(path)
    res = {"validation_rows": a.count()}
    for tag, changed in (("equal", F.lit(False)), ("one_in_100000", F.col("o_orderkey") % 100_000 == 7), ("one_in_5", F.col("o_orderkey") % 5 == 0)):
        other = f"{path}-{tag}"
        a.withColumn("o_totalprice", F.when(changed, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))).write.parquet(other)
        b = spark.read.parquet(other)
        res[f"validation_{tag}_full_join"] = timed(run(lambda: reconcile(a, b, ORDERS_CONTRACT)))
        res[f"validation_{tag}_digest_tree"] = timed(run(lambda: reconcile_by_digest(a, b, ORDERS_CONTRACT)))
        res[f"validation_{tag}_levels"] = [(x.bits, x.ranges, x.differing, x.rows[0]) for x in differing_rows(a, b, ORDERS_CONTRACT).levels]
    return res


def main():
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    spark = local_session()
    spark.sparkContext.setLogLevel("ERROR")
    res = {}
    ev = lambda: feeds.event_feed(spark, sf_dir)
    li = lambda: feeds.lineitem_feed(spark, sf_dir).drop("seq")
    res["latest_events_window_max"] = timed(run(lambda: window_ties(ev(), FEED_CONTRACT)))
    res["latest_events_agg_join"] = timed(run(lambda: latest_with_ties(ev(), FEED_CONTRACT)))
    res["latest_events_max_by"] = timed(run(lambda: latest_one(ev(), FEED_CONTRACT)))
    res["latest_lineitem_window_max"] = timed(run(lambda: window_ties(li(), LINEITEM_CONTRACT)))
    res["latest_lineitem_agg_join"] = timed(run(lambda: latest_with_ties(li(), LINEITEM_CONTRACT)))
    res["latest_lineitem_max_by"] = timed(run(
        lambda: latest_one(feeds.lineitem_feed(spark, sf_dir), LINEITEM_CONTRACT)))

    # one key holding a third of all rows: every lineitem with return flag N
    # is re-keyed to -1 (the flag splits the table in three)
    hot = lambda: feeds.lineitem_feed(spark, sf_dir).withColumn(
        "record_id", F.when(F.col("op") == "D", F.lit(-1)).otherwise(F.col("record_id")))
    res["hot_key_window_max"] = timed(run(lambda: window_ties(hot().drop("seq"), LINEITEM_CONTRACT)))
    res["hot_key_agg_join"] = timed(run(lambda: latest_with_ties(hot().drop("seq"), LINEITEM_CONTRACT)))
    res["hot_key_max_by"] = timed(run(lambda: latest_one(hot(), LINEITEM_CONTRACT)))

    target = lambda: feeds.table(spark, sf_dir, "orders").select(*ORDERS_CONTRACT.columns)
    for small in (True, False):
        tag = "small_batch" if small else "full_batch"
        for strategy in ("auto", "shuffle"):
            chosen = []

            def go():
                m = merge(target(), orders_batch(spark, sf_dir, small), ORDERS_TARGET,
                          mode="strict", strategy=strategy)
                chosen.append(m.strategy)
                m.table.write.format("noop").mode("overwrite").save()

            res[f"merge_{tag}_{strategy}"] = timed(go)
            res[f"merge_{tag}_{strategy}_plan"] = chosen[-1]

    # the same full-batch merge into a target bucketed by the key
    ct = VersionedTable(spark, scratch_path(spark, "measure_clustered"),
                        cluster_keys=("o_orderkey",), cluster_buckets=16)
    ct.write(target())

    def go_clustered():
        m = merge(ct.read(), orders_batch(spark, sf_dir, False), ORDERS_TARGET, mode="strict",
                  strategy="shuffle")
        m.table.write.format("noop").mode("overwrite").save()

    res["merge_full_batch_clustered_target"] = timed(go_clustered)

    a_b = lambda: snapshot_diff(*feeds.orders_snapshots(spark, sf_dir), ORDERS_CONTRACT)
    res["snapshot_diff_orders"] = timed(run(a_b))

    # streaming: the events feed landed as 10 files, one file per trigger
    root = scratch_path(spark, "measure_stream")
    feed = feeds.event_feed(spark, sf_dir)
    write_landing(feed.repartition(10), f"{root}/landing", FEED_CONTRACT)
    table = VersionedTable.for_contract(spark, f"{root}/table", FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn("is_deleted", F.lit(False)), version=0)
    stream = read_landing(spark, f"{root}/landing", FEED_CONTRACT, streaming=True, max_files_per_trigger=1)
    t0 = time.perf_counter()
    q = start_upsert(stream, table, FEED_CONTRACT, f"{root}/ckpt", specs=feeds.feed_typed_specs(), discard_rejects=True)
    q.awaitTermination()
    secs = time.perf_counter() - t0
    n = feed.count()
    res["stream_upsert_triggers"] = len(table.versions()) - 1
    res["stream_upsert_rows_per_sec"] = round(n / secs, 1)
    res["stream_upsert_sec_per_trigger"] = round(secs / max(1, len(table.versions()) - 1), 3)

    t = VersionedTable(spark, scratch_path(spark, "measure_compact"), partition_cols=("event_type",))
    t.write(feeds.table(spark, sf_dir, "events").repartition(64), rebalance=False)
    v, before, after = t.compact()
    res["compact_files_before"], res["compact_files_after"] = before, after
    res |= validation(spark, sf_dir)
    print(json.dumps(res, indent=1))


if __name__ == "__main__":
    main()
