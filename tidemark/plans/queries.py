"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir)
-> DataFrame`` over whole driver tables.  The DuckDB form of each is in
:mod:`tidemark.plans.oracle`; column names match one for one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.diff import reconcile, reconcile_summary, snapshot_diff
from tidemark.operators.latest import latest_one, latest_with_ties, split_valid
from tidemark.operators.merge import ambiguous_keys, fold, merge, visible
from tidemark.operators.quality import as_text, conform
from tidemark.session import scratch_path
from tidemark.sources import feeds
from tidemark.sources.feeds import FEED_CONTRACT, LINEITEM_CONTRACT, ORDERS_CONTRACT
from tidemark.sources.landing import full_load, project_contract, read_landing, split_corrupt, write_landing
from tidemark.sources.table import VersionedTable
from tidemark.streaming.upsert import start_upsert

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(name: str):
    def reg(fn: Query) -> Query:
        QUERIES[name] = fn
        return fn

    return reg


# ------------------------------------------------------------ latest per key
@query("latest_change_ties")
def latest_change_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 + B1-B5 + E1 on the events feed (compat)."""
    # B1: the reference fills a null op with ''; both are refused by the op filter.
    feed = feeds.event_feed(spark, sf_dir).fillna({"op": ""})
    return latest_with_ties(feed, FEED_CONTRACT)


@query("latest_change_ties_lineitem")
def latest_change_ties_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 with real ties: every row at a key's latest ship date survives."""
    feed = feeds.lineitem_feed(spark, sf_dir).drop("seq")
    return latest_with_ties(feed, LINEITEM_CONTRACT)


@query("latest_change_one")
def latest_change_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per key by (time, event_id); invalid ops filtered first."""
    return latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)


@query("latest_change_one_lineitem")
def latest_change_one_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 where ties at the max time are broken by a composite sequence."""
    return latest_one(feeds.lineitem_feed(spark, sf_dir), LINEITEM_CONTRACT).drop("seq")


@query("strict_quarantine")
def strict_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows strict mode refuses to apply, with the reasons."""
    _, bad = split_valid(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    return bad.select("event_id", "record_id", "cdc_ingestion_timestamp",
                      F.array_join("reasons", ",").alias("reasons"))


# --------------------------------------------------------------------- merge
def _merge(spark: SparkSession, sf_dir: str, mode: str, strategy: str = "auto"):
    feed = feeds.event_feed(spark, sf_dir)
    target = feeds.customer_target(spark, sf_dir)
    if mode == "compat":
        batch = latest_with_ties(feed, FEED_CONTRACT)
    else:
        batch = latest_one(feed, FEED_CONTRACT)
    return merge(target, batch, FEED_CONTRACT, mode=mode, strategy=strategy)


@query("merge_compat")
def merge_compat(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + F1-F3 with the reference rules (max before op filter, no guard)."""
    return _merge(spark, sf_dir, "compat").current()


@query("merge_strict")
def merge_strict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + F1-F3 + J4 with the time guard, updated state and tombstones."""
    return _merge(spark, sf_dir, "strict").current()


@query("merge_strict_shuffle")
def merge_strict_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge on the plan used beyond the broadcast bound (full outer)."""
    return _merge(spark, sf_dir, "strict", strategy="shuffle").current()


@query("merge_clustered")
def merge_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Merge on the plan for batches beyond the broadcast bound into a table
    bucketed by the key: only the batch is shuffled, the target streams
    bucket by bucket into the join and back out to the next version."""
    # Clustered by the key only: extra partition folders would multiply files.
    t = VersionedTable(spark, scratch_path(spark, "clustered"),
                       cluster_keys=FEED_CONTRACT.key_cols, cluster_buckets=16)
    t.write(feeds.customer_target(spark, sf_dir).withColumn("is_deleted", F.lit(False)))
    batch = latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    res = merge(t.read(), batch, FEED_CONTRACT, mode="strict", strategy="shuffle")
    t.write(res.table, clustered_input=True)
    return t.read(visible=True)


@query("merge_conflicts")
def merge_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The apply-conflict log of the strict merge (insert of a live key,
    update or delete of a missing key), with the action taken."""
    return _merge(spark, sf_dir, "strict").conflicts


@query("merge_action_counts")
def merge_action_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per merge action in both modes."""
    out = None
    for mode in ("compat", "strict"):
        counts = _merge(spark, sf_dir, mode).action_counts().select(
            F.lit(mode).alias("mode"), "action", "n")
        out = counts if out is None else out.unionByName(counts)
    return out


@query("rough_quarantine")
def rough_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows strict mode refuses, with every reason: null key, null time, bad op."""
    _, bad = split_valid(feeds.rough_feed(spark, sf_dir), feeds.ROUGH_CONTRACT)
    return bad.select("op", "state", "amount", "record_id", "cdc_ingestion_timestamp",
                      F.array_join("reasons", ",").alias("reasons"))


@query("rough_latest_ties")
def rough_latest_ties(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D1 where keys, times and ops are null, unknown or tied (Q1-Q5)."""
    return latest_with_ties(feeds.rough_feed(spark, sf_dir), feeds.ROUGH_CONTRACT)


@query("rough_latest_one")
def rough_latest_one(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 without a sequence: rows tied at a key's last time are ordered by
    their content (a delete first, then state and amount, then the op)."""
    return latest_one(feeds.rough_feed(spark, sf_dir), feeds.ROUGH_CONTRACT)


@query("merge_cardinality")
def merge_cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """the keys for which a compat MERGE of the tied changes is refused,
    those of the target that more than one change matches."""
    batch = latest_with_ties(feeds.rough_feed(spark, sf_dir), feeds.ROUGH_CONTRACT)
    return ambiguous_keys(feeds.all_customers(spark, sf_dir), batch, feeds.ROUGH_CONTRACT)


# ------------------------------------------------------ full load, batches
@query("full_load")
def full_load_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + B7: every customer as an insert change row with its capture time."""
    cu = feeds.table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("amount"),
        F.col("c_custkey").alias("record_id"),
    )
    return full_load(cu, FEED_CONTRACT, capture_literal=feeds.TARGET_TIME)


def _fold(spark: SparkSession, sf_dir: str, reverse: bool) -> DataFrame:
    batches = feeds.feed_batches(feeds.event_feed(spark, sf_dir))
    if reverse:
        batches = batches[::-1]
    state = fold(feeds.customer_target(spark, sf_dir), batches, FEED_CONTRACT, mode="strict")
    return visible(state)


@query("fold_batches")
def fold_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + H3: three time-ordered batches merged one by one equal one merge."""
    return _fold(spark, sf_dir, reverse=False)


@query("fold_batches_reversed")
def fold_batches_reversed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Late data: the same batches in reverse order give the same table."""
    return _fold(spark, sf_dir, reverse=True)


@query("stream_upsert")
def stream_upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + A2 + H1 + H2: the feed lands as CSV in three drops, and after each
    drop the job runs once (file stream, ``availableNow``): the checkpoint is
    the bookmark, so each run merges only the new drop.  Version 0 of the
    table is the full load of the target."""
    root = scratch_path(spark, "stream_upsert")
    landing = f"{root}/landing"
    table = VersionedTable.for_contract(spark, f"{root}/table", FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn("is_deleted", F.lit(False)), version=0)
    for drop in feeds.feed_batches(feeds.event_feed(spark, sf_dir)):
        write_landing(drop, landing, FEED_CONTRACT)
        changes = read_landing(spark, landing, FEED_CONTRACT, streaming=True)
        q = start_upsert(changes, table, FEED_CONTRACT, checkpoint=f"{root}/checkpoint",
                         specs=feeds.feed_typed_specs(), quarantine_path=f"{root}/quarantine")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
    return table.read(visible=True)


@query("stream_with_dml")
def stream_with_dml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H1 + F6 + I2 on one strict table: a drop, an UPDATE, a compaction, the
    other drops.  Every write builds on the one before it."""
    root = scratch_path(spark, "stream_dml")
    table = VersionedTable.for_contract(spark, f"{root}/table", FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn("is_deleted", F.lit(False)))
    first, *rest = feeds.feed_batches(feeds.event_feed(spark, sf_dir))

    def drop(rows: DataFrame) -> None:
        write_landing(rows, f"{root}/landing", FEED_CONTRACT)
        changes = read_landing(spark, f"{root}/landing", FEED_CONTRACT, streaming=True)
        q = start_upsert(changes, table, FEED_CONTRACT, checkpoint=f"{root}/checkpoint",
                         specs=feeds.feed_typed_specs(), quarantine_path=f"{root}/quarantine")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))

    drop(first)
    table.update("amount < 0", {"amount": "0.0D"})
    table.compact()
    for rows in rest:
        drop(rows)
    return table.read(visible=True)


@query("late_change_after_delete")
def late_change_after_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + H3: rows deleted from a strict table stay deleted for changes older
    than the delete and come back with newer ones."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, "late_delete"), FEED_CONTRACT)
    base = feeds.all_customers(spark, sf_dir).withColumn("is_deleted", F.lit(False))
    t.write(base.withColumn("cdc_ingestion_timestamp", F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")))
    t.delete("amount < 5000", at=feeds.DELETE_TIME)
    batch = latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    t.write(merge(t.read(), batch, FEED_CONTRACT).table)
    return t.read(visible=True)


# ------------------------------------------------------- snapshots, checks
@query("snapshot_diff")
def snapshot_diff_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I/U/D change rows between two snapshots of orders."""
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return snapshot_diff(a, b, ORDERS_CONTRACT)


@query("reconcile")
def reconcile_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys missing from, extra in or differing in a stale copy."""
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return reconcile(b, a, ORDERS_CONTRACT)


@query("reconcile_summary")
def reconcile_orders_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return reconcile_summary(reconcile(b, a, ORDERS_CONTRACT, only_mismatches=False))


def _conform(spark: SparkSession, sf_dir: str):
    return conform(as_text(feeds.event_feed(spark, sf_dir)), feeds.feed_specs())


@query("conform_good")
def conform_good(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1 + J2: landed text converted to the typed contract."""
    return _conform(spark, sf_dir)[0]


@query("conform_bad")
def conform_bad(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows set aside, raw text and the failed checks."""
    bad = _conform(spark, sf_dir)[1]
    return bad.select("op", "state", "amount", "record_id", "cdc_ingestion_timestamp", "event_id",
                      F.array_join("reasons", ",").alias("reasons"))


# ------------------------------------------------------- table operations
def _target_table(spark: SparkSession, sf_dir: str, name: str) -> VersionedTable:
    t = VersionedTable.for_contract(spark, scratch_path(spark, name), FEED_CONTRACT)
    t.write(feeds.customer_target(spark, sf_dir))
    return t


def _strict_customers(spark: SparkSession, sf_dir: str, name: str) -> VersionedTable:
    """Every customer in a strict table, rows of positive balance above 9000 already deleted."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, name), FEED_CONTRACT)
    t.write(feeds.all_customers(spark, sf_dir).withColumn("is_deleted", F.col("amount") > 9000))
    return t


def _left_out_customers(spark: SparkSession, sf_dir: str, extra: tuple = ()) -> DataFrame:
    cu = feeds.table(spark, sf_dir, "customer")
    return cu.where(F.col("c_mktsegment") == feeds.TARGET_LEFT_OUT_SEGMENT).select(
        F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("amount"),
        F.col("c_custkey").alias("record_id"),
        F.expr(f"TIMESTAMP_NTZ '{feeds.TARGET_TIME}'").alias("cdc_ingestion_timestamp"),
        *extra,
    )


@query("insert_rows")
def insert_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """INSERT of one segment's customers into a strict table that holds
    every customer, that segment as deleted: visible rows."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, "insert_rows"), FEED_CONTRACT)
    t.write(feeds.all_customers(spark, sf_dir).withColumn(
        "is_deleted", F.col("state") == feeds.TARGET_LEFT_OUT_SEGMENT))
    t.insert(_left_out_customers(spark, sf_dir))
    return t.read(visible=True)


@query("update_where")
def update_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """UPDATE ... SET amount = amount + 100 WHERE ... on a strict table;
    deleted rows (amounts above 9000) stay as they are."""
    t = _strict_customers(spark, sf_dir, "update_where")
    t.update("state = 'BUILDING' AND (amount < 0 OR amount > 9000)", {"amount": "amount + 100"})
    return t.read()


@query("delete_where")
def delete_where(spark: SparkSession, sf_dir: str) -> DataFrame:
    """DELETE ... WHERE amount < 0 on a strict table: stored rows, tombstones included."""
    t = _strict_customers(spark, sf_dir, "delete_where")
    t.delete("amount < 0", at="2024-02-01 00:00:00")
    return t.read()


@query("evolve_add_column")
def evolve_add_column(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Add a column; old rows read null, new rows carry it."""
    t = _target_table(spark, sf_dir, "evolve")
    t.add_columns({"nation": "int"})
    t.insert(_left_out_customers(spark, sf_dir, (F.col("c_nationkey").alias("nation"),)))
    return t.read()


@query("compact")
def compact_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + A7: many small files rewritten near the target size; rows unchanged."""
    t = VersionedTable(spark, scratch_path(spark, "compact"), partition_cols=("event_type",))
    t.write(feeds.table(spark, sf_dir, "events").repartition(32), rebalance=False)
    t.compact()
    return t.read()


@query("partition_layout")
def partition_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A6 + G3: identity(state) + bucket(16, key) layout, as the stored folders
    tell it: rows per state, the number of buckets that rows of the state are
    in, and rows that lie outside the bucket of their key."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, "layout"), FEED_CONTRACT)
    t.write(feeds.all_customers(spark, sf_dir))
    folder = F.regexp_extract(F.input_file_name(), "record_id_bucket=([0-9]+)/", 1).cast("int")
    rows = spark.read.parquet(t.version_path(0)).select(
        F.url_decode(F.regexp_extract(F.input_file_name(), "/state=([^/]*)/", 1)).alias("state"),
        "record_id", folder.alias("bucket"))
    own = F.pmod(F.hash(F.col("record_id")), F.lit(FEED_CONTRACT.num_buckets))
    return rows.groupBy("state").agg(
        F.count(F.lit(1)).alias("n_rows"), F.sum("record_id").alias("sum_keys"),
        F.sum((F.col("bucket").isNull() | (F.col("bucket") != own)).cast("long")).alias("n_misplaced"),
        F.sum((~F.col("bucket").between(0, FEED_CONTRACT.num_buckets - 1)).cast("long")).alias("n_outside"))


@query("adhoc_sql")
def adhoc_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A5 + A8 + I3: SQL over a view of the merged table's current version."""
    t = _target_table(spark, sf_dir, "adhoc")
    res = merge(t.read(), latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT), FEED_CONTRACT)
    t.write(res.table)
    t.view("current_state")
    return spark.sql(ADHOC_SQL)


ADHOC_SQL = """
SELECT state, count(*) AS n, min(amount) AS min_amount, max(amount) AS max_amount,
       max(cdc_ingestion_timestamp) AS last_change
FROM current_state GROUP BY state"""


@query("landing_roundtrip")
def landing_roundtrip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A1 + B6: change rows written as unquoted CSV and scanned back by schema."""
    path = scratch_path(spark, "landing")
    write_landing(feeds.event_feed(spark, sf_dir), path, FEED_CONTRACT)
    rows, _ = split_corrupt(read_landing(spark, path, FEED_CONTRACT))
    return project_contract(rows, FEED_CONTRACT)
