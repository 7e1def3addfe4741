"""Registered queries on validation, several writers, the end of tombstones, the
change log, files, schema versions and statements, each with its DuckDB SQL.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import DELETED_COL, ChangeContract, ColumnSpec
from tidemark.functions.expr import to_change_time_any
from tidemark.operators.apply import apply_changes, conflicts_of
from tidemark.operators.digest_tree import reconcile_by_digest, reconcile_summary_by_digest, snapshot_diff_by_digest
from tidemark.operators.latest import latest_one
from tidemark.plans.oracle import MERGE_STRICT_SQL, ORACLE
from tidemark.plans.queries import _strict_customers, query
from tidemark.replicate import replicate
from tidemark.session import scratch_path
from tidemark.sources import catalog, feeds
from tidemark.sources.feeds import ALL_CUSTOMERS_SQL, BATCH_CUTS, FEED_CONTRACT, FEED_SQL, LINEITEM_CONTRACT, ORDERS_CONTRACT, TARGET_SQL
from tidemark.sources.table import VersionedTable, folder_exists
from tidemark.sources.landing import read_landing, write_landing
from tidemark.streaming.upsert import start_upsert, upsert_batch_fn

_VALID = "op IN ('I','U','D') AND record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL"


# ---------------------------------------------------------- digest tree
@query("reconcile_by_digest")
def reconcile_orders_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J3 on a digest tree: only rows in key ranges that differ are joined."""
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return reconcile_by_digest(b, a, ORDERS_CONTRACT)


@query("reconcile_summary_by_digest")
def reconcile_orders_summary_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per class; those of equal ranges are counted, never joined."""
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return reconcile_summary_by_digest(b, a, ORDERS_CONTRACT)


@query("snapshot_diff_by_digest")
def snapshot_diff_orders_by_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J1 on a digest tree."""
    a, b = feeds.orders_snapshots(spark, sf_dir)
    return snapshot_diff_by_digest(a, b, ORDERS_CONTRACT)


@query("validate_after_load")
def validate_after_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3 + J3: the customers are loaded into a table, a statement changes few
    of them and deletes some others, and the table is validated against its
    source row by row."""
    source = feeds.all_customers(spark, sf_dir)
    t = VersionedTable.for_contract(spark, scratch_path(spark, "validate"), FEED_CONTRACT)
    t.write(source)
    t.update("amount < -950", {"amount": "amount - 1"})
    t.delete("amount > 9900")
    return reconcile_by_digest(source, t.read(), FEED_CONTRACT)


ORACLE["reconcile_by_digest"] = ORACLE["reconcile"]
ORACLE["reconcile_summary_by_digest"] = ORACLE["reconcile_summary"]
ORACLE["snapshot_diff_by_digest"] = ORACLE["snapshot_diff"]
ORACLE["validate_after_load"] = """
SELECT c_custkey AS record_id, CASE WHEN c_acctbal > 9900 THEN 'missing' ELSE 'differ' END AS status,
       CASE WHEN c_acctbal < -950 THEN 'amount' END AS diff_cols
FROM customer WHERE c_acctbal < -950 OR c_acctbal > 9900"""


# --------------------------------------------------------- latest of wide rows
@query("latest_change_one_wide")
def latest_change_one_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D2 by a hash aggregate of keys and times; whole rows are compared only
    where a key has several at its last time."""
    return latest_one(feeds.lineitem_feed(spark, sf_dir), LINEITEM_CONTRACT, wide=True).drop("seq")


@query("rough_latest_one_wide")
def rough_latest_one_wide(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same over null keys, null times, unknown ops and ties without a sequence."""
    return latest_one(feeds.rough_feed(spark, sf_dir), feeds.ROUGH_CONTRACT, wide=True)


ORACLE["latest_change_one_wide"] = ORACLE["latest_change_one_lineitem"]
ORACLE["rough_latest_one_wide"] = ORACLE["rough_latest_one"]


# ------------------------------------------------------------ several writers
def at_once(*work) -> None:
    """Run functions in threads of their own; the first error is raised."""
    errors: list[BaseException] = []

    def run(fn) -> None:
        try:
            fn()
        except BaseException as e:  # noqa: BLE001 - raised again below
            errors.append(e)

    threads = [threading.Thread(target=run, args=(fn,)) for fn in work]
    for t in threads:
        t.start()
    for t in threads:
        t.join()
    if errors:
        raise errors[0]


@query("concurrent_writers")
def concurrent_writers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q12: an UPDATE, a DELETE and a batch of changes write one table at the
    same time; whichever loses the race for a version runs again on the
    winner's, so that all three are in the result."""
    path = scratch_path(spark, "writers")
    table = VersionedTable.for_contract(spark, path, FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn(DELETED_COL, F.lit(False)))

    def writer() -> VersionedTable:
        return VersionedTable.for_contract(spark, path, FEED_CONTRACT)

    changes = upsert_batch_fn(writer(), FEED_CONTRACT, discard_rejects=True, stream_id="feed")
    at_once(
        lambda: writer().update("state = 'BUILDING'", {"state": "'B2'"}),
        lambda: writer().delete("state = 'MACHINERY'", at=feeds.TARGET_TIME),
        lambda: changes(feeds.event_feed(spark, sf_dir), 0))
    return table.read(visible=True)


# A change that the feed applies sets the state in any order of the three; a
# deleted row comes back if its change is at least as new as the delete, which
# has the target's own time.
ORACLE["concurrent_writers"] = f"""
SELECT CASE WHEN state = 'BUILDING' THEN 'B2' ELSE state END AS state, amount, record_id, cdc_ingestion_timestamp
FROM ({MERGE_STRICT_SQL}) WHERE state <> 'MACHINERY'"""


# ------------------------------------------------------- the end of tombstones
@query("tombstones_expire")
def tombstones_expire(spark: SparkSession, sf_dir: str) -> DataFrame:
    """H3 + I2: two drops of the feed are applied, the low-water mark moves to
    the second cut, and a compaction drops the tombstones below it.  Then the
    first drop lands again in another stream, with the third: what is older
    than the mark is set aside.  All stored rows, tombstones included."""
    root = scratch_path(spark, "tombstones")
    table = VersionedTable.for_contract(spark, f"{root}/table", FEED_CONTRACT)
    table.write(feeds.all_customers(spark, sf_dir).withColumns({
        DELETED_COL: F.lit(False), "cdc_ingestion_timestamp": F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'")}))
    first, second, third = feeds.feed_batches(feeds.event_feed(spark, sf_dir))
    stream = upsert_batch_fn(table, FEED_CONTRACT, quarantine_path=f"{root}/rejects", stream_id="feed")
    stream(first, 0)
    stream(second, 1)
    table.set_low_water(BATCH_CUTS[1])
    table.compact()
    again = upsert_batch_fn(table, FEED_CONTRACT, quarantine_path=f"{root}/rejects", stream_id="late")
    again(first.unionByName(third), 0)
    late = spark.read.parquet(f"{root}/rejects").where("stream = 'late' and array_contains(reasons, 'below_low_water')").count()
    return table.read().drop("change_seq").withColumn("n_late", F.lit(late).cast("long"))


ORACLE["tombstones_expire"] = f"""
WITH feed AS ({FEED_SQL}), valid AS (SELECT * FROM feed WHERE {_VALID}),
base AS (SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
         TIMESTAMP '2024-01-01 00:00:00' AS cdc_ingestion_timestamp FROM customer),
one AS (SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) = 1),
won AS (SELECT b.* FROM one b LEFT JOIN base t USING (record_id)
  WHERE t.record_id IS NULL OR b.cdc_ingestion_timestamp >= t.cdc_ingestion_timestamp),
stored AS (
  SELECT state, amount, record_id, cdc_ingestion_timestamp, op = 'D' AS is_deleted FROM won
  WHERE op <> 'D' OR cdc_ingestion_timestamp >= TIMESTAMP '{BATCH_CUTS[1]}'
  UNION ALL SELECT *, false FROM base WHERE record_id NOT IN (SELECT record_id FROM won)),
late AS (SELECT count(*) AS n_late FROM valid WHERE cdc_ingestion_timestamp < TIMESTAMP '{BATCH_CUTS[0]}')
SELECT stored.*, n_late FROM stored, late"""


# ---------------------------------------------------------- one pass, its log
def _applied(spark: SparkSession, sf_dir: str, **kw):
    table = VersionedTable.for_contract(spark, scratch_path(spark, "applied"), FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn(DELETED_COL, F.lit(False)))
    batch = latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    done = []
    table.transact(lambda base: done.append(apply_changes(table, batch, FEED_CONTRACT, base, **kw)) or done[-1].version)
    return table, done[-1]


@query("apply_in_one_pass")
def apply_in_one_pass(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C1 + F1-F3: a strict merge that reads the target once and writes the version."""
    table, _ = _applied(spark, sf_dir)
    return table.read(visible=True)


@query("apply_in_one_pass_shuffle")
def apply_in_one_pass_shuffle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same beyond the broadcast bound: one full outer join, written once."""
    table, _ = _applied(spark, sf_dir, strategy="shuffle")
    return table.read(visible=True)


@query("apply_conflicts")
def apply_conflicts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The conflicts of that merge, read from the change log of the version
    it wrote, not by a second merge."""
    table, _ = _applied(spark, sf_dir)
    return conflicts_of(table.change_log(), FEED_CONTRACT)


@query("apply_counts")
def apply_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per action, from the change log and, where the merge left a row
    alone, from the counts kept with the version."""
    table, done = _applied(spark, sf_dir)
    log = table.change_log().groupBy(F.col("_change_action").alias("action")).agg(F.count(F.lit(1)).alias("n"))
    return log.unionByName(spark.createDataFrame([("keep", done.counts["keep"])], "action string, n long"))


ORACLE["apply_in_one_pass"] = MERGE_STRICT_SQL
ORACLE["apply_in_one_pass_shuffle"] = MERGE_STRICT_SQL
ORACLE["apply_conflicts"] = ORACLE["merge_conflicts"]
ORACLE["apply_counts"] = f"SELECT action, n FROM ({ORACLE['merge_action_counts']}) WHERE mode = 'strict'"


# ------------------------------------------------------- files, schema versions
@query("compact_files")
def compact_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """I2 + A7 as the stored files tell it: per partition the rows, whether
    there are fewer files than before, and whether no more than the target
    size allows."""
    t = VersionedTable(spark, scratch_path(spark, "compact_files"), partition_cols=("event_type",))
    t.write(feeds.table(spark, sf_dir, "events").repartition(32), rebalance=False)
    after, _, _ = t.compact()
    r = t.compaction_report(after - 1, after)
    return r.select("event_type", F.col("n_rows_after").alias("n_rows"), (F.col("n_rows_before") == F.col("n_rows_after")).alias("same_rows"),
                    (F.col("n_files_after") < F.col("n_files_before")).alias("fewer_files"),
                    (F.col("n_files_after") <= F.col("n_files_allowed")).alias("within_bound"))


@query("evolve_without_rewrite")
def evolve_without_rewrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A version of a wider schema over the rows of the version before it
    (``same_files``: none was written), then rows that have the new column."""
    cu = feeds.table(spark, sf_dir, "customer")
    t = VersionedTable.for_contract(spark, scratch_path(spark, "evolve_schema"), FEED_CONTRACT)
    t.write(feeds.customer_target(spark, sf_dir))
    v = t.add_columns({"nation": "int"})
    same = t.version_path(v) == t.version_path(v - 1)
    old = t.read(v)
    t.insert(cu.where(F.col("c_mktsegment") == feeds.TARGET_LEFT_OUT_SEGMENT).select(
        F.col("c_mktsegment").alias("state"), F.col("c_acctbal").alias("amount"), F.col("c_custkey").alias("record_id"),
        F.expr(f"TIMESTAMP_NTZ '{feeds.TARGET_TIME}'").alias("cdc_ingestion_timestamp"), F.col("c_nationkey").alias("nation")))
    return (old.withColumn("version", F.lit("wider")).unionByName(t.read().withColumn("version", F.lit("inserted")))
            .withColumn("same_files", F.lit(same)))


ORACLE["compact_files"] = """
SELECT event_type, count(*) AS n_rows, true AS same_rows, true AS fewer_files, true AS within_bound
FROM events GROUP BY event_type"""

ORACLE["evolve_without_rewrite"] = f"""
SELECT *, CAST(NULL AS INTEGER) AS nation, 'wider' AS version, true AS same_files FROM ({TARGET_SQL})
UNION ALL
SELECT *, 'inserted' AS version, true AS same_files FROM ({ORACLE['evolve_add_column']})"""


# ------------------------------------------------------------------ statements
@query("late_change_after_update")
def late_change_after_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    """F6 + H3: an UPDATE with a time stands against changes older than it and
    gives way to newer ones."""
    t = _strict_customers(spark, sf_dir, "late_update")
    t.update(f"cdc_ingestion_timestamp <= TIMESTAMP_NTZ '{feeds.TARGET_TIME}'",
             {"cdc_ingestion_timestamp": "TIMESTAMP_NTZ '2024-01-01 00:00:00'"})
    t.update("amount < 5000", {"amount": "amount + 1"}, at=feeds.DELETE_TIME)
    batch = latest_one(feeds.event_feed(spark, sf_dir), FEED_CONTRACT)
    t.transact(lambda base: apply_changes(t, batch, FEED_CONTRACT, base).version)
    return t.read(visible=True)


ORACLE["late_change_after_update"] = f"""
WITH feed AS ({FEED_SQL}),
base AS (
  SELECT state, CASE WHEN amount < 5000 THEN amount + 1 ELSE amount END AS amount, record_id,
         CASE WHEN amount < 5000 THEN TIMESTAMP '{feeds.DELETE_TIME}' ELSE TIMESTAMP '2024-01-01 00:00:00' END AS cdc_ingestion_timestamp
  FROM ({ALL_CUSTOMERS_SQL}) WHERE amount <= 9000),
one AS (SELECT * FROM feed WHERE {_VALID}
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) = 1),
dead AS (SELECT c_custkey AS record_id, TIMESTAMP '{feeds.TARGET_TIME}' AS t FROM customer WHERE c_acctbal > 9000),
won AS (
  SELECT b.* FROM one b LEFT JOIN base t USING (record_id) LEFT JOIN dead d USING (record_id)
  WHERE (t.record_id IS NULL OR b.cdc_ingestion_timestamp >= t.cdc_ingestion_timestamp)
    AND (d.record_id IS NULL OR b.cdc_ingestion_timestamp >= d.t))
SELECT state, amount, record_id, cdc_ingestion_timestamp FROM won WHERE op <> 'D'
UNION ALL
SELECT * FROM base WHERE record_id NOT IN (SELECT record_id FROM won)"""


# Three forms in which the sources of this feed write a time; the
# fourth kind of event has text that is no time.
TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "dd/MM/yyyy HH:mm:ss")


@query("change_times")
def change_times(spark: SparkSession, sf_dir: str) -> DataFrame:
    """G1: change times from text in several forms, bad text becoming null."""
    ev, kind = feeds.table(spark, sf_dir, "events"), F.col("event_type")
    # text as sources would land it; by parts, so that no session zone moves it
    day, clock = F.substring(F.col("ts").cast("string"), 1, 10), F.substring(F.col("ts").cast("string"), 12, 8)
    fraction = F.rpad(F.coalesce(F.nullif(F.split_part(F.col("ts").cast("string"), F.lit("."), F.lit(2)), F.lit("")), F.lit("0")), 6, "0")
    seconds = F.datediff(F.col("ts").cast("date"), F.lit("1970-01-01").cast("date")).cast("long") * 86400 + (
        F.substring(clock, 1, 2).cast("long") * 3600 + F.substring(clock, 4, 2).cast("long") * 60 + F.substring(clock, 7, 2).cast("long"))
    text = (F.when(kind == "signup", F.concat(day, F.lit(" "), clock, F.lit("."), fraction))
            .when(kind == "click", F.concat(F.substring(day, 9, 2), F.lit("/"), F.substring(day, 6, 2), F.lit("/"), F.substring(day, 1, 4), F.lit(" "), clock))
            .when(kind == "purchase", seconds.cast("string"))
            .when(kind == "error", F.concat(F.lit("at "), clock))
            .otherwise(F.concat(day, F.lit("T"), clock)))
    return ev.select("event_id", to_change_time_any(text, TIME_FORMATS, epoch=True).alias("change_time"))


ORACLE["change_times"] = """
SELECT event_id, CASE event_type WHEN 'signup' THEN ts WHEN 'error' THEN NULL ELSE date_trunc('second', ts) END AS change_time
FROM events"""


@query("quiet_drops")
def quiet_drops(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A drop without rows and one of rejected rows alone write no version;
    a drop with good rows does.  The table's version and the rows rejected so
    far, after each."""
    root = scratch_path(spark, "quiet")
    table = VersionedTable.for_contract(spark, f"{root}/table", FEED_CONTRACT)
    table.write(feeds.customer_target(spark, sf_dir).withColumn(DELETED_COL, F.lit(False)))
    feed = feeds.event_feed(spark, sf_dir)
    out = []
    for step, rows in (("empty", feed.where("false")), ("rejected", feed.where("op is null")), ("good", feed.where("op is not null"))):
        write_landing(rows, f"{root}/landing", FEED_CONTRACT)
        q = start_upsert(read_landing(spark, f"{root}/landing", FEED_CONTRACT, streaming=True), table, FEED_CONTRACT,
                         checkpoint=f"{root}/checkpoint", specs=feeds.feed_typed_specs(), quarantine_path=f"{root}/rejects")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        found = folder_exists(spark, f"{root}/rejects")
        out.append((step, table.current_version(), spark.read.parquet(f"{root}/rejects").count() if found else 0))
    return spark.createDataFrame(out, "step string, version long, n_rejected long")


ORACLE["quiet_drops"] = f"""
WITH n AS (SELECT count(*) AS n FROM ({FEED_SQL}) WHERE op IS NULL)
SELECT 'empty' AS step, 0 AS version, 0 AS n_rejected
UNION ALL SELECT 'rejected', 0, n FROM n
UNION ALL SELECT 'good', 1, n FROM n"""

# Literal rows of a small table.
SEGMENTS = (
    ("AUTOMOBILE", "goods", 1, "2024-01-01 00:00:00"),
    ("BUILDING", "goods", 2, "2024-01-01 00:00:00"),
    ("FURNITURE", "home", 3, "2024-01-01 00:00:00"),
    ("HOUSEHOLD", "home", 4, "2024-01-01 00:00:00"),
    ("MACHINERY", None, 5, "2024-01-01 00:00:00"),
)
SEGMENT_CONTRACT = ChangeContract(
    columns=("segment", "family", "place", "loaded_at"), key_cols=("segment",), ts_col="loaded_at",
    specs=(ColumnSpec("segment", T.StringType(), False, 10), ColumnSpec("family", T.StringType(), True, 5),
           ColumnSpec("place", T.IntegerType(), False), ColumnSpec("loaded_at", T.TimestampNTZType(), False)))


@query("literal_rows")
def literal_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """literal rows, checked against their contract and inserted into a
    table, beside the customers they describe."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, "segments"), SEGMENT_CONTRACT)
    t.write(spark.createDataFrame([], "segment string, family string, place int, loaded_at timestamp_ntz"))
    t.insert_values(list(SEGMENTS), SEGMENT_CONTRACT)
    cu = feeds.table(spark, sf_dir, "customer")
    return cu.join(t.read(), F.col("c_mktsegment") == F.col("segment"), "left").groupBy("segment", "family", "place").agg(
        F.count(F.lit(1)).alias("n"), F.min("c_acctbal").alias("lowest"), F.max("c_acctbal").alias("highest"))


ORACLE["literal_rows"] = f"""
WITH s(segment, family, place) AS (VALUES {", ".join(f"('{a}', {'NULL' if b is None else repr(b)}, {p})" for a, b, p, _ in SEGMENTS)})
SELECT segment, family, place, count(*) AS n, min(c_acctbal) AS lowest, max(c_acctbal) AS highest
FROM customer LEFT JOIN s ON segment = c_mktsegment GROUP BY segment, family, place"""


# --------------------------------------------------------------------- catalog
def _database(kind: str) -> str:
    return f"tidemark_{kind}_{uuid.uuid4().hex[:10]}"  # a run's own


@query("replicate_selected")
def replicate_selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4 + A3 + H2: of three catalog tables over given data, the two that the
    pattern selects are loaded in full, changes land for them, and a second run
    applies these: customers in debt are set to 0 and those of one segment
    deleted, open orders are deleted."""
    db, root = _database("src"), scratch_path(spark, "replicate")
    spark.sql(f"CREATE DATABASE {db}")
    for name, source, key in (("src_customer", "customer", "c_custkey"), ("src_orders", "orders", "o_orderkey"), ("part", "part", "p_partkey")):
        spark.sql(f"CREATE TABLE {db}.{name} USING parquet LOCATION '{sf_dir.rstrip('/')}/{source}.parquet' "
                  f"TBLPROPERTIES ('{catalog.KEY}' = '{key}')")
    copies = replicate(spark, f"{db}.src_%", f"{root}/landing", f"{root}/target", feeds.TARGET_TIME)
    later = F.expr("TIMESTAMP_NTZ '2024-02-01 00:00:00'").alias(catalog.CAPTURE_COL)
    cu, od = spark.table(f"{db}.src_customer"), spark.table(f"{db}.src_orders")
    gone, debt = F.col("c_mktsegment") == "FURNITURE", F.col("c_acctbal") < 0
    changed = cu.where(gone | debt).select(F.when(gone, "D").otherwise("U").alias("op"), *[
        F.when(~gone, F.lit(0.0)).otherwise(F.col(x)).alias(x) if x == "c_acctbal" else F.col(x) for x in cu.columns], later)
    opened = od.where("o_orderstatus = 'O'").select(F.lit("D").alias("op"), "*", later)
    for rows, copy in ((changed, copies[0]), (opened, copies[1])):
        name = copy.source.rsplit(".", 1)[-1]
        write_landing(rows, f"{root}/landing/{name}", catalog.derive_contract(spark, copy.source).contract)
    out = None
    for copy in replicate(spark, f"{db}.src_%", f"{root}/landing", f"{root}/target"):
        rows = copy.table.read(visible=True)
        key, value = ("c_custkey", "c_acctbal") if "c_custkey" in rows.columns else ("o_orderkey", "o_totalprice")
        rows = rows.select(F.lit(copy.source.rsplit(".", 1)[-1]).alias("table_name"), F.lit(copy.version).cast("long").alias("version"),
                           F.col(key).alias("key"), F.col(value).alias("value"), F.col(catalog.CAPTURE_COL).alias("changed_at"))
        out = rows if out is None else out.unionByName(rows)
    return out


ORACLE["replicate_selected"] = f"""
SELECT 'src_customer' AS table_name, 1::BIGINT AS version, c_custkey AS key, CASE WHEN c_acctbal < 0 THEN 0 ELSE c_acctbal END AS value,
       CASE WHEN c_acctbal < 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE TIMESTAMP '{feeds.TARGET_TIME}' END AS changed_at
FROM customer WHERE c_mktsegment <> 'FURNITURE'
UNION ALL
SELECT 'src_orders', 1, o_orderkey, o_totalprice, TIMESTAMP '{feeds.TARGET_TIME}' FROM orders WHERE o_orderstatus <> 'O'"""

_TYPES = {"amount": T.DoubleType(), "record_id": T.LongType(), "state": T.StringType()}


@query("catalog_external")
def catalog_external(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An external table, by DDL from the contract, over the files of a
    stored version; its partitions are found by the catalog, and a filter on
    the partition column reads one of them."""
    t = VersionedTable.for_contract(spark, scratch_path(spark, "external"), FEED_CONTRACT)
    t.write(feeds.all_customers(spark, sf_dir))
    name = f"{_database('ext')}.current_state"
    catalog.create_table(spark, catalog.current_ddl(name, FEED_CONTRACT, t.version_path(0), _TYPES), name, discover=True)
    return spark.table(name).where("state = 'BUILDING'").drop("record_id_bucket")


@query("catalog_managed")
def catalog_managed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A managed, partitioned table by DDL from the contract, filled from an
    external landing table (also by DDL) and queried by SQL."""
    db, root = _database("man"), scratch_path(spark, "managed")
    write_landing(feeds.event_feed(spark, sf_dir), f"{root}/landing", FEED_CONTRACT)
    landed, current = f"{db}.landing", f"{db}.current_state"
    catalog.create_table(spark, catalog.landing_ddl(landed, FEED_CONTRACT, f"{root}/landing"), landed)
    catalog.create_table(spark, catalog.current_ddl(current, FEED_CONTRACT, types=_TYPES), current)
    rows = spark.table(landed).where("op IN ('I', 'U')")
    rows.select(F.col("amount").cast("double"), F.col("record_id").cast("long"), "cdc_ingestion_timestamp", "state",
                F.pmod(F.hash(F.col("record_id").cast("long")), F.lit(FEED_CONTRACT.num_buckets)).alias("record_id_bucket")
                ).repartition("state").write.insertInto(current)
    return spark.sql(f"SELECT state, count(*) AS n, min(amount) AS lowest, max(amount) AS highest, max(cdc_ingestion_timestamp) AS last "
                     f"FROM {current} WHERE state <> 'SRC-signup' GROUP BY state")


ORACLE["catalog_external"] = f"SELECT * FROM ({ALL_CUSTOMERS_SQL}) WHERE state = 'BUILDING'"
ORACLE["catalog_managed"] = f"""
SELECT state, count(*) AS n, min(amount) AS lowest, max(amount) AS highest, max(cdc_ingestion_timestamp) AS last
FROM ({FEED_SQL}) WHERE op IN ('I', 'U') AND state <> 'SRC-signup' GROUP BY state"""
