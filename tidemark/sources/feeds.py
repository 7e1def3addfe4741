"""Change feeds and tables derived from the driver's parquet tables.

These are the inputs of the registered queries.  Every one is a projection of
a whole driver table (no id subsets, no row caps); subsets are chosen by
attributes (segment, date) so the merge reaches all of its branches.

The SQL text of each feed for the DuckDB oracle lives next to the Spark form
so the two stay in step.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract
from tidemark.functions.expr import capture_time


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# ---------------------------------------------------------------- contracts
# Changes keyed by user (events) merged into a customer-derived target.
FEED_CONTRACT = ChangeContract(
    columns=("state", "amount", "record_id", "cdc_ingestion_timestamp"),
    key_cols=("record_id",),
    seq_col="event_id",
    seq_type=T.LongType(),
    frozen_cols=("state",),
    partition_cols=("state",),
    bucket_col="record_id",
    num_buckets=16,
)

# Lineitem changes keyed by order: many keys tie at their max ship date.
LINEITEM_CONTRACT = ChangeContract(
    columns=("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
             "record_id", "cdc_ingestion_timestamp"),
    key_cols=("record_id",),
    seq_col="seq",
)

# Orders snapshots keyed by order key.
ORDERS_COLUMNS = ("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice",
                  "o_orderdate", "o_orderpriority")
ORDERS_CONTRACT = ChangeContract(
    columns=ORDERS_COLUMNS, key_cols=("o_orderkey",), ts_col="o_orderdate")

# The capture time stamped on the target's rows and the
# segment the target leaves out (its keys arrive as inserts).
TARGET_TIME = "2024-01-30 12:00:00"
TARGET_LEFT_OUT_SEGMENT = "HOUSEHOLD"
# The time of the registered deletes (after every change of the feed
# that they are meant to stop).
DELETE_TIME = "2024-01-25 00:00:00"
# The times at which the feed is cut into three batches.
BATCH_CUTS = ("2024-01-11 00:00:00", "2024-01-21 00:00:00")


# -------------------------------------------------------------------- feeds
def event_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """FEED: event_type maps to an op (view rows get a null op)."""
    ev = table(spark, sf_dir, "events")
    op = (
        F.when(F.col("event_type") == "signup", "I")
        .when(F.col("event_type").isin("click", "purchase"), "U")
        .when(F.col("event_type") == "error", "D")
    )
    return ev.select(
        op.alias("op"),
        F.concat(F.lit("SRC-"), F.col("event_type")).alias("state"),
        F.col("value").alias("amount"),
        F.col("user_id").alias("record_id"),
        F.col("ts").alias("cdc_ingestion_timestamp"),
        F.col("event_id"),
    )


FEED_SQL = """
SELECT CASE event_type WHEN 'signup' THEN 'I' WHEN 'click' THEN 'U'
                       WHEN 'purchase' THEN 'U' WHEN 'error' THEN 'D' END AS op,
       concat('SRC-', event_type) AS state, value AS amount,
       user_id AS record_id, ts AS cdc_ingestion_timestamp, event_id
FROM events"""


def customer_target(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TARGET: current state built from customers of every segment but one."""
    return all_customers(spark, sf_dir).where(F.col("state") != TARGET_LEFT_OUT_SEGMENT)


def all_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer as a current-state row."""
    return table(spark, sf_dir, "customer").select(
        F.col("c_mktsegment").alias("state"),
        F.col("c_acctbal").alias("amount"),
        F.col("c_custkey").alias("record_id"),
        capture_time(TARGET_TIME).alias("cdc_ingestion_timestamp"),
    )


ALL_CUSTOMERS_SQL = f"""
SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
       TIMESTAMP '{TARGET_TIME}' AS cdc_ingestion_timestamp
FROM customer"""


TARGET_SQL = f"""
SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
       TIMESTAMP '{TARGET_TIME}' AS cdc_ingestion_timestamp
FROM customer WHERE c_mktsegment <> '{TARGET_LEFT_OUT_SEGMENT}'"""


def lineitem_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """TIED FEED: return flag maps to an op; ship date is the change time."""
    li = table(spark, sf_dir, "lineitem")
    op = (
        F.when(F.col("l_returnflag") == "A", "I")
        .when(F.col("l_returnflag") == "R", "U")
        .when(F.col("l_returnflag") == "N", "D")
    )
    return li.select(
        op.alias("op"),
        "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_orderkey").alias("record_id"),
        F.col("l_shipdate").alias("cdc_ingestion_timestamp"),
        F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice").alias("seq"),
    )


LINEITEM_FEED_SQL = """
SELECT CASE l_returnflag WHEN 'A' THEN 'I' WHEN 'R' THEN 'U' WHEN 'N' THEN 'D' END AS op,
       l_linenumber, l_partkey, l_suppkey, l_extendedprice,
       l_orderkey AS record_id, l_shipdate AS cdc_ingestion_timestamp
FROM lineitem"""


# Changes with every oddity a capture can land, by attribute over all events:
# null keys (users who are multiples of 11), null times (errors of small
# amounts), lower-case and unknown ops, keys tied at one time (times cut to
# the day, keys folded to 1/4), no sequence.
ROUGH_CONTRACT = ChangeContract(
    columns=FEED_CONTRACT.columns, key_cols=FEED_CONTRACT.key_cols, frozen_cols=("state",))


def rough_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    op = (
        F.when(F.col("event_type") == "signup", "I")
        .when((F.col("event_type") == "click") & (F.col("value") < 10), "u")
        .when((F.col("event_type") == "purchase") & (F.col("value") < 10), "X")
        .when(F.col("event_type").isin("click", "purchase"), "U")
        .when(F.col("event_type") == "error", "D")
    )
    return ev.select(
        op.alias("op"),
        F.concat(F.lit("SRC-"), F.col("event_type")).alias("state"),
        F.col("value").alias("amount"),
        F.when(F.col("user_id") % 11 != 0, F.floor(F.col("user_id") / 4)).alias("record_id"),
        F.when(~((F.col("event_type") == "error") & (F.col("value") < 20)),
               F.col("ts").cast("date").cast("timestamp_ntz")).alias("cdc_ingestion_timestamp"),
    )


ROUGH_SQL = """
SELECT CASE WHEN event_type = 'signup' THEN 'I'
            WHEN event_type = 'click' AND value < 10 THEN 'u'
            WHEN event_type = 'purchase' AND value < 10 THEN 'X'
            WHEN event_type IN ('click', 'purchase') THEN 'U'
            WHEN event_type = 'error' THEN 'D' END AS op,
       concat('SRC-', event_type) AS state, value AS amount,
       CASE WHEN user_id % 11 <> 0 THEN CAST(floor(user_id / 4) AS BIGINT) END AS record_id,
       CASE WHEN NOT (event_type = 'error' AND value < 20)
            THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS cdc_ingestion_timestamp
FROM events"""


# Snapshot rules.  A is "before": orders up to 2000.  B is
# "after": orders from 1996 on, pending orders before 1998 now filled, and
# urgent 1999 orders repriced.
SNAP_A_BEFORE = "2001-01-01"
SNAP_B_FROM = "1996-01-01"
SNAP_FILL_BEFORE = "1998-01-01"


def orders_snapshots(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    od = table(spark, sf_dir, "orders")
    a = od.where(F.col("o_orderdate") < F.lit(SNAP_A_BEFORE).cast("timestamp_ntz"))
    b = od.where(F.col("o_orderdate") >= F.lit(SNAP_B_FROM).cast("timestamp_ntz")).select(
        "o_orderkey",
        "o_custkey",
        F.when(
            (F.col("o_orderstatus") == "P")
            & (F.col("o_orderdate") < F.lit(SNAP_FILL_BEFORE).cast("timestamp_ntz")),
            F.lit("F"),
        ).otherwise(F.col("o_orderstatus")).alias("o_orderstatus"),
        F.when(
            (F.col("o_orderpriority") == "1-URGENT") & (F.year("o_orderdate") == 1999),
            F.col("o_totalprice") + 1,
        ).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        "o_orderdate",
        "o_orderpriority",
    )
    return a.select(*ORDERS_COLUMNS), b


SNAP_A_SQL = f"SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '{SNAP_A_BEFORE}'"
SNAP_B_SQL = f"""
SELECT o_orderkey, o_custkey,
       CASE WHEN o_orderstatus = 'P' AND o_orderdate < TIMESTAMP '{SNAP_FILL_BEFORE}'
            THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
       CASE WHEN o_orderpriority = '1-URGENT' AND year(o_orderdate) = 1999
            THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
       o_orderdate, o_orderpriority
FROM orders WHERE o_orderdate >= TIMESTAMP '{SNAP_B_FROM}'"""


def feed_batches(feed: DataFrame, ts_col: str = "cdc_ingestion_timestamp") -> list[DataFrame]:
    """Cut a feed into consecutive time ranges at ``BATCH_CUTS`` (null times go
    with the first batch, so good + bad rows are never lost)."""
    cuts = [F.lit(x).cast("timestamp_ntz") for x in BATCH_CUTS]
    ts = F.col(ts_col)
    out = [feed.where(ts.isNull() | (ts < cuts[0]))]
    for lo, hi in zip(cuts, cuts[1:]):
        out.append(feed.where((ts >= lo) & (ts < hi)))
    out.append(feed.where(ts >= cuts[-1]))
    return out


# Typed contract of the events feed as landed text.  ``state``
# is declared VARCHAR(10), so 'SRC-purchase' is too long and is set aside.
def feed_specs():
    from pyspark.sql import types as T

    from tidemark.contract import OPS, ColumnSpec

    return (
        ColumnSpec("op", T.StringType(), False, 1, OPS),
        ColumnSpec("state", T.StringType(), True, 10),
        ColumnSpec("amount", T.DecimalType(5, 2)),
        ColumnSpec("record_id", T.IntegerType(), False),
        ColumnSpec("cdc_ingestion_timestamp", T.TimestampNTZType(), False),
        ColumnSpec("event_id", T.LongType(), False),
    )


def feed_typed_specs():
    """The events feed's own types, to read it back from landing text."""
    from pyspark.sql import types as T

    from tidemark.contract import ColumnSpec

    return (
        ColumnSpec("amount", T.DoubleType()),
        ColumnSpec("record_id", T.LongType()),
    )
