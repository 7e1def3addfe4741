"""DuckDB SQL for every registered query (the correctness oracle).

Written independently of the Spark plans: the latest-with-ties form uses a
window (the reference's own formulation), the one-row form ``row_number``,
merges a three-branch ``UNION ALL``.
"""

from __future__ import annotations

from tidemark.plans.queries import ADHOC_SQL
from tidemark.sources.feeds import (ALL_CUSTOMERS_SQL, BATCH_CUTS, DELETE_TIME, FEED_SQL,
                                    LINEITEM_FEED_SQL, ROUGH_SQL, SNAP_A_SQL, SNAP_B_SQL,
                                    TARGET_LEFT_OUT_SEGMENT, TARGET_SQL, TARGET_TIME)

ORACLE: dict[str, str] = {}

_VALID = "op IN ('I','U','D')"

_BATCH_TIES = f"""
batch AS (
  SELECT * EXCLUDE (m) FROM (
    SELECT *, max(cdc_ingestion_timestamp) OVER (PARTITION BY record_id) AS m FROM feed)
  WHERE cdc_ingestion_timestamp = m AND {_VALID})"""

_BATCH_ONE = f"""
batch AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id
                                 ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) AS rn
    FROM feed
    WHERE {_VALID} AND record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL)
  WHERE rn = 1)"""

ORACLE["latest_change_ties"] = f"""
WITH feed AS ({FEED_SQL}), {_BATCH_TIES}
SELECT * FROM batch"""

ORACLE["latest_change_ties_lineitem"] = f"""
WITH feed AS ({LINEITEM_FEED_SQL}), {_BATCH_TIES}
SELECT * FROM batch"""

ORACLE["latest_change_one"] = f"""
WITH feed AS ({FEED_SQL}), {_BATCH_ONE}
SELECT * FROM batch"""

ORACLE["latest_change_one_lineitem"] = f"""
WITH feed AS ({LINEITEM_FEED_SQL})
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id
      ORDER BY cdc_ingestion_timestamp DESC, l_linenumber DESC, l_partkey DESC,
               l_suppkey DESC, l_extendedprice DESC) AS rn
  FROM feed WHERE {_VALID})
WHERE rn = 1"""

ORACLE["strict_quarantine"] = f"""
WITH feed AS ({FEED_SQL})
SELECT event_id, record_id, cdc_ingestion_timestamp,
       concat_ws(',', CASE WHEN record_id IS NULL THEN 'null_key' END,
                      CASE WHEN cdc_ingestion_timestamp IS NULL THEN 'null_time' END,
                      CASE WHEN op IS NULL OR op NOT IN ('I','U','D') THEN 'bad_op' END) AS reasons
FROM feed
WHERE record_id IS NULL OR cdc_ingestion_timestamp IS NULL OR op IS NULL OR op NOT IN ('I','U','D')"""

_COMPAT_BODY = """
SELECT t.state, t.amount, t.record_id, t.cdc_ingestion_timestamp
FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.record_id = t.record_id)
UNION ALL
SELECT t.state, b.amount, b.record_id, b.cdc_ingestion_timestamp
FROM target t JOIN batch b ON b.record_id = t.record_id WHERE b.op <> 'D'
UNION ALL
SELECT b.state, b.amount, b.record_id, b.cdc_ingestion_timestamp
FROM batch b WHERE NOT EXISTS (SELECT 1 FROM target t WHERE t.record_id = b.record_id)"""

_STRICT_BODY = """
SELECT t.state, t.amount, t.record_id, t.cdc_ingestion_timestamp
FROM target t WHERE NOT EXISTS (SELECT 1 FROM batch b WHERE b.record_id = t.record_id)
UNION ALL
SELECT t.state, t.amount, t.record_id, t.cdc_ingestion_timestamp
FROM target t JOIN batch b ON b.record_id = t.record_id
WHERE b.cdc_ingestion_timestamp < t.cdc_ingestion_timestamp
UNION ALL
SELECT b.state, b.amount, b.record_id, b.cdc_ingestion_timestamp
FROM batch b
WHERE b.op <> 'D' AND NOT EXISTS (
  SELECT 1 FROM target t
  WHERE t.record_id = b.record_id AND b.cdc_ingestion_timestamp < t.cdc_ingestion_timestamp)"""

MERGE_COMPAT_SQL = f"""
WITH feed AS ({FEED_SQL}), target AS ({TARGET_SQL}), {_BATCH_TIES}
{_COMPAT_BODY}"""

MERGE_STRICT_SQL = f"""
WITH feed AS ({FEED_SQL}), target AS ({TARGET_SQL}), {_BATCH_ONE}
{_STRICT_BODY}"""

ORACLE["merge_compat"] = MERGE_COMPAT_SQL
ORACLE["merge_strict"] = MERGE_STRICT_SQL
ORACLE["merge_strict_shuffle"] = MERGE_STRICT_SQL
ORACLE["merge_clustered"] = MERGE_STRICT_SQL

ORACLE["merge_conflicts"] = f"""
WITH feed AS ({FEED_SQL}), target AS ({TARGET_SQL}), {_BATCH_ONE}
SELECT * FROM (
  SELECT b.record_id, b.cdc_ingestion_timestamp, b.op,
         CASE WHEN b.op = 'I' AND t.record_id IS NOT NULL THEN 'insert_existing'
              WHEN b.op = 'U' AND t.record_id IS NULL THEN 'update_missing'
              WHEN b.op = 'D' AND t.record_id IS NULL THEN 'delete_missing' END AS conflict,
         CASE WHEN t.record_id IS NULL AND b.op = 'D' THEN 'absent_delete'
              WHEN t.record_id IS NULL THEN 'insert'
              WHEN b.cdc_ingestion_timestamp < t.cdc_ingestion_timestamp THEN 'ignore'
              WHEN b.op = 'D' THEN 'delete' ELSE 'update' END AS action
  FROM batch b LEFT JOIN target t ON t.record_id = b.record_id)
WHERE conflict IS NOT NULL"""

ORACLE["merge_action_counts"] = f"""
WITH feed AS ({FEED_SQL}), target AS ({TARGET_SQL}),
bt AS (
  SELECT * EXCLUDE (m) FROM (
    SELECT *, max(cdc_ingestion_timestamp) OVER (PARTITION BY record_id) AS m FROM feed)
  WHERE cdc_ingestion_timestamp = m AND {_VALID}),
b1 AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY record_id
                                 ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) AS rn
    FROM feed
    WHERE {_VALID} AND record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL)
  WHERE rn = 1),
compat AS (
  SELECT CASE WHEN b.record_id IS NULL THEN 'keep'
              WHEN t.record_id IS NULL THEN 'insert'
              WHEN b.op = 'D' THEN 'delete' ELSE 'update' END AS action
  FROM target t FULL OUTER JOIN bt b ON t.record_id = b.record_id),
strict AS (
  SELECT CASE WHEN b.record_id IS NULL THEN 'keep'
              WHEN t.record_id IS NULL AND b.op = 'D' THEN 'absent_delete'
              WHEN t.record_id IS NULL THEN 'insert'
              WHEN b.cdc_ingestion_timestamp < t.cdc_ingestion_timestamp THEN 'ignore'
              WHEN b.op = 'D' THEN 'delete' ELSE 'update' END AS action
  FROM target t FULL OUTER JOIN b1 b ON t.record_id = b.record_id)
SELECT 'compat' AS mode, action, count(*) AS n FROM compat GROUP BY action
UNION ALL
SELECT 'strict' AS mode, action, count(*) AS n FROM strict GROUP BY action"""

ORACLE["full_load"] = f"""
SELECT 'I' AS op, c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
       TIMESTAMP '{TARGET_TIME}' AS cdc_ingestion_timestamp
FROM customer"""

# Folding batches (any order) and the stream both equal one strict merge.
ORACLE["fold_batches"] = MERGE_STRICT_SQL
ORACLE["fold_batches_reversed"] = MERGE_STRICT_SQL
ORACLE["stream_upsert"] = MERGE_STRICT_SQL

_ORDER_PAYLOAD = ("o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
_DIFFERS = " OR ".join(f"a.{c} IS DISTINCT FROM b.{c}" for c in _ORDER_PAYLOAD)
_IMAGE = ",\n       ".join(
    f"CASE WHEN b.o_orderkey IS NULL THEN a.{c} ELSE b.{c} END AS {c}"
    for c in ("o_orderkey",) + _ORDER_PAYLOAD)

ORACLE["snapshot_diff"] = f"""
WITH a AS ({SNAP_A_SQL}), b AS ({SNAP_B_SQL})
SELECT CASE WHEN a.o_orderkey IS NULL THEN 'I' WHEN b.o_orderkey IS NULL THEN 'D' ELSE 'U' END AS op,
       {_IMAGE}
FROM a FULL OUTER JOIN b ON a.o_orderkey = b.o_orderkey
WHERE a.o_orderkey IS NULL OR b.o_orderkey IS NULL OR {_DIFFERS}"""

_DIFF_COLS = ", ".join(f"CASE WHEN a.{c} IS DISTINCT FROM b.{c} THEN '{c}' END" for c in _ORDER_PAYLOAD)
_RECON = f"""
WITH a AS ({SNAP_A_SQL}), b AS ({SNAP_B_SQL}),
r AS (
  SELECT coalesce(b.o_orderkey, a.o_orderkey) AS o_orderkey,
         CASE WHEN a.o_orderkey IS NULL THEN 'missing'
              WHEN b.o_orderkey IS NULL THEN 'extra'
              WHEN {_DIFFERS} THEN 'differ' ELSE 'match' END AS status,
         CASE WHEN a.o_orderkey IS NOT NULL AND b.o_orderkey IS NOT NULL AND ({_DIFFERS})
              THEN concat_ws(',', {_DIFF_COLS}) END AS diff_cols
  FROM b FULL OUTER JOIN a ON b.o_orderkey = a.o_orderkey)"""

ORACLE["reconcile"] = _RECON + "\nSELECT * FROM r WHERE status <> 'match'"
ORACLE["reconcile_summary"] = _RECON + "\nSELECT status, count(*) AS n FROM r GROUP BY status"

_TXT = f"""
feed AS ({FEED_SQL}),
txt AS (
  SELECT CAST(op AS VARCHAR) AS op, CAST(state AS VARCHAR) AS state,
         CAST(amount AS VARCHAR) AS amount, CAST(record_id AS VARCHAR) AS record_id,
         CAST(cdc_ingestion_timestamp AS VARCHAR) AS cdc_ingestion_timestamp,
         CAST(event_id AS VARCHAR) AS event_id
  FROM feed),
chk AS (
  SELECT *, concat_ws(',',
      CASE WHEN op IS NULL THEN 'op:null' END,
      CASE WHEN length(op) > 1 THEN 'op:length' END,
      CASE WHEN op NOT IN ('I','U','D') THEN 'op:value' END,
      CASE WHEN length(state) > 10 THEN 'state:length' END,
      CASE WHEN amount IS NOT NULL AND TRY_CAST(amount AS DECIMAL(5,2)) IS NULL THEN 'amount:type' END,
      CASE WHEN record_id IS NULL THEN 'record_id:null' END,
      CASE WHEN record_id IS NOT NULL AND TRY_CAST(record_id AS INTEGER) IS NULL THEN 'record_id:type' END,
      CASE WHEN cdc_ingestion_timestamp IS NULL THEN 'cdc_ingestion_timestamp:null' END,
      CASE WHEN cdc_ingestion_timestamp IS NOT NULL
                AND TRY_CAST(cdc_ingestion_timestamp AS TIMESTAMP) IS NULL
           THEN 'cdc_ingestion_timestamp:type' END,
      CASE WHEN event_id IS NULL THEN 'event_id:null' END,
      CASE WHEN event_id IS NOT NULL AND TRY_CAST(event_id AS BIGINT) IS NULL THEN 'event_id:type' END
  ) AS reasons
  FROM txt)"""

ORACLE["conform_good"] = f"""
WITH {_TXT}
SELECT op, state, TRY_CAST(amount AS DECIMAL(5,2)) AS amount,
       TRY_CAST(record_id AS INTEGER) AS record_id,
       TRY_CAST(cdc_ingestion_timestamp AS TIMESTAMP) AS cdc_ingestion_timestamp,
       TRY_CAST(event_id AS BIGINT) AS event_id
FROM chk WHERE reasons = ''"""

ORACLE["conform_bad"] = f"""
WITH {_TXT}
SELECT op, state, amount, record_id, cdc_ingestion_timestamp, event_id, reasons FROM chk WHERE reasons <> ''"""

_LEFT_OUT = f"""
SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
       TIMESTAMP '{TARGET_TIME}' AS cdc_ingestion_timestamp
FROM customer WHERE c_mktsegment = '{TARGET_LEFT_OUT_SEGMENT}'"""

ORACLE["insert_rows"] = f"{TARGET_SQL}\nUNION ALL{_LEFT_OUT}"

ORACLE["rough_quarantine"] = f"""
SELECT * FROM (
  SELECT *, concat_ws(',', CASE WHEN record_id IS NULL THEN 'null_key' END,
                      CASE WHEN cdc_ingestion_timestamp IS NULL THEN 'null_time' END,
                      CASE WHEN op IS NULL OR op NOT IN ('I','U','D') THEN 'bad_op' END) AS reasons
  FROM ({ROUGH_SQL}))
WHERE reasons <> ''"""

_ROUGH_TIES = f"""
  SELECT * EXCLUDE (m) FROM (
    SELECT *, max(cdc_ingestion_timestamp) OVER (PARTITION BY record_id) AS m FROM ({ROUGH_SQL}))
  WHERE cdc_ingestion_timestamp = m AND {_VALID}"""

ORACLE["rough_latest_ties"] = _ROUGH_TIES

ORACLE["rough_latest_one"] = f"""
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY record_id
            ORDER BY cdc_ingestion_timestamp DESC, op = 'D' DESC, state DESC, amount DESC, op DESC) AS rn
  FROM ({ROUGH_SQL})
  WHERE record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL AND {_VALID})
WHERE rn = 1"""

ORACLE["merge_cardinality"] = f"""
SELECT record_id FROM ({_ROUGH_TIES})
WHERE record_id IN (SELECT c_custkey FROM customer)
GROUP BY record_id HAVING count(*) > 1"""

# A drop, an update of what is then live, a compaction, the other drops.  The
# update hits rows that the first drop left in place or wrote; later drops
# overwrite those that they apply to.
ORACLE["stream_with_dml"] = f"""
WITH feed AS ({FEED_SQL}), target AS ({TARGET_SQL}),
valid AS (SELECT * FROM feed WHERE record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL AND {_VALID}),
one AS (
  SELECT * FROM valid
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) = 1),
won AS (
  SELECT b.*, b.cdc_ingestion_timestamp < TIMESTAMP '{BATCH_CUTS[0]}' AS before_update
  FROM one b LEFT JOIN target t USING (record_id)
  WHERE t.record_id IS NULL OR b.cdc_ingestion_timestamp >= t.cdc_ingestion_timestamp)
SELECT state, CASE WHEN before_update AND amount < 0 THEN 0 ELSE amount END AS amount,
       record_id, cdc_ingestion_timestamp
FROM won WHERE op <> 'D'
UNION ALL
SELECT state, CASE WHEN amount < 0 THEN 0 ELSE amount END, record_id, cdc_ingestion_timestamp
FROM target WHERE record_id NOT IN (SELECT record_id FROM won)"""

ORACLE["late_change_after_delete"] = f"""
WITH feed AS ({FEED_SQL}),
base AS (
  SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
         CASE WHEN c_acctbal < 5000 THEN TIMESTAMP '{DELETE_TIME}'
              ELSE TIMESTAMP '2024-01-01 00:00:00' END AS cdc_ingestion_timestamp,
         c_acctbal < 5000 AS dead
  FROM customer),
one AS (
  SELECT * FROM feed
  WHERE record_id IS NOT NULL AND cdc_ingestion_timestamp IS NOT NULL AND {_VALID}
  QUALIFY row_number() OVER (PARTITION BY record_id ORDER BY cdc_ingestion_timestamp DESC, event_id DESC) = 1),
won AS (
  SELECT b.* FROM one b LEFT JOIN base t USING (record_id)
  WHERE t.record_id IS NULL OR b.cdc_ingestion_timestamp >= t.cdc_ingestion_timestamp)
SELECT state, amount, record_id, cdc_ingestion_timestamp FROM won WHERE op <> 'D'
UNION ALL
SELECT state, amount, record_id, cdc_ingestion_timestamp FROM base
WHERE NOT dead AND record_id NOT IN (SELECT record_id FROM won)"""

ORACLE["update_where"] = f"""
SELECT state, CASE WHEN state = 'BUILDING' AND amount < 0 THEN amount + 100 ELSE amount END AS amount,
       record_id, cdc_ingestion_timestamp, amount > 9000 AS is_deleted
FROM ({ALL_CUSTOMERS_SQL})"""

ORACLE["delete_where"] = f"""
SELECT state, amount, record_id,
       CASE WHEN amount < 0 THEN TIMESTAMP '2024-02-01 00:00:00' ELSE cdc_ingestion_timestamp END
         AS cdc_ingestion_timestamp,
       amount > 9000 OR amount < 0 AS is_deleted
FROM ({ALL_CUSTOMERS_SQL})"""

ORACLE["evolve_add_column"] = f"""
SELECT *, CAST(NULL AS INTEGER) AS nation FROM ({TARGET_SQL})
UNION ALL
SELECT c_mktsegment AS state, c_acctbal AS amount, c_custkey AS record_id,
       TIMESTAMP '{TARGET_TIME}' AS cdc_ingestion_timestamp, c_nationkey AS nation
FROM customer WHERE c_mktsegment = '{TARGET_LEFT_OUT_SEGMENT}'"""

ORACLE["compact"] = "SELECT * FROM events"
ORACLE["partition_layout"] = """
SELECT c_mktsegment AS state, count(*) AS n_rows, CAST(sum(c_custkey) AS BIGINT) AS sum_keys,
       CAST(0 AS BIGINT) AS n_misplaced, CAST(0 AS BIGINT) AS n_outside
FROM customer GROUP BY c_mktsegment"""

ORACLE["adhoc_sql"] = f"""
WITH current_state AS ({MERGE_STRICT_SQL})
{ADHOC_SQL}"""

ORACLE["landing_roundtrip"] = f"""
SELECT op, state, CAST(amount AS VARCHAR) AS amount, CAST(record_id AS VARCHAR) AS record_id,
       cdc_ingestion_timestamp, event_id
FROM ({FEED_SQL})"""
