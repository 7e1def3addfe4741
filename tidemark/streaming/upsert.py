"""Run-on-arrival incremental upsert (A2, H1, H2) on Structured Streaming.

A file stream over the landing folder replaces the job bookmark: the query's
checkpoint records which files were processed, and ``trigger(availableNow)``
processes everything new and stops, like one scheduled job run.  Each
micro-batch is reduced to the latest change per key and merged into the
current version of the table, giving the next version, whatever wrote the
current one (another statement, a compaction, an earlier stream).  The version
records the stream and the batch it applied, so a batch replayed after a crash
between the table write and the checkpoint commit is recognised and skipped
(Q10, Q11).  Rejected rows and conflicts are written before the version, which
is what marks the batch as done.  One query owns one checkpoint; several queries
and statements may write one table (Q12): a batch whose version another writer
published first is merged again into that one.

Strict batches read the target once (:mod:`tidemark.operators.apply`).  With
``late_by`` the table's low-water mark follows the slowest stream at that
distance: changes below the mark go to the quarantine, and a compaction may
drop the tombstones below it.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tidemark.contract import ChangeContract, ColumnSpec
from tidemark.operators.apply import apply_changes
from tidemark.operators.latest import latest_one, latest_with_ties, split_valid
from tidemark.operators.merge import merge, merge_into_catalog
from tidemark.operators.quality import conform, table_specs
from tidemark.session import scratch_path
from tidemark.sources.catalog import properties, quoted
from tidemark.sources.landing import CORRUPT_COL, split_corrupt
from tidemark.sources.table import VersionedTable, delete_folder

# Fixed value: the local property that names the running streaming query.
_QUERY_ID = "sql.streaming.queryId"


def _as_rejects(bad: DataFrame) -> DataFrame:
    """Rejected rows as (raw JSON of the row, reasons)."""
    cols = [F.col(f"`{x}`") for x in bad.columns if x != "reasons"]
    return bad.select(F.to_json(F.struct(*cols)).alias("raw"), "reasons")


def _union(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def _accepted(rows: DataFrame, rejects: DataFrame | None, target: DataFrame, c: ChangeContract,
              mode: str) -> tuple[DataFrame, DataFrame | None]:
    """Rows in the target's types that can be applied, and all rejected so far."""
    as_stored = table_specs(rows, target, c)
    if as_stored:
        rows, bad = conform(rows, as_stored)
        rejects = _union(rejects, _as_rejects(bad))
    if mode == "strict":
        rows, bad = split_valid(rows, c)
        rejects = _union(rejects, _as_rejects(bad))
    return rows, rejects


def _landed(batch: DataFrame, staging: str, specs: list[ColumnSpec] | None) -> tuple[DataFrame, DataFrame | None] | None:
    """Parsed rows and rejected lines of a batch; None if nothing landed."""
    rows, rejects = batch, None
    if CORRUPT_COL in rows.columns:
        # parsed once into a staged table; the emptiness test below reads it
        rows, corrupt = split_corrupt(rows, staging)
        rejects = corrupt.select(F.col(CORRUPT_COL).alias("raw"),
                                 F.array(F.lit("corrupt")).alias("reasons"))
    if rows.isEmpty() and (rejects is None or rejects.isEmpty()):
        return None
    if specs:
        rows, bad = conform(rows, specs)
        rejects = _union(rejects, _as_rejects(bad))
    return rows, rejects


def _stream_of(batch: DataFrame, stream_id: str | None) -> str:
    stream = stream_id or batch.sparkSession.sparkContext.getLocalProperty(_QUERY_ID)
    if not stream:
        raise ValueError("outside a streaming query the batch function needs a stream_id")
    return stream


def upsert_batch_fn(
    table: VersionedTable,
    c: ChangeContract,
    mode: str = "strict",
    specs: Iterable[ColumnSpec] | None = None,
    quarantine_path: str | None = None,
    keep_versions: int | None = None,
    conflicts_path: str | None = None,
    discard_rejects: bool = False,
    stream_id: str | None = None,
    late_by: dt.timedelta | None = None,
):
    """The ``foreachBatch`` function: conform, reduce, log rejected rows
    (``quarantine_path``) and apply conflicts (``conflicts_path``), merge and
    write a version, then (``keep_versions``, if given) drop older versions.

    Rows that cannot be applied need a ``quarantine_path``, or the caller's
    word that they may go (``discard_rejects``).  Both logs are folders
    ``stream=<id>/batch=<k>``.  ``stream_id`` defaults to the id of the running
    query, which its checkpoint keeps.
    """
    if quarantine_path is None and not discard_rejects:
        raise ValueError("rejected rows need a quarantine_path (or discard_rejects=True)")
    if keep_versions is not None and keep_versions < 1:
        raise ValueError("keep at least one version")
    specs = list(specs) if specs else None

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_of(batch, stream_id)
        staging = scratch_path(table.spark, "landed")
        try:
            apply(batch, batch_id, stream, staging)
        finally:  # a crash leaves this folder; a replay stages anew
            delete_folder(table.spark, staging)

    def apply(batch: DataFrame, batch_id: int, stream: str, staging: str) -> None:
        done = table.applied_batch(stream)
        if done is not None and batch_id <= done:
            return  # replay of a batch that the table holds
        landed = _landed(batch, staging, specs)
        if landed is None:
            return  # B8: nothing landed, no new version
        rows, rejects = landed
        before = table.current_version()
        now = table.transact(lambda base: merged(rows, rejects, batch_id, stream, base))
        if keep_versions and now != before:
            table.vacuum(keep_versions)

    def merged(rows: DataFrame, rejects: DataFrame | None, batch_id: int, stream: str, base: int | None) -> int:
        """The batch applied to version ``base``; the version that holds it."""
        done = None if base is None else table._meta(base)["streams"].get(stream)
        if done is not None and batch_id <= done:
            return base
        prev = table.read(base)
        rows, rejects = _accepted(rows, rejects, prev, c, mode)
        if mode == "strict":
            rows, late = table.split_late(rows, c.ts_col, base)
            if late is not None:
                rejects = _union(rejects, _as_rejects(late.withColumn("reasons", F.array(F.lit("below_low_water")))))
        log = f"stream={stream}/batch={batch_id}"
        if quarantine_path and rejects is not None:
            rejects.write.mode("overwrite").parquet(f"{quarantine_path}/{log}")
        if rows.isEmpty():
            return base  # B8: only rejected rows landed, the table is as it was

        def keep(conflicts: DataFrame) -> None:
            if conflicts_path:
                conflicts.write.mode("overwrite").parquet(f"{conflicts_path}/{log}")

        if mode == "strict":
            # reduced in the target's types, so a key cannot occur twice
            latest = latest_one(rows, c, assume_valid=True)
            return apply_changes(table, latest, c, base, (stream, batch_id), late_by, keep, check_cardinality=False).version
        res = merge(prev, latest_with_ties(rows, c), c, mode=mode)
        keep(res.conflicts)
        return table.write(res.table, clustered_input=True, batch=(stream, batch_id), base=base)

    return run


# Table property that holds the last batch of a stream which a catalog table has.
BATCH_PROPERTY = "tidemark.batch."


def catalog_batch_fn(
    spark: SparkSession,
    table_name: str,
    c: ChangeContract,
    mode: str = "strict",
    specs: Iterable[ColumnSpec] | None = None,
    quarantine_path: str | None = None,
    discard_rejects: bool = False,
    stream_id: str | None = None,
):
    """The ``foreachBatch`` function for a table of a catalog with row-level
    operations (C1): the same rules, with ``DataFrame.mergeInto`` in place of a
    new version, so only files with matched rows are rewritten.

    The last batch of each stream is a table property, by which a replayed
    batch is skipped.  It is set after the merge; a batch replayed between the
    two is merged again, which changes nothing in strict mode."""
    if quarantine_path is None and not discard_rejects:
        raise ValueError("rejected rows need a quarantine_path (or discard_rejects=True)")
    specs = list(specs) if specs else None

    def run(batch: DataFrame, batch_id: int) -> None:
        stream = _stream_of(batch, stream_id)
        key = f"{BATCH_PROPERTY}{stream}"
        done = properties(spark, table_name).get(key)
        if done is not None and batch_id <= int(done):
            return
        staging = scratch_path(spark, "landed")
        try:
            landed = _landed(batch, staging, specs)
            if landed is None:
                return
            rows, rejects = _accepted(*landed, spark.table(quoted(table_name)), c, mode)
            if quarantine_path and rejects is not None:
                rejects.write.mode("overwrite").parquet(f"{quarantine_path}/stream={stream}/batch={batch_id}")
            if not rows.isEmpty():
                latest = latest_one(rows, c, assume_valid=True) if mode == "strict" else latest_with_ties(rows, c)
                merge_into_catalog(table_name, latest, c, mode)
            spark.sql(f"ALTER TABLE {quoted(table_name)} SET TBLPROPERTIES ('{key}' = '{batch_id}')")
        finally:
            delete_folder(spark, staging)

    return run


def start_catalog_upsert(changes: DataFrame, table_name: str, c: ChangeContract, checkpoint: str, **kw) -> StreamingQuery:
    """Start the upsert stream into a catalog table; processes what has landed and stops."""
    fn = catalog_batch_fn(changes.sparkSession, table_name, c, **kw)
    return changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(fn).trigger(availableNow=True).start()


def start_upsert(
    changes: DataFrame,
    table: VersionedTable,
    c: ChangeContract,
    checkpoint: str,
    mode: str = "strict",
    specs: Iterable[ColumnSpec] | None = None,
    quarantine_path: str | None = None,
    available_now: bool = True,
    processing_time: str | None = None,
    keep_versions: int | None = None,
    conflicts_path: str | None = None,
    discard_rejects: bool = False,
    late_by: dt.timedelta | None = None,
) -> StreamingQuery:
    """Start the upsert stream over a streaming DataFrame of change rows."""
    w = changes.writeStream.option("checkpointLocation", checkpoint).foreachBatch(
        upsert_batch_fn(table, c, mode, specs, quarantine_path, keep_versions, conflicts_path,
                        discard_rejects, late_by=late_by))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()
