"""Apply a batch to a versioned table in one pass over the target.

:func:`~tidemark.operators.merge.merge` gives DataFrames, and each of table,
actions and conflicts that is written runs the join again.  Here the version
itself is the staged result: its rows are written with what the merge did to
them in columns that readers of the table do not see
(:data:`~tidemark.sources.table.LOG_COLS`), and the conflicts, the counts and,
in the broadcast plan, the keys that matched are read from there.  The target is
read once:

* batch under the broadcast bound: ``target LEFT JOIN broadcast(batch)`` is
  written; the keys it matched (those with an action, at most as many as the
  batch has) are read back from the new files, and the changes left over are
  appended as inserts;
* larger batch: one full outer join is written.

Counts of actions and the last change time are one aggregate over two of those
columns, nearly all null, in the new files.  (``DataFrame.observe`` would give
them with the write, but adds up a task twice that is run again after a lost
executor, and reports nothing where the adaptive planner finds an input empty.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract
from tidemark.operators.merge import (_OP, _TS, ABSENT_DELETE, ACTION, CONFLICT, DELETE, IGNORE, INSERT, KEEP,
                                      UPDATE, Prepared, prepare)
from tidemark.sources.table import LOG_COLS, VersionedTable, mark_text

ACTIONS = (KEEP, UPDATE, DELETE, INSERT, IGNORE, ABSENT_DELETE)


@dataclass
class Applied:
    version: int
    strategy: str
    counts: dict[str, int]  # rows per action


def _logged(p: Prepared, joined: DataFrame) -> DataFrame:
    """The table's rows with the log beside them."""
    touched = F.when(F.col(ACTION) != KEEP, F.col(ACTION))
    log = dict(zip(LOG_COLS, (F.col(_OP), F.col(_TS), touched, F.col(CONFLICT))))
    return p.resolved(joined).select(*[F.col(f"`{x}`") for x in [*p.columns, *p.hidden]], *[v.alias(k) for k, v in log.items()])


def _counted(table: VersionedTable, folder: str, log: T.StructType) -> tuple[dict[str, int], str | None]:
    """Rows per action in a folder, and the last change time."""
    _, time, action, _ = LOG_COLS
    rows = table.spark.read.schema(log).parquet(f"{table.path}/{folder}")
    name = F.coalesce(F.col(action), F.lit(KEEP))
    got = rows.agg(*[F.count(F.when(name == a, 1)).alias(a) for a in ACTIONS],
                   mark_text(F.max(time), log[time].dataType).alias("last")).first()
    return {a: got[a] for a in ACTIONS}, got["last"]


def apply_changes(
    table: VersionedTable,
    batch: DataFrame,
    c: ChangeContract,
    base: int,
    batch_of: tuple[str, int] | None = None,
    late_by: dt.timedelta | None = None,
    on_conflicts: Callable[[DataFrame], None] | None = None,
    **prepare_kw,
) -> Applied:
    """Strict merge of ``batch`` (one change per key) into version ``base``,
    published as the next one.  ``on_conflicts`` gets the conflicts before the
    version is published; ``late_by`` moves the low-water mark along.

    Raises :class:`~tidemark.sources.table.ConcurrentWriteError` if another
    writer came first (:meth:`VersionedTable.transact` runs it again).
    """
    n, before = table._next(None, base)
    target = table.read(base)
    p = prepare(target, batch, c, "strict", **prepare_kw)
    folder = table.new_folder(n)
    log_fields = [f for f in target.select(*c.key_cols).schema.fields]
    rows = _logged(p, p.kept() if p.broadcast else p.outer())
    log = T.StructType([*log_fields, *[rows.schema[x] for x in LOG_COLS]])
    try:
        schema = table.write_rows(rows, n, folder, clustered_input=True)
        if p.broadcast:
            matched = table.folder_log(folder, log).select(*[F.col(f"`{k}`").alias(f"_t_{k}") for k in c.key_cols])
            rest = p.inserted(matched)
            empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in p.t.schema.fields]
            table.write_rows(_logged(p, rest.select("*", *empty)), n, folder, append=True)
        if on_conflicts is not None:
            on_conflicts(conflicts_of(table.folder_log(folder, log), c))
        counts, last = _counted(table, folder, log)
    except BaseException:
        table.discard(n, folder)
        raise
    meta: dict = {"log": log.jsonValue(), "counts": counts}
    if batch_of is not None and last is not None:
        kept_meta = table._meta(base)
        applied = dict(kept_meta.get("applied", {}))
        applied[batch_of[0]] = table.higher(applied.get(batch_of[0]), last)
        meta["applied"] = applied
        if late_by is not None:
            meta["low_water"] = table.higher(kept_meta.get("low_water"), table.lagging(applied, late_by))
    table.publish(n, before, folder, schema, batch_of, meta)
    return Applied(n, "broadcast" if p.broadcast else "shuffle", counts)


def conflicts_of(log: DataFrame, c: ChangeContract) -> DataFrame:
    """The changes whose op did not fit the target, from a change log."""
    op, time, action, conflict = LOG_COLS
    return log.where(F.col(conflict).isNotNull()).select(
        *[F.col(f"`{k}`") for k in c.key_cols], F.col(time).alias(c.ts_col), F.col(op).alias(c.op_col),
        F.col(conflict).alias(CONFLICT), F.col(action).alias(ACTION))
