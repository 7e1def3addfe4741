"""Latest change per key (D1, D2) and the strict-mode quarantine split.

Both forms are skew-safe: a key holding a third of all rows is first reduced
by a partial (map-side) aggregate, so no task ever receives a whole hot group.

* ``latest_with_ties`` (compat, D1) keeps every row at the key's maximum change
  time, takes that maximum *before* filtering op codes, and then keeps only
  I / U / D rows -- the reference job's exact semantics (Q1-Q5).  The maximum
  is a hash aggregate (checkpointed and measured); rows are matched back with
  an equi-join on ``(key, time)``: a broadcast join when the per-key maxima
  are under the bound, else a sort-merge join that spreads a hot key's rows
  over tasks by time.
* ``latest_one`` (strict, D2) keeps exactly one row per key, ordered by
  ``(time, seq)`` and then by the row itself, as one aggregate with a partial
  stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract
from tidemark.functions.expr import any_failed, change_order, is_delete, orderable, reasons, valid_op
from tidemark.plans.sizing import fits_broadcast
from tidemark.session import materialize

_MAX_TS = "_tm_max_ts"


def latest_with_ties(
    changes: DataFrame,
    c: ChangeContract,
    materialize_max: bool = True,
    broadcast_limit_bytes: int | None = None,
) -> DataFrame:
    """D1 + B3-B5 + E1: rows at the per-key max time whose op is I, U or D.

    * the max is taken over all rows, so a key whose latest row has a null or
      unknown op vanishes (Q1);
    * rows tied at the max all survive (Q2);
    * null-time rows never equal the max and drop; a key with only null times
      disappears (Q3);
    * the null key forms one group (null-safe match), like a window partition (Q5).
    """
    keys = list(c.key_cols)
    alias = {k: f"_tm_k_{i}" for i, k in enumerate(keys)}
    mx = changes.groupBy(*[F.col(k).alias(alias[k]) for k in keys]).agg(
        F.max(c.ts_col).alias(_MAX_TS)
    )
    if materialize_max:
        # One row per key: computed once, measured, and broadcast only when
        # its measured size is under the bound -- then the feed is never
        # shuffled.  Otherwise a sort-merge join on (key, time).
        mx = materialize(mx)
        small, _ = fits_broadcast(mx, broadcast_limit_bytes)
        # the measurement decides, not the optimizer's estimate of a checkpoint
        mx = F.broadcast(mx) if small else mx.hint("merge")
    cond = [changes[k].eqNullSafe(mx[alias[k]]) for k in keys]
    cond.append(changes[c.ts_col] == mx[_MAX_TS])
    joined = changes.join(mx, cond, "inner")
    return joined.where(valid_op(c.op_col)).select(*[changes[x] for x in changes.columns])


def split_valid(changes: DataFrame, c: ChangeContract) -> tuple[DataFrame, DataFrame]:
    """Strict mode: route rows that cannot be applied to a quarantine.

    Returns ``(good, bad)``; ``bad`` carries a ``reasons`` array naming every
    failed check (``null_key``, ``null_time``, ``bad_op``).  Good + bad = input.
    """
    key_null = F.lit(False)
    for k in c.key_cols:
        key_null = key_null | F.col(k).isNull()
    checks = (
        (key_null, "null_key"),
        (F.col(c.ts_col).isNull(), "null_time"),
        (~valid_op(c.op_col), "bad_op"),
    )
    failed = any_failed(*checks)
    good = changes.where(~failed)
    bad = changes.where(failed).withColumn("reasons", reasons(*checks))
    return good, bad


def latest_one(changes: DataFrame, c: ChangeContract, assume_valid: bool = False, wide: bool = False,
               broadcast_limit_bytes: int | None = None) -> DataFrame:
    """Exactly one change per key, the one with the greatest ``(time, seq)``.

    Rows equal in both are ordered by their content (a delete above others,
    then the contract's columns, then the rest), so the choice never depends
    on input order.

    Invalid rows (null key, null time, unknown op) are filtered first unless
    ``assume_valid``; use :func:`split_valid` to keep them.  Filtering before
    the maximum is what makes batch folding order-independent (SURVEY 2.13).

    With ``wide`` (rows of many or long columns) only keys and times are
    aggregated, by hash: rows at their key's last time are matched back and
    kept in the shared folder, and whole rows are compared only where several
    of a key are left.  Same result; more passes, but no sort of whole rows.
    """
    if not assume_valid:
        changes, _ = split_valid(changes, c)
    check_sequence(changes, c)
    if wide:
        return _latest_one_wide(changes, c, broadcast_limit_bytes)
    keys = list(c.key_cols)
    types = {f.name: f.dataType for f in changes.schema.fields}
    head = [c.ts_col] + ([c.seq_col] if c.seq_col else [])
    tail = tie_columns(changes.columns, c) + [c.op_col]
    named = [*head, None, *tail]  # None: the delete flag
    parts = [is_delete(F.col(f"`{c.op_col}`")) if x is None else F.col(f"`{x}`") for x in named]
    ordered = [p if x is None else orderable(p, types[x]) for x, p in zip(named, parts)]
    group = changes.groupBy(*[F.col(f"`{k}`") for k in keys])
    if all(a is b for a, b in zip(parts, ordered)):  # the order holds the whole row
        picked = group.agg(F.max(change_order(*parts)).alias("_tm_row"))
    else:
        picked = group.agg(F.max_by(change_order(*parts), change_order(*ordered)).alias("_tm_row"))
    at = {x: f"_tm_row.o{i}" for i, x in enumerate(named)}
    return picked.select(*[F.col(f"`{x}`") if x in keys else F.col(at[x]).alias(x) for x in changes.columns])


def _latest_one_wide(changes: DataFrame, c: ChangeContract, limit: int | None) -> DataFrame:
    keys = [F.col(f"`{k}`") for k in c.key_cols]
    # every row here has an op, a key and a time, so these are the rows at the
    # last time of their key, all ties included
    last = materialize(latest_with_ties(changes, c, broadcast_limit_bytes=limit))
    tied = materialize(last.groupBy(*keys).agg(F.count(F.lit(1)).alias("_tm_n")).where("_tm_n > 1").drop("_tm_n"))
    small, _ = fits_broadcast(tied, limit)
    tied = F.broadcast(tied) if small else tied.hint("merge")
    single = last.join(tied, list(c.key_cols), "left_anti")
    several = last.join(tied, list(c.key_cols), "left_semi")
    return single.unionByName(latest_one(several, c, assume_valid=True)).select(*[F.col(f"`{x}`") for x in changes.columns])


def tie_columns(names: list[str], c: ChangeContract) -> list[str]:
    """The columns that order changes of one key, time and sequence: the
    contract's own, then the others as they come."""
    skip = {*c.key_cols, c.ts_col, c.op_col, c.seq_col}
    own = [x for x in c.columns if x in names]
    return [x for x in [*own, *[x for x in names if x not in own]] if x not in skip]


def check_sequence(changes: DataFrame, c: ChangeContract) -> None:
    """Refuse a text sequence that the contract does not declare as text."""
    if not c.seq_col:
        return
    text = isinstance(changes.schema[c.seq_col].dataType, T.StringType)
    if text and not isinstance(c.seq_type, T.StringType):
        raise ValueError(f"sequence {c.seq_col} is text, where 9 sorts above 10: give the contract a seq_type")
