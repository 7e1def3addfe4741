"""Merge a batch of latest changes into a current-state table.

Two rule sets:

``compat`` follows the reference MERGE line by line::

    WHEN MATCHED AND s.op = 'D' THEN DELETE
    WHEN MATCHED THEN UPDATE SET <all columns but the frozen ones>
    WHEN NOT MATCHED THEN INSERT *            -- any op, a 'D' included (Q7)

    no time guard (Q8); a source key matching a target row more than once
    raises :class:`MergeCardinalityError` (F4).

``strict`` (for real use) takes one change per key, in the target's key type
(a second one raises :class:`MergeCardinalityError` too), applies it only when
it is at least as new as the target row, equal times being resolved by the
sequence and then by the row itself as in ``latest_one``, updates every column (Q6), ignores a delete of an absent key
(J4) and keeps deletes as hidden tombstones (``is_deleted``) so that batches
can be folded in any order and replayed (Q7, Q8, Q10).

Physical plans.  The batch is materialised (checkpoint) and measured once:

* batch under the broadcast bound -> ``target LEFT JOIN broadcast(batch)`` plus
  ``batch LEFT ANTI (target keys LEFT SEMI broadcast(batch keys))``.  The
  target is streamed once in full and once for its key column only; it is
  never shuffled.
* larger batch -> one ``FULL OUTER`` sort-merge join on the key.  After the
  latest-per-key reduction both sides hold each key at most once, so this
  join has no hot keys.  Rows with a null key (compat inserts them on every
  run) match nothing and would all meet in one task: they pass beside the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import (CHANGE_SEQ_COL, DELETED_COL, HIDDEN_COLS, OP_DELETE, OP_INSERT,
                               OP_UPDATE, ChangeContract)
from tidemark.functions.expr import change_order, is_delete, orderable
from tidemark.operators.latest import check_sequence, latest_one, latest_with_ties, tie_columns
from tidemark.plans.sizing import Size, fits_broadcast
from tidemark.session import materialize

ACTION = "action"
KEEP, UPDATE, DELETE, INSERT, IGNORE, ABSENT_DELETE = (
    "keep", "update", "delete", "insert", "ignore", "absent_delete")
CONFLICT = "conflict"
INSERT_EXISTING, UPDATE_MISSING, DELETE_MISSING = "insert_existing", "update_missing", "delete_missing"
_OP, _TS = "_tm_op", "_tm_ts"


class MergeCardinalityError(ValueError):
    """Several source rows match one target row (the MERGE cardinality rule)."""


@dataclass
class MergeResult:
    table: DataFrame      # next table state (strict: tombstones included)
    actions: DataFrame    # ``table``-side columns plus ``action`` for every joined row
    strategy: str         # "broadcast" or "shuffle"
    batch_size: Size | None  # measured when strategy="auto"
    mode: str
    # Changes whose op does not fit the target (key, time, op, conflict,
    # action): the apply-conflict log.  Strict mode applies them by time;
    # compat applies them as the MERGE does.
    conflicts: DataFrame | None = None

    def current(self) -> DataFrame:
        """Visible rows: tombstones hidden, ``is_deleted`` dropped."""
        return visible(self.table) if self.mode == "strict" else self.table

    def action_counts(self) -> DataFrame:
        return self.actions.groupBy(ACTION).agg(F.count(F.lit(1)).alias("n"))


def visible(table: DataFrame) -> DataFrame:
    """The current-state view of a strict table."""
    if DELETED_COL in table.columns:
        table = table.where(~F.coalesce(F.col(DELETED_COL), F.lit(False)))
    return table.drop(*HIDDEN_COLS)


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def spelled(df: DataFrame, names: list[str]) -> DataFrame:
    """``df`` with its columns spelled as in ``names`` where they differ only
    in case, unless the session tells cases apart."""
    if df.sparkSession.conf.get("spark.sql.caseSensitive") == "true":
        return df
    want = {x.lower(): x for x in names}
    ren = {x: want[x.lower()] for x in df.columns if want.get(x.lower(), x) != x}
    return df.withColumnsRenamed(ren) if ren else df


def _t(name: str) -> str:
    return f"_t_{name}"


def _s(name: str) -> str:
    return f"_s_{name}"


def merge(
    target: DataFrame,
    batch: DataFrame,
    c: ChangeContract,
    mode: str = "strict",
    keep_tombstones: bool = True,
    strategy: str = "auto",
    broadcast_limit_bytes: int | None = None,
    check_cardinality: bool = True,
    materialize_batch: bool = True,
) -> MergeResult:
    """Merge ``batch`` (op + contract columns, latest per key) into ``target``.

    ``strategy`` is ``"auto"`` (broadcast only under the measured bound) or
    ``"shuffle"`` (always the full outer join).
    """
    p = prepare(target, batch, c, mode, strategy, broadcast_limit_bytes, check_cardinality, materialize_batch)
    if p.broadcast:
        # distinct: target keys can repeat (compat inserts unmatched ties), so
        # only deduplicated they are bounded by the measured batch
        s_keys = p.s.select(*[_c(_s(k)) for k in c.key_cols])
        matched = p.t.select(*[_c(_t(k)) for k in c.key_cols]).join(F.broadcast(s_keys), p.on, "left_semi").distinct()
        joined = p.kept().unionByName(p.inserted(matched), allowMissingColumns=True)
    else:
        joined = p.outer()
    resolved = p.resolved(joined)
    out_cols = p.columns
    if mode == "compat":
        table = resolved.where(_c(ACTION) != DELETE).select(*out_cols)
    else:
        table = resolved
        if not keep_tombstones:
            table = table.where(~_c(DELETED_COL))
        table = table.select(*out_cols, *p.hidden)
    actions = resolved.select(*c.columns, ACTION)
    conflicts = resolved.where(_c(CONFLICT).isNotNull()).select(
        *c.key_cols, _c(_TS).alias(c.ts_col), _c(_OP).alias(c.op_col), CONFLICT, ACTION)
    return MergeResult(table, actions, "broadcast" if p.broadcast else "shuffle", p.size, mode,
                       conflicts)


@dataclass
class Prepared:
    """A target and a measured batch, named and typed alike, ready to be joined."""

    t: DataFrame          # target columns as _t_*, with _t_hit
    s: DataFrame          # batch columns as _s_*, with _s_hit; materialised
    on: Column
    c: ChangeContract
    mode: str
    extra: _Extra
    seq: str | None       # strict: the batch's sequence column, if it has one
    ties: list
    size: Size | None
    broadcast: bool

    @property
    def columns(self) -> list[str]:
        return [*self.c.columns, *self.extra.names]

    @property
    def hidden(self) -> list[str]:
        return [DELETED_COL, *([CHANGE_SEQ_COL] if self.seq else [])] if self.mode == "strict" else []

    def kept(self) -> DataFrame:
        """Every target row with its change, if any (the batch is broadcast)."""
        return self.t.join(F.broadcast(self.s), self.on, "left")

    def inserted(self, matched: DataFrame) -> DataFrame:
        """The changes whose key is none of ``matched`` (columns ``_t_<key>``)."""
        return self.s.join(F.broadcast(matched), self.on, "left_anti")

    def outer(self) -> DataFrame:
        """Both in one full outer join; null keys match nothing and pass beside it."""
        t_null, s_null = _null_key(self.c.key_cols, _t), _null_key(self.c.key_cols, _s)
        joined = self.t.where(~t_null).join(self.s.where(~s_null), self.on, "full_outer")
        lone = self.t.where(t_null).unionByName(self.s.where(s_null), allowMissingColumns=True)
        return joined.unionByName(lone, allowMissingColumns=True)

    def resolved(self, joined: DataFrame) -> DataFrame:
        """The next state of every joined row, with its action, its change's op
        and time, and its conflict."""
        if self.mode == "compat":
            return _resolve_compat(joined, self.c, self.extra)
        return _resolve_strict(joined, self.c, self.extra, self.seq is not None, self.ties)


def prepare(
    target: DataFrame,
    batch: DataFrame,
    c: ChangeContract,
    mode: str = "strict",
    strategy: str = "auto",
    broadcast_limit_bytes: int | None = None,
    check_cardinality: bool = True,
    materialize_batch: bool = True,
) -> Prepared:
    if mode not in ("compat", "strict"):
        raise ValueError(f"mode must be compat or strict, not {mode!r}")
    if strategy not in ("auto", "shuffle"):
        raise ValueError(f"strategy must be auto or shuffle, not {strategy!r}")
    cols, keys = list(c.columns), list(c.key_cols)
    known = [c.op_col, *cols, *([c.seq_col] if c.seq_col else []), *HIDDEN_COLS]
    target = spelled(target, known)
    batch = spelled(batch, known + [x for x in target.columns if x not in known])
    # Columns outside the contract (added by schema evolution) ride along.
    skip = {c.op_col, c.seq_col, *HIDDEN_COLS, *cols}
    # strict: the applied change's sequence is kept to order equal times
    seq = c.seq_col if (mode == "strict" and c.seq_col and c.seq_col in batch.columns) else None
    t_extra = [x for x in target.columns if x not in skip]
    s_extra = [x for x in batch.columns if x not in skip]
    types = {f.name: f.dataType for f in target.schema.fields} | {
        f.name: f.dataType for f in batch.schema.fields if f.name not in t_extra}
    extra = _Extra(t_extra + [x for x in s_extra if x not in t_extra], set(t_extra), set(s_extra), types)

    # as a SQL MERGE does, source values take the target column's type
    t_types = {f.name: f.dataType for f in target.schema.fields}
    b_types = {f.name: f.dataType for f in batch.schema.fields}

    def as_target(x: str) -> Column:
        tt = t_types.get(x)
        if tt is None or isinstance(tt, T.NullType) or tt == b_types.get(x):
            return _c(x)
        return _c(x).cast(tt)

    s = batch.select(
        _c(c.op_col).alias("_s_op"),
        *[as_target(x).alias(_s(x)) for x in cols + s_extra],
        *([_c(seq).alias("_s_seq")] if seq else []),
        F.lit(True).alias("_s_hit"),
    )
    if seq:
        check_sequence(batch, c)
    if materialize_batch:
        s = materialize(s)
    size = None
    use_broadcast = False
    if strategy == "auto":  # measure only where the size decides the plan
        use_broadcast, size = fits_broadcast(s, broadcast_limit_bytes)

    deleted = _c(DELETED_COL) if DELETED_COL in target.columns else F.lit(False)
    seq_cols = []
    if seq:
        seq_type = batch.schema[seq].dataType
        kept = _c(CHANGE_SEQ_COL) if CHANGE_SEQ_COL in target.columns else F.lit(None)
        seq_cols = [kept.cast(seq_type).alias("_t_seq")]
    t = target.select(
        *[_c(x).alias(_t(x)) for x in cols + t_extra],
        deleted.alias("_t_del"),
        *seq_cols,
        F.lit(True).alias("_t_hit"),
    )
    on = _key_match(keys)

    if check_cardinality:
        _check_cardinality(t if mode == "compat" else None, s, keys, broadcast_limit_bytes)

    ties = tie_columns([x for x in batch.columns if x not in HIDDEN_COLS], c)
    return Prepared(t, s, on, c, mode, extra, seq, ties, size, use_broadcast)


@dataclass
class _Extra:
    """Non-contract columns: their order, which side has each, their types."""

    names: list
    in_target: set
    in_batch: set
    types: dict

    def t(self, x: str) -> Column:
        return _c(_t(x)) if x in self.in_target else F.lit(None).cast(self.types[x])

    def s(self, x: str) -> Column:
        return _c(_s(x)) if x in self.in_batch else F.lit(None).cast(self.types[x])


def _null_key(keys: list[str], side) -> Column:
    cond = F.lit(False)
    for k in keys:
        cond = cond | _c(side(k)).isNull()
    return cond


def _key_match(keys: list[str]) -> Column:
    cond = None
    for k in keys:
        e = _c(_t(k)) == _c(_s(k))
        cond = e if cond is None else cond & e
    return cond


def _repeated(s: DataFrame, keys: list[str]) -> DataFrame:
    return (
        s.groupBy(*[_c(_s(k)) for k in keys])
        .agg(F.count(F.lit(1)).alias("_n"))
        .where(F.col("_n") > 1)
        .drop("_n")
    )


def ambiguous_keys(target: DataFrame, batch: DataFrame, c: ChangeContract) -> DataFrame:
    """F4 as a report: the target's keys matched by more than one batch row,
    those for which a compat merge raises :class:`MergeCardinalityError`."""
    keys = list(c.key_cols)
    types = {f.name: f.dataType for f in target.schema.fields}
    s = batch.select(*[_c(k).cast(types[k]).alias(_s(k)) for k in keys])
    t = target.select(*[_c(k).alias(_t(k)) for k in keys])
    return t.join(_repeated(s, keys), _key_match(keys), "left_semi").distinct().select(
        *[_c(_t(k)).alias(k) for k in keys])


def _check_cardinality(t: DataFrame | None, s: DataFrame, keys: list[str], limit: int | None) -> None:
    """raise when a source key occurs more than once and matches a target
    row (or at all, without ``t``: strict tables hold a key once)."""
    dup = _repeated(s, keys)
    if dup.isEmpty():
        return
    if t is None:
        raise MergeCardinalityError(
            "the batch holds several changes for one key of the target; "
            "cast the keys to the target's types and reduce (latest_one) first"
        )
    # broadcast the duplicated keys only under their measured size
    small, _ = fits_broadcast(dup, limit)
    dup = F.broadcast(dup) if small else dup.hint("merge")
    hit = t.select(*[_c(_t(k)) for k in keys]).join(dup, _key_match(keys), "left_semi")
    if not hit.isEmpty():
        raise MergeCardinalityError(
            "MERGE matched a target row with more than one source row; "
            "reduce the batch to one change per key (latest_one) first"
        )


def _hits(joined: DataFrame):
    return F.coalesce(_c("_t_hit"), F.lit(False)), F.coalesce(_c("_s_hit"), F.lit(False))


def _conflict(joined: DataFrame) -> Column:
    """A change whose op does not fit the target -- an insert of a live
    key, an update or a delete of a key with no live row."""
    t_hit, s_hit = _hits(joined)
    live = t_hit & ~F.coalesce(_c("_t_del"), F.lit(False))
    op = _c("_s_op")
    return (
        F.when(s_hit & (op == OP_INSERT) & live, F.lit(INSERT_EXISTING))
        .when(s_hit & (op == OP_UPDATE) & ~live, F.lit(UPDATE_MISSING))
        .when(s_hit & (op == OP_DELETE) & ~live, F.lit(DELETE_MISSING))
    )


def _change_cols(j: DataFrame, c: ChangeContract) -> list[Column]:
    """The change's own op, time and conflict, kept for the conflict log."""
    return [_conflict(j).alias(CONFLICT), _c("_s_op").alias(_OP), _c(_s(c.ts_col)).alias(_TS)]


def _resolve_compat(joined: DataFrame, c: ChangeContract, extra: _Extra) -> DataFrame:
    t_hit, s_hit = _hits(joined)
    action = (
        F.when(t_hit & s_hit & (_c("_s_op") == OP_DELETE), F.lit(DELETE))
        .when(t_hit & s_hit, F.lit(UPDATE))
        .when(t_hit, F.lit(KEEP))
        .otherwise(F.lit(INSERT))
    )
    j = joined.withColumn(ACTION, action)
    a = _c(ACTION)
    out = []
    for x in c.columns:
        on_update = _c(_t(x)) if x in c.frozen_cols else _c(_s(x))
        out.append(
            F.when(a == KEEP, _c(_t(x))).when(a == UPDATE, on_update).otherwise(_c(_s(x))).alias(x)
        )
    # a column outside the UPDATE SET list keeps the target's value
    for x in extra.names:
        out.append(F.when(a.isin(KEEP, UPDATE), extra.t(x)).otherwise(extra.s(x)).alias(x))
    return j.select(*out, a, *_change_cols(j, c))


def _resolve_strict(joined: DataFrame, c: ChangeContract, extra: _Extra, has_seq: bool,
                    ties: list[str]) -> DataFrame:
    t_hit, s_hit = _hits(joined)
    is_d = is_delete(_c("_s_op"))
    t_del = F.coalesce(_c("_t_del"), F.lit(False))
    # The order of latest_one; a target row without a kept sequence loses ties.
    types = {f.name: f.dataType for f in joined.schema.fields}

    def place(side, seq: str, dead: Column) -> Column:
        vals = [(extra.t if side is _t else extra.s)(x) if x in extra.names else _c(side(x)) for x in ties]
        kinds = [extra.types[x] if x in extra.names else types[_s(x)] for x in ties]
        return change_order(_c(side(c.ts_col)), *([_c(seq)] if has_seq else []), dead,
                            *[orderable(v, k) for v, k in zip(vals, kinds)])

    newer = place(_s, "_s_seq", is_d) >= place(_t, "_t_seq", t_del)
    action = (
        F.when(t_hit & ~s_hit, F.lit(KEEP))
        .when(t_hit & ~newer, F.lit(IGNORE))
        .when(t_hit & is_d, F.lit(DELETE))
        .when(t_hit & t_del, F.lit(INSERT))
        .when(t_hit, F.lit(UPDATE))
        .when(is_d, F.lit(ABSENT_DELETE))
        .otherwise(F.lit(INSERT))
    )
    j = joined.withColumn(ACTION, action)
    a = _c(ACTION)
    from_target = a.isin(KEEP, IGNORE)
    out = [F.when(from_target, _c(_t(x))).otherwise(_c(_s(x))).alias(x) for x in c.columns]
    # an applied change sets the columns it carries; others keep the target's
    for x in extra.names:
        applied = extra.s(x) if x in extra.in_batch else extra.t(x)
        out.append(F.when(from_target, extra.t(x)).otherwise(applied).alias(x))
    dele = (
        F.when(from_target, t_del)
        .when(a.isin(DELETE, ABSENT_DELETE), F.lit(True))
        .otherwise(F.lit(False))
        .alias(DELETED_COL)
    )
    kept_seq = [F.when(from_target, _c("_t_seq")).otherwise(_c("_s_seq")).alias(CHANGE_SEQ_COL)] if has_seq else []
    return j.select(*out, dele, *kept_seq, a, *_change_cols(j, c))


def fold(
    target: DataFrame,
    batches: list[DataFrame],
    c: ChangeContract,
    mode: str = "strict",
    reduce: str = "one",
    **merge_kw,
) -> DataFrame:
    """Apply change batches one after another (H1, H3).

    Each batch is reduced to its latest change per key (``reduce``: ``"one"``
    for D2, ``"ties"`` for D1) and merged; every intermediate state (the last
    one is left to the caller) is checkpointed so lineage stays one merge deep
    however many batches run.
    In strict mode with tombstones the result does not depend on the order
    of the batches and equals a single merge of all changes.
    """
    state = target
    for i, b in enumerate(batches):
        if i:
            state = materialize(state)
        latest = latest_one(b, c) if reduce == "one" else latest_with_ties(b, c)
        state = merge(state, latest, c, mode=mode, **merge_kw).table
    return state


def merge_into_catalog(
    table_name: str,
    batch: DataFrame,
    c: ChangeContract,
    mode: str = "strict",
    keep_tombstones: bool = True,
) -> None:
    """Row-level MERGE into a table-format (V2) catalog table via
    ``DataFrame.mergeInto``: the same rules as :func:`merge`, but the table
    format rewrites only the files holding matched rows.  This is the path
    for very large targets; it needs a catalog whose tables support row-level
    operations (no such connector is installed in this repository's test
    environment, so it is exercised only up to analysis).

    ``batch`` must already hold one change per key (strict) or the reference's
    latest rows (compat), with ``op`` and the contract columns.  Columns outside
    the contract that both the table and the batch have (added by schema
    evolution) are carried, as :func:`merge` does.
    """
    known = {x.lower() for x in batch.sparkSession.table(table_name).columns}
    skip = {c.op_col, c.seq_col, *HIDDEN_COLS, *c.columns}
    extra = [x for x in batch.columns if x not in skip and x.lower() in known]
    columns = [*c.columns, *extra]
    s = batch.alias("_src")
    src = lambda x: F.col(f"_src.`{x}`")
    tgt = lambda x: F.col(f"{table_name}.`{x}`")
    on = None
    for k in c.key_cols:
        e = tgt(k) == src(k)
        on = e if on is None else on & e
    is_d = src(c.op_col) == OP_DELETE
    m = s.mergeInto(table_name, on)
    if mode == "compat":
        m = (m.whenMatched(is_d).delete()
             .whenMatched().update({x: src(x) for x in c.columns if x not in c.frozen_cols})
             .whenNotMatched().insert({x: src(x) for x in columns}))
    else:
        kept = {}
        if c.seq_col and c.seq_col in batch.columns:
            # the table keeps the applied change's sequence (``change_seq``)
            check_sequence(batch, c)
            kept = {CHANGE_SEQ_COL: src(c.seq_col)}
        ties = [x for x in tie_columns(batch.columns, c) if x in columns]
        types = {f.name: f.dataType for f in batch.schema.fields}

        def place(col, seq: list[Column], dead: Column) -> Column:
            return change_order(col(c.ts_col), *seq, dead, *[orderable(col(x), types[x]) for x in ties])

        newer = place(src, [src(c.seq_col)] if kept else [], is_delete(src(c.op_col))) >= place(
            tgt, [tgt(CHANGE_SEQ_COL)] if kept else [], F.coalesce(tgt(DELETED_COL), F.lit(False)))
        live = {x: src(x) for x in columns} | {DELETED_COL: F.lit(False)} | kept
        dead = {x: src(x) for x in columns} | {DELETED_COL: F.lit(True)} | kept
        if keep_tombstones:
            m = m.whenMatched(newer & is_d).update(dead)
        else:
            m = m.whenMatched(newer & is_d).delete()
        m = m.whenMatched(newer).update(live).whenNotMatched(~is_d).insert(live)
        if keep_tombstones:
            m = m.whenNotMatched(is_d).insert(dead)
    m.merge()
