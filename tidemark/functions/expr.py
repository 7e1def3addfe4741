"""Scalar expressions (G1-G4).  Every function returns a ``Column`` built from
``pyspark.sql.functions`` so it stays inside whole-stage codegen."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import OP_DELETE, OPS


def valid_op(op_col: str = "op") -> Column:
    """The op code is one of I, U, D.  Case-sensitive; null is not valid."""
    return F.coalesce(F.col(op_col).isin(*OPS), F.lit(False))


def to_change_time(c: Column | str, fmt: str | None = None, ntz: bool = True) -> Column:
    """G1: change time from text or timestamp.

    Text is parsed with ``try_cast`` (ISO text) or ``try_to_timestamp`` (a
    pattern) so that, under ANSI mode, a bad value becomes null (and can be
    quarantined) instead of failing the job.  Times carry no zone (NTZ) by
    default, as the capture side writes them.
    """
    col = F.col(c) if isinstance(c, str) else c
    if fmt is None:
        return col.try_cast(T.TimestampNTZType() if ntz else T.TimestampType())
    out = F.try_to_timestamp(col, F.lit(fmt))
    return out.cast(T.TimestampNTZType()) if ntz else out


def to_change_time_any(c: Column | str, formats: tuple[str, ...], epoch: bool = False) -> Column:
    """G1 where sources write times in several forms: the first pattern of
    ``formats`` that fits, then (``epoch``) whole seconds since 1970, then ISO
    text; null where none does."""
    col = F.col(c) if isinstance(c, str) else c
    tries = [to_change_time(col, f) for f in formats]
    if epoch:
        whole = F.when(col.rlike(r"^-?[0-9]{1,11}$"), col).try_cast("long")
        tries.append(F.expr("TIMESTAMP_NTZ '1970-01-01 00:00:00'") + F.make_dt_interval(secs=whole.cast("decimal(18,6)")))
    return F.coalesce(*tries, to_change_time(F.when(~col.rlike(r"^[0-9]+$"), col)))


def capture_time(literal: str | None = None, ntz: bool = True) -> Column:
    """The capture-time column added to every change row.

    ``literal`` gives a fixed time so results repeat (tests, replays);
    otherwise the query's ``current_timestamp()`` is used.
    """
    if literal is None:
        now = F.current_timestamp()
        return now.cast(T.TimestampNTZType()) if ntz else now
    kind = "TIMESTAMP_NTZ" if ntz else "TIMESTAMP"
    return F.expr(f"{kind} '{literal}'")


def bucket(col: str, num_buckets: int) -> Column:
    """Hash bucket of a column, ``pmod(hash(col), n)``.

    Spark's Murmur3 ``hash`` uses seed 42, so bucket numbers differ from other
    engines' bucket transforms; rows of one key always land in one bucket.
    """
    return F.pmod(F.hash(F.col(col)), F.lit(num_buckets)).cast("int")


def any_failed(*checks: tuple[Column, str]) -> Column:
    """True when any check fails.  A plain boolean OR, so the filter that
    splits good from bad rows stays inside whole-stage codegen."""
    out = F.lit(False)
    for cond, _ in checks:
        out = out | F.coalesce(cond, F.lit(False))
    return out


def reasons(*checks: tuple[Column, str]) -> Column:
    """Array of the names of the failed checks (empty when all pass).

    A check whose condition is null counts as passed; write conditions so
    that null means "not failed".  Built with a higher-order function, which
    runs interpreted: evaluate it on the rejected rows only.
    """
    arr = F.array(*[F.when(cond, F.lit(name)) for cond, name in checks])
    return F.filter(arr, lambda x: x.isNotNull())


def orderable(col: Column, dtype: T.DataType) -> Column:
    """``col`` in a form that can be compared: types without an order (maps,
    variants) as JSON text."""
    text = dtype.simpleString()
    return F.to_json(F.struct(col.alias("v"))) if "map<" in text or "variant" in text else col


def change_order(*parts: Column) -> Column:
    """A change's place in the total order, as one struct compared field by
    field (null lowest): time, sequence, delete flag, then the row's values.
    The reducer and the merge build it from the same parts, so equal times are
    resolved alike whatever order rows arrive in."""
    return F.struct(*[p.alias(f"o{i}") for i, p in enumerate(parts)])


def is_delete(op: Column) -> Column:
    return F.coalesce(op == OP_DELETE, F.lit(False))
