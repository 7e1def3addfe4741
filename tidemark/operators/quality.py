"""Conform text to a typed contract and set failures aside.

Each column is converted with ``try_cast`` (under ANSI mode a plain cast
would fail the whole job on one bad value), then checked: not-null, length
(VARCHAR(n)), closed value set.  A row with any failure goes to the
quarantine with its raw text and the list of failed checks; good + bad = input.
Everything is a column expression: no UDF, one pass, no shuffle.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract, ColumnSpec
from tidemark.functions.expr import any_failed, reasons

REASONS = "reasons"


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def typed(spec: ColumnSpec, raw: Column, source_type: T.DataType) -> Column:
    if isinstance(spec.dtype, T.StringType) or source_type == spec.dtype:
        return raw
    return raw.try_cast(spec.dtype)


def conform(df: DataFrame, specs: Iterable[ColumnSpec]) -> tuple[DataFrame, DataFrame]:
    """Return ``(good, bad)``.

    ``good`` has the spec columns in their declared types (other columns pass
    through); ``bad`` keeps the raw columns plus ``reasons``, an array of
    ``<column>:<check>`` with checks ``null``, ``type``, ``length``, ``value``.
    """
    specs = list(specs)
    src = {f.name: f.dataType for f in df.schema.fields}
    checks: list[tuple[Column, str]] = []
    conv: dict[str, Column] = {}
    for s in specs:
        raw = _c(s.name)
        val = typed(s, raw, src[s.name])
        conv[s.name] = val
        if not s.nullable:
            checks.append((raw.isNull(), f"{s.name}:null"))
        checks.append((raw.isNotNull() & val.isNull(), f"{s.name}:type"))
        if s.max_len is not None:
            checks.append((F.length(raw) > s.max_len, f"{s.name}:length"))
        if s.allowed is not None:
            checks.append((raw.isNotNull() & ~raw.isin(*s.allowed), f"{s.name}:value"))
    failed = any_failed(*checks)
    good = df.where(~failed).select(
        *[conv[x].alias(x) if x in conv else _c(x) for x in df.columns])
    bad = df.where(failed).withColumn(REASONS, reasons(*checks))
    return good, bad


def table_specs(rows: DataFrame, target: DataFrame, c: ChangeContract) -> list[ColumnSpec]:
    """Specs that bring change rows to the types of the table they are merged
    into, so that keys equal there ('7' and '07' as numbers) are one key
    before the reduction, and a value that does not convert is set aside
    instead of failing the merge."""
    want = {f.name.lower(): f.dataType for f in target.schema.fields}
    have = {f.name: f.dataType for f in rows.schema.fields}
    return [ColumnSpec(x, want[x.lower()]) for x in c.columns
            if x in have and x.lower() in want and want[x.lower()] != have[x]
            and not isinstance(want[x.lower()], (T.NullType, T.StringType))]


def as_text(df: DataFrame, keep: Iterable[str] = ()) -> DataFrame:
    """Every column as text, the way a landing file holds it (``keep`` stay typed)."""
    keep = set(keep)
    return df.select(*[_c(f.name) if f.name in keep else _c(f.name).cast("string").alias(f.name)
                       for f in df.schema.fields])
