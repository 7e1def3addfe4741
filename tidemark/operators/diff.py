"""Change rows from two snapshots (J1) and source/target reconciliation.

Both are one full outer join on the key.  Each snapshot holds a key once, so
the join has no hot keys; the after-image is compared null-safely (a change
from null to a value, or back, is a change).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.contract import OP_DELETE, OP_INSERT, OP_UPDATE, ChangeContract


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _side(df: DataFrame, cols: list[str], tag: str) -> DataFrame:
    return df.select(*[_c(x).alias(f"_{tag}_{x}") for x in cols], F.lit(True).alias(f"_{tag}_hit"))


def _on(keys: list[str], a: str, b: str) -> Column:
    cond = None
    for k in keys:
        e = _c(f"_{a}_{k}") == _c(f"_{b}_{k}")
        cond = e if cond is None else cond & e
    return cond


class DuplicateKeyError(ValueError):
    """A snapshot holds a key more than once, so a key join would pair rows."""


class NullKeyError(ValueError):
    """A snapshot holds a row with a null key, which matches no row by key."""


def check_unique_keys(df: DataFrame, keys: list[str], what: str) -> None:
    """Raise when a key occurs twice or is null.  A count per key with a
    partial aggregate (skew-safe); stops at the first such key found."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | _c(k).isNull()
    bad = df.groupBy(*[_c(k) for k in keys]).agg(F.count(F.lit(1)).alias("_n")) \
        .where((F.col("_n") > 1) | null_key).select(null_key.alias("_null")).first()
    if bad is None:
        return
    if bad["_null"]:
        raise NullKeyError(f"{what} holds a null key, which cannot be matched; set such rows aside first")
    raise DuplicateKeyError(
        f"{what} holds a key more than once; a key join would emit every pair of its rows")


def snapshot_diff(before: DataFrame, after: DataFrame, c: ChangeContract,
                  check_keys: bool = True) -> DataFrame:
    """I for keys only in ``after``, D for keys only in ``before``, U for
    keys whose row differs.  Rows carry the after-image (the before-image for D).

    Each snapshot must hold a key once and no null key (``check_keys`` verifies
    it first): otherwise the key join would pair every copy with every other
    copy, and a null key would match nothing.
    """
    cols, keys = list(c.columns), list(c.key_cols)
    if check_keys:
        check_unique_keys(before, keys, "the before snapshot")
        check_unique_keys(after, keys, "the after snapshot")
    payload = [x for x in cols if x not in keys]
    j = _side(before, cols, "a").join(_side(after, cols, "b"), _on(keys, "a", "b"), "full_outer")
    a_hit = F.coalesce(_c("_a_hit"), F.lit(False))
    b_hit = F.coalesce(_c("_b_hit"), F.lit(False))
    same = F.struct(*[_c(f"_a_{x}") for x in payload]).eqNullSafe(
        F.struct(*[_c(f"_b_{x}") for x in payload]))
    op = (
        F.when(~a_hit, F.lit(OP_INSERT))
        .when(~b_hit, F.lit(OP_DELETE))
        .when(~same, F.lit(OP_UPDATE))
    )
    j = j.withColumn(c.op_col, op).where(_c(c.op_col).isNotNull())
    img = [F.when(~b_hit, _c(f"_a_{x}")).otherwise(_c(f"_b_{x}")).alias(x) for x in cols]
    return j.select(_c(c.op_col), *img)


# Reconciliation classes.
MATCH, DIFFER, MISSING, EXTRA = "match", "differ", "missing", "extra"


def reconcile(source: DataFrame, target: DataFrame, c: ChangeContract,
              columns: list[str] | None = None, only_mismatches: bool = True,
              check_keys: bool = True) -> DataFrame:
    """Compare a target with its source row by row.

    Per key: ``missing`` (in source only), ``extra`` (in target only),
    ``differ`` (both, with ``diff_cols`` naming the columns that differ,
    compared null-safely) or ``match``.
    """
    keys = list(c.key_cols)
    if check_keys:
        check_unique_keys(source, keys, "the source")
        check_unique_keys(target, keys, "the target")
    cols = columns or [x for x in c.columns if x in source.columns and x in target.columns]
    payload = [x for x in cols if x not in keys]
    allc = keys + payload
    j = _side(source, allc, "s").join(_side(target, allc, "t"), _on(keys, "s", "t"), "full_outer")
    s_hit = F.coalesce(_c("_s_hit"), F.lit(False))
    t_hit = F.coalesce(_c("_t_hit"), F.lit(False))
    diffs = F.concat_ws(",", *[
        F.when(~_c(f"_s_{x}").eqNullSafe(_c(f"_t_{x}")), F.lit(x)) for x in payload])
    status = (
        F.when(~t_hit, F.lit(MISSING))
        .when(~s_hit, F.lit(EXTRA))
        .when(diffs != "", F.lit(DIFFER))
        .otherwise(F.lit(MATCH))
    )
    out = j.select(
        *[F.coalesce(_c(f"_s_{k}"), _c(f"_t_{k}")).alias(k) for k in keys],
        status.alias("status"),
        F.when(s_hit & t_hit & (diffs != ""), diffs).alias("diff_cols"),
    )
    return out.where(F.col("status") != MATCH) if only_mismatches else out


def reconcile_summary(report: DataFrame) -> DataFrame:
    return report.groupBy("status").agg(F.count(F.lit(1)).alias("n"))
