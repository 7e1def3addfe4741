"""Validation and difference of two very large tables by a digest tree.

A full outer join of two tables shuffles every row of both, however few differ.
Here each side is first reduced to one line per range of its keys' hash: the
number of rows and order-free sums of two row digests.  These are aggregates
with a partial stage, so a task sends a line per range and no row.  Ranges whose
lines agree hold the same rows.  Only ranges that differ are looked at again,
each divided further, while that narrows the search enough to be worth another
scan; the rows of those left are joined.  Equal tables shuffle no row at all.

What a level aggregates, and the list of differing ranges that goes to the driver
and back as a broadcast, are bounded by ``max_ranges`` whatever the tables hold.

Keys are checked on the rows that are joined: there, a key that occurs twice on
one side raises :class:`~tidemark.operators.diff.DuplicateKeyError`.  In a range
that agrees, both sides hold the same rows the same number of times.  Null keys
are counted in the first pass and raise ``NullKeyError``.

Rows are equal if two 64-bit digests of their columns, brought to a common type,
are (values that differ only in form, as 0.0 and -0.0, agree); rows that differ
in a digest but not by ``<=>`` are told apart by the join, not reported.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract
from tidemark.functions.expr import orderable
from tidemark.operators.diff import MATCH, NullKeyError, reconcile, reconcile_summary, snapshot_diff


@dataclass(frozen=True)
class DigestTree:
    root_bits: int = 12   # ranges of the first level: 2^root_bits
    step_bits: int = 6    # each differing range is divided into 2^step_bits
    #: Bound of the ranges that one level compares.
    max_ranges: int = 1 << 18
    #: Divide further only while the differing ranges hold more than this share
    #: of all rows: below it, joining them costs less than another scan.
    join_share: float = 0.02
    #: A level that left more than this share of its rows has told that the
    #: differences lie everywhere: the rows are joined.
    gain_share: float = 0.8

    def __post_init__(self):
        if not (0 < self.root_bits <= 20 and 0 < self.step_bits <= 20 and (1 << self.root_bits) <= self.max_ranges):
            raise ValueError("bits must be in 1..20, and max_ranges hold the first level")


@dataclass(frozen=True)
class Level:
    bits: int
    ranges: int     # compared
    differing: int
    rows: tuple[int, int]  # of the two sides, in the differing ranges


@dataclass
class Differing:
    """The rows of two tables outside the ranges that agree."""

    a: DataFrame
    b: DataFrame
    rows_a: int          # of the whole tables
    rows_b: int
    equal_rows: int      # rows of each side in ranges that agree
    levels: list[Level] = field(default_factory=list)


_RANGE, _HASH, _D1, _D2 = "_dt_range", "_dt_hash", "_dt_one", "_dt_two"
_SUMS = ("n", "one_low", "one_high", "two_low", "two_high")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _common(a: DataFrame, b: DataFrame, cols: list[str]) -> dict[str, T.DataType]:
    """The type of each column in which both sides' values can be compared."""
    one, two = a.select(*[_c(x) for x in cols]), b.select(*[_c(x) for x in cols])
    return {f.name: f.dataType for f in one.limit(0).union(two.limit(0)).schema.fields}


def _value(df: DataFrame, x: str, types: dict[str, T.DataType]) -> Column:
    v = _c(x) if df.schema[x].dataType == types[x] else _c(x).cast(types[x])
    return orderable(v, types[x])


def _key_hash(df: DataFrame, keys: list[str], types: dict[str, T.DataType]) -> Column:
    return F.xxhash64(*[_value(df, k, types) for k in keys])


def _hashed(df: DataFrame, keys: list[str], cols: list[str], types: dict[str, T.DataType]) -> DataFrame:
    """Per row: the hash of its key and two digests of its columns.  Nulls are
    marked, because the hash functions pass over them."""
    vals = [_value(df, x, types) for x in cols]
    marks = [sum((F.when(_c(x).isNull(), 1 << i).otherwise(0).cast("long") for i, x in enumerate(cols[at : at + 60])), F.lit(0).cast("long"))
             for at in range(0, len(cols), 60)]
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | _c(k).isNull()
    return df.select(_key_hash(df, keys, types).alias(_HASH), F.xxhash64(*marks, *vals).alias(_D1),
                     F.xxhash64(F.lit("second"), *vals, *marks).alias(_D2), null_key.alias("_dt_null"))


def _range(bits: int) -> Column:
    return F.shiftrightunsigned(_HASH, 64 - bits)


def _sums(hashed: DataFrame, bits: int) -> DataFrame:
    """Per range: rows, null keys, and sums of the halves of both digests (a
    sum of 32-bit numbers cannot overflow below 2^31 rows in a range)."""
    low = F.lit((1 << 32) - 1)
    return hashed.groupBy(_range(bits).alias(_RANGE)).agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.col("_dt_null").cast("long")).alias("nulls"),
        F.sum(F.col(_D1).bitwiseAND(low)).alias("one_low"), F.sum(F.shiftrightunsigned(_D1, 32)).alias("one_high"),
        F.sum(F.col(_D2).bitwiseAND(low)).alias("two_low"), F.sum(F.shiftrightunsigned(_D2, 32)).alias("two_high"))


def _compared(a: DataFrame, b: DataFrame, bits: int) -> DataFrame:
    """The ranges of both sides, beside each other."""
    one = _sums(a, bits).select(F.col(_RANGE), *[F.col(x).alias(f"a_{x}") for x in (*_SUMS, "nulls")])
    two = _sums(b, bits).select(F.col(_RANGE).alias("_dt_other"), *[F.col(x).alias(f"b_{x}") for x in (*_SUMS, "nulls")])
    return one.join(two, F.col(_RANGE) == F.col("_dt_other"), "full_outer").withColumn(_RANGE, F.coalesce(_RANGE, "_dt_other"))


def differing_rows(a: DataFrame, b: DataFrame, c: ChangeContract, columns: list[str] | None = None,
                   tree: DigestTree = DigestTree()) -> Differing:
    """The rows of ``a`` and ``b`` whose keys lie in ranges that differ."""
    keys = list(c.key_cols)
    cols = columns or [x for x in c.columns if x in a.columns and x in b.columns]
    cols = keys + [x for x in cols if x not in keys]
    types = _common(a, b, cols)
    if any(isinstance(types[k], T.MapType) for k in keys):
        raise ValueError("a map cannot be a key")
    sides = [_hashed(a, keys, cols, types), _hashed(b, keys, cols, types)]
    zero = F.lit(0).cast("long")
    same = F.lit(True)
    for x in _SUMS:
        same = same & (F.coalesce(F.col(f"a_{x}"), zero) == F.coalesce(F.col(f"b_{x}"), zero))

    totals, levels, bits, chosen = None, [], tree.root_bits, None
    while True:
        # one line per range; the differing ones' numbers (at most max_ranges) come to the driver
        found = _compared(*[s if chosen is None else _within(s, chosen, levels[-1].bits) for s in sides], bits)
        na, nb = (F.coalesce(F.col(f"{t}_n"), zero) for t in "ab")
        out = found.agg(
            F.sum(na).alias("a"), F.sum(nb).alias("b"), F.count(F.lit(1)).alias("ranges"),
            F.sum(F.coalesce(F.col("a_nulls"), zero)).alias("a_nulls"), F.sum(F.coalesce(F.col("b_nulls"), zero)).alias("b_nulls"),
            F.sum(F.when(same, zero).otherwise(na)).alias("a_left"), F.sum(F.when(same, zero).otherwise(nb)).alias("b_left"),
            F.collect_list(F.when(~same, F.col(_RANGE))).alias("differing")).first()
        if totals is None:
            totals = (out["a"] or 0, out["b"] or 0)
            for n, what in ((out["a_nulls"], "the first table"), (out["b_nulls"], "the second table")):
                if n:
                    raise NullKeyError(f"{what} holds a null key, which cannot be matched; set such rows aside first")
        left = (out["a_left"] or 0, out["b_left"] or 0)
        before = sum(levels[-1].rows) if levels else sum(totals)
        chosen = out["differing"]
        levels.append(Level(bits, out["ranges"], len(chosen), left))
        if (not chosen or sum(left) <= tree.join_share * sum(totals) or bits + tree.step_bits > 62
                or len(chosen) << tree.step_bits > tree.max_ranges or (len(levels) > 1 and sum(left) > tree.gain_share * before)):
            break
        bits += tree.step_bits
    pick = [df.sparkSession.createDataFrame([], df.schema) if not chosen else
            _within(df.withColumn(_HASH, _key_hash(df, keys, types)), chosen, bits).drop(_HASH) for df in (a, b)]
    return Differing(*pick, *totals, totals[0] - levels[-1].rows[0], levels)


def _within(hashed: DataFrame, ranges: list[int], bits: int) -> DataFrame:
    """The rows of some ranges (a list of bounded length, broadcast)."""
    picked = hashed.sparkSession.createDataFrame([(r,) for r in ranges], "_dt_in long")
    return hashed.join(F.broadcast(picked), _range(bits) == F.col("_dt_in"), "left_semi")


def reconcile_by_digest(source: DataFrame, target: DataFrame, c: ChangeContract, columns: list[str] | None = None,
                        tree: DigestTree = DigestTree()) -> DataFrame:
    """The mismatches that ``reconcile`` gives, joining only the rows of ranges
    that differ."""
    d = differing_rows(source, target, c, columns, tree)
    return reconcile(d.a, d.b, c, columns)


def reconcile_summary_by_digest(source: DataFrame, target: DataFrame, c: ChangeContract,
                                columns: list[str] | None = None, tree: DigestTree = DigestTree()) -> DataFrame:
    """Rows per class, those in ranges that agree counted by the tree."""
    d = differing_rows(source, target, c, columns, tree)
    joined = reconcile_summary(reconcile(d.a, d.b, c, columns, only_mismatches=False))
    agree = source.sparkSession.createDataFrame([(MATCH, d.equal_rows)], "status string, n long")
    return joined.unionByName(agree).groupBy("status").agg(F.sum("n").alias("n")).where("n > 0")


def snapshot_diff_by_digest(before: DataFrame, after: DataFrame, c: ChangeContract,
                            tree: DigestTree = DigestTree()) -> DataFrame:
    """The change rows that ``snapshot_diff`` gives, in the same way."""
    d = differing_rows(before, after, c, tree=tree)
    return snapshot_diff(d.a, d.b, c)

