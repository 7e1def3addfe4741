"""Size checks that gate every broadcast.

A side is broadcast only when its measured size is under a bound; the
measurement is one aggregation over an already materialised (checkpointed)
DataFrame, so it is cheap and exact rather than an optimizer estimate.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20,
          "g": 1 << 30, "gb": 1 << 30, "t": 1 << 40, "tb": 1 << 40}


def parse_bytes(text: str) -> int:
    m = re.fullmatch(r"\s*(-?\d+)\s*([a-zA-Z]*)\s*", str(text))
    if not m:
        raise ValueError(f"not a byte size: {text!r}")
    return int(m.group(1)) * _UNITS[m.group(2).lower()]


def broadcast_limit(spark: SparkSession) -> int:
    """The session's broadcast bound (``spark.sql.autoBroadcastJoinThreshold``);
    -1 or less disables broadcasting."""
    return parse_bytes(spark.conf.get("spark.sql.autoBroadcastJoinThreshold", "10MB"))


#: Types held in their 8-byte slot.
_FIXED = (T.NumericType, T.BooleanType, T.DateType, T.TimestampType, T.TimestampNTZType,
          T.DayTimeIntervalType, T.YearMonthIntervalType, T.NullType)


def _row_bytes(schema: T.StructType):
    """Per-row size in an in-memory row: an 8-byte slot per field plus the
    variable-length bytes, plus a null bitmap.  Strings and binaries count
    their bytes and wide decimals 16.  Arrays, maps and structs count the
    larger of their JSON text and 16 bytes for every character that can end a
    value in it, so that neither long texts nor many short numbers are missed.
    Any other variable-length type cannot be measured and is refused."""
    fixed = 8 * (len(schema.fields) + 1)
    var = []
    for f in schema.fields:
        x, dt = F.col(f"`{f.name}`"), f.dataType
        if isinstance(dt, (T.StringType, T.BinaryType, T.CharType, T.VarcharType)):
            var.append(F.coalesce(F.octet_length(x), F.lit(0)))
        elif isinstance(dt, T.DecimalType):
            fixed += 16 if dt.precision > 18 else 0
        elif isinstance(dt, (T.ArrayType, T.MapType, T.StructType)):
            # null fields are written too: they take a slot as well
            text = F.coalesce(F.to_json(F.struct(x), {"ignoreNullFields": "false"}), F.lit(""))
            ends = F.octet_length(text) - F.octet_length(F.translate(text, ",:]}", ""))
            var.append(F.greatest(F.octet_length(text), ends * 16) + 16)
        elif not isinstance(dt, _FIXED):
            raise TypeError(f"cannot measure a column of type {dt.simpleString()}")
    out = F.lit(fixed).cast("long")
    for v in var:
        out = out + ((v + 7) / 8).cast("long") * 8
    return out


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def measure(df: DataFrame) -> Size:
    """Row count and in-memory byte size of ``df`` in one aggregation."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.sum(_row_bytes(df.schema)).alias("b")).first()
    return Size(int(r["n"]), int(r["b"] or 0))


def fits_broadcast(df: DataFrame, limit_bytes: int | None = None) -> tuple[bool, Size]:
    """Whether ``df`` is small enough to broadcast, with its measured size."""
    limit = broadcast_limit(df.sparkSession) if limit_bytes is None else limit_bytes
    try:
        size = measure(df)
    except TypeError:  # an unmeasured side is never broadcast
        return False, Size(df.count(), -1)
    return (limit >= 0 and size.bytes <= limit), size
