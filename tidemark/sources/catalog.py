"""Catalog DDL from a contract (A9), and tables selected by pattern (A4).

``create_table`` makes the statement from the contract: the landing table
(external, positional text columns over a folder of unquoted CSV) or the
current-state table (Parquet, partitioned as the contract says; external where a
location is given, managed otherwise).  ``select_sources`` goes over catalog
metadata, never rows, and derives a contract for each table that a ``%`` pattern
selects: its columns and types from the table, its key, change time, sequence
and partitions from table properties.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import types as T

from tidemark.contract import ChangeContract, ColumnSpec, landing_schema
from tidemark.sources.landing import TS_FORMAT, _csv_options, select_tables
from tidemark.sources.table import BUCKET_SUFFIX, TARGET_FILE_BYTES

# Table properties that a source table's contract is read from.
KEY, TIME, SEQUENCE, PARTITIONS = (f"tidemark.{x}" for x in ("key", "time", "sequence", "partitions"))
#: The change-time column that a table without one gets.
CAPTURE_COL = "cdc_ingestion_timestamp"


def quoted(name: str) -> str:
    return ".".join(f"`{x}`" for x in name.split("."))


def _text(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def _columns(fields: list[T.StructField]) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" + ("" if f.nullable else " NOT NULL") for f in fields)


def landing_ddl(name: str, c: ChangeContract, location: str, ts_format: str = TS_FORMAT) -> str:
    """An external table over landing change rows."""
    options = ", ".join(f"{_text(k)} {_text(v)}" for k, v in _csv_options(ts_format).items())
    return (f"CREATE TABLE {quoted(name)} ({_columns(landing_schema(c).fields)}) USING csv "
            f"OPTIONS ({options}) LOCATION {_text(location)}")


def current_ddl(name: str, c: ChangeContract, location: str | None = None, types: dict[str, T.DataType] | None = None) -> str:
    """The current-state table: data columns, then the partition columns; a
    column has the type of its spec (text without one) unless ``types`` says
    otherwise."""
    spec = {s.name: T.StructField(s.name, s.dtype, s.nullable) for s in c.specs}
    text = T.StringType()
    own = {x: spec.get(x, T.StructField(x, T.TimestampNTZType() if x == c.ts_col else text)) for x in c.columns}
    own |= {x: T.StructField(x, t) for x, t in (types or {}).items() if x in own}
    parts = list(c.partition_cols)
    fields = [own[x] for x in c.columns if x not in parts] + [own[x] for x in parts]
    if c.bucket_col:
        parts.append(f"{c.bucket_col}{BUCKET_SUFFIX}")
        fields.append(T.StructField(parts[-1], T.IntegerType()))
    split = f" PARTITIONED BY ({', '.join(f'`{x}`' for x in parts)})" if parts else ""
    where = f" LOCATION {_text(location)}" if location else ""
    return (f"CREATE TABLE {quoted(name)} ({_columns(fields)}) USING parquet{split}{where} "
            f"TBLPROPERTIES ({_text(KEY)} = {_text(','.join(c.key_cols))}, {_text(TIME)} = {_text(c.ts_col)}, "
            f"'write_target_data_file_size_bytes' = '{TARGET_FILE_BYTES}')")


def create_table(spark: SparkSession, ddl: str, name: str, discover: bool = False) -> str:
    """Run a statement of this module, with its database; ``discover`` adds the
    partition folders that are already under the table's location."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {quoted(name.rsplit('.', 1)[0])}")
    spark.sql(ddl)
    if discover:
        spark.sql(f"MSCK REPAIR TABLE {quoted(name)}")
    return name


# ----------------------------------------------------------- tables by pattern
@dataclass(frozen=True)
class Source:
    """A selected source table, and the contract of its copy."""

    name: str
    contract: ChangeContract
    has_time: bool  # the source has the change time; else the load adds it


def properties(spark: SparkSession, name: str) -> dict[str, str]:
    return {r["key"]: r["value"] for r in spark.sql(f"SHOW TBLPROPERTIES {quoted(name)}").collect()}


def derive_contract(spark: SparkSession, name: str) -> Source:
    """The contract of one table, from its schema and properties."""
    fields = spark.table(quoted(name)).schema.fields
    known = {f.name: f for f in fields}
    props = properties(spark, name)
    names = lambda k: tuple(x.strip() for x in props.get(k, "").split(",") if x.strip())
    keys = names(KEY)
    if not keys:
        raise ValueError(f"table {name} has no property {KEY}: which columns are its key?")
    for k in (*keys, *names(TIME), *names(SEQUENCE), *names(PARTITIONS)):
        if k not in known:
            raise ValueError(f"a property of table {name} names the unknown column {k}")
    time = names(TIME)[0] if names(TIME) else CAPTURE_COL
    seq = names(SEQUENCE)[0] if names(SEQUENCE) else None
    own = [f for f in fields if f.name != seq]
    cols = tuple(f.name for f in own) + (() if time in known else (time,))
    specs = tuple(ColumnSpec(f.name, f.dataType, f.name not in keys) for f in own if f.name != time)
    return Source(name, ChangeContract(cols, keys, time, seq_col=seq, seq_type=known[seq].dataType if seq else None,
                                       partition_cols=names(PARTITIONS), specs=specs), time in known)


def select_sources(spark: SparkSession, pattern: str) -> list[Source]:
    """A4: the tables that ``<database>.<pattern>`` selects (``%``: any text),
    each with its contract."""
    db, pattern = pattern.rsplit(".", 1)
    return [derive_contract(spark, f"{db}.{t}") for t in select_tables(spark, pattern, db)]
