"""Landing change rows: the CSV the capture service writes.

The landing format is positional, comma separated and *unquoted*, with no
header: ``op`` first, then every column as text, then the capture time.
Nothing is inferred; the schema is declared.  A line that does not fit the
schema (too few fields, a bad time) keeps its raw text in a corrupt-record
column so it can be quarantined rather than silently lost (Q13).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import OP_INSERT, ChangeContract, landing_schema
from tidemark.functions.expr import capture_time
from tidemark.session import scratch_path

CORRUPT_COL = "_corrupt_record"
# Fixed value: text form of the capture time (microsecond precision).
TS_FORMAT = "yyyy-MM-dd HH:mm:ss.SSSSSS"


def _csv_options(ts_format: str) -> dict[str, str]:
    return {
        "sep": ",",
        "header": "false",
        "quote": "",          # unquoted: a comma or newline inside a value breaks the row
        "escape": "\\",
        "nullValue": "",
        "emptyValue": "",
        "timestampFormat": ts_format,
        "timestampNTZFormat": ts_format,
        "encoding": "UTF-8",
    }


def read_landing(
    spark: SparkSession,
    path: str,
    c: ChangeContract,
    ts_type: T.DataType | None = None,
    ts_format: str = TS_FORMAT,
    streaming: bool = False,
    max_files_per_trigger: int | None = None,
) -> DataFrame:
    """A1 / A2: scan landing CSV with the declared schema plus the corrupt column.

    With ``streaming`` the same scan is a file stream: each run processes only
    files not yet committed to its checkpoint (the bookmark, A2).
    """
    schema = landing_schema(c, ts_type or T.TimestampNTZType())
    schema = schema.add(T.StructField(CORRUPT_COL, T.StringType(), True))
    opts = _csv_options(ts_format) | {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT_COL}
    if streaming:
        reader = spark.readStream.schema(schema).options(**opts)
        if max_files_per_trigger:
            reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
        return reader.csv(path)
    return spark.read.schema(schema).options(**opts).csv(path)


def split_corrupt(landed: DataFrame, staging: str | None = None) -> tuple[DataFrame, DataFrame]:
    """``(rows, corrupt)``: parsed rows without the corrupt column, and the raw
    text of lines that did not parse.

    The parsed rows are staged once as Parquet (in the folder ``staging``, by
    default a new one in the shared work folder), so that neither output parses
    the CSV again and each reads only its columns; it also lets a query touch
    only the corrupt column, which Spark refuses on a raw CSV scan.
    """
    spark = landed.sparkSession
    staging = staging or scratch_path(spark, "landed")
    landed.write.parquet(staging)
    landed = spark.read.schema(landed.schema).parquet(staging)
    ok = landed.where(F.col(CORRUPT_COL).isNull()).drop(CORRUPT_COL)
    bad = landed.where(F.col(CORRUPT_COL).isNotNull()).select(CORRUPT_COL)
    return ok, bad


def write_landing(changes: DataFrame, path: str, c: ChangeContract,
                  ts_format: str = TS_FORMAT, mode: str = "append") -> None:
    """Write change rows in the landing format (what the capture side emits):
    the fields as they are, joined by commas, nothing quoted, escaped or
    trimmed; null and '' are both an empty field.  A comma or a newline inside
    a value breaks its row, as the format has it (Q13)."""
    types = {f.name: f.dataType for f in changes.schema.fields}
    cols = [c.op_col, *c.columns] + ([c.seq_col] if c.seq_col else [])
    fields = [F.coalesce(_text(F.col(f"`{x}`"), types[x], ts_format), F.lit("")) for x in cols]
    changes.select(F.concat_ws(",", *fields).alias("value")).write.mode(mode).text(path)


def _text(x: Column, dtype: T.DataType, ts_format: str) -> Column:
    if isinstance(dtype, T.TimestampNTZType) and ts_format == TS_FORMAT:
        # by text: date_format would move the time through the session's zone
        whole = x.cast("string")
        part = F.when(F.instr(whole, ".") > 0, F.substring_index(whole, ".", -1)).otherwise("")
        return F.concat(F.substring_index(whole, ".", 1), F.lit("."), F.rpad(part, 6, "0"))
    if isinstance(dtype, (T.TimestampNTZType, T.TimestampType)):
        return F.date_format(x, ts_format)
    return x.cast("string")


def project_contract(df: DataFrame, c: ChangeContract, with_op: bool = True) -> DataFrame:
    """The explicit, ordered projection of the contract columns."""
    cols = ([c.op_col] if with_op else []) + list(c.columns) + ([c.seq_col] if c.seq_col else [])
    return df.select(*[F.col(f"`{x}`") for x in cols if x in df.columns])


def add_capture_time(df: DataFrame, c: ChangeContract, literal: str | None = None) -> DataFrame:
    """Stamp every row with the capture time."""
    return df.withColumn(c.ts_col, capture_time(literal))


def full_load(rows: DataFrame, c: ChangeContract, capture_literal: str | None = None) -> DataFrame:
    """A3: a whole source table as insert change rows ahead of ongoing changes."""
    stamped = rows if c.ts_col in rows.columns else add_capture_time(rows, c, capture_literal)
    return stamped.select(F.lit(OP_INSERT).alias(c.op_col), *[F.col(f"`{x}`") for x in c.columns])


def select_tables(spark: SparkSession, pattern: str, db: str | None = None) -> list[str]:
    """A4: names of catalog tables matching a ``%`` pattern (``sales.%``).

    Catalog metadata only, never rows.
    """
    if "." in pattern and db is None:
        db, pattern = pattern.split(".", 1)
    spark_pattern = pattern.replace("%", "*")
    # a session's temporary views are listed with every database, but are in none
    return sorted(t.name for t in spark.catalog.listTables(db, spark_pattern)
                  if db is None or not t.isTemporary)


def create_landing_table(spark: SparkSession, name: str, path: str, c: ChangeContract,
                         ts_type: T.DataType | None = None, ts_format: str = TS_FORMAT) -> str:
    """An external catalog table over the landing folder, with the
    declared positional schema and the unquoted CSV options."""
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name.split('.')[0]}")
    schema = landing_schema(c, ts_type or T.TimestampNTZType())
    spark.catalog.createTable(name, path=path, source="csv", schema=schema, **_csv_options(ts_format))
    return name
