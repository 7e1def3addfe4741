"""Table contracts: which columns are the key, the change time, the op code.

A contract names columns only; it never holds data.  The same operators run
on the toll-road table of the reference sample and on feeds derived from the
driver's tables.
"""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import types as T

# The change-row op codes of the landing format (insert, update, delete).
OP_INSERT = "I"
OP_UPDATE = "U"
OP_DELETE = "D"
OPS = (OP_INSERT, OP_UPDATE, OP_DELETE)

# Hidden column of strict-mode tables: a tombstone keeps the key and the time
# of its delete so that an older change arriving later cannot bring it back.
DELETED_COL = "is_deleted"
# Hidden column of strict-mode tables: the sequence of the change a row holds,
# so that two changes at the same time are ordered the same way in every
# batch order (the time guard compares (time, sequence)).
CHANGE_SEQ_COL = "change_seq"
HIDDEN_COLS = (DELETED_COL, CHANGE_SEQ_COL)


@dataclass(frozen=True)
class ColumnSpec:
    """Typed contract for one column (used by conform, J2)."""

    name: str
    dtype: T.DataType
    nullable: bool = True
    max_len: int | None = None  # VARCHAR(n) length limit for strings
    allowed: tuple[str, ...] | None = None  # closed set of values (op codes)


@dataclass(frozen=True)
class ChangeContract:
    """Describes a current-state table and the change rows that feed it.

    ``columns`` is the target column order (key and change time included);
    change rows carry ``op_col`` in front of them and may carry ``seq_col``.
    """

    columns: tuple[str, ...]
    key_cols: tuple[str, ...]
    ts_col: str = "cdc_ingestion_timestamp"
    op_col: str = "op"
    seq_col: str | None = None
    # Type of the sequence.  Landing rows are text, where 9 sorts above 10, so
    # a text sequence is used only where this says that text order is meant.
    seq_type: T.DataType | None = None
    # Columns the compat MERGE leaves out of its UPDATE SET list.
    frozen_cols: tuple[str, ...] = ()
    partition_cols: tuple[str, ...] = ()
    bucket_col: str | None = None
    num_buckets: int = 16
    specs: tuple[ColumnSpec, ...] = field(default=(), compare=False)

    def __post_init__(self):
        missing = [c for c in (*self.key_cols, self.ts_col) if c not in self.columns]
        if missing:
            raise ValueError(f"contract columns lack {missing}")

    @property
    def payload_cols(self) -> tuple[str, ...]:
        return tuple(c for c in self.columns if c not in self.key_cols)

    @property
    def change_cols(self) -> tuple[str, ...]:
        """Columns of a change row: op, the target columns, then the sequence."""
        seq = (self.seq_col,) if self.seq_col else ()
        return (self.op_col, *self.columns, *seq)

    def with_seq(self, seq_col: str | None, seq_type: T.DataType | None = None) -> "ChangeContract":
        return replace(self, seq_col=seq_col, seq_type=seq_type)

    @classmethod
    def from_dict(cls, d: dict) -> "ChangeContract":
        """A contract from plain data (e.g. a JSON file); column types are DDL
        strings: ``{"columns": [{"name": "toll_id", "type": "int"}, ...],
        "key_cols": ["record_id"], "seq_col": "lsn", "seq_type": "bigint", ...}``.
        Columns without a type stay text."""
        specs, names = [], []
        for col in d["columns"]:
            col = {"name": col} if isinstance(col, str) else col
            names.append(col["name"])
            if "type" in col:
                specs.append(ColumnSpec(col["name"], T.DataType.fromDDL(col["type"]),
                                        col.get("nullable", True), col.get("max_len"),
                                        tuple(col["allowed"]) if col.get("allowed") else None))
        kw = {k: (tuple(v) if isinstance(v, list) else v) for k, v in d.items()
              if k in ("key_cols", "ts_col", "op_col", "seq_col", "frozen_cols",
                       "partition_cols", "bucket_col", "num_buckets")}
        if d.get("seq_type"):
            kw["seq_type"] = T.DataType.fromDDL(d["seq_type"])
        return cls(columns=tuple(names), specs=tuple(specs), **kw)


# --------------------------------------------------------------------------
# The toll-road table of the reference sample.
# Column names, order and declared types of the source table,
# its landing change rows and its current-state table.
# --------------------------------------------------------------------------
TOLL_COLUMNS = (
    "state",
    "name_of_facility",
    "toll_id",
    "operating_authority",
    "from_location",
    "to_location",
    "miles",
    "rural_urban",
    "kind",
    "Authority_Source",
    "Fee_Type",
    "vehicle_fee",
    "Truck_fee",
    "record_id",
    "cdc_ingestion_timestamp",
)

TOLL_SPECS = (
    ColumnSpec("state", T.StringType(), True, 14),
    ColumnSpec("name_of_facility", T.StringType(), True, 74),
    ColumnSpec("toll_id", T.IntegerType()),
    ColumnSpec("operating_authority", T.StringType(), True, 97),
    ColumnSpec("from_location", T.StringType(), True, 57),
    ColumnSpec("to_location", T.StringType(), True, 46),
    ColumnSpec("miles", T.DecimalType(6, 2)),
    ColumnSpec("rural_urban", T.StringType(), True, 11),
    ColumnSpec("kind", T.StringType(), True, 72),
    ColumnSpec("Authority_Source", T.StringType(), True, 38),
    ColumnSpec("Fee_Type", T.StringType(), True, 7),
    ColumnSpec("vehicle_fee", T.DecimalType(5, 2)),
    ColumnSpec("Truck_fee", T.DecimalType(6, 2)),
    ColumnSpec("record_id", T.IntegerType(), False),
    ColumnSpec("cdc_ingestion_timestamp", T.TimestampNTZType()),
)

TOLL_CONTRACT = ChangeContract(
    columns=TOLL_COLUMNS,
    key_cols=("record_id",),
    ts_col="cdc_ingestion_timestamp",
    op_col="op",
    frozen_cols=("state",),
    partition_cols=("state",),
    bucket_col="toll_id",
    num_buckets=16,
    specs=TOLL_SPECS,
)


def landing_schema(c: ChangeContract, ts_type: T.DataType | None = None) -> T.StructType:
    """Schema of landing change rows: op, every contract column as text, the
    capture time as a timestamp without a zone and the sequence in its declared
    type (types are lost on landing)."""
    ts_type = ts_type or T.TimestampNTZType()
    fields = [T.StructField(c.op_col, T.StringType(), True)]
    for name in c.columns:
        fields.append(T.StructField(name, ts_type if name == c.ts_col else T.StringType(), True))
    if c.seq_col:
        fields.append(T.StructField(c.seq_col, c.seq_type or T.StringType(), True))
    return T.StructType(fields)


def raw_schema(c: ChangeContract, ts_type: T.DataType | None = None) -> T.StructType:
    """Schema of the raw current-state table: landing schema without op."""
    drop = {c.op_col, c.seq_col}
    return T.StructType([f for f in landing_schema(c, ts_type).fields if f.name not in drop])
