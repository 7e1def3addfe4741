import datetime as dt
import sys
import tempfile
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from pyspark.sql import SparkSession  # noqa: E402
from pyspark.sql import types as T  # noqa: E402

from tidemark.contract import ChangeContract  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[*]")
        .appName("tidemark-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    # Tests set their own shared folder only where the session has none.
    if not s.conf.get("spark.checkpoint.dir", None):
        s.conf.set("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tidemark-test-"))
    yield s


@pytest.fixture
def tmp_dir(spark):
    from tidemark.session import scratch_path

    return scratch_path(spark, "test")


# A small contract used by the hand-written edge rows (FIXTURES section 4).
C = ChangeContract(
    columns=("state", "val", "record_id", "ts"),
    key_cols=("record_id",),
    ts_col="ts",
    seq_col="seq",
    frozen_cols=("state",),
)

CHANGE_SCHEMA = T.StructType([
    T.StructField("op", T.StringType()),
    T.StructField("state", T.StringType()),
    T.StructField("val", T.StringType()),
    T.StructField("record_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("seq", T.LongType()),
])

TABLE_SCHEMA = T.StructType([f for f in CHANGE_SCHEMA.fields if f.name not in ("op", "seq")])


def t(h):
    """Timestamp at hour ``h`` of a fixed day."""
    return None if h is None else dt.datetime(2024, 1, 1) + dt.timedelta(hours=h)


@pytest.fixture
def changes(spark):
    def make(rows):
        return spark.createDataFrame(
            [(op, st, v, k, t(h), seq) for (op, st, v, k, h, seq) in rows], CHANGE_SCHEMA)

    return make


@pytest.fixture
def target(spark):
    def make(rows):
        return spark.createDataFrame([(st, v, k, t(h)) for (st, v, k, h) in rows], TABLE_SCHEMA)

    return make


def srt(rows):
    """Sort tuples that may hold nulls (nulls last)."""
    return sorted(rows, key=lambda r: tuple((v is None, "" if v is None else v) for v in r))


def rows_of(df, *cols):
    cols = cols or tuple(df.columns)
    return srt(tuple(r[c] for c in cols) for r in df.collect())
