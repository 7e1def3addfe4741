"""Every registered query against its DuckDB oracle on the smallest scale."""

import sys
from pathlib import Path

import duckdb
import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

import __spark_entry__ as E  # noqa: E402
from tools.oracle_check import TABLES, digest  # noqa: E402

SF = "/root/testdata/sf0.001"
NAMES = sorted(E.QUERIES)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        p = f"{SF}/{t}.parquet"
        if Path(p).exists():
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def test_every_query_has_an_oracle():
    assert set(E.ORACLE) == set(E.QUERIES)


@pytest.mark.skipif(not Path(SF).exists(), reason="driver test data not present")
@pytest.mark.parametrize("name", NAMES)
def test_query_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    res = duck.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in res.description]
    drows = res.fetchall()
    assert sorted(df.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert digest(df.columns, srows)[0] == digest(dcols, drows)[0]


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0 and df.columns == ["state", "amount", "record_id", "cdc_ingestion_timestamp"]
