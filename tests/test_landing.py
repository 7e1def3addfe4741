"""Landing CSV scan, quarantine and the toll-table contract end to end."""

from pathlib import Path

from pyspark.sql import functions as F

from tidemark.contract import TOLL_CONTRACT, TOLL_SPECS, ChangeContract
from tidemark.operators.latest import latest_with_ties
from tidemark.operators.merge import merge
from tidemark.operators.quality import conform
from tidemark.sources.landing import (
    CORRUPT_COL,
    full_load,
    read_landing,
    select_tables,
    split_corrupt,
    write_landing,
)
from tidemark.sources.table import VersionedTable

T0 = "2024-01-02 10:00:00.000000"
# Hand-written landing lines in the positional 16-column toll format.
LINES = [
    f"I,Alabama,Bay Road Express,4,County Roads LLC,AL 1,AL 2,8.53,Rural,Freedom Pass,None,Fixed,3.50,3.50,1,{T0}",
    f"I,Oklahoma 5/,Nation Turnpike,200,OK Auth,I-40,US 70,105.2,Rural,Pike Pass,None,Fixed,0.50,1.00,2,{T0}",
    f"I,Colorado,Peak Road,299,City Works,Town A,Top -14- 110'' elevation,19,Rural,Booth,None,Fixed,10.00,10.00,3,{T0}",
    # a newline inside the `kind` value splits the row in two (Q13)
    "I,North Carolina,Triangle Expressway,193,NC Auth,I-40,NC-55,18.8,Urban,Quick Pass (pre-paid)",
    f"Bill by Mail (post-paid),Section 129,Dynamic,3.13,6.26,4,{T0}",
    "U,Texas,Loop Road,9,TX Auth,A,B,abc,Urban,TxTag,None,Fixed,1.00,2.00,5,2024-01-03 10:00:00.000000",
    "U,Texas,Loop Road,10,TX Auth,A,B,1.5,Urban/Rural/X,TxTag,None,Fixed,1.00,2.00,6,2024-01-03 10:00:00.000000",
    "U,Texas,Loop Road,11,TX Auth,A,B,1.5,Urban,TxTag,None,Fixed,1234.56,2.00,7,2024-01-03 10:00:00.000000",
    "D,Alabama,Bay Road Express,4,County Roads LLC,AL 1,AL 2,8.53,Rural,Freedom Pass,None,Fixed,3.50,3.50,1,"
    "2024-01-04 10:00:00.000000",
    "U,Texas,Bad Time,12,TX Auth,A,B,1.5,Urban,TxTag,None,Fixed,1.00,2.00,8,2024-13-45 99:00:00.000000",
]


def _land(spark, tmp_dir, lines=LINES):
    d = Path(tmp_dir.replace("file:", "")) / "landing"
    d.mkdir(parents=True, exist_ok=True)
    (d / "part-0.csv").write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(d)


def test_scan_keeps_bad_lines_aside(spark, tmp_dir):
    landed = read_landing(spark, _land(spark, tmp_dir), TOLL_CONTRACT).cache()
    rows, corrupt = split_corrupt(landed)
    assert landed.count() == len(LINES)
    bad_text = sorted(r[CORRUPT_COL] for r in corrupt.collect())
    assert len(bad_text) == 3  # the two halves of the split row and the bad time
    assert any(t.startswith("Bill by Mail") for t in bad_text)
    assert any("2024-13-45" in t for t in bad_text)
    got = {r["record_id"]: r for r in rows.collect()}
    assert got["2"]["state"] == "Oklahoma 5/"
    assert got["3"]["to_location"] == "Top -14- 110'' elevation"  # kept verbatim
    assert rows.schema[TOLL_CONTRACT.ts_col].dataType.typeName() == "timestamp_ntz"


def test_conform_toll_contract(spark, tmp_dir):
    rows, _ = split_corrupt(read_landing(spark, _land(spark, tmp_dir), TOLL_CONTRACT))
    good, bad = conform(rows, TOLL_SPECS)
    reasons = {r["record_id"]: list(r["reasons"]) for r in bad.collect()}
    assert reasons == {"5": ["miles:type"], "6": ["rural_urban:length"], "7": ["vehicle_fee:type"]}
    assert good.count() + bad.count() == rows.count()
    types = {f.name: f.dataType.simpleString() for f in good.schema.fields}
    assert types["miles"] == "decimal(6,2)" and types["toll_id"] == "int" and types["record_id"] == "int"
    one = good.where("record_id = 2").first()
    assert str(one["miles"]) == "105.20" and one["toll_id"] == 200


def test_compat_job_into_partitioned_raw_table(spark, tmp_dir):
    """The reference job, end to end: landing -> latest -> MERGE -> layout."""
    rows, _ = split_corrupt(read_landing(spark, _land(spark, tmp_dir), TOLL_CONTRACT))
    table = VersionedTable.for_contract(spark, f"{tmp_dir}/raw", TOLL_CONTRACT)
    empty = rows.where(F.lit(False)).drop("op")
    table.write(empty, version=0)
    batch = latest_with_ties(rows.fillna({"op": ""}), TOLL_CONTRACT)
    table.write(merge(table.read(), batch, TOLL_CONTRACT, mode="compat").table)
    cur = table.read()
    # key 1: I then D -> D is latest; absent in target -> inserted (Q7)
    assert sorted(r["record_id"] for r in cur.collect()) == ["1", "2", "3", "5", "6", "7"]
    assert cur.where("record_id = '1'").first()["name_of_facility"] == "Bay Road Express"
    # slash in a partition value reads back whole
    assert cur.where("state = 'Oklahoma 5/'").count() == 1
    parts = {p.name for p in Path(table.version_path(1).replace("file:", "")).iterdir() if p.is_dir()}
    assert "state=Oklahoma 5%2F" in parts


def test_full_load_and_select_tables(spark):
    df = spark.createDataFrame([("Alabama", 1)], "state string, record_id int")
    df.createOrReplaceTempView("sales_roads")
    spark.createDataFrame([(1,)], "x int").createOrReplaceTempView("other_table")
    assert select_tables(spark, "sales_%") == ["sales_roads"]
    from tidemark.contract import ChangeContract

    c = ChangeContract(columns=("state", "record_id", "ts"), key_cols=("record_id",), ts_col="ts")
    out = full_load(df, c, capture_literal="2024-01-01 00:00:00").first()
    assert out["op"] == "I" and out["ts"].year == 2024


def test_landing_catalog_table(spark, tmp_dir):
    from tidemark.sources.landing import create_landing_table

    create_landing_table(spark, "tm_db.landed_rows", _land(spark, tmp_dir), TOLL_CONTRACT)
    got = spark.sql("SELECT op, count(*) AS n FROM tm_db.landed_rows "
                    "WHERE record_id IS NOT NULL GROUP BY op").collect()
    # the short first half of the split row has no key; the bad-time row keeps
    # its key and reads a null time in a table without the corrupt column
    assert {r["op"]: r["n"] for r in got} == {"I": 3, "U": 4, "D": 1}


def test_to_change_time(spark):
    import datetime as dt

    from tidemark.functions.expr import to_change_time

    df = spark.createDataFrame([("2024-01-02 03:04:05.123456", "02/01/2024 03:04"), ("nope", "bad")],
                               "iso string, custom string")
    got = df.select(to_change_time("iso").alias("a"),
                    to_change_time("custom", "dd/MM/yyyy HH:mm").alias("b")).collect()
    assert got[0]["a"] == dt.datetime(2024, 1, 2, 3, 4, 5, 123456)
    assert got[0]["b"] == dt.datetime(2024, 1, 2, 3, 4)
    assert got[1]["a"] is None and got[1]["b"] is None
    assert df.select(to_change_time("iso")).schema[0].dataType.typeName() == "timestamp_ntz"


def test_comma_inside_value_is_quarantined(spark, tmp_dir):
    """Unquoted landing text: a comma inside a value makes the line one field
    too long; it is set aside whole instead of shifting columns (Q13)."""
    line = f"I,Alabama,Bay Road, Express,4,County Roads LLC,AL 1,AL 2,8.53,Rural,Pass,None,Fixed,3.50,3.50,2,{T0}"
    rows, corrupt = split_corrupt(read_landing(spark, _land(spark, tmp_dir, [LINES[0], line]), TOLL_CONTRACT))
    assert [r["record_id"] for r in rows.collect()] == ["1"]
    assert [r[CORRUPT_COL] for r in corrupt.collect()] == [line]


def test_contract_from_json_runs_the_job(spark, tmp_dir):
    import json

    from tidemark import job
    from tidemark.contract import ChangeContract

    spec = {"columns": ["region", {"name": "amount", "type": "decimal(6,2)"},
                        {"name": "id", "type": "int", "nullable": False}, "ts"],
            "key_cols": ["id"], "ts_col": "ts", "partition_cols": ["region"]}
    c = ChangeContract.from_dict(spec)
    assert c.key_cols == ("id",) and [s.name for s in c.specs] == ["amount", "id"]
    path = Path(tmp_dir.replace("file:", ""))
    path.mkdir(parents=True, exist_ok=True)
    (path / "c.json").write_text(json.dumps(spec))
    landing = path / "landing"
    landing.mkdir()
    lines = [f"I,north,1.50,1,{T0}", "U,south,2.25,1,2024-01-03 00:00:00.000000", f"I,north,bad,2,{T0}"]
    (landing / "a.csv").write_text("\n".join(lines) + "\n")
    v = job.run(spark, str(landing), f"{tmp_dir}/t", contract=str(path / "c.json"), conform=True)
    t = VersionedTable(spark, f"{tmp_dir}/t", partition_cols=("region",))
    cur = t.read(v, visible=True)
    assert {f.name: f.dataType.simpleString() for f in cur.schema.fields}["amount"] == "decimal(6,2)"
    rows = {r["id"]: (r["region"], str(r["amount"])) for r in cur.collect()}
    assert rows == {1: ("south", "2.25")}  # id 2 set aside by conform (amount:type)


def test_capture_time_now_and_literal(spark):
    from tidemark.functions.expr import capture_time

    df = spark.range(1).select(capture_time().alias("now"), capture_time("2024-01-01 00:00:00").alias("lit"),
                               capture_time(ntz=False).alias("ltz"))
    types = [f.dataType.typeName() for f in df.schema.fields]
    assert types == ["timestamp_ntz", "timestamp_ntz", "timestamp"]
    r = df.first()
    assert r["now"].year >= 2024 and r["lit"].isoformat() == "2024-01-01T00:00:00"


def test_landing_lines_are_written_as_they_are(spark, tmp_dir):
    """No quotes, no escapes, no trimming, no shift of a time without a zone."""
    c = ChangeContract(columns=("v", "k", "ts"), key_cols=("k",), ts_col="ts")
    df = spark.sql("""
        SELECT 'U' AS op, v, id AS k, t AS ts FROM VALUES
          (' lead', 1, TIMESTAMP_NTZ '2024-03-10 02:30:00'), ('trail ', 2, TIMESTAMP_NTZ '2024-03-10 02:30:00.5'),
          ('', 3, NULL), (NULL, 4, TIMESTAMP_NTZ '1999-12-31 23:59:59.123456'),
          ('a"b\\\\c', 5, NULL), ('x,y', 6, NULL) AS t(v, id, t)""")
    old = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", "America/New_York")  # 02:30 is skipped there
    try:
        write_landing(df.coalesce(1), f"{tmp_dir}/exact", c)
        lines = [r["value"] for r in spark.read.text(f"{tmp_dir}/exact").collect()]
        rows, corrupt = split_corrupt(read_landing(spark, f"{tmp_dir}/exact", c))
        back = {r["k"]: (r["v"], str(r["ts"])) for r in rows.collect()}
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)
    assert lines == ["U, lead,1,2024-03-10 02:30:00.000000", "U,trail ,2,2024-03-10 02:30:00.500000", "U,,3,",
                     "U,,4,1999-12-31 23:59:59.123456", 'U,a"b\\c,5,', "U,x,y,6,"]
    assert back["1"] == (" lead", "2024-03-10 02:30:00") and back["2"][0] == "trail "
    assert back["5"][0] == 'a"b\\c' and back["4"] == (None, "1999-12-31 23:59:59.123456")
    assert [r[0] for r in corrupt.collect()] == ["U,x,y,6,"]  # the comma broke its row (Q13)
