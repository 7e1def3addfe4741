"""DDL from contracts, partition discovery, tables selected by pattern, replication."""

import contextlib
import io
import re

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import ChangeContract, ColumnSpec
from tidemark.replicate import replicate
from tidemark.sources import catalog
from tidemark.sources.landing import write_landing
from tidemark.sources.table import VersionedTable

K = ChangeContract(columns=("k", "part", "v", "at"), key_cols=("k",), ts_col="at", partition_cols=("part",),
                   specs=(ColumnSpec("k", T.LongType(), False), ColumnSpec("v", T.DecimalType(6, 2))))


def plan_of(df):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def rows(spark, n=40):
    return spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("p/"), (F.col("id") % 4).cast("string")).alias("part"),
                                 (F.col("id") / 4).cast("decimal(6,2)").alias("v"), F.expr("TIMESTAMP_NTZ '2024-01-01 00:00:00'").alias("at"))


def test_external_table_finds_its_partitions_and_prunes(spark, tmp_dir):
    t = VersionedTable.for_contract(spark, f"{tmp_dir}/t", K)
    t.write(rows(spark))
    ddl = catalog.current_ddl("tm_cat.ext", K, t.version_path(0))
    assert "`k` bigint NOT NULL" in ddl and "PARTITIONED BY (`part`)" in ddl and "decimal(6,2)" in ddl
    catalog.create_table(spark, ddl, "tm_cat.ext", discover=True)
    assert spark.sql("SHOW PARTITIONS tm_cat.ext").count() == 4
    one = spark.table("tm_cat.ext").where("part = 'p/3'")
    assert sorted(r["k"] for r in one.collect()) == list(range(3, 40, 4))
    plan = plan_of(one)
    assert re.search(r"PartitionFilters: \[isnotnull\(part", plan)
    assert len(one.inputFiles()) < len(spark.table("tm_cat.ext").inputFiles())
    spark.sql("DROP TABLE tm_cat.ext")
    assert t.read().count() == 40  # external: its files are not the catalog's


def test_managed_table_and_landing_ddl(spark, tmp_dir):
    catalog.create_table(spark, catalog.current_ddl("tm_cat.man", K), "tm_cat.man")
    assert catalog.properties(spark, "tm_cat.man")[catalog.KEY] == "k"
    rows(spark).select("k", "v", "at", "part").write.insertInto("tm_cat.man")
    assert spark.sql("SELECT count(*) FROM tm_cat.man WHERE part = 'p/1'").first()[0] == 10
    changes = rows(spark, 3).withColumn("op", F.lit("U"))
    write_landing(changes, f"{tmp_dir}/land", K)
    catalog.create_table(spark, catalog.landing_ddl("tm_cat.land", K, f"{tmp_dir}/land"), "tm_cat.land")
    got = spark.table("tm_cat.land").orderBy("k").collect()
    assert [(r["op"], r["k"], r["part"], r["v"]) for r in got] == [("U", "0", "p/0", "0.00"), ("U", "1", "p/1", "0.25"), ("U", "2", "p/2", "0.50")]
    spark.sql("DROP DATABASE tm_cat CASCADE")


def test_contracts_are_derived_from_the_catalog(spark, tmp_dir):
    spark.sql("CREATE DATABASE tm_src")
    try:
        spark.sql(f"CREATE TABLE tm_src.toll_a (k BIGINT, v DECIMAL(6,2), lsn INT, at TIMESTAMP_NTZ) USING parquet "
                  f"TBLPROPERTIES ('{catalog.KEY}' = 'k', '{catalog.TIME}' = 'at', '{catalog.SEQUENCE}' = 'lsn')")
        spark.sql(f"CREATE TABLE tm_src.toll_b (a STRING, b STRING) USING parquet TBLPROPERTIES ('{catalog.KEY}' = 'a, b')")
        spark.sql("CREATE TABLE tm_src.other (a STRING) USING parquet")
        one, two = catalog.select_sources(spark, "tm_src.toll_%")
        assert (one.contract.columns, one.contract.ts_col, one.contract.seq_col, one.has_time) == (("k", "v", "at"), "at", "lsn", True)
        assert isinstance(one.contract.seq_type, T.IntegerType)
        assert (two.contract.columns, two.contract.key_cols, two.has_time) == (("a", "b", catalog.CAPTURE_COL), ("a", "b"), False)
        with pytest.raises(ValueError, match="no property"):
            catalog.select_sources(spark, "tm_src.%")
        spark.sql(f"CREATE TABLE tm_src.wrong (a STRING) USING parquet TBLPROPERTIES ('{catalog.KEY}' = 'b')")
        with pytest.raises(ValueError, match="unknown column"):
            catalog.derive_contract(spark, "tm_src.wrong")
    finally:
        spark.sql("DROP DATABASE tm_src CASCADE")


def test_replication_loads_once_then_applies(spark, tmp_dir):
    spark.sql("CREATE DATABASE tm_rep")
    try:
        for name in ("a_one", "a_two", "b"):
            rows(spark, 5).select("k", "v").write.saveAsTable(f"tm_rep.{name}")
            spark.sql(f"ALTER TABLE tm_rep.{name} SET TBLPROPERTIES ('{catalog.KEY}' = 'k')")
        first = replicate(spark, "tm_rep.a%", f"{tmp_dir}/land", f"{tmp_dir}/copy", "2024-01-01 00:00:00")
        assert [(r.source, r.loaded, r.version) for r in first] == [("tm_rep.a_one", True, 0), ("tm_rep.a_two", True, 0)]
        c = catalog.derive_contract(spark, "tm_rep.a_one").contract
        land = rows(spark, 2).select(F.lit("D").alias("op"), "k", "v", F.expr("TIMESTAMP_NTZ '2024-01-02 00:00:00'").alias(catalog.CAPTURE_COL))
        write_landing(land, f"{tmp_dir}/land/a_one", c)
        again = replicate(spark, "tm_rep.a%", f"{tmp_dir}/land", f"{tmp_dir}/copy")
        assert [(r.loaded, r.version) for r in again] == [(False, 1), (False, 0)]
        assert sorted(r["k"] for r in again[0].table.read(visible=True).collect()) == [2, 3, 4]
        assert not again[0].table._fs.exists(f"{tmp_dir}/copy/b")
    finally:
        spark.sql("DROP DATABASE tm_rep CASCADE")
