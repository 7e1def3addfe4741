"""One replication job per selected source table (A3, A4, H2).

    python -m tidemark.replicate --tables sales.% --landing s3://.../landing --target s3://.../current

A run goes over the catalog's tables that match the pattern.  A table seen for
the first time is loaded in full (version 0 of its copy, stamped with the time
of the load where it has no change time); then, and in every later run, the
change rows that landed for it (``<landing>/<table>``) are applied.  Tables that
the pattern does not select, and tables without a key, are never touched.
"""

from __future__ import annotations

import argparse
from dataclasses import dataclass

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.contract import DELETED_COL
from tidemark.sources.catalog import Source, quoted, select_sources
from tidemark.sources.landing import full_load, read_landing
from tidemark.sources.table import VersionedTable, folder_exists
from tidemark.streaming.upsert import start_upsert


@dataclass(frozen=True)
class Replica:
    source: str
    table: VersionedTable
    loaded: bool   # by this run
    version: int


def replica_table(spark: SparkSession, target: str, s: Source) -> VersionedTable:
    return VersionedTable.for_contract(spark, f"{target.rstrip('/')}/{s.name.rsplit('.', 1)[-1]}", s.contract)


def replicate_one(spark: SparkSession, s: Source, landing: str, target: str, capture_literal: str | None = None) -> Replica:
    table = replica_table(spark, target, s)
    first = table.current_version() is None
    if first:
        rows = full_load(spark.table(quoted(s.name)), s.contract, capture_literal).drop(s.contract.op_col)
        table.write(rows.withColumn(DELETED_COL, F.lit(False)))
    folder = f"{landing.rstrip('/')}/{s.name.rsplit('.', 1)[-1]}"
    if folder_exists(spark, folder):  # nothing has landed for it yet otherwise
        q = start_upsert(read_landing(spark, folder, s.contract, streaming=True), table, s.contract,
                         checkpoint=f"{table.path}/_checkpoint", specs=s.contract.specs,
                         quarantine_path=f"{table.path}/_quarantine", conflicts_path=f"{table.path}/_conflicts")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(f"{s.name}: {q.exception()}")
    return Replica(s.name, table, first, table.current_version())


def replicate(spark: SparkSession, pattern: str, landing: str, target: str, capture_literal: str | None = None) -> list[Replica]:
    """A run over every table that ``pattern`` (``database.%``) selects."""
    return [replicate_one(spark, s, landing, target, capture_literal) for s in select_sources(spark, pattern)]


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--tables", required=True, help="database and pattern, e.g. sales.%%")
    ap.add_argument("--landing", required=True)
    ap.add_argument("--target", required=True)
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark-replicate").config("spark.ui.enabled", "false").getOrCreate()
    for r in replicate(spark, a.tables, a.landing, a.target):
        print(f"{r.source}: version {r.version}{' (loaded)' if r.loaded else ''}")


if __name__ == "__main__":
    main()
