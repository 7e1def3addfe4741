"""Command-line upsert job: landing CSV -> latest change per key -> merge into
a versioned table.  One run processes every landing file not yet processed
(the stream checkpoint is the bookmark) and stops.

    python -m tidemark.job --landing s3://bucket/landing --table s3://bucket/current \\
        --mode strict [--contract toll | contract.json] [--full-load path/to/parquet]

The checkpoint and quarantine live under the table folder; the cluster's
``spark.checkpoint.dir`` is used for intermediate checkpoints.  With
``--catalog-table`` the changes are merged into a table of a catalog with
row-level operations instead, and ``--table`` is the folder of the checkpoint and
the quarantine only.
"""

from __future__ import annotations

import argparse
import datetime as dt
import json

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.contract import DELETED_COL, TOLL_CONTRACT, TOLL_SPECS, ChangeContract
from tidemark.operators.quality import conform as conform_rows
from tidemark.sources.landing import CORRUPT_COL, full_load as load_rows, read_landing
from tidemark.sources.table import VersionedTable
from tidemark.streaming.upsert import start_catalog_upsert, start_upsert

CONTRACTS = {"toll": (TOLL_CONTRACT, TOLL_SPECS)}


def load_contract(name_or_path: str):
    """A built-in contract by name, or one read from a JSON file."""
    if name_or_path in CONTRACTS:
        return CONTRACTS[name_or_path]
    with open(name_or_path, encoding="utf-8") as fh:
        c = ChangeContract.from_dict(json.load(fh))
    return c, c.specs


def run(spark: SparkSession, landing: str, table_path: str, mode: str = "strict",
        contract: str = "toll", full_load: str | None = None, conform: bool = False,
        keep_versions: int | None = None, cluster_buckets: int = 0, late_by: dt.timedelta | None = None,
        catalog_table: str | None = None) -> int | None:
    """Run the job once; returns the table's current version (none for a
    catalog table, which has its own)."""
    c, specs = load_contract(contract)
    if catalog_table:
        q = start_catalog_upsert(
            read_landing(spark, landing, c, streaming=True), catalog_table, c, f"{table_path}/_checkpoint",
            mode=mode, specs=specs if conform else None, quarantine_path=f"{table_path}/_quarantine")
        q.awaitTermination()
        if q.exception() is not None:
            raise RuntimeError(str(q.exception()))
        return None
    table = VersionedTable.for_contract(spark, table_path, c, cluster_buckets=cluster_buckets)
    if table.current_version() is None:
        if full_load:  # H2: the full load becomes version 0
            base = load_rows(spark.read.parquet(full_load), c).drop(c.op_col)
        else:  # an empty table with the contract's columns (typed when conforming)
            base = read_landing(spark, landing, c).where(F.lit(False)).drop(CORRUPT_COL)
            if conform and specs:
                base = conform_rows(base, specs)[0]
            base = base.select(*c.columns)
        if mode == "strict":
            base = base.withColumn(DELETED_COL, F.lit(False))
        table.write(base, version=0)
    q = start_upsert(
        read_landing(spark, landing, c, streaming=True), table, c,
        checkpoint=f"{table_path}/_checkpoint", mode=mode,
        specs=specs if conform else None, quarantine_path=f"{table_path}/_quarantine",
        keep_versions=keep_versions, conflicts_path=f"{table_path}/_conflicts", late_by=late_by)
    q.awaitTermination()
    if q.exception() is not None:
        raise RuntimeError(str(q.exception()))
    return table.current_version()


def main(argv: list[str] | None = None) -> None:
    ap = argparse.ArgumentParser(description=__doc__.split("\n\n")[0])
    ap.add_argument("--landing", required=True)
    ap.add_argument("--table", required=True)
    ap.add_argument("--mode", choices=("compat", "strict"), default="strict")
    ap.add_argument("--contract", default="toll",
                    help="built-in contract name (toll) or a JSON contract file")
    ap.add_argument("--full-load")
    ap.add_argument("--conform", action="store_true", help="convert text to the typed contract")
    ap.add_argument("--keep-versions", type=int,
                    help="delete all but the newest N versions after each batch (default: keep all)")
    ap.add_argument("--cluster-buckets", type=int, default=0,
                    help="store versions bucketed by the key (co-located merges)")
    ap.add_argument("--late-by-hours", type=float,
                    help="move the low-water mark this far behind the last change applied; older changes are "
                         "set aside, and compactions drop older tombstones (default: no mark)")
    ap.add_argument("--catalog-table", help="merge into this table of a catalog with row-level operations")
    a = ap.parse_args(argv)
    spark = SparkSession.builder.appName("tidemark-upsert").config("spark.ui.enabled", "false") \
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").getOrCreate()
    v = run(spark, a.landing, a.table, a.mode, a.contract, a.full_load, a.conform, a.keep_versions,
            a.cluster_buckets, None if a.late_by_hours is None else dt.timedelta(hours=a.late_by_hours), a.catalog_table)
    print(f"merged into {a.catalog_table}" if a.catalog_table else f"current version {v}")


if __name__ == "__main__":
    main()
