"""tidemark: change-data upserts on Spark.

Change rows (insert / update / delete) are reduced to the latest change per key
and merged into a current-state table.  Every operator is a function from
DataFrame to DataFrame parameterised by a :class:`~tidemark.contract.ChangeContract`;
Catalyst plans the work, nothing is collected to the driver.
"""

from tidemark.contract import OPS, TOLL_CONTRACT, ChangeContract, ColumnSpec
from tidemark.operators.apply import apply_changes
from tidemark.operators.diff import DuplicateKeyError, reconcile, reconcile_summary, snapshot_diff
from tidemark.operators.digest_tree import DigestTree, reconcile_by_digest, reconcile_summary_by_digest, snapshot_diff_by_digest
from tidemark.operators.latest import latest_one, latest_with_ties, split_valid
from tidemark.operators.merge import (
    MergeCardinalityError,
    MergeResult,
    fold,
    merge,
    merge_into_catalog,
    visible,
)
from tidemark.operators.quality import conform
from tidemark.sources.landing import full_load, read_landing, split_corrupt, write_landing
from tidemark.replicate import replicate
from tidemark.sources.table import ConcurrentWriteError, VersionedTable
from tidemark.streaming.upsert import start_catalog_upsert, start_upsert

__all__ = [
    "OPS",
    "TOLL_CONTRACT",
    "ChangeContract",
    "ColumnSpec",
    "ConcurrentWriteError",
    "DigestTree",
    "DuplicateKeyError",
    "MergeCardinalityError",
    "MergeResult",
    "VersionedTable",
    "apply_changes",
    "conform",
    "fold",
    "full_load",
    "latest_one",
    "latest_with_ties",
    "merge",
    "merge_into_catalog",
    "read_landing",
    "reconcile",
    "reconcile_by_digest",
    "reconcile_summary",
    "reconcile_summary_by_digest",
    "replicate",
    "snapshot_diff",
    "snapshot_diff_by_digest",
    "split_corrupt",
    "split_valid",
    "start_catalog_upsert",
    "start_upsert",
    "visible",
    "write_landing",
]
