"""Session helpers: a local session for tests and the shared work folder.

Jobs cut lineage and write intermediate tables only under the folder the
cluster names in ``spark.checkpoint.dir``.  A private temporary folder is
created only when that setting is unset *and* the driver is the only process
(master ``local`` or ``local[...]``: tests); a cluster of any kind, one of
several processes on one machine included, must name the folder.
"""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "tidemark") -> SparkSession:
    """Local session used by tests and the bench: UI off, AQE on."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.ui.enabled", "false")
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", "8g")
        # checkpoints of materialised batches are removed once unreferenced
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def work_root(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    Read ``spark.checkpoint.dir`` from the session.  Only where it is unset
    and there is no executor process is a temporary folder created (and set).
    """
    sc = spark.sparkContext
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not re.fullmatch(r"local(\[.*\])?", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set: set it to a shared folder (HDFS, object store) "
                "that every executor and the driver can reach"
            )
        root = tempfile.mkdtemp(prefix="tidemark-")
        spark.conf.set("spark.checkpoint.dir", root)
    if sc.getCheckpointDir() is None:
        sc.setCheckpointDir(root)
    return root.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique folder under the shared work root."""
    return f"{work_root(spark)}/tidemark/{name}-{uuid.uuid4().hex[:12]}"


def materialize(df: DataFrame) -> DataFrame:
    """Compute ``df`` once and cut its lineage with a reliable checkpoint in
    the shared folder, so later reuse neither recomputes it nor depends on an
    executor that may be lost."""
    work_root(df.sparkSession)
    return df.checkpoint(eager=True)
