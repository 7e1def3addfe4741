"""Current-state table kept as immutable Parquet versions.

Layout::

    <path>/v=<n>-<writer>/<partition cols>=.../part-*.parquet   rows written for version n
    <path>/v=<n>-<writer>/_version.json    they are complete
    <path>/_versions/<n>.json    the version: its rows' folder, schema, stream progress

A version is never written in place: each change writes a folder of its own
from version ``n`` and then points ``n+1`` to it.  The pointer is put in place
last, and a version exists only once it is there: a write that dies earlier
leaves a folder that no reader sees.  A published version is never overwritten.
The pointer also carries, for every stream that writes the table, the last batch
it applied; every later version keeps that record, so a replayed batch is
recognised whatever was written since.  Files are listed through the Hadoop FileSystem of the path, so the same
code runs on a local disk, HDFS or an object store.

Several writers (Q12).  Each writes into a folder of its own, and only one can
create the pointer of ``n+1``: the other gets :class:`ConcurrentWriteError`, its
folder goes, and :meth:`VersionedTable.transact` builds its change again on the
winner's version.  Every statement here, and the stream, works that way, so a
version that a writer was told of is never lost.  On HDFS the pointer is created
by a rename that fails where the file is; on a local disk by a hard link; an
object store must offer a rename that does not overwrite.

A version may name another version's folder: :meth:`~VersionedTable.add_columns`
and :meth:`~VersionedTable.set_low_water` change the schema or the mark and
write no row.

End of tombstones.  Deletes of a strict table stay as tombstones so that late
changes do not bring rows back.  A version carries a low-water mark of change
time, below which changes are set aside instead of applied (the stream does
that, with the reason ``below_low_water``); :meth:`~VersionedTable.compact` then
drops the tombstones below it.

At very large scale the portable cost of this design is a full rewrite per
version; a table-format catalog with ``DataFrame.mergeInto`` is the path that
rewrites only touched files.  This module does not try to be a storage engine.
"""

from __future__ import annotations

import contextlib
import datetime as dt
import hashlib
import json
import re
import threading
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import CHANGE_SEQ_COL, DELETED_COL, HIDDEN_COLS, ChangeContract
from tidemark.functions.expr import bucket

# Fixed value: target data file size of the reference table (512 MiB).
TARGET_FILE_BYTES = 536870912
BUCKET_SUFFIX = "_bucket"
_VERSION_FILE = "_version.json"
_POINTER = re.compile(r".*/_versions/(\d+)\.json$")
_FOLDER = re.compile(r".*/(v=(\d+)-\w+)$")


def _live() -> Column:
    """A row that is no tombstone (an unset flag counts as live)."""
    return ~F.coalesce(F.col(DELETED_COL), F.lit(False))


#: Options in force, per session and name: (holders, value before the first).
_HELD: dict[tuple[int, str], list] = {}
_HELD_LOCK = threading.Lock()


@contextlib.contextmanager
def session_conf(spark: SparkSession, conf: dict[str, str]):
    """Set session options for the duration of one action, then restore.
    Writers in several threads of a session share its options: the last one to
    leave restores what was there before the first."""
    with _HELD_LOCK:
        for k, v in conf.items():
            held = _HELD.setdefault((id(spark), k), [0, spark.conf.get(k, None)])
            held[0] += 1
            spark.conf.set(k, v)
    try:
        yield
    finally:
        with _HELD_LOCK:
            for k in conf:
                held = _HELD[id(spark), k]
                held[0] -= 1
                if held[0]:
                    continue
                del _HELD[id(spark), k]
                if held[1] is None:
                    spark.conf.unset(k)
                else:
                    spark.conf.set(k, held[1])


class _FS:
    """Thin access to the Hadoop FileSystem of a path (list, read, write small files)."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.conf = spark.sparkContext._jsc.hadoopConfiguration()
        self.root = self.jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.root.getFileSystem(self.conf)

    def path(self, p: str):
        return self.jvm.org.apache.hadoop.fs.Path(p)

    def glob(self, pattern: str) -> list[str]:
        st = self.fs.globStatus(self.path(pattern))
        return [] if st is None else [s.getPath().toString() for s in st]

    def exists(self, p: str) -> bool:
        return self.fs.exists(self.path(p))

    def create_text(self, p: str, text: str) -> bool:
        """Create a file that must not be there yet; whether this call did.
        Written beside the final name first: a reader sees all or nothing."""
        tmp, final = self.path(f"{p}.{uuid.uuid4().hex}.tmp"), self.path(p)
        out = self.fs.create(tmp, False)
        try:
            out.write(bytearray(text.encode("utf-8")))
        finally:
            out.close()
        try:
            where = self.fs.resolvePath(tmp)  # behind a mount table
            if where.toUri().getScheme() in (None, "file"):
                files, paths = self.jvm.java.nio.file.Files, self.jvm.java.io.File
                target = self.jvm.org.apache.hadoop.fs.Path(where.getParent(), final.getName())
                try:  # a rename would overwrite here
                    files.createLink(paths(target.toUri().getPath()).toPath(), paths(where.toUri().getPath()).toPath())
                    return True
                except Exception:
                    if self.fs.exists(final):
                        return False
                    raise
            return not self.fs.exists(final) and self.fs.rename(tmp, final)
        finally:
            if self.fs.exists(tmp):
                self.fs.delete(tmp, False)

    def read_text(self, p: str) -> str:
        stream = self.fs.open(self.path(p))
        try:
            reader = self.jvm.java.io.BufferedReader(self.jvm.java.io.InputStreamReader(stream, "UTF-8"))
            lines = []
            line = reader.readLine()
            while line is not None:
                lines.append(line)
                line = reader.readLine()
            return "\n".join(lines)
        finally:
            stream.close()

    def delete(self, p: str) -> bool:
        return self.fs.delete(self.path(p), True)

    def count_files(self, p: str, suffix: str = ".parquet") -> int:
        it = self.fs.listFiles(self.path(p), True)
        n = 0
        while it.hasNext():
            if it.next().getPath().getName().endswith(suffix):
                n += 1
        return n


def delete_folder(spark: SparkSession, path: str) -> None:
    """Remove an intermediate table, whatever file system it is on."""
    _FS(spark, path).delete(path)


def folder_exists(spark: SparkSession, path: str) -> bool:
    return _FS(spark, path).exists(path)


class VersionExistsError(ValueError):
    """A published version would be overwritten, or hidden by a newer one."""


class ConcurrentWriteError(VersionExistsError):
    """Another writer published the next version first."""


class LiveKeyError(ValueError):
    """An insert would give a key of a strict table a second live row."""


# Columns stored beside a version's rows that say what the version's merge did
# to a row (null where nothing); no reader of the table sees them.
LOG_COLS = ("_change_op", "_change_time", "_change_action", "_change_conflict")


def mark_text(col: Column, dtype: T.DataType) -> Column:
    """A change time in the form a version's file keeps: text without a zone,
    or microseconds of an instant."""
    if isinstance(dtype, T.TimestampType):
        return F.unix_micros(col).cast("string")
    return col.cast("string")


def mark_value(text: str, dtype: T.DataType) -> Column:
    if isinstance(dtype, T.TimestampType):
        return F.timestamp_micros(F.lit(int(text)))
    return F.lit(text).cast(dtype)


def _mark_less(text: str, by: dt.timedelta) -> str:
    if text.lstrip("-").isdigit():
        return str(int(text) - by // dt.timedelta(microseconds=1))
    return str(dt.datetime.fromisoformat(text) - by)


def _mark_key(text: str):
    return int(text) if text.lstrip("-").isdigit() else dt.datetime.fromisoformat(text)


def literal_rows(spark: SparkSession, rows: list[tuple], c: ChangeContract) -> DataFrame:
    """Literal rows as a DataFrame of the contract's columns and types."""
    from tidemark.operators.quality import conform

    wrong = [r for r in rows if len(r) != len(c.columns)]
    if wrong:
        raise ValueError(f"a row has {len(wrong[0])} values, the contract {len(c.columns)} columns: {wrong[0]!r}")
    text = spark.createDataFrame([tuple(None if v is None else str(v) for v in r) for r in rows],
                                 T.StructType([T.StructField(x, T.StringType()) for x in c.columns]))
    good, bad = conform(text, c.specs)
    first = bad.first()
    if first is not None:
        raise ValueError(f"a row does not fit the contract: {', '.join(first['reasons'])}: {first.asDict()}")
    return good


class VersionedTable:
    """A partitioned Parquet table written as whole versions.

    ``partition_cols`` are identity partitions; ``bucket_col`` adds a
    ``<col>_bucket`` partition of ``pmod(hash(col), num_buckets)`` (A6, G3).

    ``cluster_keys`` + ``cluster_buckets`` store each version as a Spark
    bucketed table on the merge key (an external catalog table over the
    version folder).  A merge whose target is read from such a version joins
    without shuffling the target -- only the batch is hash-partitioned into
    the same buckets -- and the merged rows are written back bucket by bucket
    without a shuffle either.  Choose ``cluster_buckets`` of about the table
    size / 512 MiB and at least ``spark.sql.shuffle.partitions``.

    ``key_cols`` and ``ts_col`` are what the row-level statements need on a
    strict table (one with ``is_deleted``): a delete leaves a tombstone with a
    change time, and an insert takes the place of its key's tombstone.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        partition_cols: tuple[str, ...] = (),
        bucket_col: str | None = None,
        num_buckets: int = 16,
        file_bytes: int = TARGET_FILE_BYTES,
        cluster_keys: tuple[str, ...] = (),
        cluster_buckets: int = 0,
        key_cols: tuple[str, ...] = (),
        ts_col: str | None = None,
    ):
        if bool(cluster_keys) != bool(cluster_buckets):
            raise ValueError("cluster_keys and cluster_buckets go together")
        self.spark = spark
        self.path = path.rstrip("/")
        self.partition_cols = tuple(partition_cols)
        self.bucket_col = bucket_col
        self.num_buckets = num_buckets
        self.file_bytes = file_bytes
        self.cluster_keys = tuple(cluster_keys)
        self.cluster_buckets = cluster_buckets
        self.key_cols = tuple(key_cols)
        self.ts_col = ts_col
        self._fs = _FS(spark, self.path)

    @classmethod
    def for_contract(cls, spark: SparkSession, path: str, c: ChangeContract, **kw) -> "VersionedTable":
        """The contract's layout; ``cluster_buckets=N`` clusters by the key."""
        if kw.get("cluster_buckets") and not kw.get("cluster_keys"):
            kw["cluster_keys"] = c.key_cols
        kw = {"key_cols": c.key_cols, "ts_col": c.ts_col, **kw}
        return cls(spark, path, c.partition_cols, c.bucket_col, c.num_buckets, **kw)

    # ------------------------------------------------------------ versions
    def _pointer(self, n: int) -> str:
        return f"{self.path}/_versions/{n}.json"

    def version_path(self, n: int) -> str:
        """The folder that holds the rows of a published version."""
        return f"{self.path}/{self._meta(n)['data']}"

    def _whole(self, n: int) -> bool:
        return self._fs.exists(f"{self.version_path(n)}/{_VERSION_FILE}")

    def _pointers(self) -> list[int]:
        found = (_POINTER.match(p) for p in self._fs.glob(f"{self.path}/_versions/*.json"))
        return sorted(int(m.group(1)) for m in found if m)

    def versions(self) -> list[int]:
        return [n for n in self._pointers() if self._whole(n)]

    def current_version(self) -> int | None:
        return next((n for n in reversed(self._pointers()) if self._whole(n)), None)

    def _meta(self, version: int) -> dict:
        return json.loads(self._fs.read_text(self._pointer(version)))

    def applied_batch(self, stream_id: str) -> int | None:
        """The last batch of a stream that the current version holds."""
        v = self.current_version()
        return None if v is None else self._meta(v)["streams"].get(stream_id)

    def files(self, version: int | None = None) -> int:
        """Number of data files in a version (for compaction reports)."""
        v = self.current_version() if version is None else version
        return self._fs.count_files(self.version_path(v))

    def transact(self, change: Callable[[int | None], int], attempts: int = 50) -> int:
        """Run ``change(base)``, which writes the version after ``base`` (with
        ``write(..., base=base)``), on the current version; if another writer
        publishes first, run it again on the version that one wrote."""
        for left in reversed(range(attempts)):
            base = self.current_version()
            try:
                return change(base)
            except ConcurrentWriteError:
                if not left:
                    raise
            except Exception:  # the rows it read were dropped after newer versions came
                if not left or base is None or base in self.versions():
                    raise

    @property
    def bucket_name(self) -> str | None:
        return f"{self.bucket_col}{BUCKET_SUFFIX}" if self.bucket_col else None

    @property
    def clustered(self) -> bool:
        return self.cluster_buckets > 0

    def catalog_name(self, n: int) -> str:
        """Catalog table of version ``n`` of a clustered table."""
        return self._catalog_name(n, self._meta(n)["data"])

    def _catalog_name(self, n: int, folder: str) -> str:
        # a version of another writer, or of a wider schema, has its own
        tag = hashlib.sha1(f"{self.path}/{folder}".encode()).hexdigest()[:12]
        return f"tidemark_{tag}_v{n}"

    def _parts(self) -> list[str]:
        return [*self.partition_cols, *([self.bucket_name] if self.bucket_col else [])]

    def _register_version(self, n: int, schema: T.StructType) -> str:
        """(Re)create the bucketed catalog table of a version from its saved
        schema, e.g. in a new session with an in-memory catalog."""
        name = self.catalog_name(n)
        if self.spark.catalog.tableExists(name):
            return name
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        parts = self._parts()
        ddl = f"CREATE TABLE {name} ({cols}) USING parquet"
        if parts:
            ddl += " PARTITIONED BY (" + ", ".join(f"`{x}`" for x in parts) + ")"
        keys = ", ".join(f"`{k}`" for k in self.cluster_keys)
        ddl += f" CLUSTERED BY ({keys}) SORTED BY ({keys}) INTO {self.cluster_buckets} BUCKETS"
        ddl += f" LOCATION '{self.version_path(n)}'"
        self.spark.sql(ddl)
        if parts:
            self.spark.sql(f"MSCK REPAIR TABLE {name}")
        return name

    # ----------------------------------------------------------- read/write
    def read(self, version: int | None = None, visible: bool = False) -> DataFrame:
        """A5: the rows of a version (the current one by default).  The layout
        bucket column is dropped; ``visible`` hides strict-mode tombstones."""
        v = self.current_version() if version is None else version
        if v is None:
            raise FileNotFoundError(f"no published version under {self.path}")
        schema = T.StructType.fromJson(self._meta(v)["schema"])
        if self.clustered:
            df = self.spark.table(self._register_version(v, schema))
        else:
            df = self.spark.read.schema(schema).parquet(self.version_path(v))
        if self.bucket_name and self.bucket_name in df.columns:
            df = df.drop(self.bucket_name)
        cols = [f.name for f in schema.fields if f.name != self.bucket_name]
        df = df.select(*[F.col(f"`{x}`") for x in cols])
        if visible and DELETED_COL in df.columns:
            df = df.where(_live())
        if visible:
            df = df.drop(*HIDDEN_COLS)
        return df

    def write(self, df: DataFrame, version: int | None = None, rebalance: bool = True,
              clustered_input: bool = False, batch: tuple[str, int] | None = None,
              base: int | None = None, meta: dict | None = None) -> int:
        """Write ``df`` as version ``n`` (next by default) and return ``n``.

        ``n`` must be above every published version.  ``base`` is the version
        that ``df`` was made from: then ``n`` is the one after it, and
        :class:`ConcurrentWriteError` says that another writer published that
        one meanwhile (see :meth:`transact`).  ``batch`` is the ``(stream id,
        batch id)`` this version applies, if a stream writes it; ``meta`` holds
        further entries for the version's file.

        The rows are rebalanced on the partition columns so each partition
        folder gets files near the target size; AQE splits a hot partition
        over several tasks instead of sending it to one (A6, A7).

        For a clustered table, ``clustered_input`` says ``df`` already comes
        bucket by bucket (a merge whose target was read from this table):
        it is written without a shuffle.  Otherwise it is hash-partitioned
        into the buckets first.  Either way the data is correct; the flag only
        decides the number of files.
        """
        n, before = self._next(version, base)
        folder = self.new_folder(n)
        schema = self.write_rows(df, n, folder, rebalance=rebalance, clustered_input=clustered_input)
        return self.publish(n, before, folder, schema, batch, meta)

    def _next(self, version: int | None, base: int | None) -> tuple[int, int | None]:
        """(version to write, the one before it)."""
        cur = self.current_version()
        if base is not None:
            if cur != base:
                raise ConcurrentWriteError(f"version {cur} of {self.path} is newer than {base}")
            return base + 1, base
        if version is None:
            return (0 if cur is None else cur + 1), cur
        if cur is not None and version <= cur:
            raise VersionExistsError(f"version {version} is not above the current version {cur} of {self.path}")
        return version, cur

    def new_folder(self, n: int) -> str:
        """A folder (under the table's) of one writer of version ``n``."""
        return f"v={n}-{uuid.uuid4().hex[:16]}"

    def write_rows(self, df: DataFrame, n: int, folder: str, rebalance: bool = True,
                   clustered_input: bool = False, append: bool = False) -> T.StructType:
        """Write rows into a writer's folder; returns the schema of the table
        (columns of :data:`LOG_COLS` are stored, but are no part of it)."""
        out, path = df, f"{self.path}/{folder}"
        if self.bucket_col:
            out = out.withColumn(self.bucket_name, bucket(self.bucket_col, self.num_buckets))
        parts = self._parts()
        if self.clustered:
            if not clustered_input:
                out = out.repartition(self.cluster_buckets, *[F.col(f"`{k}`") for k in self.cluster_keys])
        elif rebalance:
            out = out.hint("rebalance", *parts) if parts else out.hint("rebalance")
        # Data columns first, partition columns last: the order a partitioned read returns.
        ordered = [c for c in out.columns if c not in parts] + parts
        out = out.select(*[F.col(f"`{x}`") for x in ordered])
        conf = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": str(self.file_bytes)}
        if parts:
            # Every partition folder goes to exactly one task (skewed ones are
            # split), so more tasks do not mean more files: let AQE keep the
            # default parallelism for small data instead of coalescing it into
            # one task that writes every folder in turn.  At scale the advisory
            # size still sets the task size.
            conf["spark.sql.adaptive.coalescePartitions.minPartitionSize"] = "1"
        if self.clustered:
            # keep the target's bucketed scan (one task per bucket) even where
            # no join asks for it, so merged rows stay bucket-aligned
            conf["spark.sql.sources.bucketing.autoBucketedScan.enabled"] = "false"
        with session_conf(self.spark, conf):
            w = out.write.mode("append" if append else "errorifexists")
            if parts:
                w = w.partitionBy(*parts)
            if self.clustered:
                name = self._catalog_name(n, folder)
                keys = list(self.cluster_keys)
                w.bucketBy(self.cluster_buckets, keys[0], *keys[1:]).sortBy(keys[0], *keys[1:]) \
                    .option("path", path).saveAsTable(name, format="parquet")
            else:
                w.parquet(path)
        return T.StructType([f for f in out.schema.fields if f.name not in LOG_COLS])

    def publish(self, n: int, before: int | None, folder: str, schema: T.StructType,
                batch: tuple[str, int] | None = None, meta: dict | None = None) -> int:
        """Create the pointer of version ``n``; only one writer can."""
        kept = {} if before is None else self._meta(before)
        streams = kept.get("streams", {})
        if batch is not None:
            streams = {**streams, batch[0]: batch[1]}
        text = {"schema": schema.jsonValue(), "streams": streams, "data": folder, "low_water": kept.get("low_water"),
                "applied": kept.get("applied", {}), **(meta or {})}
        own = before is None or folder != kept["data"]
        if own:
            self._fs.create_text(f"{self.path}/{folder}/{_VERSION_FILE}", json.dumps({"version": n}))
        while not self._fs.create_text(self._pointer(n), json.dumps(text)):
            if self._whole(n):
                if own:
                    self.discard(n, folder)
                raise ConcurrentWriteError(f"version {n} of {self.path} was published by another writer")
            self._fs.delete(self._pointer(n))  # its rows are gone: it is no version
        return n

    def discard(self, n: int, folder: str) -> None:
        """Remove a folder that will not be published."""
        if self.clustered:
            self.spark.sql(f"DROP TABLE IF EXISTS {self._catalog_name(n, folder)}")  # external: files stay
        self._fs.delete(f"{self.path}/{folder}")

    def vacuum(self, keep: int = 2) -> list[int]:
        """Delete all but the newest ``keep`` published versions (and any
        unpublished folder older than them); rows that a kept version still
        names stay.  Returns the deleted versions.  Nothing calls this unless a
        caller asks for it."""
        if keep < 1:
            raise ValueError("keep at least one version")
        published = self.versions()
        if len(published) <= keep:
            return []
        oldest_kept = published[-keep]
        # a version of a wider schema or a newer mark has the rows of an older one
        needed = {self._meta(n)["data"] for n in published[-keep:]}
        gone = [n for n in published if n < oldest_kept]
        for n in gone:
            if self.clustered:
                self.spark.sql(f"DROP TABLE IF EXISTS {self.catalog_name(n)}")
            self._fs.delete(self._pointer(n))
        for p in self._fs.glob(f"{self.path}/v=*"):
            m = _FOLDER.match(p)
            if m and int(m.group(2)) < oldest_kept and m.group(1) not in needed:
                self._fs.delete(p)
        return gone

    # ---------------------------------------------------------------- views
    def view(self, name: str, version: int | None = None, visible: bool = True) -> str:
        """Register the (visible) current version as a temp view."""
        self.read(version, visible=visible).createOrReplaceTempView(name)
        return name

    def register(self, table_name: str, version: int | None = None) -> str:
        """Point a catalog table at a version."""
        v = self.current_version() if version is None else version
        loc = self.version_path(v)
        schema = T.StructType.fromJson(self._meta(v)["schema"])
        if "." in table_name:
            self.spark.sql(f"CREATE DATABASE IF NOT EXISTS {table_name.split('.')[0]}")
        # An external table: dropping it never touches the version's files.
        # Re-creating it (rather than moving its location) also replaces the
        # partition list, which a location change would keep pointing at the
        # old version.
        self.spark.sql(f"DROP TABLE IF EXISTS {table_name}")
        parts = self._parts()
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        split = f" PARTITIONED BY ({', '.join(f'`{x}`' for x in parts)})" if parts else ""
        self.spark.sql(f"CREATE TABLE {table_name} ({cols}) USING parquet{split} LOCATION '{loc}'")
        if parts:
            self.spark.sql(f"MSCK REPAIR TABLE {table_name}")
        return table_name

    # ----------------------------------------------- row-level DML
    def insert(self, rows: DataFrame) -> int:
        """Append rows as the next version (columns matched by name).

        On a strict table the rows are live unless they say otherwise, and a
        row takes the place of its key's tombstone; a key that is live (or
        comes twice) is refused, and without ``key_cols`` the keys cannot be
        told, which is refused too."""
        return self.transact(lambda base: self._insert(rows, base))

    def insert_values(self, rows: list[tuple], c: ChangeContract) -> int:
        """``INSERT INTO t VALUES ...`` of literal rows, given in the order
        of the contract's columns.  Each is checked against the contract (its
        types, lengths, value sets and not-null columns); one bad row refuses
        the statement."""
        return self.insert(literal_rows(self.spark, rows, c))

    def _insert(self, rows: DataFrame, base: int | None) -> int:
        cur = self.read(base)
        if DELETED_COL in cur.columns:
            if not self.key_cols:
                raise ValueError("insert into a strict table needs the table's key_cols")
            flag = F.col(DELETED_COL) if DELETED_COL in rows.columns else F.lit(None).cast("boolean")
            rows = rows.withColumn(DELETED_COL, F.coalesce(flag, F.lit(False)))
            keys = [F.col(f"`{k}`") for k in self.key_cols]
            twice = rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1")
            known = cur.where(_live()).select(*keys).join(rows.select(*keys), list(self.key_cols), "left_semi")
            if not twice.isEmpty() or not known.isEmpty():
                raise LiveKeyError("INSERT of a key that is live already, or comes twice; use merge to change it")
            dead = cur.where(~_live()).join(rows.select(*keys), list(self.key_cols), "left_anti")
            cur = cur.where(_live()).unionByName(dead)
        if self.clustered:
            cur = cur if DELETED_COL not in cur.columns else self._by_key(cur)
            rows = self._by_key(rows)
        return self.write(cur.unionByName(rows, allowMissingColumns=True), clustered_input=True, base=base)

    def _by_key(self, df: DataFrame) -> DataFrame:
        return df.repartition(self.cluster_buckets, *[F.col(f"`{k}`") for k in self.cluster_keys])

    def update(self, where: Column | str, assignments: dict[str, Column | str],
               at: Column | str | None = None) -> int:
        """``UPDATE t SET col = expr WHERE cond`` as a conditional projection.
        Tombstones of a strict table are no rows of it and stay as they are.

        ``at`` is the time of the update on a strict table: the rows take it as
        their change time (never one before their own), so that an older change
        arriving later does not undo the update.  Without it they keep theirs."""
        return self.transact(lambda base: self._update(where, assignments, at, base))

    def _update(self, where, assignments, at, base: int | None) -> int:
        cond = F.expr(where) if isinstance(where, str) else where
        cond = F.coalesce(cond, F.lit(False))
        cur = self.read(base)
        unknown = [x for x in assignments if x not in cur.columns]
        if unknown:
            raise ValueError(f"UPDATE sets unknown columns {unknown}")
        if DELETED_COL in cur.columns:
            cond = cond & _live()
        new = {x: F.expr(v) if isinstance(v, str) else v for x, v in assignments.items()}
        if at is not None:
            new |= self._stamped(cur, at, new)
        cols = []
        for name in cur.columns:
            if name in new:
                cols.append(F.when(cond, new[name]).otherwise(F.col(f"`{name}`")).cast(cur.schema[name].dataType).alias(name))
            else:
                cols.append(F.col(f"`{name}`"))
        return self.write(cur.select(*cols), clustered_input=not set(new) & set(self.cluster_keys), base=base)

    def _stamped(self, cur: DataFrame, at: Column | str | None, taken=()) -> dict[str, Column]:
        """The change time ``at`` (now by default; never before the row's own)
        and, where the row keeps the sequence of its change, what is left of it."""
        if not self.ts_col or DELETED_COL not in cur.columns:
            raise ValueError("a statement's time needs a strict table and the table's ts_col")
        if self.ts_col in taken:
            raise ValueError(f"both at and an assignment set {self.ts_col}")
        own = F.col(f"`{self.ts_col}`")
        when = F.current_timestamp() if at is None else F.lit(at) if isinstance(at, str) else at
        when = F.greatest(own, when.cast(cur.schema[self.ts_col].dataType))
        out = {self.ts_col: when}
        if CHANGE_SEQ_COL in cur.columns:  # the kept sequence belongs to the row's own time
            out[CHANGE_SEQ_COL] = F.when(when == own, F.col(CHANGE_SEQ_COL))
        return out

    def delete(self, where: Column | str, at: Column | str | None = None) -> int:
        """``DELETE FROM t WHERE cond``: rows where the condition is true go;
        a null condition keeps the row, as in SQL.

        On a strict table they become tombstones at the time ``at`` (now by
        default; never before the row's own time), so that an older change
        arriving later does not bring them back."""
        return self.transact(lambda base: self._delete(where, at, base))

    def _delete(self, where, at, base: int | None) -> int:
        cond = F.expr(where) if isinstance(where, str) else where
        cond = F.coalesce(cond, F.lit(False))
        cur = self.read(base)
        if DELETED_COL not in cur.columns:
            return self.write(cur.where(~cond), clustered_input=True, base=base)
        if not self.ts_col:
            raise ValueError("delete from a strict table needs the table's ts_col")
        hit = cond & _live()
        new = {DELETED_COL: F.lit(True), **self._stamped(cur, at)}
        return self.write(cur.select(*[
            F.when(hit, new[x]).otherwise(F.col(f"`{x}`")).alias(x) if x in new else F.col(f"`{x}`")
            for x in cur.columns]), clustered_input=True, base=base)

    # ------------------------------------------------ maintenance
    def add_columns(self, columns: dict[str, T.DataType | str]) -> int:
        """Schema evolution: the next version has new columns, null in every
        row so far.  It names the rows of the version before it; no data file
        is written."""
        def change(base: int | None) -> int:
            meta = self._meta(base)
            schema, parts = T.StructType.fromJson(meta["schema"]), self._parts()
            known = {f.name.lower() for f in schema.fields}
            taken = [x for x in columns if x.lower() in known | {y.lower() for y in LOG_COLS}]
            if taken:
                raise ValueError(f"the table has columns {taken}")
            new = [T.StructField(x, T.DataType.fromDDL(d) if isinstance(d, str) else d) for x, d in columns.items()]
            own = [f for f in schema.fields if f.name not in parts]
            wide = T.StructType([*own, *new, *[f for f in schema.fields if f.name in parts]])
            return self.publish(base + 1, base, meta["data"], wide)

        return self.transact(change)

    def low_water(self) -> str | None:
        """The mark below which changes are no longer applied."""
        v = self.current_version()
        return None if v is None else self._meta(v).get("low_water")

    def set_low_water(self, mark: str | None = None, lateness: dt.timedelta | None = None) -> int:
        """Raise the low-water mark, to ``mark`` or to ``lateness`` before the
        last change time that every stream has applied.  A mark never falls.
        Writes no data file; :meth:`compact` then drops what lies below it."""
        def change(base: int | None) -> int:
            meta = self._meta(base)
            new = mark if mark is not None else self.lagging(meta["applied"], lateness)
            if new is None:
                raise ValueError("no stream has applied a change yet: give the mark itself")
            new = self.higher(meta.get("low_water"), new)
            return self.publish(base + 1, base, meta["data"], T.StructType.fromJson(meta["schema"]), meta={"low_water": new})

        return self.transact(change)

    @staticmethod
    def lagging(applied: dict[str, str], lateness: dt.timedelta | None) -> str | None:
        """``lateness`` before the slowest stream's last change time."""
        if not applied:
            return None
        return _mark_less(min(applied.values(), key=_mark_key), lateness or dt.timedelta(0))

    @staticmethod
    def higher(a: str | None, b: str | None) -> str | None:
        marks = [x for x in (a, b) if x is not None]
        return max(marks, key=_mark_key) if marks else None

    def split_late(self, changes: DataFrame, ts_col: str, version: int | None = None) -> tuple[DataFrame, DataFrame | None]:
        """``(rows, late)``: changes at or above the low-water mark, and those
        below it, which must not be applied: the tombstone that would stop one
        may be gone."""
        v = self.current_version() if version is None else version
        mark = None if v is None else self._meta(v).get("low_water")
        if mark is None:
            return changes, None
        old = F.col(f"`{ts_col}`") < mark_value(mark, changes.schema[ts_col].dataType)
        old = F.coalesce(old, F.lit(False))
        return changes.where(~old), changes.where(old)

    def compact(self) -> tuple[int, int, int]:
        """Rewrite the current version into files near the target size; on a
        strict table, tombstones below the low-water mark go.  Rows are
        otherwise unchanged.  Returns ``(version, files_before, files_after)``."""
        found = {}

        def change(base: int | None) -> int:
            found["before"] = self.files(base)
            rows = self.read(base)
            mark = self._meta(base).get("low_water")
            if mark is not None and DELETED_COL in rows.columns and self.ts_col:
                late = F.col(f"`{self.ts_col}`") < mark_value(mark, rows.schema[self.ts_col].dataType)
                rows = rows.where(_live() | ~F.coalesce(late, F.lit(False)))
            return self.write(rows, base=base)

        v = self.transact(change)
        return v, found["before"], self.files(v)

    def file_report(self, version: int | None = None) -> DataFrame:
        """Per partition folder of a version: rows, files, bytes and the
        largest file, as the stored files tell it (``_metadata``)."""
        v = self.current_version() if version is None else version
        folder = self.version_path(v)
        schema = T.StructType.fromJson(self._meta(v)["schema"])
        parts = self._parts()
        rows = self.spark.read.schema(schema).parquet(folder).select(
            *[F.col(f"`{x}`") for x in parts], F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
        files = rows.groupBy(*[F.col(f"`{x}`") for x in parts], "_path").agg(
            F.max("_size").alias("_size"), F.count(F.lit(1)).alias("_rows"))
        return files.groupBy(*[F.col(f"`{x}`") for x in parts]).agg(
            F.sum("_rows").alias("n_rows"), F.count(F.lit(1)).alias("n_files"),
            F.sum("_size").alias("n_bytes"), F.max("_size").alias("largest_file"))

    def compaction_report(self, before: int, after: int) -> DataFrame:
        """Per partition folder: rows and files of two versions, and the
        number of files that the target size allows (one more than the bytes
        fill, for the last file of a task)."""
        parts = self._parts()
        old, new = (self.file_report(v).select(*[F.col(f"`{x}`") for x in parts],
                                               *[F.col(x).alias(f"{x}_{tag}") for x in ("n_rows", "n_files", "n_bytes")])
                    for v, tag in ((before, "before"), (after, "after")))
        same = F.lit(True)
        for x in parts:
            same = same & old[x].eqNullSafe(new[x])
        allowed = F.ceil(F.col("n_bytes_after") / F.lit(self.file_bytes)) + 1
        names = [F.coalesce(old[x], new[x]).alias(x) for x in parts]
        return old.join(new, same, "full_outer").select(
            *names, "n_rows_before", "n_rows_after", "n_files_before", "n_files_after", allowed.alias("n_files_allowed"))

    # ------------------------------------------------------- change log
    def change_log(self, version: int | None = None) -> DataFrame:
        """What the merge that wrote a version did: key columns, the change's
        time and op, action and conflict, for every row it touched.  Read from
        the version's own files; rows it left alone are not read back."""
        v = self.current_version() if version is None else version
        meta = self._meta(v)
        if "log" not in meta:
            raise ValueError(f"version {v} of {self.path} was not written by a merge with a log")
        return self.folder_log(meta["data"], T.StructType.fromJson(meta["log"]))

    def folder_log(self, folder: str, schema: T.StructType) -> DataFrame:
        rows = self.spark.read.schema(schema).parquet(f"{self.path}/{folder}")
        return rows.where(F.col(LOG_COLS[2]).isNotNull()).select(*[F.col(f"`{f.name}`") for f in schema.fields])
