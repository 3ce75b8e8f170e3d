"""Files on the shared file system: listing, sizes, and versioned target tables.

A version is a folder of ordinary Parquet files and counts as committed once
Spark's own ``_SUCCESS`` marker is there, so a run that dies leaves the table as
it was. Nothing overwrites files that a plan still reads.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence
from hashlib import md5

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE = "_slice"
SLICES = 1024
# The layout of a version that holds accepted rows and those set aside, told apart by their folder.
TAGGED, SET_ASIDE = "t", "_set_aside"
# A version's folder: its number, its layout, and the mark of the write that made it, if it bears one.
_VERSION = re.compile(r"v_(\d{8})(?:-[\w-]+)?(?:\.\w+)?$")


class SharedFiles:
    """The few file-system calls Spark's readers and writers do not cover."""

    def __init__(self, spark: SparkSession, root: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def names(self, path: str) -> list[str]:
        """Names directly under a folder; none if it does not exist."""
        if not self.exists(path):
            return []
        return sorted(s.getPath().getName() for s in self._fs.listStatus(self._path(path)))

    def total_bytes(self, path: str) -> int:
        return self._fs.getContentSummary(self._path(path)).getLength()

    def touch(self, path: str) -> None:
        """An empty file."""
        self._fs.create(self._path(path), True).close()

    def remove(self, path: str) -> None:
        self._fs.delete(self._path(path), True)


class VersionedTable:
    """A target table kept as numbered versions.

    ``slice_by`` is a SQL expression over immutable key columns (a range of ids, a
    month); its values, NULL among them, are dealt to ``slices`` numbered slices by a
    hash. Each version then holds only the slices it rewrote, whole, and the current
    table is the newest copy of every slice: a delta merge reads and writes the slices
    its keys fall into and leaves the rest of the table alone. More slices make a
    smaller rewrite; their number is part of the layout and bounds what is listed.

    ``bucket_by`` (key columns and a number of buckets) is for tables merged with
    whole snapshots: the files keep the layout a join on the keys needs, so each
    merge shuffles the snapshot only and never the table. What is written after the
    first version should come from such a join.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType,
        slice_by: str | None = None,
        bucket_by: tuple[Sequence[str], int] | None = None,
        slices: int = SLICES,
    ):
        if slice_by and bucket_by:
            raise ValueError("a table is either sliced or bucketed")
        if slices < 1:
            raise ValueError("a table has one slice at least")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), all_nullable(schema)
        self.slice_by, self.bucket_by, self.slices = slice_by, bucket_by, slices
        self.files = SharedFiles(spark, self.path)

    @property
    def layout(self) -> str:
        """How this object arranges files; part of a version's folder name.

        Files must be read the way they were written: a wrong number of buckets or
        another slice expression would silently lose rows in joins.
        """
        if self.bucket_by:
            keys, count = self.bucket_by
            return f"b{count}-{_digest(','.join(keys))}"
        return f"s{self.slices}-{_digest(self.slice_by)}" if self.slice_by else ""

    def versions(self) -> list[int]:
        return [v for v, _ in self._committed()]

    def folder(self, version: int) -> str:
        return next(f for v, f in self._committed() if v == version)

    def read(self, slices: Sequence[str] | None = None) -> DataFrame:
        """The current rows; of the given slices only, if any are named.

        A version in another layout is read as it is; the next whole write then
        brings the table into this one.
        """
        committed = self._committed()
        if not committed:
            return self._empty()
        version, newest = committed[-1]
        layout = _layout(newest)
        if self.bucket_by and layout == self.layout:
            return self._read_bucketed(version, newest)
        if layout == TAGGED:
            return self._tagged(newest, self.schema, 0)
        if not layout.startswith("s"):
            return self.spark.read.schema(self.schema).parquet(newest)
        current = self._current_slices(committed)
        wanted = current if slices is None else {s: current[s] for s in slices if s in current}
        if not wanted:
            return self._empty()
        return self.spark.read.schema(self.schema).parquet(*wanted.values())

    def slices_of(self, df: DataFrame) -> list[str] | None:
        """The slices the rows of ``df`` fall into: no more numbers than the layout has slices.

        None stands for the whole table: it has no slices, or none by this expression yet.
        """
        if self.slice_by is None or not self._in_layout():
            return None
        return sorted(r[0] for r in df.select(self._slice()).distinct().collect())

    def slice_folders(self) -> dict[int, str]:
        """The folder, below the table's, that holds the current copy of each slice."""
        return {int(s): f.removeprefix(f"{self.path}/") for s, f in self._current_slices(self._committed()).items()}

    def write(self, df: DataFrame, last: Callable[[DataFrame], DataFrame] = lambda df: df, replaces: Sequence[str] | None = None,
              mark: str | None = None) -> int:
        """Commit ``df`` as the next version: the whole table, or the whole of every slice in it.

        ``last`` is applied after any shuffle the layout needs, so what it observes
        is observed by the writing tasks, each of which counts once even if
        executors are lost. ``replaces`` is for tables whose rows do not name their slice.
        ``mark`` (letters and digits) is committed with the version, see ``has_mark``.
        """
        version = max(self._seen(), default=0) + 1
        folder = f"{self.path}/v_{version:08d}" + (f"-{self.layout}" if self.layout else "") + (f".{mark}" if mark else "")
        names = self.schema.names
        if self.bucket_by:
            self._write_bucketed(last(self._in_buckets(df)).select(*names), version, folder)
        elif self.slice_by is None:
            last(df).select(*names).write.parquet(folder)
        else:
            # Gathers each slice into few files, splitting the large ones over several tasks.
            sliced = last(df.withColumn(SLICE, self._slice()).hint("rebalance", F.col(SLICE)))
            sliced.select(*names, SLICE).write.partitionBy(SLICE).parquet(folder)
        return version

    def has_mark(self, mark: str) -> bool:
        """Whether a version that is still there was committed with this mark."""
        return any(folder.endswith(f".{mark}") for _, folder in self._committed())

    def write_tagged(self, df: DataFrame, set_aside: Column, columns: Sequence[str]) -> int:
        """Commit the rows of one pass as the next version of a plain table: the accepted ones are the table, the others are
        kept beside them with ``columns``. Both count as committed with the same marker, or neither does."""
        if self.layout:
            raise ValueError("only a table without slices or buckets takes rows set aside")
        version = max(self._seen(), default=0) + 1
        rows = df.withColumn(SET_ASIDE, F.when(set_aside, 1).otherwise(0)).select(*self.schema.names, *columns, SET_ASIDE)
        rows.write.partitionBy(SET_ASIDE).parquet(f"{self.path}/v_{version:08d}-{TAGGED}")
        return version

    def set_aside(self, schema: T.StructType) -> DataFrame:
        """The rows that the newest version set aside."""
        committed = self._committed()
        if not committed or _layout(committed[-1][1]) != TAGGED:
            return self.spark.createDataFrame([], schema)
        return self._tagged(committed[-1][1], schema, 1)

    def _tagged(self, folder: str, schema: T.StructType, tag: int) -> DataFrame:
        path = f"{folder}/{SET_ASIDE}={tag}"
        return self.spark.read.schema(schema).parquet(path) if self.files.exists(path) else self.spark.createDataFrame([], schema)

    def truncate(self) -> int:
        """Commit an empty version; only for tables without slices."""
        if self.slice_by is not None:
            raise ValueError("a sliced table is not truncated")
        return self.write(self._empty())

    def expire(self, keep: int = 2) -> None:
        """Remove what is older than the ``keep`` newest versions and holds no current rows.

        That is whole versions, superseded slices of versions that hold current ones,
        and versions below the newest that were never finished (a table has one writer).
        """
        committed = self._committed()
        current = set(self._current_slices(committed).values())
        in_use = {path.rsplit("/", 1)[0] for path in current}
        for _, folder in committed[:-keep]:
            if folder not in in_use:
                self.files.remove(folder)
                continue
            for name in self.files.names(folder):
                if name.startswith(SLICE + "=") and f"{folder}/{name}" not in current:
                    self.files.remove(f"{folder}/{name}")
        finished = {folder for _, folder in committed}
        for m in map(_VERSION.match, self.files.names(self.path)):
            if m and committed and int(m.group(1)) < committed[-1][0] and f"{self.path}/{m.group(0)}" not in finished:
                self.files.remove(f"{self.path}/{m.group(0)}")

    def _committed(self) -> list[tuple[int, str]]:
        """Version and folder of every finished write, oldest first."""
        found = [(int(m.group(1)), f"{self.path}/{m.group(0)}") for m in map(_VERSION.match, self.files.names(self.path)) if m]
        return sorted((v, f) for v, f in found if self.files.exists(f"{f}/_SUCCESS"))

    def _seen(self) -> list[int]:
        """Numbers in use, committed or not: an unfinished version is never reused."""
        return [int(m.group(1)) for m in map(_VERSION.match, self.files.names(self.path)) if m]

    def _in_layout(self) -> bool:
        committed = self._committed()
        return bool(committed) and _layout(committed[-1][1]) == self.layout

    def _current_slices(self, committed: Sequence[tuple[int, str]]) -> dict[str, str]:
        """Slice value -> folder of its newest copy, among the latest versions of one layout."""
        newest: dict[str, str] = {}
        layout = _layout(committed[-1][1]) if committed else ""
        if not layout.startswith("s"):
            return newest
        for _, folder in reversed(committed):
            if _layout(folder) != layout:
                break
            for name in self.files.names(folder):
                if name.startswith(SLICE + "="):
                    newest.setdefault(name.split("=", 1)[1], f"{folder}/{name}")
        return newest

    def _in_buckets(self, df: DataFrame) -> DataFrame:
        """One task per bucket, so that a version has one file per bucket.

        A merge with the current version comes in that layout by itself, because
        the join follows the table's buckets; the first version has to be arranged.
        """
        keys, count = self.bucket_by
        return df if self._in_layout() else df.repartition(count, *keys)

    def _write_bucketed(self, df: DataFrame, version: int, folder: str) -> None:
        """Bucketed files come from the catalog's writer; its entry is not needed afterwards."""
        keys, count = self.bucket_by
        name = self._catalog_name(version)
        df.write.format("parquet").option("path", folder).bucketBy(count, *keys).saveAsTable(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: the files stay

    def _read_bucketed(self, version: int, folder: str) -> DataFrame:
        """A catalog entry tells Spark that the files are bucketed; the plan holds that on, so the entry goes at once."""
        keys, count = self.bucket_by
        name = self._catalog_name(version)
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.schema)
        self.spark.sql(
            f"CREATE TABLE {name} ({columns}) USING parquet "
            f"CLUSTERED BY ({', '.join(f'`{k}`' for k in keys)}) INTO {count} BUCKETS LOCATION '{folder}'")
        rows = self.spark.table(name)
        self.spark.sql(f"DROP TABLE {name}")  # an external table: the files stay
        return rows

    def _catalog_name(self, version: int) -> str:
        return f"tidemark_{_digest(self.path)}_{version}_{uuid.uuid4().hex[:8]}"

    def _slice(self):
        value = F.coalesce(F.expr(self.slice_by).cast("string"), F.lit(""))
        return F.pmod(F.xxhash64(value), F.lit(self.slices)).cast("string").alias(SLICE)

    def _empty(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)


def all_nullable(schema: T.StructType) -> T.StructType:
    return T.StructType([T.StructField(f.name, f.dataType, True) for f in schema])


def _layout(folder: str) -> str:
    return folder.rsplit("/", 1)[1][len("v_00000000-"):].split(".")[0]


def _digest(text: str) -> str:
    return md5(text.encode()).hexdigest()[:12]


def append_run(df: DataFrame, path: str, run: str) -> None:
    """Append the rows of one run; a replay of the same run replaces its rows instead of doubling them."""
    df.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")


def read_appended(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    files = SharedFiles(spark, path)
    runs = [n for n in files.names(path) if n.startswith("run=")]
    done = [f"{path}/{n}" for n in runs if files.exists(f"{path}/{n}/_SUCCESS")]
    schema = all_nullable(schema)
    return spark.read.schema(schema).parquet(*done) if done else spark.createDataFrame([], schema)
