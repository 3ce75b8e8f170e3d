"""Target tables as files by key range, listed in a manifest of every version.

A version is a list of data files, each with the range of keys it holds; no two ranges meet. A delta merge
rewrites the files whose range its keys fall into and lists all others again, so versions share what they have in
common: nothing is moved, and a plain table needs no expression to be sliced by. The manifest is written last and
commits the version.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.sources.storage import SharedFiles, all_nullable

PART, LOW, HIGH, FILE, ROWS = "_part", "low", "high", "file", "rows"
_VERSION = re.compile(r"v_(\d{8})(?:\.\w+)?$")
_DATA = re.compile(r"v_(\d{8})-\w+$")
# Range starts travel as one JSON text, in which timestamps need all their digits.
_JSON = {"timestampNTZFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSS", "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


class ManifestTable:
    """A table of unique, non-null ``keys`` in files of ``file_rows`` rows at most, each of a key range of its own.

    The offered methods are those of ``VersionedTable``; what is a slice there is a file here. The driver
    holds the names of the files and where their ranges start, as Spark itself does for a table it lists.

    Every write checks, in the tasks that write, that no key repeats and none is NULL. As ranges do not meet, a table
    written so is unique on its keys; ``certified`` says so of a version, and a merge can rely on it.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], file_rows: int = 1_000_000):
        if not keys or file_rows < 1:
            raise ValueError("a table by key ranges needs keys, and files of one row at least")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), all_nullable(schema)
        self.keys, self.file_rows = list(keys), file_rows
        self.files = SharedFiles(spark, self.path)
        key_fields = [T.StructField(k, self.schema[k].dataType) for k in self.keys]
        self._range = T.StructType(key_fields)
        self._manifest = T.StructType([
            T.StructField(FILE, T.StringType()), T.StructField(ROWS, T.LongType()),
            T.StructField(LOW, self._range), T.StructField(HIGH, self._range)])

    def versions(self) -> list[int]:
        return [v for v, _ in self._committed()]

    def has_mark(self, mark: str) -> bool:
        """Whether a version that is still there was committed with this mark."""
        return any(name.endswith(f".{mark}") for _, name in self._committed())

    def manifest(self, version: int | None = None) -> DataFrame:
        """(file, rows, low, high) of a version, the newest by default: one row for each data file."""
        committed = self._committed()
        if version is None and not committed:
            return self.spark.createDataFrame([], self._manifest)
        name = committed[-1][1] if version is None else dict(committed)[version]
        return self.spark.read.schema(self._manifest).parquet(f"{self.path}/manifests/{name}")

    def certified(self) -> bool:
        """Whether the current version was checked to be unique on its keys; every committed one was."""
        return bool(self.versions())

    def read(self, files: Sequence[str] | None = None, version: int | None = None) -> DataFrame:
        """The rows of a version, the newest by default; of the given files only, if any are named."""
        if files is None:
            files = [r[FILE] for r in self.manifest(version).select(FILE).collect()]
        if not files:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*(f"{self.path}/{f}" for f in files)).select(*self.schema.names)

    def slices_of(self, df: DataFrame) -> list[str]:
        """The files whose key range a key of ``df`` falls into; a key in a gap belongs to the range below it.

        Every key finds its file by a binary search in the starts of the ranges, a constant of the plan: the table is
        not read, and nothing is joined.
        """
        files, starts = self._starts()
        if not files:
            return []
        return sorted(files[r[0]] for r in df.select(_owner(self._key(), starts, len(files))).distinct().collect())

    def write(self, df: DataFrame, last: Callable[[DataFrame], DataFrame] = lambda df: df, replaces: Sequence[str] | None = None,
              mark: str | None = None) -> int:
        """Commit ``df`` in the place of the files ``replaces``, or of all; what other files hold stays as it is.

        Rows go by key range into sorted files, and those of one replaced range never share a file with those of another, so
        that ranges stay apart. ``last`` is applied in the writing tasks. A key that repeats or is NULL fails the write before
        it is committed. ``mark`` (letters and digits) is committed with the version, see ``has_mark``.
        """
        version = max(self._seen(), default=0) + 1
        data = f"data/v_{version:08d}-{uuid.uuid4().hex[:8]}"
        files, starts = self._starts()
        whole = replaces is None or not files
        parts = [] if whole else [PART]
        if not whole:
            df = df.withColumn(PART, _owner(self._key(), starts, len(files)))
        checked = Observation(f"keys of {data}")
        order = [*parts, *self.keys]
        nth = F.row_number().over(Window.partitionBy(*order).orderBy(*order))
        # The window follows the ranges the rows are dealt by, so it costs no further shuffle, and its sort is that of the files.
        placed = df.repartitionByRange(*order).withColumn("_nth", nth)
        any_null = F.greatest(*(F.col(k).isNull() for k in self.keys), F.lit(False))
        placed = placed.observe(checked, F.count_if(F.col("_nth") > 1).alias("repeated"), F.count_if(any_null).alias("nulls"))
        (last(placed).select(*self.schema.names, *parts).write.option("maxRecordsPerFile", self.file_rows)
         .partitionBy(*parts).parquet(f"{self.path}/{data}"))
        if checked.get["repeated"] or checked.get["nulls"]:
            self.files.remove(f"{self.path}/{data}")
            raise ValueError(f"{self.path}: {checked.get['repeated']} rows repeat a key of the target, {checked.get['nulls']} have none")
        listed = self._described(data)
        if not whole:
            gone = self.spark.createDataFrame([(f,) for f in replaces], f"{FILE} string")
            listed = self.manifest().join(gone, FILE, "left_anti").select(*self._manifest.names).unionByName(listed)
        listed.coalesce(1).write.parquet(f"{self.path}/manifests/v_{version:08d}" + (f".{mark}" if mark else ""))
        return version

    def truncate(self) -> int:
        """Commit an empty version."""
        return self.write(self.spark.createDataFrame([], self.schema))

    def expire(self, keep: int = 2) -> None:
        """Remove the manifests below the ``keep`` newest, the files that only they list, and data that was never listed."""
        versions = self.versions()
        old, kept = versions[:-keep], versions[-keep:]
        if not kept:
            return
        used = self.manifest(kept[0])
        for v in kept[1:]:
            used = used.unionByName(self.manifest(v))
        held = used.select(FILE).distinct()
        for v in old:
            # What a version alone lists is what later ones have rewritten.
            for r in self.manifest(v).join(held, FILE, "left_anti").select(FILE).collect():
                self.files.remove(f"{self.path}/{r[FILE]}")
        folders = {r[0] for r in held.select(F.substring_index(FILE, "/", 2)).distinct().collect()}
        for name in self.files.names(f"{self.path}/data"):
            found = _DATA.match(name)
            if found and int(found.group(1)) <= kept[-1] and f"data/{name}" not in folders:
                self.files.remove(f"{self.path}/data/{name}")
        for name in self.files.names(f"{self.path}/manifests"):
            found = _VERSION.match(name)
            if found and int(found.group(1)) < kept[0]:
                self.files.remove(f"{self.path}/manifests/{name}")

    def _described(self, data: str) -> DataFrame:
        """The manifest rows of the files of a folder: their keys are read, nothing is shuffled but a row for each file and task."""
        folder = f"{self.path}/{data}"
        rows = self.spark.read.schema(self._range).parquet(folder)
        name = F.regexp_extract(F.col("_metadata.file_path"), f"({data}/.+)$", 1)
        key = self._key()
        return rows.select(name.alias(FILE), key.alias("_key")).groupBy(FILE).agg(
            F.count(F.lit(1)).alias(ROWS), F.min("_key").alias(LOW), F.max("_key").alias(HIGH))

    def _starts(self) -> tuple[list[str], Column | None]:
        """The files by the start of their ranges, and the starts as a constant array."""
        row = self.manifest().agg(F.sort_array(F.collect_list(F.struct(LOW, FILE))).alias("all")).select(
            F.col(f"all.{FILE}").alias("files"), F.to_json(f"all.{LOW}", _JSON).alias("starts")).first()
        if not row["files"]:
            return [], None
        return list(row["files"]), F.from_json(F.lit(row["starts"]), T.ArrayType(self._range), _JSON)

    def _key(self) -> Column:
        return F.struct(*(F.col(k).cast(self._range[k].dataType).alias(k) for k in self.keys))

    def _seen(self) -> list[int]:
        """Numbers in use, committed or not."""
        lists = [int(m.group(1)) for m in map(_VERSION.match, self.files.names(f"{self.path}/manifests")) if m]
        return lists + [int(m.group(1)) for m in map(_DATA.match, self.files.names(f"{self.path}/data")) if m]

    def _committed(self) -> list[tuple[int, str]]:
        """Number and folder of every manifest that was written to its end."""
        root = f"{self.path}/manifests"
        found = sorted((int(m.group(1)), m.group(0)) for m in map(_VERSION.match, self.files.names(root)) if m)
        return [(v, name) for v, name in found if self.files.exists(f"{root}/{name}/_SUCCESS")]


def _owner(key: Column, starts: Column, size: int) -> Column:
    """The place of the last start that is not above the key; the first if all are."""
    low, high = F.lit(0), F.lit(size)

    def halve(s: Column, _: Column) -> Column:
        middle = F.floor((s["low"] + s["high"]) / 2).cast("int")
        above = starts[middle] > key
        open_ = s["high"] - s["low"] > 1
        return F.struct(F.when(open_ & ~above, middle).otherwise(s["low"]).alias("low"),
                        F.when(open_ & above, middle).otherwise(s["high"]).alias("high"))

    steps = F.sequence(F.lit(1), F.lit(max(1, size.bit_length())))
    return F.aggregate(steps, F.struct(low.alias("low"), high.alias("high")), halve, lambda s: s["low"])
