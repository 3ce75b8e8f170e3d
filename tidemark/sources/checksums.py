"""Checksums of the slices of tables, in a tree, so that equal slices are never compared row by row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.merge import except_rows
from tidemark.sources.storage import SharedFiles, VersionedTable

# Slices under one inner node of the tree.
FANOUT = 32
_SCHEMA = "slice int, folder string, rows bigint, first decimal(38,0), second decimal(38,0)"


def row_codes(columns: Sequence[str]) -> list[Column]:
    """Two independent codes of a row; a NULL counts as one in its column."""
    values = [F.col(c) for c in columns] + [F.col(c).isNull() for c in columns]
    return [F.xxhash64(*values), F.xxhash64(F.lit(1), *reversed(values))]


class SliceChecksums:
    """The checksums of a sliced table over some columns: the rows of a slice and the sums of their codes.

    Sums do not depend on the order of rows and add up, so an inner node is the sum of its slices. What is recorded
    names the folder of the slice it was made from: a slice that later versions left alone is not read again.
    """

    def __init__(self, table: VersionedTable, columns: Sequence[str]):
        if table.slice_by is None:
            raise ValueError("checksums are kept of sliced tables")
        self.table, self.columns, self.spark = table, list(columns), table.spark
        self.path = f"{table.path}_checksums"
        self.files = SharedFiles(self.spark, self.path)

    def record(self) -> DataFrame:
        """(slice, folder, rows, first, second) of the current slices; the ones not seen before are read."""
        current = self.table.slice_folders()
        held = self._recorded()
        known = {(r.slice, r.folder) for r in held.select("slice", "folder").collect()}
        new = {s: f for s, f in current.items() if (s, f) not in known}
        wanted = self.spark.createDataFrame(list(current.items()), "slice int, folder string")
        rows = held.join(F.broadcast(wanted), ["slice", "folder"])
        if new:
            rows = rows.unionByName(self._summed(new))
        number = max((int(n) for n in self.files.names(self.path)), default=0) + 1
        rows.select("slice", "folder", "rows", "first", "second").coalesce(1).write.parquet(f"{self.path}/{number:08d}")
        return self._recorded()

    def _summed(self, slices: dict[int, str]) -> DataFrame:
        parts = self.table.read([str(s) for s in slices]).select(*self.columns, F.col("_metadata.file_path").alias("_file"))
        number = F.regexp_extract("_file", r"_slice=(\d+)/[^/]+$", 1).cast("int")
        first, second = (F.sum(c.cast("decimal(38,0)")) for c in row_codes(self.columns))
        summed = parts.groupBy(number.alias("slice")).agg(F.count(F.lit(1)).alias("rows"), first.alias("first"), second.alias("second"))
        folders = self.spark.createDataFrame(list(slices.items()), "slice int, folder string")
        return summed.join(F.broadcast(folders), "slice")

    def _recorded(self) -> DataFrame:
        done = [n for n in self.files.names(self.path) if self.files.exists(f"{self.path}/{n}/_SUCCESS")]
        return self.spark.read.schema(_SCHEMA).parquet(f"{self.path}/{done[-1]}") if done else self.spark.createDataFrame([], _SCHEMA)


def unequal_slices(left: DataFrame, right: DataFrame) -> list[int]:
    """The slices whose checksums differ, from the recorded ones of two tables of one layout: the tree is walked from its
    inner nodes, and leaves are looked at below unequal ones alone. A slice that one side lacks is unequal."""
    sums = ["rows", "first", "second"]

    def differing(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
        b = b.select(key, *(F.col(c).alias(f"{c}_b") for c in sums))
        same = [F.col(c).eqNullSafe(F.col(f"{c}_b")) for c in sums]
        return a.join(b, key, "full").where(~(same[0] & same[1] & same[2])).select(key)

    def inner(df: DataFrame) -> DataFrame:
        return df.groupBy(F.expr(f"slice div {FANOUT}").alias("node")).agg(*(F.sum(c).alias(c) for c in sums))

    nodes = [r[0] for r in differing(inner(left), inner(right), "node").collect()]
    below = F.expr(f"slice div {FANOUT}").isin(nodes)
    # No more numbers than the layout has slices.
    return sorted(r[0] for r in differing(left.where(below), right.where(below), "slice").collect()) if nodes else []


def except_by_slices(left: VersionedTable, right: VersionedTable, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold, NULL equal to NULL, over two tables of one layout.

    The columns have to determine the slice, so that equal rows lie in slices of the same number. Checksums of either table are
    brought up to date, which reads what was rewritten since; then only slices that differ are read.
    """
    if left.layout != right.layout:
        raise ValueError("only tables of one layout can be compared by their slices")
    sums = [SliceChecksums(t, columns).record() for t in (left, right)]
    unequal = [str(s) for s in unequal_slices(*sums)]
    return except_rows(left.read(unequal), right.read(unequal), columns)
