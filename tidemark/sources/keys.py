"""Surrogate keys that are handed out once and kept with the rows that have them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import PLACE, TASK, placed_rows
from tidemark.sources.storage import SharedFiles, all_nullable


class KeyRegistry:
    """Rows with numbers that continue from run to run.

    A run sorts its rows and stores them where they stay, each with its task and its place there; the registry gives every
    task of the run a range of numbers, right after the last one it has handed out. A row's number is the start of its
    task's range plus its place. So there is no copy beside the table, and no scan of it for the highest number: the registry holds
    one row for each task and run. The ranges commit a run; one that died before is done anew.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType, name: str = "id"):
        self.spark, self.path, self.schema, self.name = spark, path.rstrip("/"), all_nullable(schema), name
        self.files = SharedFiles(spark, self.path)

    def highest(self) -> int:
        """The last number handed out, 0 before the first."""
        return self._ranges().agg(F.coalesce(F.max(F.col("start") + F.col("rows")), F.lit(0)).alias("top")).first()["top"]

    def add(self, rows: DataFrame, order: Sequence[Column], run: str) -> int:
        """Number the rows in order, after all earlier ones; returns how many got one. A run that is there already adds nothing."""
        if run in self.runs():
            return 0
        folder = f"{self.path}/rows/run={run}"
        placed_rows(rows.select(*self.schema.names), order).write.mode("overwrite").parquet(folder)
        sizes = self.spark.read.schema(f"{TASK} int").parquet(folder).groupBy(TASK).agg(F.count(F.lit(1)).alias("rows"))
        # One row for each task of the sort: the window's single task sees no table rows.
        before = Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
        start = F.lit(self.highest()) + F.coalesce(F.sum("rows").over(before), F.lit(0))
        sizes.select(TASK, start.alias("start"), "rows").coalesce(1).write.mode("overwrite").parquet(f"{self.path}/ranges/run={run}")
        return self._ranges().where(F.col("run") == run).agg(F.coalesce(F.sum("rows"), F.lit(0)).alias("rows")).first()["rows"]

    def runs(self) -> list[str]:
        root = f"{self.path}/ranges"
        return [n.split("=", 1)[1] for n in self.files.names(root) if self.files.exists(f"{root}/{n}/_SUCCESS")]

    def read(self) -> DataFrame:
        """All rows with their numbers."""
        runs = self.runs()
        schema = T.StructType([*self.schema.fields, T.StructField(TASK, T.IntegerType()), T.StructField(PLACE, T.LongType()),
                               T.StructField("run", T.StringType())])
        root = f"{self.path}/rows"
        rows = (self.spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/run={r}" for r in runs))
                if runs else self.spark.createDataFrame([], schema))
        return rows.join(self._ranges(), ["run", TASK]).select(
            *self.schema.names, (F.col("start") + F.col(PLACE) + 1).cast("bigint").alias(self.name))

    def _ranges(self) -> DataFrame:
        root, runs = f"{self.path}/ranges", self.runs()
        schema = f"{TASK} int, start bigint, rows bigint, run string"
        if not runs:
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).option("basePath", root).parquet(*(f"{root}/run={r}" for r in runs))
