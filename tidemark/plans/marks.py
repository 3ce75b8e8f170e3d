"""The high-water mark of every load: computing it, keeping it, reading it back."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.text import timestamp_literal
from tidemark.sources.extract import Delta
from tidemark.sources.storage import SharedFiles

STATE_SCHEMA = "value_type string, value string, committed_at timestamp_ntz, committed_seq long"


def highest(df: DataFrame, delta: Delta, mark: str | None = None) -> DataFrame:
    """One row: the highest delta value as text, never below ``mark``; NULLs are skipped."""
    top = F.max(delta.value)
    if mark is not None:
        top = F.greatest(top, delta.literal(mark, delta.type_in(df)))
    return df.agg(delta.as_text(top).alias("mark"))


def current_marks(log: DataFrame) -> DataFrame:
    """The latest commit of every load, by the order of commits as a load itself reads them, whatever session they name;
    a long history collapses before the shuffle."""
    newest = F.max_by(F.struct("value_type", "value", "committed_at"), "committed_seq")
    return log.groupBy("load_name").agg(newest.alias("state")).select("load_name", "state.*")


def marks_or_default(loads: DataFrame, log: DataFrame) -> DataFrame:
    """Every load (load_name, first_mark) with its stored mark, or its first mark if it never ran."""
    return loads.join(current_marks(log), "load_name", "left").select(
        "load_name", F.coalesce("value", "first_mark").alias("mark"))


class MarkStore:
    """Marks on the shared file system: one append-only folder per load, newest commit wins.

    A mark is committed only after the data it stands for. Each load writes its own
    folder, so loads that run side by side do not meet.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")

    def log(self) -> DataFrame:
        schema = "load_name string, " + STATE_SCHEMA
        if not SharedFiles(self.spark, self.path).names(self.path):
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(self.path)

    def read(self, load: str, delta: Delta) -> str:
        return self._newest(load)[0] or delta.first_mark

    def commit(self, load: str, delta: Delta, mark: str, at: str) -> None:
        row = self.spark.range(0, 1, 1, 1).select(
            F.lit(delta.kind).alias("value_type"),
            F.lit(mark).alias("value"),
            timestamp_literal(at).alias("committed_at"),
            F.lit(self._newest(load)[1] + 1).cast("long").alias("committed_seq"),
        )
        row.write.mode("append").parquet(self._folder(load))

    def _newest(self, load: str) -> tuple[str | None, int]:
        folder = self._folder(load)
        if not SharedFiles(self.spark, folder).exists(folder):
            return None, 0
        rows = self.spark.read.schema(STATE_SCHEMA).parquet(folder)
        row = rows.agg(F.max_by("value", "committed_seq").alias("value"), F.max("committed_seq").alias("seq")).first()
        return row["value"], row["seq"] or 0

    def _folder(self, load: str) -> str:
        return f"{self.path}/load_name={load}"
