"""Row numbers over a whole table, keys handed out from them, ordered text."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.session import new_workdir
from tidemark.sources.storage import SharedFiles

# The task of a sort that has a row, and the row's place there.
TASK, PLACE = "_task", "_place"
_AT, _TIE = "_at", "_tie"
_PARTITION_BITS = 33  # monotonically_increasing_id: partition above, row position below


def sort_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """A global sort whose equal rows may spread over several range partitions.

    The number of the input partition breaks ties: a value that fills a third of
    the table is split by where its rows came from. Unlike an arrival position it
    is the same when a lost task is run again, whatever order its rows come in.
    """
    return df.withColumn(_TIE, F.spark_partition_id()).orderBy(*order, _TIE).drop(_TIE)


def placed_rows(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows globally sorted, each with the task of the sort that has it and its place there, from 0."""
    return sort_rows(df, order).withColumn(_AT, F.monotonically_increasing_id()).select(
        *df.columns,
        F.shiftright(_AT, _PARTITION_BITS).cast("int").alias(TASK),
        F.col(_AT).bitwiseAND(F.lit(2**_PARTITION_BITS - 1)).alias(PLACE),
    )


def row_numbers(df: DataFrame, order: Sequence[Column], name: str = "row_number", folder: str | None = None) -> DataFrame:
    """ROW_NUMBER() OVER (ORDER BY ..) without putting the table into one task.

    Range partitions are sorted in parallel and written once, each row with its
    partition and its position there. A row's number is its position plus the
    rows of all earlier partitions, and that table has one row per partition.

    The sorted rows are written to ``folder`` (a new one under the shared folder by
    default), and the result reads them from there; ``numbered`` removes them when done, and a
    ``KeyRegistry`` keeps them as the table itself.
    """
    spark = df.sparkSession
    placed = placed_rows(df, order)
    folder = folder or new_workdir(spark, "row-numbers")
    placed.write.parquet(folder)
    placed = spark.read.schema(placed.schema).parquet(folder)

    sizes = placed.groupBy(TASK).agg(F.count(F.lit(1)).alias("_rows"))
    # One row per range partition: the window's single task sees no table rows.
    before = Window.orderBy(TASK).rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(TASK, F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_offset"))
    numbered = placed.join(F.broadcast(offsets), TASK)
    return numbered.select(*df.columns, (F.col("_offset") + F.col(PLACE) + 1).cast("bigint").alias(name))


@contextmanager
def numbered(df: DataFrame, order: Sequence[Column], name: str = "row_number") -> Iterator[DataFrame]:
    """``row_numbers`` for as long as the block runs; the sorted rows are removed at its end."""
    folder = new_workdir(df.sparkSession, "row-numbers")
    try:
        yield row_numbers(df, order, name, folder)
    finally:
        SharedFiles(df.sparkSession, folder).remove(folder)


def surrogate_keys(new: DataFrame, existing: DataFrame, key: str, order: Sequence[Column], folder: str | None = None) -> DataFrame:
    """New rows with keys that continue after the highest one in ``existing``, which is read for it; a ``KeyRegistry`` knows
    it without. ``folder`` as for ``row_numbers``."""
    top = existing.agg(F.coalesce(F.max(key), F.lit(0)).alias("top")).first()["top"]
    return row_numbers(new, order, name=key, folder=folder).withColumn(key, (F.col(key) + F.lit(top)).cast("bigint"))


def ordered_concat(df: DataFrame, group: Sequence[str], ordinal: str, text: str, delimiter: str, name: str) -> DataFrame:
    """One text per group: its fragments in the order of their ordinals.

    (group, ordinal) must be unique, so a group holds no more fragments than there
    are ordinals (the columns of a table, the lines of an order).
    """
    quoted = delimiter.replace("\\", "\\\\").replace("'", "\\'")
    spec = f"listagg(`{text}`, '{quoted}') WITHIN GROUP (ORDER BY `{ordinal}`)"
    return df.groupBy(*group).agg(F.expr(spec).alias(name))


def min_pending(df: DataFrame, number: str, done: Column) -> DataFrame:
    """The lowest stored number not yet done."""
    return df.where(~done).agg(F.min(number).alias("next_number"))


def first_pending(df: DataFrame, order: Sequence[str], done: Column) -> DataFrame:
    """The row number, in an order without ties, of the first row not yet done, without numbering the others: one more than
    the rows that come before it. Two aggregates, no sort; NULL if all are done."""
    key = F.struct(*order)
    first = df.where(~done).agg(F.min(key).alias("first")).scalar()
    seen = df.select((key < first).alias("_before"), first.isNull().alias("_none"))
    return seen.agg(F.when(~F.bool_or("_none"), F.count_if("_before") + 1).alias("next_number"))
