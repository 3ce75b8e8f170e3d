"""Which source rows a run reads, and what is done around the read."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Contract
from tidemark.functions import rowversion
from tidemark.functions.text import mark_text, timestamp_literal
from tidemark.operators.numbering import sort_rows

# Marks of a load that has never run.
FIRST_NUMBER = "0"
FIRST_DATETIME = "1900-01-01 00:00:00.000"
FIRST_VERSION = "0x" + "0" * rowversion.HEX_DIGITS
CONSTANT_COLUMN = "1"

KINDS = ("numeric", "datetime", "rowversion", "constant")


@dataclass(frozen=True)
class Delta:
    """The column whose growth tells new rows from rows already read.

    Rows whose value is NULL, or is not above the mark, are not read again.
    """

    column: str
    kind: str = "numeric"

    def __post_init__(self) -> None:
        if self.kind not in KINDS:
            raise ValueError(f"unknown delta kind {self.kind!r}")

    @classmethod
    def constant(cls) -> Delta:
        """For tables without a usable delta column: the literal 1 against the mark."""
        return cls(CONSTANT_COLUMN, "constant")

    @property
    def first_mark(self) -> str:
        return {"datetime": FIRST_DATETIME, "rowversion": FIRST_VERSION}.get(self.kind, FIRST_NUMBER)

    def literal(self, mark: str, data_type: T.DataType | None = None) -> Column:
        """The mark as a constant of the column's own type, exactly, so that the scan can skip row groups by it.

        Without a type a number is as wide as its text asks for.
        """
        if self.kind == "datetime":
            return timestamp_literal(mark)
        if self.kind == "rowversion":
            return rowversion.literal(mark)
        if self.kind == "numeric" and isinstance(data_type, T.NumericType):
            return F.lit(mark).cast(data_type)
        return F.lit(int(mark)) if mark.lstrip("-").isdigit() else F.lit(Decimal(mark))

    @property
    def value(self) -> Column:
        return F.lit(1) if self.kind == "constant" else F.col(self.column)

    def type_in(self, df: DataFrame) -> T.DataType | None:
        return df.schema[self.column].dataType if self.column in df.columns else None

    def after(self, mark: str, data_type: T.DataType | None = None) -> Column:
        return self.value > self.literal(mark, data_type)

    def up_to(self, mark: str, data_type: T.DataType | None = None) -> Column:
        return self.value <= self.literal(mark, data_type)

    def as_text(self, value: Column) -> Column:
        """A value of this column in the form in which marks are stored."""
        if self.kind == "datetime":
            return mark_text(value)
        if self.kind == "rowversion":
            return rowversion.to_hex_text(value)
        return value.cast("string")


def extract(
    df: DataFrame,
    contract: Contract | None = None,
    *,
    delta: Delta | None = None,
    mark: str | None = None,
    upper: str | None = None,
    where: str | None = None,
    join: tuple[DataFrame, Column] | None = None,
    distinct: bool = False,
    sorted_columns: int = 0,
) -> DataFrame:
    """The rows and columns one run reads.

    No delta means a full extract. ``where`` takes the place of the delta
    condition. ``upper`` closes the window above, so rows that arrive during the
    run wait for the next one. A join applies before the projection.
    """
    if join is not None:
        df = df.join(join[0], join[1])
    if where is not None:
        df = df.where(F.expr(where))
    elif delta is not None:
        df = df.where(delta.after(mark if mark is not None else delta.first_mark, delta.type_in(df)))
        if upper is not None:
            df = df.where(delta.up_to(upper, delta.type_in(df)))
    if contract is not None:
        df = contract.project(df)
    if distinct:
        df = df.distinct()
    if sorted_columns:
        df = sort_rows(df, [F.col(c) for c in df.columns[:sorted_columns]])
    return df


def source_mark(df: DataFrame, delta: Delta) -> str | None:
    """The highest value now in the source, as text: one aggregate, one value to the driver."""
    return df.agg(delta.as_text(F.max(delta.value)).alias("mark")).first()["mark"]


def sql_override(spark: SparkSession, text: str, **tables: DataFrame) -> DataFrame:
    """A source given as SQL text; tables are bound by name as ``{name}``."""
    return spark.sql(text, **tables)


def run_hook(spark: SparkSession, hook: Callable[[SparkSession], object] | str | None) -> None:
    """A hook is a callable or one SQL statement, run for its effect."""
    if callable(hook):
        hook(spark)
    elif hook:
        spark.sql(hook)
