"""Where source rows come from: relational tables, files, SQL text, inline rows."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tidemark.sources.extract import Delta
from tidemark.sources.split import Part, split


def jdbc_options(
    url: str,
    table: str,
    *,
    partition_column: str | None = None,
    lower: object = None,
    upper: object = None,
    partitions: int = 1,
    fetch_rows: int = 10_000,
    query: str | None = None,
) -> dict[str, str]:
    """Options of a relational read; a query is read as a derived table, so that it can be partitioned too."""
    options = {
        "url": url,
        "dbtable": f"({query}) src" if query else table,
        "fetchsize": str(fetch_rows),
        "preferTimestampNTZ": "true",
    }
    if partition_column:
        if lower is None or upper is None or partitions < 1:
            raise ValueError("a partitioned read needs lower, upper and partitions")
        options |= {
            "partitionColumn": partition_column,
            "lowerBound": str(lower),
            "upperBound": str(upper),
            "numPartitions": str(partitions),
        }
    return options


# Rows that one task of a relational read fetches.
TASK_ROWS = 2_000_000


@dataclass(frozen=True)
class RelationalSource:
    """A relational table or query, read by as many tasks as its rows call for.

    ``split_on`` is a numeric column or expression whose values share the rows out, ``second`` one that cuts values with
    too many rows; see ``split``. A source without ``split_on`` comes through one task, which has to be
    asked for (``one_task``) and suits small tables only. As the ``read`` of a load it is given the mark: rows are
    counted and fetched past it alone. Filters and column choices on the result are sent to the database.

    ``datetime_literal`` writes a mark as the database's own constant.
    """

    url: str
    table: str
    query: str | None = None
    split_on: str | None = None
    second: str | None = None
    one_task: bool = False
    task_rows: int = TASK_ROWS
    properties: tuple[tuple[str, str], ...] = ()
    datetime_literal: Callable[[str], str] = "TIMESTAMP '{}'".format

    def __post_init__(self) -> None:
        if not self.split_on and not self.one_task:
            raise ValueError(f"{self.table}: name a column to split on, or ask for one task")

    @property
    def source(self) -> str:
        return f"({self.query}) src" if self.query else self.table

    def __call__(self, spark: SparkSession) -> DataFrame:
        return self._read(spark, None)

    def after(self, spark: SparkSession, delta: Delta, mark: str, upper: str | None = None) -> DataFrame:
        """The rows past the mark, and not past ``upper`` if it is given; split by what is there."""
        bounds = [f"{delta.column} {op} {self._literal(delta, m)}" for op, m in ((">", mark), ("<=", upper)) if m is not None]
        return self._read(spark, " AND ".join(bounds))

    def parts(self, spark: SparkSession, where: str | None) -> list[Part]:
        """The conditions of the tasks of a read."""
        def ask(sql: str) -> list:
            return self.ask(spark, sql)

        total = int(ask(f"SELECT COUNT(*) AS n FROM {self.source}" + (f" WHERE {where}" if where else ""))[0][0])
        return split(ask, self.source, self.split_on, max(1, -(-total // self.task_rows)), where, self.second)

    def ask(self, spark: SparkSession, sql: str) -> list:
        """The rows of a short answer from the database."""
        return self._format(spark, jdbc_options(self.url, self.table, query=sql)).load().collect()

    def fetch(self, spark: SparkSession, conditions: list[str]) -> DataFrame:
        """The rows that meet each condition, one task for each."""
        options = jdbc_options(self.url, self.table, query=self.query)
        url, table = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, table, predicates=conditions, properties={**options, **dict(self.properties)})

    def _read(self, spark: SparkSession, where: str | None) -> DataFrame:
        if not self.split_on:
            return self.fetch(spark, [where or "1 = 1"])
        return self.fetch(spark, [f"({where}) AND ({p.condition})" if where else p.condition for p in self.parts(spark, where)])

    def _format(self, spark: SparkSession, options: dict[str, str]):
        return spark.read.format("jdbc").options(**options).options(**dict(self.properties))

    def _literal(self, delta: Delta, mark: str) -> str:
        return self.datetime_literal(mark) if delta.kind == "datetime" else mark


def read_files(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(path)


def inline_rows(spark: SparkSession, columns: Sequence[str], rows: Sequence[tuple], types: Sequence[str]) -> DataFrame:
    """Rows written in the program itself (a VALUES list)."""
    schema = ", ".join(f"`{c}` {t}" for c, t in zip(columns, types, strict=True))
    return spark.createDataFrame(list(rows), schema)
