"""Which tables to load and how, resolved from control tables."""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Column, Contract
from tidemark.functions.text import server_label
from tidemark.operators.joins import inner_distinct, left_chain
from tidemark.plans.load import INCREMENT, LoadSpec, Stage
from tidemark.sources.extract import CONSTANT_COLUMN, Delta

DIFF_SUFFIX = "_diff"


def load_plan(flows: DataFrame, statements: DataFrame, conditions: DataFrame, columns: DataFrame,
              config: DataFrame | None = None, version: str | None = None) -> DataFrame:
    """One row per table to load.

    flows:      flow_id, schema_name, table_name, source_server, source_db, target_schema
    statements: statement_id, flow_id, custom_where
    conditions: statement_id, delta_column, delta_type
    columns:    schema_name, table_name, pattern (one row per column of every table)
    config:     generate_version, repository, folder, owner, name_prefix, created_at

    One delta condition per statement, one statement per flow. An incremental load
    goes to the diff table. A custom condition outranks the
    delta condition, and a full load has neither. A flow that cannot run carries
    the cause in ``problem``; see ``runnable``.

    With ``config``, flows also have generate_version, target_server and target_db, and a table may be
    described by several versions: the one asked for counts, or else that of the newest configuration. A version
    without a configuration row, or with one that lacks its repository, folder or owner, is a problem. The plan then
    also has the version, the label of the target and the name of the load.
    """
    tables = columns.select("schema_name", "table_name", "pattern").distinct()
    if config is not None:
        flows = _of_one_version(flows, config, version)
    joined = left_chain(
        flows.join(tables, ["schema_name", "table_name"]),
        (statements.withColumnRenamed("flow_id", "_flow_id"), F.col("flow_id") == F.col("_flow_id")),
        (conditions.withColumnRenamed("statement_id", "_statement_id"), F.col("statement_id") == F.col("_statement_id")),
    )
    increment = F.col("pattern") == "Increment"
    quoted_name = F.concat(F.lit("$last_"), "delta_column")
    delta = (
        F.when(F.col("delta_type") == "datetime", F.concat("delta_column", F.lit(" > timestamp_ntz'"), quoted_name, F.lit("'")))
        .otherwise(F.concat("delta_column", F.lit(" > "), quoted_name))
    )
    source_filter = F.when(increment, F.coalesce("custom_where", delta)).otherwise(F.lit(""))
    target = F.concat("target_schema", F.lit("."), "table_name", F.when(increment, F.lit(DIFF_SUFFIX)).otherwise(F.lit("")))
    unconfigured = F.lit(False) if config is None else ~F.col("configured")
    problem = (
        F.when(unconfigured, F.lit("no configuration"))
        .when(F.col("pattern").isNull() | ~F.col("pattern").isin("Full", "Increment"), F.lit("no valid pattern"))
        .when(increment & source_filter.isNull(), F.lit("no delta condition"))
        .when(server_label(F.col("source_server"), F.col("source_db")).isNull(), F.lit("no source"))
        .when(target.isNull(), F.lit("no target"))
    )
    versioned = [] if config is None else [
        F.col("generate_version"), server_label(F.col("target_server"), F.col("target_db")).alias("target_label"),
        F.concat("name_prefix", "table_name").alias("load_name")]
    return joined.select(
        "flow_id", "schema_name", "table_name", "pattern",
        server_label(F.col("source_server"), F.col("source_db")).alias("source_name"),
        target.alias("target_name"), source_filter.alias("source_filter"),
        F.when(increment, F.col("delta_column")).alias("delta_column"),
        F.when(increment, F.col("custom_where")).alias("custom_where"),
        *versioned, problem.alias("problem"),
    )


def _of_one_version(flows: DataFrame, config: DataFrame, version: str | None) -> DataFrame:
    """The flows of one version per table, each with its configuration and whether that is whole.

    A flow that is listed twice in its version stays listed twice: two loads of one name are refused where they are run.
    """
    if version is not None:
        flows, config = flows.where(F.col("generate_version") == version), config.where(F.col("generate_version") == version)
    whole = F.col("repository").isNotNull() & F.col("folder").isNotNull() & F.col("owner").isNotNull()
    known = flows.join(config.select("generate_version", "name_prefix", "created_at", whole.alias("configured")), "generate_version", "left")
    known = known.withColumn("configured", F.coalesce("configured", F.lit(False)))
    if version is None:
        newest = F.max(F.struct("created_at", "generate_version")).over(Window.partitionBy("schema_name", "table_name"))
        known = known.withColumn("_newest", newest).where(F.struct("created_at", "generate_version").eqNullSafe(F.col("_newest")))
    return known.drop("_newest", "created_at")


def runnable(plan: DataFrame) -> DataFrame:
    """The plan's rows, failing the job on the first one that has a problem."""
    cause = F.concat(F.lit("load of "), F.coalesce("schema_name", F.lit("?")), F.lit("."),
                     F.coalesce("table_name", F.lit("?")), F.lit(": "), "problem")
    checked = F.when(F.col("problem").isNull(), F.col("flow_id")).otherwise(F.raise_error(cause).cast("bigint"))
    return plan.withColumn("flow_id", checked).drop("problem")


def described(catalog: DataFrame, plan: DataFrame) -> DataFrame:
    """The rows of the catalog that describe a table of the plan."""
    return inner_distinct(catalog, plan, ["schema_name", "table_name"])


def contracts(catalog: DataFrame) -> dict[tuple[str, str], Contract]:
    """Contracts from a column catalog, by (schema_name, table_name).

    catalog: schema_name, table_name, column_id, column_name, type_name, max_length
    (bytes, -1 for unlimited), precision, scale, is_nullable, is_pk, target_column.
    A catalog describes tables, it does not hold their rows; it is read as a whole.
    """
    return {table: Contract(_column(c) for c in columns) for table, columns in catalog_columns(catalog).items()}


def catalog_columns(catalog: DataFrame) -> dict[tuple[str, str], list[Row]]:
    """The catalog's rows by table, in column order."""
    rows = catalog.orderBy("schema_name", "table_name", "column_id").collect()
    return {table: list(columns) for table, columns in groupby(rows, key=lambda r: (r.schema_name, r.table_name))}


def _column(r: Row) -> Column:
    length = None
    # A catalog gives a GUID's 16 bytes; as text it is longer and of one length by itself.
    if r.max_length is not None and r.max_length > 0 and r.type_name != "uniqueidentifier":
        length = r.max_length // 2 if r.type_name in ("nchar", "nvarchar") else r.max_length
    return Column(
        r.target_column or r.column_name, r.type_name, length=length, precision=r.precision, scale=r.scale,
        nullable=bool(r.is_nullable), key=bool(r.is_pk), source=r.column_name)


def load_spec(entry: Row, contract: Contract, read: Callable[[SparkSession], DataFrame]) -> LoadSpec:
    """The load one row of a plan asks for. The delta's kind follows from its column's type."""
    if entry.problem:
        raise ValueError(entry.problem)
    name = f"{entry.schema_name}.{entry.table_name}"
    delta = None
    if entry.delta_column == CONSTANT_COLUMN:
        delta = Delta.constant()
    elif entry.delta_column is not None:
        column = next((c for c in contract.data_columns if c.source_name == entry.delta_column), None)
        if column is None:
            raise ValueError(f"{name}: delta column {entry.delta_column!r} is not in the contract")
        kinds = {T.TimestampNTZType(): "datetime", T.BinaryType(): "rowversion"}
        delta = Delta(entry.delta_column, kinds.get(column.spark_type, "numeric"))
    where = entry.custom_where if entry.pattern == INCREMENT else None
    return LoadSpec(name, contract, read, entry.pattern, delta, where)


def run_plan(
    stage: Stage,
    plan: DataFrame,
    catalog: DataFrame,
    reader: Callable[[Row], Callable[[SparkSession], DataFrame]],
    session_start: str,
    merge_ts: str | None = None,
    fail_fast: bool = False,
) -> DataFrame:
    """Run every load of a plan; one that cannot be set up fails alone, with its cause in the statistics.

    ``reader`` gives the function that reads the source of one row of the plan. With ``fail_fast`` the first problem
    of the plan stops the run before anything is loaded.
    """
    if fail_fast:
        plan = runnable(plan).withColumn("problem", F.lit(None).cast("string"))
    # What describes other tables stays where it is.
    known, specs, refused = catalog_columns(described(catalog, plan)), [], {}
    for entry in plan.collect():  # one row per table to load
        table = (entry.schema_name, entry.table_name)
        try:
            if table not in known:
                raise ValueError("no columns in the catalog")
            specs.append(load_spec(entry, Contract(_column(c) for c in known[table]), reader(entry)))
        except Exception as error:  # noqa: BLE001 - whatever keeps one table from being set up is its own failure
            refused[".".join(table)] = str(error) or type(error).__name__
    return stage.run_all(specs, session_start, merge_ts, refused=refused)
