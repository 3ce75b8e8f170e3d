"""Load control, multi-run loads and the stream (C operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import Column, Contract
from tidemark.functions import rowversion
from tidemark.functions.text import timestamp_literal
from tidemark.operators.merge import audit_stamp
from tidemark.plans.control import load_plan, run_plan
from tidemark.plans.load import APPEND, FULL, INCREMENT, LoadSpec, Stage
from tidemark.plans.marks import marks_or_default
from tidemark.registry.common import EVENT_MARK, MERGE_TS, RUN1, RUN2, registry, table
from tidemark.registry.extracts import EVENTS, ORDERS
from tidemark.session import new_workdir
from tidemark.sources.extract import FIRST_NUMBER, Delta
from tidemark.sources.storage import VersionedTable
from tidemark.streaming.continuous import read_stream, start_merge_stream

QUERIES, ORACLES, query = registry()


# Control tables at the size of the data: every supplier is a source table, its
# parts are the columns of that table, customers and parts hold the conditions.
_CONTROL = r"""
WITH flows AS (
    SELECT s_suppkey AS flow_id, 'S' || s_nationkey AS schema_name, s_name AS table_name,
           CASE WHEN s_acctbal >= 0 THEN n_name || '\INST' ELSE n_name END AS source_server,
           CASE WHEN s_acctbal >= -900 THEN 'DB' || n_regionkey END AS source_db, 'stg' AS target_schema,
           'V' || s_suppkey % 6 AS generate_version, n_name || '\DWH' AS target_server, 'DW' || n_regionkey AS target_db
    FROM supplier JOIN nation ON s_nationkey = n_nationkey),
listed AS (
    SELECT * FROM flows UNION ALL
    SELECT flow_id + 1000000, schema_name, table_name, source_server, source_db, 'stg2', 'V4', target_server, target_db
    FROM flows WHERE flow_id % 6 <> 4 AND flow_id % 5 = 0),
config AS (
    SELECT 'V' || r_regionkey AS generate_version, CASE WHEN r_regionkey <> 3 THEN r_name END AS repository,
           r_regionkey * 7 % 5 AS created_at, 'm' || r_regionkey || '_' AS name_prefix FROM region),
current AS (
    SELECT l.*, c.repository, c.name_prefix FROM listed l LEFT JOIN config c ON l.generate_version = c.generate_version
    QUALIFY rank() OVER (PARTITION BY schema_name, table_name ORDER BY created_at DESC NULLS LAST, l.generate_version DESC) = 1),
tables AS (
    SELECT DISTINCT 'S' || s_nationkey AS schema_name, s_name AS table_name,
           CASE WHEN s_acctbal > 6000 THEN 'Full' WHEN s_acctbal > -500 THEN 'Increment' END AS pattern
    FROM lineitem JOIN supplier ON l_suppkey = s_suppkey),
statements AS (
    SELECT c_custkey AS statement_id, c_custkey AS flow_id,
           CASE WHEN c_acctbal < 0 THEN 'c_acctbal < 0' END AS custom_where FROM customer),
conditions AS (
    SELECT p_partkey AS statement_id, CASE WHEN p_size <= 45 THEN p_type END AS delta_column,
           CASE WHEN p_size < 25 THEN 'datetime' ELSE 'numeric' END AS delta_type FROM part)
"""
def _label(side):
    return rf"""'SQL_' || CASE WHEN strpos({side}_server, '\') > 0 THEN split_part({side}_server, '\', 1) ELSE '' END || '_' || {side}_db"""


@query(f"""{_CONTROL}, resolved AS (
    SELECT f.*, t.pattern, s.custom_where, c.delta_column, {_label("source")} AS source_name, {_label("target")} AS target_label,
           target_schema || '.' || f.table_name || CASE WHEN pattern = 'Increment' THEN '_diff' ELSE '' END AS target_name,
           CASE WHEN pattern = 'Increment' THEN coalesce(custom_where,
                CASE WHEN delta_type = 'datetime' THEN delta_column || ' > timestamp_ntz''$last_' || delta_column || ''''
                     ELSE delta_column || ' > $last_' || delta_column END)
                ELSE '' END AS source_filter
    FROM current f JOIN tables t ON f.schema_name = t.schema_name AND f.table_name = t.table_name
    LEFT JOIN statements s ON f.flow_id = s.flow_id LEFT JOIN conditions c ON s.statement_id = c.statement_id)
SELECT flow_id, schema_name, table_name, pattern, source_name, target_name, source_filter,
       CASE WHEN pattern = 'Increment' THEN resolved.delta_column END AS delta_column,
       CASE WHEN pattern = 'Increment' THEN resolved.custom_where END AS custom_where,
       generate_version, target_label, name_prefix || table_name AS load_name,
       CASE WHEN repository IS NULL THEN 'no configuration' WHEN pattern IS NULL THEN 'no valid pattern' WHEN pattern = 'Increment' AND source_filter IS NULL THEN 'no delta condition'
            WHEN source_name IS NULL THEN 'no source' END AS problem
FROM resolved""", name="load_plan")
def table_load_plan(spark, sf_dir):
    supplier, nation = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "nation")
    schema_name = F.concat(F.lit("S"), F.col("s_nationkey").cast("string")).alias("schema_name")
    balance = F.col("s_acctbal")
    flows = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey")).select(
        F.col("s_suppkey").alias("flow_id"), schema_name, F.col("s_name").alias("table_name"),
        F.when(balance >= 0, F.concat("n_name", F.lit("\\INST"))).otherwise(F.col("n_name")).alias("source_server"),
        F.when(balance >= -900, F.concat(F.lit("DB"), F.col("n_regionkey").cast("string"))).alias("source_db"),
        F.lit("stg").alias("target_schema"),
        F.concat(F.lit("V"), (F.col("s_suppkey") % 6).cast("string")).alias("generate_version"),
        F.concat("n_name", F.lit("\\DWH")).alias("target_server"),
        F.concat(F.lit("DW"), F.col("n_regionkey").cast("string")).alias("target_db"),
    )
    again = flows.where("flow_id % 6 <> 4 AND flow_id % 5 = 0").withColumns({
        "flow_id": F.col("flow_id") + 1000000, "target_schema": F.lit("stg2"), "generate_version": F.lit("V4")})
    region = table(spark, sf_dir, "region")
    number = F.col("r_regionkey").cast("string")
    config = region.select(
        F.concat(F.lit("V"), number).alias("generate_version"), F.when(F.col("r_regionkey") != 3, F.col("r_name")).alias("repository"),
        F.lit("staging").alias("folder"), F.lit("loader").alias("owner"), F.concat(F.lit("m"), number, F.lit("_")).alias("name_prefix"),
        (F.col("r_regionkey") * 7 % 5).alias("created_at"))
    columns = table(spark, sf_dir, "lineitem").join(supplier, F.col("l_suppkey") == F.col("s_suppkey")).select(
        schema_name, F.col("s_name").alias("table_name"),
        F.when(balance > 6000, "Full").when(balance > -500, "Increment").alias("pattern"),
    )
    statements = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("statement_id"), F.col("c_custkey").alias("flow_id"),
        F.when(F.col("c_acctbal") < 0, "c_acctbal < 0").alias("custom_where"),
    )
    conditions = table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("statement_id"),
        F.when(F.col("p_size") <= 45, F.col("p_type")).alias("delta_column"),
        F.when(F.col("p_size") < 25, "datetime").otherwise("numeric").alias("delta_type"),
    )
    return load_plan(flows.unionByName(again), statements, conditions, columns, config)


@query("""SELECT 'customer ' || c_custkey AS load_name, CAST(coalesce(last_key, 0) AS VARCHAR) AS mark FROM customer
    LEFT JOIN (SELECT o_custkey, max_by(o_orderkey, o_orderkey * 7919 % 1000003) AS last_key FROM orders GROUP BY o_custkey) ON o_custkey = c_custkey""")
def watermark_state(spark, sf_dir):
    """Every customer is a load and every order a commit of its mark; the latest commit counts."""
    name = F.concat(F.lit("customer "), F.col("c_custkey").cast("string"))
    loads = table(spark, sf_dir, "customer").select(name.alias("load_name"), F.lit(FIRST_NUMBER).alias("first_mark"))
    log = table(spark, sf_dir, "orders").select(
        F.concat(F.lit("customer "), F.col("o_custkey").cast("string")).alias("load_name"),
        F.lit("numeric").alias("value_type"),
        F.col("o_orderkey").cast("string").alias("value"),
        F.col("o_orderdate").alias("committed_at"),
        (F.col("o_orderkey") * 7919 % 1000003).alias("committed_seq"),
    )
    return marks_or_default(loads, log)


SHORT_SEGMENT = Contract([
    Column("c_custkey", "bigint", key=True),
    Column("c_name", "nvarchar", length=50),
    Column("c_mktsegment", "nvarchar", length=9),
])
PART = Contract([Column("p_partkey", "bigint", key=True), Column("p_name", "varchar", length=40), Column("p_size", "tinyint")])
SUPPLIER = Contract([Column("s_suppkey", "bigint", key=True), Column("s_name", "varchar"), Column("s_acctbal", "money")])


@query("""SELECT load_name, CAST(read_rows AS BIGINT) AS src_success_rows, CAST(read_rows - bad AS BIGINT) AS tgt_success_rows,
    CAST(bad AS BIGINT) AS tgt_failed_rows, first_error, CAST(read_rows - bad AS BIGINT) AS inserted_rows, 'SUCCEEDED' AS status FROM (
    SELECT 'customer' AS load_name, count(*) AS read_rows, count(*) FILTER (length(c_mktsegment) > 9) AS bad,
           max(CASE WHEN length(c_mktsegment) > 9 THEN 'c_mktsegment: length' END) AS first_error FROM customer
    UNION ALL SELECT 'orders', count(*), 0, NULL FROM orders
    UNION ALL SELECT 'part', count(*), 0, NULL FROM part
    UNION ALL SELECT 'supplier', count(*), 0, NULL FROM supplier)""")
def multi_table_load_stats(spark, sf_dir):
    """Four tables loaded side by side."""
    stage = Stage(spark, new_workdir(spark, "multi"))

    def how(name):
        return (INCREMENT, Delta.constant()) if name == "orders" else (FULL,)

    contracts = {"customer": SHORT_SEGMENT, "orders": ORDERS, "part": PART, "supplier": SUPPLIER}
    specs = [
        LoadSpec(name, contract, lambda s, name=name: table(s, sf_dir, name), *how(name))
        for name, contract in contracts.items()
    ]
    stats = stage.run_all(specs, RUN1)
    return stats.select("load_name", "src_success_rows", "tgt_success_rows", "tgt_failed_rows", "first_error",
                        "inserted_rows", "status")


def changed_events(spark, sf_dir):
    """Events as the source holds them later: early errors have been corrected and stamped
    anew, early views corrected without a new stamp."""
    events = table(spark, sf_dir, "events")
    early = F.col("ts") <= timestamp_literal(EVENT_MARK)
    corrected = early & F.col("event_type").isin("error", "view")
    stamped = early & (F.col("event_type") == "error")
    return events.withColumns({
        "value": F.when(corrected, F.col("value") + 1).otherwise(F.col("value")),
        "ts": F.when(stamped, F.col("ts") + F.expr("INTERVAL 30 DAYS")).otherwise(F.col("ts")),
    })


def early_events(spark, sf_dir):
    return table(spark, sf_dir, "events").where(F.col("ts") <= timestamp_literal(EVENT_MARK))


_EARLY_ERROR = f"(ts <= TIMESTAMP '{EVENT_MARK}' AND event_type = 'error')"
_TWO_RUNS = f"""
    SELECT event_id, CASE WHEN {_EARLY_ERROR} THEN ts + INTERVAL 30 DAY ELSE ts END AS ts, user_id, event_type,
           CASE WHEN {_EARLY_ERROR} THEN value + 1 ELSE value END AS value,
           CASE WHEN ts <= TIMESTAMP '{EVENT_MARK}' THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_CreateDatetime",
           CASE WHEN ts <= TIMESTAMP '{EVENT_MARK}' AND event_type <> 'error' THEN TIMESTAMP '{RUN1}'
                ELSE TIMESTAMP '{RUN2}' END AS "AUD_LastModDatetime",
           CAST(0 AS INTEGER) AS "AUD_isDeleted"
    FROM events"""


@query(_TWO_RUNS)
def incremental_load_two_runs(spark, sf_dir):
    """Rows up to a date, then all later changes: corrected rows update, new ones insert, and a
    correction that kept its old stamp is not seen."""
    stage = Stage(spark, new_workdir(spark, "two-runs"))
    runs = [
        (LoadSpec("events", EVENTS, lambda s: early_events(s, sf_dir), INCREMENT, Delta("ts", "datetime")), RUN1),
        (LoadSpec("events", EVENTS, lambda s: changed_events(s, sf_dir), INCREMENT, Delta("ts", "datetime")), RUN2),
    ]
    for spec, at in runs:
        stage.run(spec, at)
    return stage.target(runs[-1][0])


@query(_TWO_RUNS)
def stream_incremental_merge(spark, sf_dir):
    """The same change set arriving twice as files of a stream that is started anew each time, on a sliced target."""
    folder = new_workdir(spark, "stream")
    target = VersionedTable(spark, f"{folder}/target", EVENTS.target_schema(), slice_by="event_id div 4096")
    target.write(audit_stamp(EVENTS.project(early_events(spark, sf_dir)), RUN1))
    incoming = EVENTS.project(changed_events(spark, sf_dir)).where(F.col("ts") > timestamp_literal(EVENT_MARK))
    viewed = F.col("event_type") == "view"
    for arrival in (incoming.where(viewed), incoming.where(~viewed)):
        arrival.write.mode("append").option("maxRecordsPerFile", 1_000_000).parquet(f"{folder}/incoming")
        stream = read_stream(spark, f"{folder}/incoming", incoming.schema, bytes_per_batch=64 * 2**30)
        start_merge_stream(stream, target, EVENTS, f"{folder}/checkpoint", RUN2, "ts").awaitTermination()
    return target.read()


MONTH_MARK = "1997-06-15 00:00:00.000"
MONTHLY_ORDERS = Contract([
    Column("o_orderkey", "bigint", key=True, nullable=False),
    Column("o_month", "datetime", key=True, nullable=False),
    Column("o_totalprice", "float"),
    Column("changed", "datetime"),
])


@query(f"""SELECT o_orderkey, date_trunc('month', o_orderdate) AS o_month,
    o_totalprice + CASE WHEN early AND o_orderstatus = 'F' THEN 1 ELSE 0 END AS o_totalprice,
    CASE WHEN early AND o_orderstatus = 'F' THEN o_orderdate + INTERVAL 3650 DAY ELSE o_orderdate END AS changed,
    CASE WHEN early THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_CreateDatetime",
    CASE WHEN early AND o_orderstatus <> 'F' THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_LastModDatetime",
    CAST(0 AS INTEGER) AS "AUD_isDeleted"
    FROM (SELECT *, o_orderdate <= TIMESTAMP '{MONTH_MARK}' AS early FROM orders)""")
def merge_sliced_month(spark, sf_dir):
    """A target in slices of months, two delta runs: early orders, then later ones and corrections of the early."""
    orders = table(spark, sf_dir, "orders").withColumn("o_month", F.date_trunc("month", "o_orderdate").cast("timestamp_ntz"))
    early = F.col("o_orderdate") <= timestamp_literal(MONTH_MARK)
    corrected = early & (F.col("o_orderstatus") == "F")
    later = orders.withColumns({
        "changed": F.when(corrected, F.col("o_orderdate") + F.expr("INTERVAL 3650 DAYS")).otherwise(F.col("o_orderdate")),
        "o_totalprice": F.when(corrected, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
    })
    first = orders.where(early).withColumn("changed", F.col("o_orderdate"))
    stage = Stage(spark, new_workdir(spark, "months"))
    for rows, at in ((first, RUN1), (later, RUN2)):
        spec = LoadSpec("orders", MONTHLY_ORDERS, lambda _, rows=rows: rows, INCREMENT, Delta("changed", "datetime"),
                        slice_by="date_trunc('month', o_month)", unique_source=True, closed=True)
        stage.run(spec, at)
    return stage.target(spec)


CHANGING_ORDERS = Contract([
    Column("o_orderkey", "bigint", key=True, nullable=False), Column("o_totalprice", "float"), Column("changed", "datetime")])


_KEY_RANGES = f"""SELECT o_orderkey, o_totalprice + CASE WHEN o_orderkey % 1000 = 5 THEN 1 ELSE 0 END AS o_totalprice,
    CASE WHEN o_orderkey % 1000 = 5 THEN o_orderdate + INTERVAL 9000 DAY ELSE o_orderdate END AS changed,
    CASE WHEN o_orderkey % 1000 < 900 THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_CreateDatetime",
    CASE WHEN o_orderkey % 1000 < 900 AND o_orderkey % 1000 <> 5 THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_LastModDatetime",
    CAST(0 AS INTEGER) AS "AUD_isDeleted" FROM orders"""


def _two_changes(spark, sf_dir, **layout):
    """Nine tenths of the orders, then the others and corrections, as two delta loads of one target."""
    orders = table(spark, sf_dir, "orders").withColumn("changed", F.col("o_orderdate"))
    early, corrected = F.col("o_orderkey") % 1000 < 900, F.col("o_orderkey") % 1000 == 5
    late = F.expr("INTERVAL 9000 DAYS")
    rows = orders.where(~early | corrected).withColumns({
        "changed": F.col("o_orderdate") + late, "o_totalprice": F.when(corrected, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))})
    stage = Stage(spark, new_workdir(spark, "changes"))
    for part, at in ((orders.where(early), RUN1), (rows, RUN2)):
        spec = LoadSpec("orders", CHANGING_ORDERS, lambda _, part=part: part, INCREMENT, Delta("changed", "datetime"), unique_source=True, **layout)
        stage.run(spec, at)
    # New rows carry the stamp that the mark lets through; as they are told: the order's own.
    stamp = F.when(corrected, F.col("changed")).otherwise(F.when(early, F.col("changed")).otherwise(F.col("changed") - late))
    return stage.target(spec).withColumn("changed", stamp)


@query(_KEY_RANGES)
def merge_manifest_delta(spark, sf_dir):
    """A target as files by key range: the second load rewrites the files its keys fall into."""
    return _two_changes(spark, sf_dir, file_rows=100_000)


@query(f"""SELECT c_custkey, c_name, c_acctbal, TIMESTAMP '{RUN1}' AS "AUD_CreateDatetime",
    CASE WHEN c_custkey % 4 = 0 THEN TIMESTAMP '{MERGE_TS}' WHEN c_custkey % 3 = 0 THEN TIMESTAMP '{RUN2}' ELSE TIMESTAMP '{RUN1}' END AS "AUD_LastModDatetime",
    CAST(c_custkey % 4 = 0 AS INTEGER) AS "AUD_isDeleted" FROM (
    SELECT c_custkey, c_name, CAST(c_acctbal + CASE WHEN c_custkey % 4 > 0 AND c_custkey % 3 = 0 THEN 1 ELSE 0 END AS DECIMAL(19,4)) AS c_acctbal FROM customer)""")
def merge_bucketed_snapshot(spark, sf_dir):
    """A target in buckets of its key, merged with a snapshot that lacks a quarter of the customers."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_acctbal")
    later = customers.where("c_custkey % 4 > 0").withColumn(
        "c_acctbal", F.when(F.col("c_custkey") % 3 == 0, F.col("c_acctbal") + 1).otherwise(F.col("c_acctbal")))
    contract = Contract([Column("c_custkey", "bigint", key=True), Column("c_name", "nvarchar", length=50), Column("c_acctbal", "money")])
    stage = Stage(spark, new_workdir(spark, "buckets"))
    for rows, at, merged in ((customers, RUN1, None), (later, RUN2, MERGE_TS)):
        spec = LoadSpec("customer", contract, lambda _, rows=rows: rows, INCREMENT, Delta.constant(), buckets=8)
        stage.run(spec, at, merged)
    return stage.target(spec)


@query("""SELECT 'c_mktsegment: length' AS reject_reason, c_custkey, CAST(2 AS BIGINT) AS times FROM customer WHERE length(c_mktsegment) > 9
    UNION ALL SELECT NULL, c_custkey, CAST(1 AS BIGINT) FROM customer WHERE length(c_mktsegment) <= 9""")
def full_refresh_rejects(spark, sf_dir):
    """A full load run twice: the rows of the target, and how often a row was set aside over both runs."""
    stage = Stage(spark, new_workdir(spark, "refresh"))
    spec = LoadSpec("customer", SHORT_SEGMENT, lambda s: table(s, sf_dir, "customer"), FULL)
    for at in (RUN1, RUN2):
        stage.run(spec, at)
    key = F.get_json_object("raw_row", "$.c_custkey").cast("bigint").alias("c_custkey")
    bad = stage.reject_history(spec).groupBy("reject_reason", key).agg(F.count(F.lit(1)).alias("times"))
    good = stage.target(spec).select(F.lit(None).cast("string").alias("reject_reason"), "c_custkey", F.lit(1).cast("bigint").alias("times"))
    return bad.unionByName(good)


VERSIONED_EVENTS = Contract([
    Column("event_id", "bigint", key=True, nullable=False), Column("event_type", "varchar", length=20), Column("rowver", "rowversion")])


@query(f"""SELECT event_id, CASE WHEN event_id % 10 = 0 THEN 'changed' ELSE event_type END AS event_type,
    '0x' || lpad(hex(CASE WHEN event_id % 10 = 0 THEN event_id + 1000000000 ELSE event_id END), 16, '0') AS rowver,
    CASE WHEN event_id < 5000 THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_CreateDatetime",
    CASE WHEN event_id < 5000 AND event_id % 10 > 0 THEN TIMESTAMP '{RUN1}' ELSE TIMESTAMP '{RUN2}' END AS "AUD_LastModDatetime",
    CAST(0 AS INTEGER) AS "AUD_isDeleted" FROM events WHERE event_id > 0""")
def rowversion_load_two_runs(spark, sf_dir):
    """A load past an eight-byte row version, closed at the highest one there is; a changed row gets a new version."""
    events = table(spark, sf_dir, "events").where("event_id > 0")
    changed = F.col("event_id") % 10 == 0
    later = events.withColumns({
        "event_type": F.when(changed, F.lit("changed")).otherwise(F.col("event_type")),
        "rowver": rowversion.from_number(F.when(changed, F.col("event_id") + 1_000_000_000).otherwise(F.col("event_id")))})
    early = events.where("event_id < 5000").withColumn("rowver", rowversion.from_number(F.col("event_id")))
    stage = Stage(spark, new_workdir(spark, "versions"))
    for rows, at in ((early, RUN1), (later, RUN2)):
        spec = LoadSpec("events", VERSIONED_EVENTS, lambda _, rows=rows: rows, INCREMENT, Delta("rowver", "rowversion"), closed=True)
        stage.run(spec, at)
    return stage.target(spec).withColumn("rowver", rowversion.to_hex_text(F.col("rowver")))


@query("""SELECT load_name, status, CAST(read_rows AS BIGINT) AS src_success_rows, CAST(read_rows AS BIGINT) AS inserted_rows, first_error FROM (
    SELECT 'tpch.customer' AS load_name, 'SUCCEEDED' AS status, count(*) AS read_rows, NULL AS first_error FROM customer
    UNION ALL SELECT 'tpch.orders', 'SUCCEEDED', count(*) FILTER (o_orderkey > 0), NULL FROM orders
    UNION ALL SELECT 'tpch.part', 'SUCCEEDED', count(*) FILTER (p_size > 10), NULL FROM part
    UNION ALL SELECT 'tpch.nation', 'SUCCEEDED', count(*), NULL FROM nation
    UNION ALL SELECT 'tpch.region', 'FAILED', 0, 'no columns in the catalog'
    UNION ALL SELECT 'tpch.supplier', 'FAILED', 0, 'no delta condition')""")
def run_plan_stats(spark, sf_dir):
    """A plan resolved from control tables and run: whole, past a mark, by a condition, as a snapshot; two flows cannot run."""
    kinds = {"customer": "Full", "orders": "Increment", "part": "Increment", "nation": "Increment", "region": "Full", "supplier": "Increment"}
    described = {
        "customer": [("c_custkey", "bigint", 8, 1), ("c_name", "nvarchar", 100, 0)], "orders": [("o_orderkey", "bigint", 8, 1), ("o_orderdate", "datetime", 8, 0)],
        "part": [("p_partkey", "bigint", 8, 1), ("p_size", "int", 4, 0)], "nation": [("n_nationkey", "int", 4, 1), ("n_name", "varchar", 50, 0)],
        "supplier": [("s_suppkey", "bigint", 8, 1)]}
    flows = spark.createDataFrame(
        [(i, "tpch", t, "HOST\\I", "Shop", "stg", "V1", "DWH\\I", "Stage") for i, t in enumerate(kinds)],
        "flow_id long, schema_name string, table_name string, source_server string, source_db string, target_schema string, "
        "generate_version string, target_server string, target_db string")
    config = spark.createDataFrame([("V1", "repo", "f", "o", "m_", 1)], "generate_version string, repository string, folder string, owner string, name_prefix string, created_at int")
    statements = spark.createDataFrame([(10 + i, i, "p_size > 10" if t == "part" else None) for i, t in enumerate(kinds)],
                                       "statement_id long, flow_id long, custom_where string")
    conditions = spark.createDataFrame([(11, "o_orderkey", "numeric"), (13, "1", "integer")], "statement_id long, delta_column string, delta_type string")
    columns = spark.createDataFrame([("tpch", t, p) for t, p in kinds.items()], "schema_name string, table_name string, pattern string")
    catalog = spark.createDataFrame(
        [("tpch", t, n, c, kind, size, None, None, 1 - key, key, None) for t, cs in described.items() for n, (c, kind, size, key) in enumerate(cs)],
        "schema_name string, table_name string, column_id int, column_name string, type_name string, max_length int, precision int, scale int, "
        "is_nullable int, is_pk int, target_column string")
    plan = load_plan(flows, statements, conditions, columns, config)
    stage = Stage(spark, new_workdir(spark, "plan"))
    stats = run_plan(stage, plan, catalog, lambda entry: lambda s: table(s, sf_dir, entry.table_name), RUN1)
    return stats.select("load_name", "status", "src_success_rows", "inserted_rows", "first_error")


DECIMAL_LINES = Contract([
    Column("l_orderkey", "bigint"), Column("l_linenumber", "int"), Column("l_quantity", "float"),
    Column("version", "decimal", precision=20, scale=12),
])
DECIMAL_MARK = "1000.000000000003"


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def append_decimal_mark(spark, sf_dir):
    """Rows appended past a mark of twelve decimals, in two runs and one more that finds nothing: each is there once."""
    version = F.concat_ws(".", F.col("l_orderkey").cast("string"), F.lpad(F.col("l_linenumber").cast("string"), 12, "0"))
    lines = table(spark, sf_dir, "lineitem").withColumn("version", version.cast("decimal(20,12)"))
    first = lines.where(F.col("version") <= F.lit(DECIMAL_MARK).cast("decimal(20,12)"))
    stage = Stage(spark, new_workdir(spark, "decimals"))
    for rows, at in ((first, RUN1), (lines, RUN2), (lines, RUN2)):
        spec = LoadSpec("lines", DECIMAL_LINES, lambda _, rows=rows: rows, APPEND, Delta("version"))
        stage.run(spec, at)
    return stage.target(spec).drop("version")
