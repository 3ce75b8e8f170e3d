"""Scans, extracts and expressions (S and P operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.contract import Column, Contract
from tidemark.functions import rowversion, text
from tidemark.operators.merge import audit_stamp
from tidemark.operators.quality import accepted, classify, rejected
from tidemark.registry.common import EVENT_MARK, RUN1, SOURCE_ORDERS, registry, source_orders, table
from tidemark.sources.extract import Delta, extract, source_mark, sql_override
from tidemark.sources.readers import inline_rows, read_files

QUERIES, ORACLES, query = registry()

CUSTOMER = Contract([
    Column("c_custkey", "bigint", key=True, nullable=False),
    Column("c_name", "nvarchar", length=50),
    Column("c_nationkey", "int"),
    Column("c_mktsegment", "nvarchar", length=20),
])
EVENTS = Contract([
    Column("event_id", "bigint", key=True, nullable=False),
    Column("ts", "datetime"),
    Column("user_id", "bigint"),
    Column("event_type", "varchar", length=20),
    Column("value", "float"),
])
ORDERS = Contract([
    Column("o_orderkey", "bigint", key=True, nullable=False),
    Column("o_custkey", "bigint"),
    Column("o_orderstatus", "char", length=1),
    Column("o_totalprice", "float"),
    Column("o_orderdate", "datetime"),
    Column("o_orderpriority", "varchar", length=15),
])


# --- extracts -------------------------------------------------------------

@query("SELECT c_custkey, c_name, c_nationkey, c_mktsegment FROM customer")
def source_scan_full(spark, sf_dir):
    return extract(read_files(spark, f"{sf_dir}/customer.parquet"), CUSTOMER)


@query(f"""SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts > strptime('{EVENT_MARK}', '%Y-%m-%d %H:%M:%S.%g')""")
def extract_by_datetime(spark, sf_dir):
    return extract(table(spark, sf_dir, "events"), EVENTS, delta=Delta("ts", "datetime"), mark=EVENT_MARK)


@query("""SELECT event_id, ts, user_id, event_type, value FROM events
    WHERE ts > strptime(substr('2024-01-15 00:00:00.000999', 1, 23), '%Y-%m-%d %H:%M:%S.%g')""")
def extract_by_datetime_text(spark, sf_dir):
    """The mark given as text with milliseconds, parsed in the condition itself."""
    mark = text.style_121(F.substring(F.lit("2024-01-15 00:00:00.000999"), 1, 23))
    return EVENTS.project(table(spark, sf_dir, "events").where(F.col("ts") > mark))


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderkey > 7500""")
def extract_by_id(spark, sf_dir):
    return extract(table(spark, sf_dir, "orders"), ORDERS, delta=Delta("o_orderkey"), mark="7500")


@query("""SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE o_orderstatus = 'F' AND o_totalprice > 100000""")
def extract_custom_where(spark, sf_dir):
    return extract(table(spark, sf_dir, "orders"), ORDERS, delta=Delta("o_orderkey"), mark="7500",
                   where="o_orderstatus = 'F' AND o_totalprice > 100000")


@query("""SELECT 1 AS run, s_suppkey, s_name, s_nationkey FROM supplier WHERE 1 > 0
    UNION ALL SELECT 2 AS run, s_suppkey, s_name, s_nationkey FROM supplier WHERE 1 > 1""")
def extract_constant_delta(spark, sf_dir):
    """No usable delta column: the first run reads everything, the second nothing."""
    supplier = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    first = extract(supplier, delta=Delta.constant(), mark="0")
    second = extract(supplier, delta=Delta.constant(), mark="1")
    return first.select(F.lit(1).alias("run"), "*").unionAll(second.select(F.lit(2).alias("run"), "*"))


def versioned_events(spark, sf_dir):
    return table(spark, sf_dir, "events").withColumn("rowver", rowversion.from_number(F.col("event_id")))


@query("""SELECT event_id, '0x' || lpad(hex(event_id), 16, '0') AS rowver_hex, event_id AS rowver_number,
    CAST(event_id AS INTEGER) AS rowver_int, event_type AS raw_text, '0x' || hex(encode(event_type)) AS raw_hex
    FROM events WHERE unhex(lpad(hex(event_id), 16, '0')) > unhex('0000000000001388')""")
def extract_by_rowversion(spark, sf_dir):
    rows = extract(versioned_events(spark, sf_dir), delta=Delta("rowver", "rowversion"), mark="0x1388")
    raw = F.encode("event_type", "UTF-8")
    return rows.select(
        "event_id",
        rowversion.to_hex_text(F.col("rowver")).alias("rowver_hex"),
        rowversion.to_bigint(F.col("rowver")).alias("rowver_number"),
        rowversion.to_int(F.col("rowver")).alias("rowver_int"),
        rowversion.to_text(raw).alias("raw_text"),
        rowversion.to_hex_text(raw).alias("raw_hex"),
    )


@query("""SELECT event_id, event_type, hex(rv) AS rowver_hex
    FROM (SELECT *, unhex(lpad(hex(event_id), 16, '0')) AS rv FROM events)
    WHERE rv > unhex('0000000000001388')
      AND rv <= (SELECT max(unhex(lpad(hex(event_id), 16, '0'))) FROM events WHERE ts <= TIMESTAMP '2024-01-25 00:00:00')""")
def rowversion_window(spark, sf_dir):
    """Rows between the stored mark and the highest version the source held when the run began."""
    delta = Delta("rowver", "rowversion")
    events = versioned_events(spark, sf_dir)
    at_start = events.where(F.col("ts") <= text.timestamp_literal("2024-01-25 00:00:00"))
    upper = source_mark(at_start, delta) or delta.first_mark
    return extract(events, delta=delta, mark="0x1388", upper=upper).select(
        "event_id", "event_type", F.hex("rowver").alias("rowver_hex"))


@query("""SELECT v.code, v.rank, CAST(count(*) AS BIGINT) AS orders
    FROM (VALUES ('1-URGENT', 1), ('2-HIGH', 2), ('3-MEDIUM', 3), ('9-NONE', 4)) v(code, rank)
    JOIN orders ON o_orderpriority = v.code GROUP BY ALL""")
def values_source(spark, sf_dir):
    """Rows written in the program, used against a table."""
    codes = inline_rows(spark, ["code", "rank"], [("1-URGENT", 1), ("2-HIGH", 2), ("3-MEDIUM", 3), ("9-NONE", 4)],
                        ["string", "int"])
    per_code = table(spark, sf_dir, "orders").groupBy(F.col("o_orderpriority").alias("code")).agg(
        F.count(F.lit(1)).alias("orders"))
    return codes.join(per_code, "code").select("code", "rank", "orders")


@query("""SELECT o_orderkey, o_totalprice, c_name FROM orders JOIN customer ON o_custkey = c_custkey
    WHERE c_mktsegment = 'BUILDING'""")
def extract_sql_override(spark, sf_dir):
    return sql_override(
        spark,
        """SELECT o_orderkey, o_totalprice, c_name FROM {orders} JOIN {customer} ON o_custkey = c_custkey
           WHERE c_mktsegment = 'BUILDING'""",
        orders=table(spark, sf_dir, "orders"), customer=table(spark, sf_dir, "customer"))


@query("""SELECT o_orderkey, o_orderdate, c_name AS customer_name FROM orders JOIN customer
    ON o_custkey = c_custkey AND c_acctbal > 0 WHERE o_orderkey > 7500""")
def extract_with_join(spark, sf_dir):
    contract = Contract([
        Column("o_orderkey", "bigint", key=True),
        Column("o_orderdate", "datetime"),
        Column("customer_name", "nvarchar", source="c_name"),
    ])
    on = (F.col("o_custkey") == F.col("c_custkey")) & (F.col("c_acctbal") > 0)
    return extract(table(spark, sf_dir, "orders"), contract, delta=Delta("o_orderkey"), mark="7500",
                   join=(table(spark, sf_dir, "customer"), on))


@query("SELECT DISTINCT o_orderstatus, o_orderpriority FROM orders")
def extract_distinct(spark, sf_dir):
    contract = Contract([Column("o_orderstatus", "char"), Column("o_orderpriority", "varchar")])
    return extract(table(spark, sf_dir, "orders"), contract, distinct=True)


@query("""SELECT o_orderstatus, o_orderpriority, o_orderkey, o_orderdate FROM orders
    ORDER BY o_orderstatus, o_orderpriority""")
def extract_sorted(spark, sf_dir):
    contract = Contract([
        Column("o_orderstatus", "char"), Column("o_orderpriority", "varchar"),
        Column("o_orderkey", "bigint", key=True), Column("o_orderdate", "datetime"),
    ])
    return extract(table(spark, sf_dir, "orders"), contract, sorted_columns=2)


# --- projections and expressions ------------------------------------------

@query("""SELECT c_custkey AS "ID", c_name AS "CustomerName", c_mktsegment AS "Segment" FROM customer""")
def project_rename(spark, sf_dir):
    contract = Contract([
        Column("ID", "bigint", key=True, source="c_custkey"),
        Column("CustomerName", "nvarchar", source="c_name"),
        Column("Segment", "nvarchar", source="c_mktsegment"),
        Column("AUD_isDeleted", "bit"),
    ])
    return contract.project(table(spark, sf_dir, "customer"))


@query(f"""SELECT c_custkey, c_name, c_nationkey, c_mktsegment, TIMESTAMP '{RUN1}' AS "AUD_CreateDatetime",
    TIMESTAMP '{RUN1}' AS "AUD_LastModDatetime", CAST(0 AS INTEGER) AS "AUD_isDeleted" FROM customer""", name="audit_stamp")
def audit_columns(spark, sf_dir):
    return audit_stamp(CUSTOMER.project(table(spark, sf_dir, "customer")), RUN1)


@query("""SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts_text,
    substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, 23) AS ts_millis FROM events""")
def format_delta_text(spark, sf_dir):
    ts = text.mark_text(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", ts.alias("ts_text"), F.substring(ts, 1, 23).alias("ts_millis"))


@query("""SELECT event_id, strptime(substr(strftime(ts, '%Y-%m-%d %H:%M:%S.%f'), 1, 23), '%Y-%m-%d %H:%M:%S.%g') AS ts_millis
    FROM events""")
def parse_delta_text(spark, sf_dir):
    millis = F.substring(text.mark_text(F.col("ts")), 1, 23)
    return table(spark, sf_dir, "events").select("event_id", text.style_121(millis).alias("ts_millis"))


@query("""SELECT o_orderkey, CAST(o_custkey AS INTEGER) AS cust, CAST(o_totalprice AS DECIMAL(19, 4)) AS price,
    CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS order_day, CAST(month(o_orderdate) AS SMALLINT) AS order_month,
    CAST(year(o_orderdate) AS SMALLINT) AS order_year, CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END AS finished,
    lpad(hex(o_orderkey), 16, '0') AS version_hex FROM orders""")
def contract_cast(spark, sf_dir):
    """Every conversion a contract can ask for: narrower ints, money, date to datetime, bit from text, row version."""
    contract = Contract([
        Column("o_orderkey", "bigint", key=True),
        Column("cust", "int", source="o_custkey"),
        Column("price", "money", source="o_totalprice"),
        Column("order_day", "date"),
        Column("order_month", "tinyint"),
        Column("order_year", "smallint"),
        Column("finished", "bit"),
        Column("version", "timestamp", source="o_orderkey"),
    ])
    raw = table(spark, sf_dir, "orders").withColumns({
        "order_day": F.to_date("o_orderdate"),
        "order_month": F.date_format("o_orderdate", "M"),
        "order_year": F.year("o_orderdate"),
        "finished": F.when(F.col("o_orderstatus") == "F", "1").otherwise("0"),
    })
    cast = contract.cast(contract.project(raw))
    return cast.withColumn("version_hex", F.hex("version")).drop("version")


RAW_CUSTOMER = Contract([
    Column("c_custkey", "bigint", key=True, nullable=False),
    Column("c_nationkey", "tinyint", nullable=False),
    Column("c_mktsegment", "nvarchar", length=9),
    Column("c_acctbal", "decimal", precision=6, scale=2),
    Column("credit", "int"),
])


def raw_customer(spark, sf_dir):
    """Customers as text, the way a careless source might send them."""
    balance = F.col("c_acctbal").cast("decimal(12,2)").cast("string")
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(F.col("c_nationkey") != 7, F.when(F.col("c_nationkey") == 9, F.lit(300)).otherwise(F.col("c_nationkey"))).alias("c_nationkey"),
        "c_mktsegment",
        F.when(F.col("c_nationkey") == 5, F.concat(F.lit("9"), F.regexp_replace(balance, "^-", ""))).otherwise(balance).alias("c_acctbal"),
        F.when(F.col("c_nationkey") == 3, F.lit("n/a")).otherwise(F.col("c_nationkey").cast("string")).alias("credit"),
    )


_RAW_CUSTOMER = """
    SELECT c_custkey, CASE WHEN c_nationkey = 7 THEN NULL WHEN c_nationkey = 9 THEN 300 ELSE c_nationkey END AS nation,
           c_mktsegment,
           CASE WHEN c_nationkey = 5 THEN '9' || ltrim(CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR), '-')
                ELSE CAST(CAST(c_acctbal AS DECIMAL(12, 2)) AS VARCHAR) END AS balance,
           CASE WHEN c_nationkey = 3 THEN 'n/a' ELSE CAST(c_nationkey AS VARCHAR) END AS credit
    FROM customer"""
_REASON = """
    CASE WHEN nation IS NULL THEN 'c_nationkey: not null'
         WHEN nation NOT BETWEEN 0 AND 255 THEN 'c_nationkey: range'
         WHEN length(c_mktsegment) > 9 THEN 'c_mktsegment: length'
         WHEN TRY_CAST(balance AS DECIMAL(6, 2)) IS NULL THEN 'c_acctbal: precision'
         WHEN TRY_CAST(credit AS INTEGER) IS NULL THEN 'credit: conversion' END"""


@query(f"""SELECT c_custkey, CAST(nation AS SMALLINT) AS c_nationkey, c_mktsegment,
    CAST(balance AS DECIMAL(6, 2)) AS c_acctbal, CAST(credit AS INTEGER) AS credit
    FROM (SELECT *, {_REASON} AS reason FROM ({_RAW_CUSTOMER})) WHERE reason IS NULL""")
def accepted_rows(spark, sf_dir):
    return accepted(classify(raw_customer(spark, sf_dir), RAW_CUSTOMER))


@query(f"""SELECT reject_reason, c_custkey, credit FROM
    (SELECT {_REASON} AS reject_reason, c_custkey, credit FROM ({_RAW_CUSTOMER})) WHERE reject_reason IS NOT NULL""")
def reject_rows(spark, sf_dir):
    bad = rejected(classify(raw_customer(spark, sf_dir), RAW_CUSTOMER))
    row = F.from_json("raw_row", "c_custkey bigint, credit string")
    return bad.select("reject_reason", row["c_custkey"].alias("c_custkey"), row["credit"].alias("credit"))


@query(f"""SELECT o_orderkey, CASE WHEN o_orderstatus IS NULL THEN 'unknown' WHEN o_orderstatus IN ('F', 'P') THEN 'known'
    ELSE 'open' END AS status_group, CAST(CASE WHEN o_orderstatus IS NOT NULL THEN 1 ELSE 0 END AS INTEGER) AS has_status
    FROM ({SOURCE_ORDERS})""")
def scalar_case(spark, sf_dir):
    status = F.col("o_orderstatus")
    return source_orders(spark, sf_dir).select(
        "o_orderkey",
        F.when(status.isNull(), "unknown").when(status.isin("F", "P"), "known").otherwise("open").alias("status_group"),
        F.when(status.isNotNull(), 1).otherwise(0).alias("has_status"),
    )


@query("""SELECT c_custkey, CASE WHEN strpos(c_name, '#') > 0 THEN split_part(c_name, '#', 1) ELSE '' END AS before_hash,
    CASE WHEN strpos(c_mktsegment, 'I') > 0 THEN split_part(c_mktsegment, 'I', 1) ELSE '' END AS before_i FROM customer""")
def prefix_before(spark, sf_dir):
    return table(spark, sf_dir, "customer").select(
        "c_custkey",
        text.prefix_before(F.col("c_name"), "#").alias("before_hash"),
        text.prefix_before(F.col("c_mktsegment"), "I").alias("before_i"),
    )


@query(f"SELECT o_orderkey, 'status=' || o_orderstatus || ';' || o_orderpriority AS label FROM ({SOURCE_ORDERS})")
def concat_nulls(spark, sf_dir):
    """A NULL part makes the whole text NULL."""
    return source_orders(spark, sf_dir).select(
        "o_orderkey", F.concat(F.lit("status="), "o_orderstatus", F.lit(";"), "o_orderpriority").alias("label"))


_AUDIT_LIKE = "CASE WHEN c_mktsegment = 'BUILDING' THEN 'AUD_' WHEN c_mktsegment = 'MACHINERY' THEN 'AUDIT' ELSE '' END || c_name"


@query(f"""SELECT c_custkey, {_AUDIT_LIKE} AS column_name FROM customer
    WHERE {_AUDIT_LIKE} LIKE 'AUD$_%' ESCAPE '$' AND {_AUDIT_LIKE} NOT LIKE '%9'""")
def like_filter(spark, sf_dir):
    """Names that begin with the audit prefix, its underscore taken literally."""
    name = F.concat(
        F.when(F.col("c_mktsegment") == "BUILDING", "AUD_").when(F.col("c_mktsegment") == "MACHINERY", "AUDIT").otherwise(""),
        F.col("c_name"))
    named = table(spark, sf_dir, "customer").select("c_custkey", name.alias("column_name"))
    return named.where(text.like_prefix(F.col("column_name"), "AUD_") & ~F.col("column_name").like("%9"))


@query(r"SELECT p_partkey, replace(p_name || ';' || p_type, ';', '\;') AS escaped FROM part")
def replace_text(spark, sf_dir):
    joined = F.concat("p_name", F.lit(";"), "p_type")
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.replace(joined, F.lit(";"), F.lit(r"\;")).alias("escaped"))


@query(f"SELECT o_orderkey, TIMESTAMP '{RUN1}' AS run_ts FROM orders")
def run_timestamp(spark, sf_dir):
    """One clock value for the whole run, the same in every row."""
    return table(spark, sf_dir, "orders").select("o_orderkey", text.timestamp_literal(RUN1).alias("run_ts"))


@query("SELECT p_partkey, CAST(length(rtrim(p_name || '  ')) AS INTEGER) AS name_length FROM part")
def text_length(spark, sf_dir):
    padded = F.concat("p_name", F.lit("  "))
    return table(spark, sf_dir, "part").select("p_partkey", text.text_length(padded).alias("name_length"))


@query("SELECT p_partkey, CAST(p_partkey AS VARCHAR) AS key_text, 'v' || CAST(p_size AS VARCHAR) AS size_label FROM part")
def number_to_text(spark, sf_dir):
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        F.col("p_partkey").cast("string").alias("key_text"),
        F.concat(F.lit("v"), F.col("p_size").cast("string")).alias("size_label"),
    )


@query(f"""SELECT o_orderkey, coalesce(CASE WHEN o_orderstatus = 'F' THEN o_orderdate END, TIMESTAMP '{RUN1}') AS created_at
    FROM orders""")
def default_fill(spark, sf_dir):
    """A column left out by the source takes the time of the run."""
    known = F.when(F.col("o_orderstatus") == "F", F.col("o_orderdate"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", text.default_fill(known, text.timestamp_literal(RUN1)).alias("created_at"))
