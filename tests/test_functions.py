"""Expressions, contracts, extracts and readers."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import Column, Contract, is_audit
from tidemark.functions import rowversion, text
from tidemark.operators.joins import update_from
from tidemark.operators.quality import classify
from tidemark.plans.control import described, load_plan, runnable
from tidemark.plans.marks import highest
from tidemark.sources.extract import Delta, extract, run_hook, source_mark
from tidemark.sources.readers import jdbc_options


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("number", [0, 1, 0x4652, 2**31, 2**63 - 1, -1, -(2**63)])
def test_rowversion_round_trip(spark, number):
    version = rowversion.from_number(F.lit(number))
    assert one(spark, version) == (number % 2**64).to_bytes(8, "big")
    assert one(spark, rowversion.to_bigint(version)) == number
    low = number % 2**32
    assert one(spark, rowversion.to_int(version)) == (low - 2**32 if low >= 2**31 else low)


def test_rowversion_text(spark):
    assert one(spark, rowversion.to_hex_text(rowversion.literal("0x4652"))) == "0x0000000000004652"
    phrase = F.unhex(F.lit("5468697320697320612074657374"))
    assert one(spark, rowversion.to_text(phrase)) == "This is a test"


def test_rowversions_order_as_unsigned(spark):
    low, high = rowversion.literal("0x7FFFFFFFFFFFFFFF"), rowversion.literal("0x8000000000000000")
    assert one(spark, high > low) is True


@pytest.mark.parametrize("value, want", [("HOST\\INST", "HOST"), ("HOST", ""), ("\\X", ""), (None, ""), ("A\\B\\C", "A")])
def test_prefix_before(spark, value, want):
    assert one(spark, text.prefix_before(F.lit(value).cast("string"), "\\")) == want


@pytest.mark.parametrize("server, db, want", [
    ("HOST\\I", "DB", "SQL_HOST_DB"), ("HOST", "DB", "SQL__DB"), (None, "DB", "SQL__DB"), ("HOST\\I", None, None)])
def test_server_label(spark, server, db, want):
    label = text.server_label(F.lit(server).cast("string"), F.lit(db).cast("string"))
    assert one(spark, label) == want


@pytest.mark.parametrize("value, want", [("ab  ", 2), ("  ab", 4), ("", 0), ("   ", 0), ("a\t", 2)])
def test_text_length_ignores_trailing_blanks(spark, value, want):
    assert one(spark, text.text_length(F.lit(value))) == want


def test_audit_prefix_is_literal(spark):
    assert is_audit("AUD_isDeleted") and not is_audit("AUDIT") and not is_audit("aud_x")
    names = spark.createDataFrame([("AUD_x",), ("AUDIT",), ("xAUD_",)], "n string")
    assert [r.n for r in names.where(text.like_prefix(F.col("n"), "AUD_")).collect()] == ["AUD_x"]


def test_style_121_and_mark_text(spark):
    assert one(spark, text.style_121(F.lit("2024-01-15 10:20:30.123"))) == dt.datetime(2024, 1, 15, 10, 20, 30, 123000)
    moment = text.timestamp_literal("2024-01-15 10:20:30.000007")
    assert one(spark, text.mark_text(moment)) == "2024-01-15 10:20:30.000007"


def test_contract_refuses_bad_declarations():
    with pytest.raises(ValueError, match="invalid decimal"):
        Column("x", "decimal", precision=2, scale=4)
    with pytest.raises(ValueError, match="unknown type"):
        Column("x", "geography")
    with pytest.raises(ValueError, match="repeated"):
        Contract([Column("x", "int"), Column("x", "int")])


def test_contract_scan_skips_audit_columns_and_keeps_order(spark):
    contract = Contract([Column("b", "int"), Column("AUD_x", "bit"), Column("A", "int", source="a")])
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, AUD_x int")
    assert contract.project(df).columns == ["b", "A"]
    assert tuple(contract.project(df).first()) == (2, 1)


@pytest.mark.parametrize("type_name, source, value, want", [
    ("bigint", "string", "9007199254740993", 9007199254740993),
    ("tinyint", "string", "255", 255),
    ("bit", "string", "1", 1),
    ("bit", "boolean", True, 1),
    ("money", "double", 1.25, "1.2500"),
    ("date", "date", dt.date(2024, 2, 3), dt.datetime(2024, 2, 3)),
    ("datetime", "string", "2024-02-03 04:05:06.789", dt.datetime(2024, 2, 3, 4, 5, 6, 789000)),
    ("timestamp", "long", 10, bytes([0] * 7 + [10])),
    ("timestamp", "string", "0x000000000000000A", bytes([0] * 7 + [10])),
    ("uniqueidentifier", "string", "{ABC}", "{ABC}"),
])
def test_conversions(spark, type_name, source, value, want):
    contract = Contract([Column("v", type_name)])
    df = spark.createDataFrame([(value,)], f"v {source}")
    got = contract.cast(df).first()["v"]
    assert (str(got) if type_name == "money" else got) == want
    row = classify(df, contract).first()
    assert row["v"] == got and row["reject_reason"] is None


def test_strict_cast_fails_the_job(spark):
    df = spark.createDataFrame([("x",)], "v string")
    for ansi in ("true", "false"):
        spark.conf.set("spark.sql.ansi.enabled", ansi)
        try:
            with pytest.raises(PySparkException, match="v: a value cannot be converted to int"):
                Contract([Column("v", "int")]).cast(df).collect()
        finally:
            spark.conf.unset("spark.sql.ansi.enabled")


@pytest.mark.parametrize("column, source, value, reason", [
    (Column("v", "int", nullable=False), "string", None, "v: not null"),
    (Column("v", "int", key=True), "int", None, "v: not null"),
    (Column("v", "int"), "string", "1x", "v: conversion"),
    (Column("v", "int"), "long", 2**40, "v: conversion"),
    (Column("v", "tinyint"), "int", 256, "v: range"),
    (Column("v", "tinyint"), "int", -1, "v: range"),
    (Column("v", "bit"), "string", "2", "v: range"),
    (Column("v", "nvarchar", length=3), "string", "abcd", "v: length"),
    (Column("v", "nvarchar", length=3), "string", "äöü", None),
    (Column("v", "decimal", precision=5, scale=2), "string", "1234.5", "v: precision"),
    (Column("v", "decimal", precision=5, scale=2), "double", 1234.5, "v: precision"),
    (Column("v", "decimal", precision=5, scale=2), "string", "abc", "v: conversion"),
    (Column("v", "timestamp"), "string", "0xZZ", "v: conversion"),
    (Column("v", "datetime"), "string", "2024-13-01", "v: conversion"),
    (Column("v", "datetime"), "string", None, None),
])
def test_broken_rules(spark, column, source, value, reason):
    df = spark.createDataFrame([(value,)], T.StructType([T.StructField("v", T._parse_datatype_string(source))]))
    row = classify(df, Contract([column])).first()
    assert row["reject_reason"] == reason
    assert (row["raw_row"] is None) == (reason is None)


def test_first_broken_column_is_the_reason(spark):
    df = spark.createDataFrame([("x", "toolong")], "a string, b string")
    contract = Contract([Column("a", "int"), Column("b", "varchar", length=3)])
    assert classify(df, contract).first()["reject_reason"] == "a: conversion"


def test_window_is_open_below_and_closed_above(spark):
    df = spark.range(10)
    got = extract(df, delta=Delta("id"), mark="3", upper="6")
    assert [r.id for r in got.collect()] == [4, 5, 6]
    assert source_mark(df, Delta("id")) == "9"
    assert source_mark(df.limit(0), Delta("id")) is None


def test_where_outranks_the_mark(spark):
    got = extract(spark.range(10), delta=Delta("id"), mark="8", where="id < 2")
    assert [r.id for r in got.collect()] == [0, 1]


def test_decimal_delta(spark):
    df = spark.sql("SELECT CAST(v AS DECIMAL(10,2)) v FROM VALUES (1.50), (1.75), (NULL) t(v)")
    assert [str(r.v) for r in extract(df, delta=Delta("v"), mark="1.50").collect()] == ["1.75"]
    assert highest(df, Delta("v"), "1.50").first()["mark"] == "1.75"


def test_highest_keeps_the_old_mark(spark):
    empty = spark.range(0)
    assert highest(empty, Delta("id"), "7").first()["mark"] == "7"
    assert highest(spark.range(5), Delta("id"), "7").first()["mark"] == "7"


def test_big_ids_stay_exact(spark):
    df = spark.createDataFrame([(2**53,), (2**53 + 1,)], "id long")
    assert highest(df, Delta("id")).first()["mark"] == str(2**53 + 1)
    assert extract(df, delta=Delta("id"), mark=str(2**53)).count() == 1


def test_jdbc_options():
    plain = jdbc_options("jdbc:x", "dbo.t")
    assert plain["dbtable"] == "dbo.t" and "numPartitions" not in plain
    ranged = jdbc_options("jdbc:x", "dbo.t", partition_column="id", lower=0, upper=100, partitions=8)
    assert (ranged["partitionColumn"], ranged["lowerBound"], ranged["upperBound"], ranged["numPartitions"]) == ("id", "0", "100", "8")
    assert jdbc_options("jdbc:x", "t", query="select 1 a")["dbtable"] == "(select 1 a) src"
    with pytest.raises(ValueError):
        jdbc_options("jdbc:x", "t", partition_column="id")


def test_hooks(spark):
    run_hook(spark, "CREATE OR REPLACE TEMP VIEW hooked AS SELECT 7 AS v")
    assert spark.table("hooked").first()["v"] == 7
    run_hook(spark, lambda s: s.catalog.dropTempView("hooked"))
    run_hook(spark, None)
    assert not spark.catalog.tableExists("hooked")


def test_update_from_sees_old_values(spark):
    target = spark.createDataFrame([(1, 10), (2, 20), (None, 30)], "k int, v int")
    updates = spark.createDataFrame([(1, 5), (None, 9)], "k int, add int")
    got = update_from(target, updates, ["k"], {"v": F.col("v") + F.col("add")})
    assert sorted(map(tuple, got.collect()), key=str) == [(1, 15), (2, 20), (None, 30)]


@pytest.fixture
def control(spark):
    flows = spark.createDataFrame(
        [(1, "s", "a", "H\\I", "D", "stg"), (2, "s", "b", "H\\I", "D", "stg"), (3, "s", "c", "H\\I", "D", "stg"), (4, "s", "zz", "H", "D", "stg")],
        "flow_id long, schema_name string, table_name string, source_server string, source_db string, target_schema string")
    columns = spark.createDataFrame([("s", "a", "Full"), ("s", "a", "Full"), ("s", "b", "Increment"), ("s", "c", "Increment")],
                                    "schema_name string, table_name string, pattern string")
    statements = spark.createDataFrame([(10, 2, None), (11, 3, None)], "statement_id long, flow_id long, custom_where string")
    conditions = spark.createDataFrame([(10, "ts", "datetime")], "statement_id long, delta_column string, delta_type string")
    return flows, statements, conditions, columns


def test_load_plan(control):
    rows = {r.table_name: r for r in load_plan(*control).collect()}
    assert set(rows) == {"a", "b", "c"}
    assert (rows["a"].target_name, rows["a"].source_filter, rows["a"].problem) == ("stg.a", "", None)
    assert (rows["b"].target_name, rows["b"].source_filter) == ("stg.b_diff", "ts > timestamp_ntz'$last_ts'")
    assert rows["c"].problem == "no delta condition"
    assert sorted(r.table_name for r in described(control[0], control[3]).collect()) == ["a", "b", "c"]


def versioned(spark, control):
    """Table a in three versions, b in one that lacks its owner, c in one without a configuration."""
    listed = [("a", "V1"), ("a", "V2"), ("a", "V0"), ("b", "V3"), ("c", "none")]
    flows = spark.createDataFrame(
        [(i, "s", t, "H\\I", "D", "stg", v, "T\\I", "W") for i, (t, v) in enumerate(listed)],
        "flow_id long, schema_name string, table_name string, source_server string, source_db string, target_schema string, "
        "generate_version string, target_server string, target_db string")
    config = spark.createDataFrame(
        [("V1", "repo", "f", "o", "m_", 1), ("V2", "repo", "f", "o", "n_", 5), ("V0", "repo", "f", "o", "z_", 3), ("V3", "repo", "f", None, "m_", 9)],
        "generate_version string, repository string, folder string, owner string, name_prefix string, created_at int")
    return (flows, *control[1:], config)


def test_one_version_of_a_flow_counts(spark, control):
    rows = {r.table_name: r for r in load_plan(*versioned(spark, control)).collect()}
    assert (rows["a"].flow_id, rows["a"].generate_version, rows["a"].target_label, rows["a"].load_name) == (1, "V2", "SQL_T_W", "n_a")
    assert rows["a"].problem is None and rows["b"].problem == rows["c"].problem == "no configuration"
    asked = load_plan(*versioned(spark, control), version="V0").collect()
    assert [(r.flow_id, r.load_name, r.problem) for r in asked] == [(2, "z_a", None)]
    assert load_plan(*versioned(spark, control), version="V7").collect() == []


def test_runnable_stops_on_a_problem(control):
    plan = load_plan(*control)
    assert runnable(plan.where("table_name = 'a'")).count() == 1
    with pytest.raises(PySparkException, match="load of s.c: no delta condition"):
        runnable(plan).collect()


@pytest.mark.parametrize("column, source, value, reason", [
    (Column("v", "decimal", precision=6, scale=2), "string", "12.3456", "v: precision"),
    (Column("v", "decimal", precision=6, scale=2), "string", "12.340", None),
    (Column("v", "decimal", precision=6, scale=2), "double", 0.1, None),
    (Column("v", "decimal", precision=6, scale=2), "double", 0.125, "v: precision"),
    (Column("v", "money"), "string", "1.00009", "v: precision"),
    (Column("v", "int"), "double", 1.9, "v: precision"),
    (Column("v", "int"), "double", -2.0, None),
    (Column("v", "int"), "string", " 7 ", None),
    (Column("v", "bigint"), "string", "123456789012345678", None),
    (Column("v", "decimal", precision=38, scale=0), "string", "99999999999999999999999999999999999999", None),
    (Column("v", "float"), "string", "0.1", None),
])
def test_numbers_that_lose_digits_are_set_aside(spark, column, source, value, reason):
    rows = spark.createDataFrame([(value,), (None,)], f"v {source}")
    got = [r[0] for r in classify(rows, Contract([column])).select("reject_reason").collect()]
    assert got == [reason, None]


@pytest.mark.parametrize("limit, want", [("10MB", 10 * 2**20), ("1t", 2**40), ("-1", -1)])
def test_broadcast_limit(spark, limit, want):
    from tidemark.operators.merge import broadcast_limit
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
    try:
        assert broadcast_limit(spark) == want
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.mark.parametrize("kind, source, value, want", [
    ("time", "string", "7:05:09.25", "07:05:09.250000"), ("time", "string", "25:00:00", "c: conversion"), ("time", "string", None, None),
    ("time", "timestamp_ntz", dt.datetime(2024, 1, 2, 3, 4, 5, 6), "03:04:05.000006"),
    ("varbinary", "string", "0x0aFF", b"\x0a\xff"), ("varbinary", "string", "zz", "c: conversion"), ("varbinary", "binary", b"12345", "c: length"),
    ("rowversion", "bigint", 258, b"\0\0\0\0\0\0\1\2"), ("xml", "string", "<a/>", "<a/>"),
    ("datetimeoffset", "string", "2024-01-01 10:00:00 +02:00", "2024-01-01 08:00:00"), ("datetimeoffset", "string", "never", "c: conversion")])
def test_further_types(spark, kind, source, value, want):
    contract = Contract([Column("c", kind, length=4 if kind == "varbinary" else None)])
    row = classify(spark.createDataFrame([(value,)], f"c {source}"), contract).first()
    got = row.reject_reason or row.c
    if kind == "datetimeoffset" and row.reject_reason is None:
        got = classify(spark.createDataFrame([(value,)], f"c {source}"), contract).select(F.col("c").cast("string")).first()[0]
    assert (bytes(got) if isinstance(got, bytearray) else got) == want
