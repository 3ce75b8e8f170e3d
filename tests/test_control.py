"""From control tables to loaded tables."""

import datetime as dt

import pytest
from pyspark.errors import PySparkException

from tidemark.contract import DELETED
from tidemark.plans.control import contracts, load_plan, load_spec, run_plan
from tidemark.plans.load import Stage

DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]
CATALOG = """schema_name string, table_name string, column_id int, column_name string, type_name string, max_length int,
    precision int, scale int, is_nullable int, is_pk int, target_column string"""


@pytest.fixture
def tables(spark):
    flows = spark.createDataFrame(
        [(i, "sls", t, "HOST\\I", "Shop", "stg") for i, t in enumerate(["Currency", "Customer", "Quota", "Open", "Broken", "Lost"])],
        "flow_id long, schema_name string, table_name string, source_server string, source_db string, target_schema string")
    patterns = {"Currency": "Full", "Customer": "Increment", "Quota": "Increment", "Open": "Increment", "Broken": "Increment", "Lost": "Increment"}
    catalog = spark.createDataFrame(
        [("sls", t, n, c, ty, ln, None, None, null, pk, None)
         for t in patterns if t != "Lost"
         for n, (c, ty, ln, null, pk) in enumerate([
             ("Id", "bigint", 8, 0, 1), ("Name", "nvarchar", 10, 1, 0), ("Changed", "datetime", 8, 1, 0), ("AUD_isDeleted", "bit", 1, 0, 0)])],
        CATALOG)
    columns = spark.createDataFrame([("sls", t, p) for t, p in patterns.items()], "schema_name string, table_name string, pattern string")
    statements = spark.createDataFrame(
        [(10 + i, i, "Name = 'open'" if i == 3 else None) for i in range(6)], "statement_id long, flow_id long, custom_where string")
    conditions = spark.createDataFrame(
        [(11, "Changed", "datetime"), (12, "1", "integer"), (13, "Id", "numeric"), (15, "Id", "numeric")],
        "statement_id long, delta_column string, delta_type string")
    return load_plan(flows, statements, conditions, columns), catalog


def test_contracts_from_a_catalog(tables):
    known = contracts(tables[1])
    assert set(known) == {("sls", t) for t in ("Currency", "Customer", "Quota", "Open", "Broken")}
    customer = known["sls", "Customer"]
    assert customer.names == ["Id", "Name", "Changed"] and customer.keys == ["Id"]
    assert customer.column("Name").length == 5  # ten bytes
    assert not customer.column("Id").nullable


def test_specs_follow_the_plan(tables):
    plan, catalog = tables
    known = contracts(catalog)
    specs = {}
    for entry in plan.where("problem IS NULL AND table_name <> 'Lost'").collect():
        specs[entry.table_name] = load_spec(entry, known["sls", entry.table_name], None)
    assert specs["Currency"].delta is None and specs["Currency"].pattern == "Full"
    assert specs["Customer"].delta.kind == "datetime"
    assert specs["Quota"].is_snapshot
    assert specs["Open"].where == "Name = 'open'"
    assert "Broken" not in specs


def test_plan_runs(spark, tmp_path, tables):
    plan, catalog = tables
    stage = Stage(spark, str(tmp_path))
    state = {"rows": [(1, "open", DAY[0]), (2, "shut", DAY[1])]}

    def reader(entry):
        assert entry.source_name == "SQL_HOST_Shop"
        return lambda s: s.createDataFrame(state["rows"], "Id long, Name string, Changed timestamp_ntz")

    stats = {r.load_name: r for r in run_plan(stage, plan, catalog, reader, "2024-02-01").collect()}
    assert {n: r.status for n, r in stats.items()} == {
        "sls.Currency": "SUCCEEDED", "sls.Customer": "SUCCEEDED", "sls.Quota": "SUCCEEDED", "sls.Open": "SUCCEEDED",
        "sls.Broken": "FAILED", "sls.Lost": "FAILED"}
    assert stats["sls.Broken"].first_error == "no delta condition"
    assert stats["sls.Lost"].first_error == "no columns in the catalog"
    assert {n: r.src_success_rows for n, r in stats.items()} == {
        "sls.Currency": 2, "sls.Customer": 2, "sls.Quota": 2, "sls.Open": 1, "sls.Broken": 0, "sls.Lost": 0}

    state["rows"] = [(2, "shut", DAY[1]), (3, "open", DAY[2])]
    stats = {r.load_name: r for r in run_plan(stage, plan, catalog, reader, "2024-02-02").collect()}
    assert stats["sls.Customer"].src_success_rows == 1
    assert (stats["sls.Quota"].inserted_rows, stats["sls.Quota"].deleted_rows) == (1, 1)
    known = contracts(catalog)
    specs = {e.table_name: load_spec(e, known["sls", e.table_name], None)
             for e in plan.where("problem IS NULL AND table_name <> 'Lost'").collect()}
    ids = {t: sorted(map(tuple, stage.target(s).select("Id", DELETED).collect())) for t, s in specs.items()}
    assert ids == {"Currency": [(2, 0), (3, 0)], "Customer": [(1, 0), (2, 0), (3, 0)],
                   "Quota": [(1, 1), (2, 0), (3, 0)], "Open": [(1, 0), (3, 0)]}


def test_fail_fast_loads_nothing(spark, tmp_path, tables):
    plan, catalog = tables
    stage = Stage(spark, str(tmp_path))
    reader = lambda entry: lambda s: s.createDataFrame([(1, "open", DAY[0])], "Id long, Name string, Changed timestamp_ntz")
    with pytest.raises(PySparkException, match="load of sls.Broken: no delta condition"):
        run_plan(stage, plan, catalog, reader, "2024-02-01", fail_fast=True)
    assert not list(tmp_path.iterdir())
    sound = plan.where("table_name IN ('Currency', 'Quota')")
    stats = run_plan(stage, sound, catalog, reader, "2024-02-01", fail_fast=True).collect()
    assert [r.status for r in stats] == ["SUCCEEDED", "SUCCEEDED"]
