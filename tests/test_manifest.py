"""Targets as files by key range: what a delta rewrites, what versions share, what fails."""

import datetime as dt
import re
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import DELETED, Column, Contract
from tidemark.plans.load import INCREMENT, LoadSpec, Stage
from tidemark.sources.extract import Delta
from tidemark.sources.manifest import ManifestTable

SCHEMA = T.StructType([T.StructField("id", T.LongType()), T.StructField("s", T.StringType())])
ROWS = 40


@pytest.fixture
def table(spark, tmp_path):
    out = ManifestTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], ROWS)
    out.write(spark.range(0, 4000, 10).selectExpr("id", "'old' AS s").repartition(5))
    return out


def listed(table, version=None):
    return {r.file: (r.low[0], r.high[0], r.rows) for r in table.manifest(version).collect()}


def apart(table):
    """Ranges in order: none reaches into the next."""
    ranges = sorted(v[:2] for v in listed(table).values())
    return all(a[1] < b[0] for a, b in zip(ranges, ranges[1:]))


def test_ranges_do_not_meet(table):
    files = listed(table)
    assert len(files) >= 400 // ROWS and sum(v[2] for v in files.values()) == 400 and apart(table)
    assert table.read().count() == 400 and table.certified()


@pytest.mark.parametrize("keys", [[5], [0], [-7], [99_999], [1995, 2000], list(range(1, 4000, 400)), list(range(2001, 2400))], ids=str)
def test_a_delta_rewrites_the_files_its_keys_reach(spark, table, keys):
    before = listed(table)
    delta = spark.createDataFrame([(k, "new") for k in keys], SCHEMA)
    reached = table.slices_of(delta)
    starts = sorted((low, f) for f, (low, _, _) in before.items())
    assert reached == sorted({max([f for f in starts if f[0] <= k] or starts[:1])[1] for k in keys})
    kept = table.read(reached).join(delta, "id", "left_anti").select("id", "s")
    table.write(kept.unionByName(delta), replaces=reached)
    after = listed(table)
    assert set(before) - set(after) == set(reached) and apart(table)
    assert all(after[f] == before[f] for f in set(before) & set(after))
    want = {**{i: "old" for i in range(0, 4000, 10)}, **{k: "new" for k in keys}}
    assert dict(map(tuple, table.read().collect())) == want
    assert dict(map(tuple, table.read(version=1).collect())) == {i: "old" for i in range(0, 4000, 10)}
    assert max(v[2] for v in after.values()) <= ROWS


def test_the_reached_files_alone_are_read(spark, table):
    reached = table.slices_of(spark.createDataFrame([(1234, "x")], SCHEMA))
    assert len(reached) == 1 and [f.rsplit("/", 1)[1] for f in table.read(reached).inputFiles()] == [reached[0].rsplit("/", 1)[1]]


@pytest.mark.parametrize("rows", [[(1, "a"), (1, "b")], [(None, "a")]], ids=str)
def test_a_repeated_or_missing_key_fails_before_the_commit(spark, table, rows):
    files = listed(table)
    bad = spark.createDataFrame(rows, SCHEMA)
    with pytest.raises(ValueError, match="repeat a key"):
        table.write(table.read().unionByName(bad))
    assert table.versions() == [1] and listed(table) == files
    assert not [n for n in table.files.names(f"{table.path}/data") if n.startswith("v_00000002")]


def test_a_write_that_died_is_no_version(spark, table, monkeypatch):
    monkeypatch.setattr(ManifestTable, "_described", lambda *_: (_ for _ in ()).throw(OSError("lost")))
    with pytest.raises(OSError):
        table.write(spark.createDataFrame([(1, "a")], SCHEMA))
    monkeypatch.undo()
    assert table.versions() == [1] and table.read().count() == 400
    assert table.write(spark.createDataFrame([(1, "a")], SCHEMA)) == 3
    table.expire(1)
    assert [n[:10] for n in table.files.names(f"{table.path}/data")] == ["v_00000003"]
    assert table.read().count() == 1


def test_expired_versions_leave_what_is_shared(spark, table):
    for k in (5, 15, 3005):
        reached = table.slices_of(spark.createDataFrame([(k, "n")], SCHEMA))
        table.write(table.read(reached).unionByName(spark.createDataFrame([(k, "n")], SCHEMA)), replaces=reached)
    rows = sorted(map(tuple, table.read().collect()))
    shared = set(listed(table, 3))
    table.expire(2)
    assert table.versions() == [3, 4] and set(listed(table, 3)) == shared
    assert sorted(map(tuple, table.read().collect())) == rows and table.read(version=3).count() == 402
    held = {f for v in (3, 4) for f in listed(table, v)}
    on_disk = {f"data/{d}/{g}" for d in table.files.names(f"{table.path}/data") for g in names_under(table, f"{table.path}/data/{d}")}
    assert on_disk == held


def names_under(table, folder):
    out = []
    for n in table.files.names(folder):
        if n.startswith("_part="):
            out += [f"{n}/{x}" for x in table.files.names(f"{folder}/{n}") if x.endswith(".parquet")]
        elif n.endswith(".parquet"):
            out.append(n)
    return out


def test_the_write_deals_rows_out_once(spark, table):
    """The check for repeated keys follows the ranges of the files: one exchange, no hash of the keys."""
    plans = []
    table.write(spark.range(100).selectExpr("id", "'x' AS s"), last=lambda df: (plans.append(df._jdf.queryExecution().executedPlan().toString()), df)[1])
    assert len(re.findall(r"Exchange rangepartitioning", plans[0])) == 1 and "hashpartitioning" not in plans[0]


def test_keys_of_several_types(spark, tmp_path):
    schema = T.StructType.fromDDL("s string, at timestamp_ntz, d decimal(20,6), v int")
    table = ManifestTable(spark, str(tmp_path / "t"), schema, ["s", "at", "d"], 7)
    first = dt.datetime(2024, 1, 1, 0, 0, 0, 1)
    rows = [(f"k\"{i % 3}\\", first + dt.timedelta(microseconds=i // 3), Decimal(i) / 1000000, i) for i in range(100)]
    table.write(spark.createDataFrame(rows, schema))
    assert len(listed(table)) >= 15
    for row in (rows[50], ("", first, Decimal(0), 0), ("z", first, Decimal("12345678901234.123456"), 0)):
        reached = table.slices_of(spark.createDataFrame([row], schema))
        low_to_high = {r.file: (tuple(r.low), tuple(r.high)) for r in table.manifest().collect()}
        assert len(reached) == 1
        if row in rows:
            assert low_to_high[reached[0]][0] <= row[:3] <= low_to_high[reached[0]][1]


def test_empty_table(spark, tmp_path):
    table = ManifestTable(spark, str(tmp_path / "t"), SCHEMA, ["id"], 10)
    assert table.read().count() == 0 and table.slices_of(spark.createDataFrame([(1, "a")], SCHEMA)) == []
    table.truncate()
    assert table.read().count() == 0 and table.versions() == [1]
    table.write(spark.createDataFrame([(1, "a")], SCHEMA), replaces=[])
    assert table.read().count() == 1


# As the target of a load.

PEOPLE = Contract([Column("id", "bigint", key=True, nullable=False), Column("name", "nvarchar", length=9), Column("changed", "datetime")])
DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]


def people(spark, ids, name, at):
    return spark.createDataFrame([(i, name, at) for i in ids], "id long, name string, changed timestamp_ntz")


def spec(df, **how):
    return LoadSpec("people", PEOPLE, lambda _: df, INCREMENT, how.pop("delta", Delta("changed", "datetime")), file_rows=20, **how)


def test_delta_loads_share_files(spark, tmp_path):
    stage = Stage(spark, str(tmp_path))
    stage.run(spec(people(spark, range(0, 1000, 2), "a", DAY[0])), "2024-02-01")
    before = {r.file for r in stage.table(spec(None)).manifest().collect()}
    delta = people(spark, [10, 11, 2000], "b", DAY[1]).unionByName(people(spark, [12], "too long a name", DAY[1]))
    stats = stage.run(spec(delta), "2024-02-02")
    assert (stats.inserted_rows, stats.updated_rows, stats.unchanged_rows, stats.tgt_failed_rows) == (2, 1, 0, 1)
    after = {r.file for r in stage.table(spec(None)).manifest().collect()}
    assert len(before - after) == 2 and len(after & before) == len(before) - 2
    rows = {r.id: r.name for r in stage.target(spec(None)).collect()}
    assert rows == {**{i: "a" for i in range(0, 1000, 2)}, 10: "b", 11: "b", 2000: "b"}


def test_snapshot_load_replaces_all_files(spark, tmp_path):
    stage, snapshot = Stage(spark, str(tmp_path)), {"delta": Delta.constant()}
    stage.run(spec(people(spark, range(100), "a", DAY[0]), **snapshot), "2024-02-01")
    stats = stage.run(spec(people(spark, range(50, 150), "a", DAY[0]), keep_versions=1, **snapshot), "2024-02-02")
    assert (stats.inserted_rows, stats.deleted_rows, stats.unchanged_rows) == (50, 50, 50)
    assert stage.target(spec(None, **snapshot)).where(F.col(DELETED) == 1).count() == 50
    assert stage.table(spec(None)).versions() == [2]


def test_one_layout_at_a_time():
    for how in ({"slice_by": "id"}, {"buckets": 2}):
        with pytest.raises(ValueError, match="layout"):
            spec(None, **how)
