"""Every registered query against its SQL equivalent on the same files."""

import datetime
import math
import os

import duckdb
import pytest

import __spark_entry__ as entry

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = [f[:-8] for f in sorted(os.listdir(SF_DIR)) if f.endswith(".parquet")]
# Spark type -> the SQL type the comparison expects to see.
TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "smallint": "SMALLINT", "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP", "decimal(19,4)": "DECIMAL(19,4)", "decimal(6,2)": "DECIMAL(6,2)",
}


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, datetime.datetime):
        return value.isoformat(timespec="microseconds")
    return "\0" if value is None else str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(plain(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(entry.CORE))
def test_query_matches_sql(spark, db, name):
    df = entry.queries()[name](spark, SF_DIR)
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    result = db.execute(entry.oracle_sql()[name])
    described = {d[0]: str(d[1]) for d in result.description}
    want = rows_of(list(described), result.fetchall())
    assert sorted(described) == sorted(df.columns)
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == described
    assert len(got) == len(want)
    assert got == want
    assert got, "an empty result checks nothing"


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_has_sql():
    assert set(entry.CORE) <= set(entry.oracle_sql()) <= set(entry.queries())
