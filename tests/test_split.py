"""Splitting a relational read: on skewed keys the conditions are disjoint, complete and balanced."""

import re

import duckdb
import pytest
from pyspark.sql import functions as F

from tidemark.contract import Column, Contract
from tidemark.plans.load import INCREMENT, LoadSpec, Stage
from tidemark.sources.extract import Delta
from tidemark.sources.readers import RelationalSource
from tidemark.sources.split import split

N = 20_000
# Each column is skewed in its own way.
ROWS = f"""SELECT i AS id, i * i * i AS cubes, CASE WHEN i % 10 < 9 THEN 5000000 + i ELSE i * 1000000 END AS dense,
    CASE WHEN i % 3 = 0 THEN 7 ELSE i END AS hot, CASE WHEN i % 3 > 0 THEN i END AS gaps, CASE WHEN i % 2 = 0 THEN 1 ELSE i END AS half,
    (i % 7) - 3 AS few, CAST(power(1.0005, i) AS DOUBLE) AS grows, CAST(NULL AS BIGINT) AS nothing,
    9223372036854775807 - i AS large FROM range({N}) t(i)"""


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    con.execute(f"CREATE TABLE src AS {ROWS}")
    return con


def asked(db, texts=None):
    return lambda sql: (texts.append(sql) if texts is not None else None, db.execute(sql).fetchall())[1]


def met(db, parts, where="TRUE"):
    """How many conditions each row meets, and how many rows each condition has."""
    each = " + ".join(f"CASE WHEN {p.condition} THEN 1 ELSE 0 END" for p in parts)
    times = db.execute(f"SELECT DISTINCT {each} FROM src WHERE {where}").fetchall()
    return [t for t, in times], [db.execute(f"SELECT count(*) FROM src WHERE ({where}) AND ({p.condition})").fetchall()[0][0] for p in parts]


@pytest.mark.parametrize("column, second", [
    ("id", None), ("cubes", None), ("dense", None), ("hot", "id"), ("gaps", "id"), ("half", "cubes"), ("few", "id"), ("grows", None), ("nothing", "id"),
    ("large", None), ("id - 10000", None)])
@pytest.mark.parametrize("parts", [1, 7, 40])
@pytest.mark.parametrize("where", [None, "id > 15000"])
def test_conditions_share_the_rows_out(db, column, second, parts, where):
    got = split(asked(db), "src", column, parts, where, second)
    times, rows = met(db, got, where or "TRUE")
    assert times == [1]
    total = N if where is None else N - 15_001
    assert sum(rows) == total and rows == [p.rows for p in got]
    assert max(rows) <= 2 * -(-total // parts) and len(got) <= 4 * parts + 4


def test_rows_that_arrive_later_are_read_too(db):
    got = split(asked(db), "src", "id", 5)
    for late in ("-1000000", "1000000000", "NULL"):
        met_by = [db.execute(f"SELECT {p.condition.replace('id', late)}").fetchall()[0][0] for p in got]
        assert met_by.count(True) == 1


def test_a_hot_value_alone_is_one_part(db):
    got = split(asked(db), "src", "hot", 10)
    assert met(db, got)[0] == [1] and max(p.rows for p in got) == -(-N // 3) + 1  # and the row 7 itself


def test_an_empty_source(db):
    got = split(asked(db), "src", "id", 5, "id < 0")
    assert met(db, got)[0] == [1] and sum(p.rows for p in got) == 0


def test_few_questions_are_asked(db):
    texts = []
    split(asked(db, texts), "src", "cubes", 40)
    assert len(texts) < 200 and all("COUNT(" in t for t in texts)


# As the source of a load: the database is played by files and Spark's own SQL.

class FileSource(RelationalSource):
    """Answers and rows come from a temporary view of the same name as the table."""

    reads: list = []

    def ask(self, spark, sql):
        return spark.sql(sql).collect()

    def fetch(self, spark, conditions):
        FileSource.reads.append(conditions)
        parts = [spark.table(self.table).where(c) for c in conditions]
        out = parts[0]
        for p in parts[1:]:
            out = out.unionAll(p)
        return out


EVENTS = Contract([Column("id", "bigint", key=True, nullable=False), Column("grp", "bigint"), Column("at", "datetime")])


def test_a_load_reads_past_its_mark_in_even_parts(spark, tmp_path):
    at = F.expr("timestamp_ntz'2024-01-01 00:00:00' + make_dt_interval(0, 0, 0, id)")
    rows = spark.range(3000).select("id", F.when(F.col("id") % 3 > 0, F.col("id") * F.col("id")).alias("grp"), at.alias("at"))
    rows.where("id < 1000").createOrReplaceTempView("relation_events")
    stage, FileSource.reads = Stage(spark, str(tmp_path)), []
    source = FileSource("jdbc:none", "relation_events", split_on="grp", second="id", task_rows=200, datetime_literal="TIMESTAMP_NTZ '{}'".format)
    spec = LoadSpec("events", EVENTS, source, INCREMENT, Delta("at", "datetime"))
    assert stage.run(spec, "2024-02-01").inserted_rows == 1000
    rows.createOrReplaceTempView("relation_events")
    stats = stage.run(spec, "2024-02-02")
    assert (stats.src_success_rows, stats.inserted_rows) == (2000, 2000)
    assert stage.target(spec).count() == 3000
    assert [len(r) >= n for r, n in zip(FileSource.reads, (5, 10))] == [True, True]
    # The rows of the first run are neither counted nor fetched again.
    assert all(re.search(r"at > TIMESTAMP_NTZ '2024-01-01 00:16:39", c) for c in FileSource.reads[1])
    assert stage.run(spec, "2024-02-03").src_success_rows == 0
    spark.catalog.dropTempView("relation_events")


def test_one_task_has_to_be_asked_for():
    with pytest.raises(ValueError, match="split on"):
        RelationalSource("jdbc:x", "dbo.t")
    assert RelationalSource("jdbc:x", "dbo.t", query="SELECT 1 a", one_task=True).source == "(SELECT 1 a) src"
