"""Numbers that continue between runs, and tables compared by the checksums of their slices."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.numbering import first_pending, numbered
from tidemark.session import shared_dir
from tidemark.sources.checksums import SliceChecksums, except_by_slices, unequal_slices
from tidemark.sources.keys import KeyRegistry
from tidemark.sources.storage import SharedFiles, VersionedTable

NAMES = T.StructType([T.StructField("name", T.StringType())])


def names(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], NAMES)


@pytest.fixture
def registry(spark, tmp_path):
    return KeyRegistry(spark, str(tmp_path / "keys"), NAMES)


def test_numbers_continue(spark, registry):
    assert registry.highest() == 0 and registry.read().count() == 0
    assert registry.add(names(spark, "b", "a", None), [F.col("name")], "1") == 3
    assert registry.add(names(spark, "c", "a"), [F.col("name").desc()], "2") == 2
    assert registry.add(names(spark), [F.col("name")], "3") == 0
    assert registry.add(names(spark, "z"), [F.col("name")], "4") == 1
    assert {r.id: r.name for r in registry.read().collect()} == {1: None, 2: "a", 3: "b", 4: "c", 5: "a", 6: "z"}
    assert registry.highest() == 6


def test_a_replayed_run_hands_out_nothing(spark, registry):
    registry.add(names(spark, "a"), [F.col("name")], "1")
    assert registry.add(names(spark, "a", "b"), [F.col("name")], "1") == 0
    assert registry.read().count() == 1


def test_a_run_that_died_is_done_anew(spark, registry):
    registry.add(names(spark, "a", "b", "c"), [F.col("name")], "1")
    registry.add(names(spark, "d"), [F.col("name")], "2")
    registry.files.remove(f"{registry.path}/ranges/run=2")  # stored, not committed
    assert registry.read().count() == 3 and registry.highest() == 3
    registry.add(names(spark, "d", "e"), [F.col("name")], "2")
    assert {r.id: r.name for r in registry.read().collect()} == {1: "a", 2: "b", 3: "c", 4: "d", 5: "e"}


def test_many_tasks_and_a_hot_value(spark, tmp_path):
    schema = T.StructType([T.StructField("v", T.LongType())])
    registry = KeyRegistry(spark, str(tmp_path / "keys"), schema)
    rows = spark.range(0, 30_000, numPartitions=6).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("v"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for run in ("1", "2"):
            registry.add(rows, [F.col("v")], run)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    ids = sorted((r.id, r.v) for r in registry.read().collect())
    assert [i for i, _ in ids] == list(range(1, 60_001))
    assert [v for _, v in ids[:30_000]] == sorted(v for _, v in ids[:30_000]) and [v for _, v in ids[30_000:]] == [v for _, v in ids[:30_000]]


def test_numbers_for_a_while_leave_no_folder(spark):
    root = shared_dir(spark).removeprefix("file:")
    before = set(os.listdir(root)) if os.path.isdir(root) else set()
    with numbered(names(spark, "b", "a"), [F.col("name")], "n") as rows:
        assert sorted((r.n, r.name) for r in rows.collect()) == [(1, "a"), (2, "b")]
    assert set(os.listdir(root)) == before


def test_first_pending(spark):
    rows = spark.createDataFrame([(3, True), (1, True), (2, False), (4, False)], "k int, done boolean")
    assert first_pending(rows, ["k"], F.col("done")).first()["next_number"] == 2
    assert first_pending(rows, ["k"], F.lit(True)).first()["next_number"] is None
    assert first_pending(rows.where("k = 4"), ["k"], F.col("done")).first()["next_number"] == 1
    assert first_pending(rows.limit(0), ["k"], F.col("done")).first()["next_number"] is None


# Checksums.

ROWS = T.StructType([T.StructField("id", T.LongType()), T.StructField("a", T.StringType()), T.StructField("b", T.StringType())])


def sliced(spark, path, rows, slices=200):
    table = VersionedTable(spark, str(path), ROWS, slice_by="id div 10", slices=slices)
    table.write(rows)
    return table


def plain(spark, n=2000):
    return spark.range(n).selectExpr("id", "concat('a', id % 3) AS a", "CAST(NULL AS string) AS b")


def test_equal_tables_are_not_read(spark, tmp_path):
    left, right = sliced(spark, tmp_path / "l", plain(spark)), sliced(spark, tmp_path / "r", plain(spark).orderBy(F.rand()))
    got = except_by_slices(left, right, ROWS.names)
    assert got.count() == 0 and got.inputFiles() == []


def test_unequal_slices_alone_are_read(spark, tmp_path):
    left = sliced(spark, tmp_path / "l", plain(spark))
    # A value that moves to the next column, a value that differs, a row less and a row more.
    moved = plain(spark).withColumns({
        "b": F.when(F.col("id") == 77, F.col("a")), "a": F.when(F.col("id") == 1033, "x").when(F.col("id") != 77, F.col("a"))})
    right = sliced(spark, tmp_path / "r", moved.where("id <> 500").unionByName(plain(spark).where("id = 3").withColumn("id", F.lit(999_999).cast("long"))))
    got = except_by_slices(left, right, ROWS.names)
    assert sorted(r.id for r in got.collect()) == [77, 500, 1033]
    folders = {os.path.dirname(f).rsplit("_slice=")[1] for f in got.inputFiles()}
    assert len(folders) <= 4
    back = except_by_slices(right, left, ROWS.names)
    assert sorted(r.id for r in back.collect()) == [77, 1033, 999_999]


def test_slices_left_alone_are_not_summed_again(spark, tmp_path, monkeypatch):
    table = sliced(spark, tmp_path / "t", plain(spark))
    sums, seen = SliceChecksums(table, ROWS.names), []
    first = {r.slice: tuple(r)[2:] for r in sums.record().collect()}
    summed = SliceChecksums._summed
    monkeypatch.setattr(SliceChecksums, "_summed", lambda self, slices: (seen.extend(slices), summed(self, slices))[1])
    delta = plain(spark).where("id BETWEEN 40 AND 49").withColumn("a", F.lit("new"))
    touched = table.slices_of(delta)
    table.write(table.read(touched).join(delta, "id", "left_anti").select(*ROWS.names).unionByName(delta))
    second = {r.slice: tuple(r)[2:] for r in sums.record().collect()}
    assert [str(s) for s in seen] == touched and {s for s in first if first[s] != second[s]} == {int(s) for s in touched}
    sums.record()
    assert len(seen) == len(touched)


def test_layouts_have_to_agree(spark, tmp_path):
    with pytest.raises(ValueError, match="one layout"):
        except_by_slices(sliced(spark, tmp_path / "l", plain(spark)), sliced(spark, tmp_path / "r", plain(spark), 7), ROWS.names)
    with pytest.raises(ValueError, match="sliced"):
        SliceChecksums(VersionedTable(spark, str(tmp_path / "p"), ROWS), ROWS.names)


def test_tree_of_an_empty_side(spark, tmp_path):
    full, empty = (SliceChecksums(sliced(spark, tmp_path / n, rows), ROWS.names).record()
                   for n, rows in (("f", plain(spark, 100)), ("e", plain(spark, 0))))
    assert unequal_slices(empty, empty) == [] and len(unequal_slices(full, empty)) == full.count()
    assert SharedFiles(spark, str(tmp_path)).exists(str(tmp_path / "e_checksums"))
