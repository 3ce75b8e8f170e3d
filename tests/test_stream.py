"""The continuous form: restarts, replays, several batches."""

import datetime as dt

import pytest

from tidemark.contract import CREATED, MODIFIED, Column, Contract
from tidemark.operators.merge import audit_stamp
from tidemark.sources.storage import VersionedTable
from tidemark.sources.manifest import ManifestTable
from tidemark.streaming.continuous import ledger, merge_batch, read_stream, start_merge_stream, stream_rejects

PEOPLE = Contract([
    Column("id", "bigint", key=True, nullable=False),
    Column("name", "nvarchar", length=5),
    Column("changed", "datetime"),
])
SCHEMA = "id long, name string, changed timestamp_ntz"
DAY = [dt.datetime(2024, 1, 1) + dt.timedelta(days=i) for i in range(5)]


def people(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def test_stream_resumes_and_updates(spark, tmp_path):
    incoming, checkpoint = str(tmp_path / "in"), str(tmp_path / "cp")
    table = VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema(), slice_by="id div 10")

    def arrive_and_run(df, at):
        df.coalesce(1).write.mode("append").parquet(incoming)
        stream = read_stream(spark, incoming, df.schema, files_per_batch=1)
        start_merge_stream(stream, table, PEOPLE, checkpoint, lambda batch: at, "changed", keep_versions=1).awaitTermination()

    arrive_and_run(people(spark, (1, "a", DAY[0]), (11, "k", DAY[0])), "2024-02-01")
    assert table.versions() == [1]
    arrive_and_run(people(spark, (1, "a2", DAY[2]), (1, "a1", DAY[1]), (2, "toolong", DAY[1]), (None, "x", DAY[1])), "2024-02-02")
    rows = sorted(tuple(r) for r in table.read().select("id", "name", CREATED, MODIFIED).collect())
    first, second = dt.datetime(2024, 2, 1), dt.datetime(2024, 2, 2)
    assert rows == [(1, "a2", first, second), (11, "k", first, first)]
    assert len([n for n in table.files.names(table.folder(2)) if "=" in n]) == 1


def test_replayed_batch_changes_no_row(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema())
    table.write(audit_stamp(people(spark, (1, "a", DAY[0])), "2024-01-01"))
    batch = people(spark, (1, "b", DAY[1]), (2, "c", DAY[1]))
    states = []
    for at in ("2024-02-01", "2024-02-02"):
        merge_batch(batch, table, PEOPLE, at)
        states.append(sorted(map(tuple, table.read().collect())))
    assert states[0] == states[1]


def test_empty_batch_writes_no_version(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema())
    merge_batch(people(spark), table, PEOPLE, "2024-02-01")
    assert table.versions() == []


def test_rejects_of_a_stream_are_kept(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema())
    assert stream_rejects(spark, table).count() == 0
    merge_batch(people(spark, (1, "a", DAY[0]), (2, "toolong", DAY[0])), table, PEOPLE, "2024-02-01", "changed", 0)
    merge_batch(people(spark, (None, "b", DAY[0])), table, PEOPLE, "2024-02-02", "changed", 1)
    merge_batch(people(spark, (None, "b", DAY[0])), table, PEOPLE, "2024-02-02", "changed", 1)  # a replay
    assert sorted((r.batch, r.reject_reason) for r in stream_rejects(spark, table).collect()) == [(0, "name: length"), (1, "id: not null")]
    assert [r.id for r in table.read().collect()] == [1]


def test_older_rows_do_not_win_in_a_later_batch(spark, tmp_path):
    table = VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema(), slice_by="id")
    batches = [(1, "new", DAY[4]), (1, "old", DAY[1]), (1, "none", None), (1, "same", DAY[4])]
    seen = []
    for number, row in enumerate(batches):
        merge_batch(people(spark, row), table, PEOPLE, "2024-02-01", "changed", number)
        seen += [r.name for r in table.read().collect()]
    assert seen == ["new", "new", "new", "same"]


def table_of(spark, tmp_path, layout):
    if layout == "manifest":
        return ManifestTable(spark, str(tmp_path / "t"), PEOPLE.target_schema(), ["id"], 10)
    return VersionedTable(spark, str(tmp_path / "t"), PEOPLE.target_schema(), slice_by="id" if layout == "slices" else None)


@pytest.mark.parametrize("layout", ["plain", "slices", "manifest"])
@pytest.mark.parametrize("lost", ["ledger", "nothing"])
def test_a_batch_is_merged_once(spark, tmp_path, layout, lost):
    """A batch comes again after its version was committed, with or without its entry in the ledger."""
    table = table_of(spark, tmp_path, layout)
    batch = people(spark, (1, "a", DAY[0]), (2, "toolong", DAY[0]))
    assert merge_batch(batch, table, PEOPLE, "2024-02-01", number=0, stream="s")
    if lost == "ledger":
        table.files.remove(f"{table.path}_ledger")
    assert not merge_batch(batch, table, PEOPLE, "2024-02-09", number=0, stream="s")
    assert table.versions() == [1] and stream_rejects(spark, table).count() == 1
    assert merge_batch(people(spark, (1, "b", DAY[1])), table, PEOPLE, "2024-02-02", number=1, stream="s")
    assert merge_batch(people(spark, (3, "c", DAY[1])), table, PEOPLE, "2024-02-03", number=0, stream="t")
    table.expire(1)
    # The version of the second batch is gone: the ledger knows it still.
    assert not merge_batch(people(spark, (1, "x", DAY[1])), table, PEOPLE, "2024-02-09", number=1, stream="s")
    assert sorted((r.id, r.name) for r in table.read().collect()) == [(1, "b"), (3, "c")]
    assert sorted(map(tuple, ledger(spark, table).collect())) == [("s", n) for n in ([1] if lost == "ledger" else [0, 1])] + [("t", 0)]


def test_batches_without_a_number_are_always_merged(spark, tmp_path):
    table = table_of(spark, tmp_path, "plain")
    for name in "abc":
        assert merge_batch(people(spark, (1, name, DAY[0]), (2, "toolong", DAY[0])), table, PEOPLE, "2024-02-01")
    assert [r.name for r in table.read().collect()] == ["c"] and stream_rejects(spark, table).count() == 3
    assert ledger(spark, table).count() == 0


def test_a_new_checkpoint_is_another_stream(spark, tmp_path):
    """Batch 0 of a second checkpoint is merged, and leaves the rejects of the first in place."""
    incoming, table = str(tmp_path / "in"), table_of(spark, tmp_path, "slices")
    people(spark, (1, "a", DAY[0]), (2, "toolong", DAY[0])).coalesce(1).write.parquet(incoming)
    for n in (1, 2):
        stream = read_stream(spark, incoming, people(spark).schema, bytes_per_batch=2**30)
        start_merge_stream(stream, table, PEOPLE, str(tmp_path / f"cp{n}"), f"2024-02-0{n}").awaitTermination()
    rejects = stream_rejects(spark, table).collect()
    assert len(rejects) == 2 and len({r.stream for r in rejects}) == 2 and {r.batch for r in rejects} == {0}
    assert ledger(spark, table).count() == 2
