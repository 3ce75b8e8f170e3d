"""Merge semantics row by row, against a plain Python model."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tidemark.contract import CREATED, DELETED, MODIFIED
from tidemark.operators.merge import (
    ActionRules,
    MergeRules,
    apply_row_actions,
    except_rows,
    merge,
    merge_counts,
    new_rows,
    vanished_rows,
)

OLD, NEW, GONE = (dt.datetime(2024, 1, d) for d in (1, 2, 3))
SCHEMA = f"k1 int, k2 string, a string, b double, {CREATED} timestamp_ntz, {MODIFIED} timestamp_ntz, {DELETED} int"
KEYS = ["k1", "k2"]


def frame(spark, rows, at):
    return spark.createDataFrame([(*r[:4], at, at, r[4] if len(r) > 4 else 0) for r in rows], SCHEMA)


def model(target, source, rules):
    """What the merge must give, one row at a time; None never equals a key."""
    out, used = [], set()
    by_key = {r[:2]: r for r in source if None not in r[:2]}
    for row in target:
        deleted = row[4] if len(row) > 4 else 0
        match = by_key.get(row[:2]) if None not in row[:2] else None
        if match is not None:
            used.add(row[:2])
            if match[2:4] != row[2:4] or (rules.undelete and deleted):
                out.append((*match[:4], OLD, NEW, 0 if rules.undelete else deleted))
            else:
                out.append((*row[:4], OLD, OLD, deleted))
        elif rules.not_matched_by_source == "soft_delete" and not (rules.only_active and deleted):
            out.append((*row[:4], OLD, GONE, 1))
        else:
            out.append((*row[:4], OLD, OLD, deleted))
    out += [(*r[:4], NEW, NEW, 0) for r in source if None in r[:2] or r[:2] not in used]
    return out


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


FORMS = [{}, {"unique_target": False}, {"source_bytes": 100}]
RULES = [
    MergeRules(),
    MergeRules("ignore"),
    MergeRules(undelete=True),
    MergeRules(only_active=True),
    MergeRules("ignore", undelete=True, only_active=True),
]

TARGET = [
    (1, "x", "same", 1.0), (2, "x", "old", 1.0), (3, "x", None, 1.0), (4, "x", "v", None),
    (5, "x", None, None), (6, "x", "gone", 6.0), (7, "x", "gone", 7.0, 1), (8, "x", "back", 8.0, 1),
    (9, "x", "back", 9.0, 1), (None, "x", "nokey", 0.0), (10, None, "nokey", 0.0), (11, "x", "nan", float("inf")),
]
SOURCE = [
    (1, "x", "same", 1.0), (2, "x", "new", 1.0), (3, "x", "v", 1.0), (4, "x", None, None),
    (5, "x", None, None), (8, "x", "back", 8.0), (9, "x", "changed", 9.0), (1, "y", "fresh", 1.0),
    (12, "x", None, None), (None, "x", "nokey", 0.0), (10, None, "other", 1.0), (11, "x", "nan", float("inf")),
]


@pytest.mark.parametrize("form", FORMS, ids=["full", "split", "broadcast"])
@pytest.mark.parametrize("rules", RULES, ids=str)
def test_merge_cases(spark, form, rules):
    got = merge(frame(spark, TARGET, OLD), frame(spark, SOURCE, NEW), KEYS, merge_ts=str(GONE), rules=rules, **form)
    assert got.columns == frame(spark, [], OLD).columns
    assert rows(got) == sorted(model(TARGET, SOURCE, rules), key=repr)


@pytest.mark.parametrize("form", FORMS, ids=["full", "split", "broadcast"])
@pytest.mark.parametrize("sides", [([], SOURCE), (TARGET, []), ([], [])], ids=["no target", "no source", "neither"])
def test_merge_empty_sides(spark, form, sides):
    got = merge(frame(spark, sides[0], OLD), frame(spark, sides[1], NEW), KEYS, merge_ts=str(GONE), **form)
    assert rows(got) == sorted(model(*sides, MergeRules()), key=repr)


@pytest.mark.parametrize("seed", range(3))
def test_forms_agree_on_random_rows(spark, seed):
    rng = random.Random(seed)

    def some(n):
        keys = rng.sample(range(400), n)
        return [(k, rng.choice("xy"), rng.choice(["p", "q", None]), rng.choice([0.5, None])) for k in keys]

    target, source = some(300), some(250)
    rules = rng.choice(RULES)
    want = sorted(model(target, source, rules), key=repr)
    for form in [*FORMS, {"keys_not_null": True}]:
        got = merge(frame(spark, target, OLD), frame(spark, source, NEW), KEYS, merge_ts=str(GONE), rules=rules, **form)
        assert rows(got) == want


def test_repeated_target_key_is_resolved_row_by_row(spark):
    target = [(1, "x", "a", 1.0), (1, "x", "b", 1.0), (2, "x", "c", 1.0)]
    source = [(1, "x", "b", 1.0), (3, "x", "d", 1.0)]
    got = merge(frame(spark, target, OLD), frame(spark, source, NEW), KEYS, merge_ts=str(GONE), unique_target=False)
    assert rows(got) == sorted(model(target, source, MergeRules()), key=repr)


def test_merge_twice_changes_nothing(spark):
    rules = MergeRules("ignore")
    keyed = [r for r in SOURCE if None not in r[:2]]
    once = merge(frame(spark, TARGET, OLD), frame(spark, keyed, NEW), KEYS, merge_ts=str(GONE), rules=rules)
    twice = merge(once, frame(spark, keyed, GONE), KEYS, merge_ts=str(GONE), rules=rules)
    assert rows(once) == rows(twice)


def test_counts(spark):
    merged = merge(frame(spark, TARGET, OLD), frame(spark, SOURCE, NEW), KEYS, merge_ts=str(GONE), with_action=True)
    counts = {r["merge_action"]: r["row_count"] for r in merge_counts(merged).collect()}
    assert counts == {"unchanged": 4, "updated": 4, "deleted": 4, "inserted": 4}


def test_anti_joins_and_except(spark):
    target, source = frame(spark, TARGET, OLD), frame(spark, SOURCE, NEW)
    new = {r[:2] for r in rows(new_rows(source, target, KEYS))}
    assert new == {(1, "y"), (12, "x"), (None, "x"), (10, None)}
    gone = {r[:2] for r in rows(vanished_rows(target, source, KEYS))}
    assert gone == {(6, "x"), (7, "x"), (None, "x"), (10, None)}
    cols = ["k1", "k2", "a", "b"]
    twice = source.unionAll(source)
    want = set(r[:4] for r in SOURCE) - set(r[:4] for r in TARGET)
    assert set(rows(except_rows(twice, target, cols))) == want
    assert except_rows(twice, target, cols).count() == len(want)


@pytest.mark.parametrize("rules, want", [
    (ActionRules(), [(1, "U"), (3, "c"), (4, "d"), (6, "I")]),
    (ActionRules(delete=False), [(1, "U"), (2, "b"), (3, "c"), (4, "d"), (6, "I")]),
    (ActionRules(insert=False), [(1, "U"), (3, "c"), (4, "d")]),
    (ActionRules(update_else_insert=True), [(1, "U"), (3, "c"), (4, "d"), (5, "U"), (6, "I")]),
    (ActionRules(update_as_update=False), [(1, "a"), (3, "c"), (4, "d"), (6, "I")]),
    (ActionRules(update_as_insert=True), [(1, "a"), (3, "c"), (4, "d"), (5, "U"), (6, "I")]),
], ids=str)
def test_row_actions(spark, rules, want):
    target = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c"), (4, "d")], "k int, v string")
    tagged = spark.createDataFrame(
        [(1, "U", "update"), (2, "D", "delete"), (3, "I", "insert"), (5, "U", "update"), (6, "I", "insert"), (7, "D", "delete")],
        "k int, v string, row_action string")
    assert rows(apply_row_actions(target, tagged, ["k"], rules=rules)) == want


def test_untagged_rows_are_inserts(spark):
    target = spark.createDataFrame([(1, "a")], "k int, v string")
    more = spark.createDataFrame([(1, "x"), (2, "b")], "k int, v string")
    assert rows(apply_row_actions(target, more, ["k"], action=None)) == [(1, "a"), (2, "b")]


def test_row_actions_null_key(spark):
    target = spark.createDataFrame([(1, "a"), (None, "n")], "k int, v string")
    tagged = spark.createDataFrame([(None, "U", "update"), (None, "I", "insert"), (None, "D", "delete")],
                                   "k int, v string, row_action string")
    assert rows(apply_row_actions(target, tagged, ["k"])) == sorted([(1, "a"), (None, "n"), (None, "I")], key=repr)


def test_source_columns_may_come_in_any_order(spark):
    source = frame(spark, SOURCE, NEW)
    shuffled = source.select(*reversed(source.columns))
    got = merge(frame(spark, TARGET, OLD), shuffled, KEYS, merge_ts=str(GONE))
    assert rows(got) == sorted(model(TARGET, SOURCE, MergeRules()), key=repr)


def test_unknown_rule_is_refused():
    with pytest.raises(ValueError):
        MergeRules("drop")


def test_nothing_to_compare(spark):
    """A table of keys only: matched rows are unchanged."""
    schema = f"k int, {CREATED} timestamp_ntz, {MODIFIED} timestamp_ntz, {DELETED} int"
    target = spark.createDataFrame([(1, OLD, OLD, 0), (2, OLD, OLD, 0)], schema)
    source = spark.createDataFrame([(2, NEW, NEW, 0), (3, NEW, NEW, 0)], schema)
    got = merge(target, source, ["k"], merge_ts=str(GONE), with_action=True).select("k", "merge_action")
    assert rows(got) == [(1, "deleted"), (2, "unchanged"), (3, "inserted")]
    assert got.where(F.col("k") == 2).count() == 1
