"""Merging a diff into a target: null-safe change detection, inserts, soft deletes."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.contract import AUDIT_COLUMNS, CREATED, DELETED, MODIFIED, is_audit
from tidemark.functions.text import timestamp_literal
from tidemark.operators.joins import distinct_keys

ACTION = "merge_action"
UNCHANGED, UPDATED, INSERTED, SOFT_DELETED = "unchanged", "updated", "inserted", "deleted"
MATCHED = "merge_matched"
_SRC = "_src_"
_INSERT, _UPDATE, _DELETE, _HELD = "_insert", "_update", "_delete", "_held"
_OLD, _NEW, _SALT = "_old", "_new", "_salt"


def row_differs(left: Sequence[Column], right: Sequence[Column]) -> Column:
    """True when the rows differ; NULL equals NULL, NULL differs from any value."""
    return ~F.struct(*left).eqNullSafe(F.struct(*right))


def audit_stamp(df: DataFrame, session_start: str) -> DataFrame:
    """Both datetimes set to the start of the session, the deleted flag to 0."""
    started = timestamp_literal(session_start)
    return df.withColumns({CREATED: started, MODIFIED: started, DELETED: F.lit(0)})


@dataclass(frozen=True)
class MergeRules:
    """What to do where the choice is open.

    not_matched_by_source: ``soft_delete`` for a snapshot, ``ignore`` for a delta.
    undelete: a returning key gets its flag cleared (otherwise it stays set).
    only_active: rows already deleted keep their last-modified time.
    """

    not_matched_by_source: str = "soft_delete"
    undelete: bool = False
    only_active: bool = False

    def __post_init__(self) -> None:
        if self.not_matched_by_source not in ("soft_delete", "ignore"):
            raise ValueError(f"not_matched_by_source: {self.not_matched_by_source!r}")


def merge(
    target: DataFrame,
    source: DataFrame,
    keys: Sequence[str],
    *,
    merge_ts: str,
    rules: MergeRules = MergeRules(),
    keys_not_null: bool = False,
    unique_target: bool = True,
    source_bytes: int | None = None,
    with_action: bool = False,
    with_matched: bool = False,
    held: DataFrame | None = None,
    newer_by: str | None = None,
) -> DataFrame:
    """The target after the merge, as a plan; nothing is written.

    Both sides carry the audit columns. The source must be unique on ``keys``
    (see ``dedupe_latest``). NULL keys match nothing: such a source row is
    inserted and such a target row counts as not matched. They would all hash to
    one partition of a shuffled join, so rows with a NULL key carry a salt there, from
    their values and the partition they come from; ``keys_not_null`` spares it.

    ``held`` lists keys the source has although their rows are not merged (they were
    rejected): the target rows stay as they are, and nothing is inserted for them.
    With ``newer_by``, a source row whose value there is below the target's, or NULL
    where the target has one, changes nothing. ``with_matched`` adds a flag: the row
    comes from the source or has its key.

    Three physical forms, same rows:
    * a full outer join, one shuffle of either side (none for a side bucketed on
      the keys), when the target is unique on the keys;
    * otherwise a left join, whose skewed partitions Spark can split, plus an
      anti join for the new keys;
    * when ``source_bytes``, a measured size, is within the session's broadcast
      limit, a broadcast of the source, so that the target is never shuffled.
    """
    keys = list(keys)
    source = source.select(*target.columns)
    compare = [c for c in target.columns if c not in keys and not is_audit(c)]

    renamed = source.select(*[F.col(c).alias(_SRC + c) for c in target.columns], F.lit(True).alias(_NEW))
    on = reduce(Column.__and__, [F.col(k) == F.col(_SRC + k) for k in keys])
    # The measured size says nothing about the keys held back.
    small = held is None and source_bytes is not None and source_bytes <= broadcast_limit(source.sparkSession)
    if held is not None:
        known_keys = distinct_keys(source, keys)
        others = held.select(*keys).dropna().distinct().join(known_keys, keys, "left_anti")
        others = others.select(*[F.col(k).alias(_SRC + k) for k in keys], F.lit(True).alias(_NEW), F.lit(True).alias(_HELD))
        renamed = renamed.withColumn(_HELD, F.lit(False)).unionByName(others, allowMissingColumns=True)
    else:
        renamed = renamed.withColumn(_HELD, F.lit(False))

    old = target.withColumn(_OLD, F.lit(True))
    if not keys_not_null and not small:
        old = old.withColumn(_SALT, _null_salt(keys, target.columns))
        renamed = renamed.withColumn(_SRC + _SALT, _null_salt([_SRC + k for k in keys], [_SRC + c for c in target.columns]))
        on = on & (F.col(_SALT) == F.col(_SRC + _SALT))

    if small or not unique_target:
        # The hint gives the source a shuffle of its own, without which Spark would not
        # split a hot key of the target if the source was partitioned on the keys before.
        side = F.broadcast(renamed) if small else renamed.hint("rebalance")
        known = old.join(side, on, "left")
        result = _resolve(known, target.columns, keys, compare, merge_ts, rules, newer_by)
        result = result.unionByName(_label(new_rows(source, target, keys, small), INSERTED))
    else:
        paired = old.join(renamed, on, "full")
        if held is not None:
            paired = paired.where(F.col(_OLD).isNotNull() | ~F.col(_HELD))
        result = _resolve(paired, target.columns, keys, compare, merge_ts, rules, newer_by)
    unwanted = [c for c, wanted in ((ACTION, with_action), (MATCHED, with_matched)) if not wanted]
    return result.drop(*unwanted)


def _null_salt(keys: Sequence[str], columns: Sequence[str]) -> Column:
    """0 for a whole key. With a NULL in it, a number that spreads such rows over the partitions of a join in which they
    match nothing; copies of a row are told apart by their partition, which stays the same if a task is run again."""
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    return F.when(any_null, F.xxhash64(*columns, F.spark_partition_id())).otherwise(F.lit(0).cast("bigint"))


def new_rows(source: DataFrame, target: DataFrame, keys: Sequence[str], small_source: bool = False) -> DataFrame:
    """Source rows whose key the target lacks.

    With a small source the target is first cut to the keys they share, a scan of
    its key columns without a shuffle.
    """
    known = target.select(*keys)
    if small_source:
        known = known.join(F.broadcast(source.select(*keys)), list(keys), "left_semi")
    return source.join(distinct_keys(known, keys), list(keys), "left_anti").select(*source.columns)


def vanished_rows(target: DataFrame, source: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Target rows whose key the source lacks."""
    return target.join(distinct_keys(source, keys), list(keys), "left_anti").select(*target.columns)


def except_rows(left: DataFrame, right: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct rows of ``left`` that ``right`` does not hold, NULL equal to NULL.

    One grouping of both sides instead of an anti join: copies of a row collapse
    before the shuffle, and grouping treats NULLs as equal by itself.
    """
    tagged = left.select(*columns, F.lit(0).alias("_side")).unionAll(right.select(*columns, F.lit(1).alias("_side")))
    return tagged.groupBy(*columns).agg(F.max("_side").alias("_side")).where("_side = 0").drop("_side")


def merge_counts(merged: DataFrame) -> DataFrame:
    """Rows per action of a merge run ``with_action``."""
    return merged.groupBy(ACTION).agg(F.count(F.lit(1)).alias("row_count"))


@dataclass(frozen=True)
class ActionRules:
    """Which tagged rows reach the target, named as in the writer's own settings."""

    insert: bool = True
    update_as_update: bool = True
    update_as_insert: bool = False
    update_else_insert: bool = False
    delete: bool = True


def apply_row_actions(
    target: DataFrame,
    rows: DataFrame,
    keys: Sequence[str],
    action: str | None = "row_action",
    rules: ActionRules = ActionRules(),
) -> DataFrame:
    """Apply rows tagged insert, update or delete; at most one row per key.

    With ``action=None`` the rows carry no tag and are all treated as inserts.
    Deletes remove the row. An update without a match is dropped unless
    ``update_else_insert``; an insert whose key exists leaves the row as it is.
    Rows with a NULL key match nothing.
    """
    keys, columns = list(keys), target.columns
    if action is None:
        action, rows = "_action", rows.withColumn("_action", F.lit("insert"))
    any_null = reduce(Column.__or__, [F.col(k).isNull() for k in keys])
    inserts = [a for a, on in (("insert", rules.insert), ("update", rules.update_as_insert or rules.update_else_insert)) if on]
    wanted = F.col(action).isin(*inserts) if inserts else F.lit(False)

    keyed = rows.where(~any_null)
    renamed = keyed.select(*[F.col(c).alias(_SRC + c) for c in columns], action)
    on = reduce(Column.__and__, [F.col(k) == F.col(_SRC + k) for k in keys])
    old, new = F.col(keys[0]).isNotNull(), F.col(_SRC + keys[0]).isNotNull()
    replaces = old & new & F.lit(rules.update_as_update and not rules.update_as_insert) & (F.col(action) == "update")
    removed = old & new & F.lit(rules.delete) & (F.col(action) == "delete")
    paired = target.where(~any_null).join(renamed, on, "full").where(
        F.when(old, ~F.coalesce(removed, F.lit(False))).otherwise(wanted))
    kept = paired.select(*[
        F.when(~old | replaces, F.col(_SRC + c)).otherwise(F.col(c)).alias(c) for c in columns])
    spare = target.where(any_null).unionByName(rows.where(any_null & wanted).select(*columns))
    return kept.unionByName(spare)


def broadcast_limit(spark: SparkSession) -> int:
    """The session's own bound on what may be broadcast, in bytes."""
    return spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()


def memory_bytes(df: DataFrame, rows: int | None = None) -> int:
    """The size of a landed diff in memory: a fixed part per value, and its texts as they are measured."""
    if rows is None or _texts(df.schema):
        found = df.agg(F.count(F.lit(1)).alias("rows"), F.sum(text_bytes(df.schema)).alias("bytes")).first()
        return fixed_bytes(df, found["rows"]) + (found["bytes"] or 0)
    return fixed_bytes(df, rows)


def _texts(schema: T.StructType) -> list[str]:
    return [f.name for f in schema if f.dataType.typeName() in ("string", "binary")]


def text_bytes(schema: T.StructType) -> Column:
    """The bytes of a row's texts."""
    return sum((F.coalesce(F.octet_length(c), F.lit(0)).cast("bigint") for c in _texts(schema)), F.lit(0).cast("bigint"))


def fixed_bytes(df: DataFrame, rows: int) -> int:
    return rows * (16 * len(df.columns) + 32)


def _label(df: DataFrame, action: str) -> DataFrame:
    return df.withColumns({ACTION: F.lit(action), MATCHED: F.lit(True)})


def _marks_deleted(rules: MergeRules) -> Column:
    if rules.not_matched_by_source == "ignore":
        return F.lit(False)
    return F.col(DELETED) == 0 if rules.only_active else F.lit(True)


def _resolve(
    paired: DataFrame,
    columns: Sequence[str],
    keys: Sequence[str],
    compare: Sequence[str],
    merge_ts: str,
    rules: MergeRules,
    newer_by: str | None = None,
) -> DataFrame:
    """One output row per pair; the side that an outer row lacks shows as NULL in its mark."""
    src = {c: F.col(_SRC + c) for c in columns}
    old, new = F.col(_OLD).isNotNull(), F.col(_NEW).isNotNull()
    differs = row_differs([src[c] for c in compare], [F.col(c) for c in compare]) if compare else F.lit(False)
    if rules.undelete:
        differs = differs | (F.col(DELETED) == 1)
    if newer_by is not None:
        older = F.coalesce(src[newer_by] < F.col(newer_by), src[newer_by].isNull() & F.col(newer_by).isNotNull())
        differs = differs & ~older
    # Decided once per row; the columns below only test these flags.
    decided = paired.withColumns({
        _INSERT: ~old,
        _UPDATE: old & new & ~F.col(_HELD) & differs,
        _DELETE: ~new & _marks_deleted(rules),
    })
    insert, update, delete = F.col(_INSERT), F.col(_UPDATE), F.col(_DELETE)
    takes = insert | update
    out = [F.when(takes, src[c]).otherwise(F.col(c)).alias(c) for c in columns if c not in AUDIT_COLUMNS]
    cleared = takes if rules.undelete else insert
    out += [
        F.when(insert, src[CREATED]).otherwise(F.col(CREATED)).alias(CREATED),
        F.when(takes, src[MODIFIED])
        .when(delete, timestamp_literal(merge_ts))
        .otherwise(F.col(MODIFIED)).alias(MODIFIED),
        F.when(cleared, F.lit(0)).when(delete, F.lit(1)).otherwise(F.col(DELETED)).alias(DELETED),
        F.when(insert, F.lit(INSERTED))
        .when(update, F.lit(UPDATED))
        .when(delete, F.lit(SOFT_DELETED))
        .otherwise(F.lit(UNCHANGED)).alias(ACTION),
        (new & ~F.col(_HELD)).alias(MATCHED),
    ]
    return decided.select(*out)
