"""Joins used to put control and lookup tables together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def distinct_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The distinct keys of a table, to be joined with a side that may hold hot keys.

    Repeated keys collapse before they move, one row per key and task. Grouping by
    a hash as well leaves the result partitioned differently from what the join
    wants, so the join shuffles these few rows once more by itself: Spark splits a
    skewed partition only when both inputs of the join come straight from a shuffle.
    """
    return df.select(*keys, F.xxhash64(*keys).alias("_hash")).distinct().drop("_hash")


def left_chain(first: DataFrame, *steps: tuple[DataFrame, Column]) -> DataFrame:
    """first LEFT JOIN a ON .. LEFT JOIN b ON ..; the optimizer broadcasts the steps it measures as small."""
    for table, on in steps:
        first = first.join(table, on, "left")
    return first


def inner_distinct(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Inner join against the distinct keys of another table."""
    return left.join(distinct_keys(right, keys), list(keys))


def semi_exists(left: DataFrame, right: DataFrame, on: dict[str, str]) -> DataFrame:
    """Rows of ``left`` for which a matching row exists; ``on`` maps left columns to right columns."""
    renamed = right.select(*[F.col(r).alias(l) for l, r in on.items()])
    return left.join(distinct_keys(renamed, list(on)), list(on), "left_semi")


def update_from(
    target: DataFrame,
    updates: DataFrame,
    keys: Sequence[str],
    assignments: dict[str, Column],
    matched: str = "_matched",
) -> DataFrame:
    """UPDATE .. FROM: set columns on the rows whose key is in ``updates``.

    ``updates`` must be unique on the keys; its other columns are in scope of the
    assignments, which see the old values of the target too.
    """
    joined = target.join(updates.withColumn(matched, F.lit(True)), list(keys), "left")
    hit = F.coalesce(F.col(matched), F.lit(False))
    return joined.select(*[
        F.when(hit, assignments[c]).otherwise(F.col(c)).alias(c) if c in assignments else F.col(c)
        for c in target.columns
    ])
