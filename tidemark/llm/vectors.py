"""Rows of vectors: which take part, and how they travel in packs."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def usable(df: DataFrame, id_column: str, vector_column: str, zeros: bool = True) -> DataFrame:
    """(id, vector as doubles) of the rows that take part, without other columns.

    Left out are null ids, null or empty vectors, vectors with null or non-finite components and, if asked,
    vectors of zeros.
    """
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    vector = F.col(vector_column).cast("array<double>")
    rows = df.select(F.col(id_column).cast("bigint").alias("id"), vector.alias("vector"))
    rows = rows.where(F.col("id").isNotNull() & (F.size("vector") > 0) & F.forall("vector", lambda x: F.coalesce(finite(x), F.lit(False))))
    return rows if zeros else rows.where(F.exists("vector", lambda x: x != 0))


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """The vectors of an Arrow column as rows of doubles; shorter ones are filled up with zeros."""
    lengths = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    if len(lengths) and (lengths == dim).all():
        return flat.reshape(-1, dim)
    out = np.zeros((len(lengths), dim))
    owner = np.repeat(np.arange(len(lengths)), lengths)
    place = np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    out[owner, place] = flat
    return out


def inner(query: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products summed in the same order for every row, so that equal vectors score alike to the last bit."""
    return np.add.reduce(rows * query, axis=1)


def best_of(group_key: Column | str, rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best (score, id) of every group, each id and score once: largest score first, ties to the smaller id.

    The groups are bounded by what a task already cut down to ``k`` rows for each block it scored.
    """
    order = F.sort_array(F.collect_set(F.struct(F.negative("score").alias("down"), F.col("id"))))
    return (rows.groupBy(group_key).agg(F.slice(order, 1, k).alias("best"))
            .select(group_key, F.posexplode("best").alias("place", "hit"))
            .select(group_key, (F.col("place") + 1).cast("int").alias("rank"), F.col("hit.id").alias("vec_id"),
                    F.negative("hit.down").alias("score")))
