"""Connected components by alternating large and small stars; no group of neighbours is ever gathered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


# Rows of a few numbers each that one file is to hold.
FILE_ROWS = 1 << 16


def files(amount: int, each: int = FILE_ROWS) -> int:
    return max(1, -(-amount // each))


def landed(df: DataFrame, path: str, most: int | None = None) -> DataFrame:
    """Writes a table and reads it back. Where the size of what its last stage reads is known, ``most`` bounds the
    files, so that a small table doesn't leave one in every shuffle partition; it never adds any."""
    (df if most is None else df.coalesce(most)).write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _stars(pairs: DataFrame, work: str, most: int) -> tuple[DataFrame, DataFrame]:
    """``pairs`` (u, v), and the smallest v of every u, never above u."""
    least = pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return pairs, landed(least, work, most)


def components(edges: DataFrame, work: str, at_most: int | None = None) -> DataFrame:
    """(id, component) of every id in the edges (a, b); a component is named by its smallest id.

    Self loops, repeated edges and edges in both directions are fine; ids of no edge are not returned, an
    empty table returns none. Each step writes its edges to the folder ``work``, so a lost executor costs one step at most,
    and to as few files as they call for. ``at_most`` bounds the number of edges, if one is known.
    """
    plain = edges.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    now, seen, step = landed(plain, f"{work}/stars-0", None if at_most is None else files(at_most)), None, 0
    while True:
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen or not mark[0]:
            break
        # An edge makes two pairs, and stands in one star of each of its ends.
        seen, step, most = mark, step + 1, files(2 * mark[0])
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        pairs, least = _stars(both, f"{work}/least-{step}", most)
        large = pairs.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        large = landed(large, f"{work}/large-{step}", most)
        pairs, least = _stars(large, f"{work}/less-{step}", most)
        small = (pairs.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        now = landed(small, f"{work}/stars-{step}", most)
    found = now.select(F.col("u").alias("id"), F.col("v").alias("component"))
    return found.unionByName(now.select(F.col("v").alias("id"), F.col("v").alias("component"))).distinct()
