"""Row numbers and per-group results on data where one value fills a third of the rows."""

from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators.numbering import ordered_concat, row_numbers, sort_rows, surrogate_keys
from tidemark.operators.quality import dedupe_latest, duplicate_keys


@pytest.fixture(scope="module")
def skewed(spark):
    """30,000 rows; a third of them, exact copies of one row, share the key 7."""
    df = spark.range(0, 30000, numPartitions=6).select(
        F.when(F.col("id") < 10000, F.lit(7)).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") < 10000, F.lit(0)).otherwise(F.col("id") % 13).alias("v"))
    return df


def test_numbers_are_complete_and_ordered(spark, skewed):
    got = row_numbers(skewed, [F.col("v"), F.col("k")], name="n")
    stats = got.agg(F.min("n"), F.max("n"), F.countDistinct("n")).first()
    assert tuple(stats) == (1, 30000, 30000)
    rows = [(r.v, r.k) for r in got.orderBy("n").collect()]
    assert rows == sorted(rows)


def test_copies_spread_over_partitions(spark, skewed):
    """The hot value must not sit in one range partition."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        ordered = sort_rows(skewed, [F.col("v"), F.col("k")])
        sizes = Counter(r["p"] for r in ordered.select(F.spark_partition_id().alias("p")).collect())
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(sizes.values()) < 10000


def test_empty_and_single(spark):
    assert row_numbers(spark.range(0), [F.col("id")]).count() == 0
    assert row_numbers(spark.range(1), [F.col("id")]).first()["row_number"] == 1


def test_keys_continue(spark):
    existing = spark.createDataFrame([(1,), (41,)], "id long")
    new = spark.createDataFrame([("b",), ("a",), ("c",)], "name string")
    got = surrogate_keys(new, existing, "id", [F.col("name")])
    assert sorted(map(tuple, got.select("id", "name").collect())) == [(42, "a"), (43, "b"), (44, "c")]
    first = surrogate_keys(new, existing.limit(0), "id", [F.col("name").desc()])
    assert sorted(map(tuple, first.select("id", "name").collect())) == [(1, "c"), (2, "b"), (3, "a")]


def test_dedupe_of_a_hot_key(spark, skewed):
    got = dedupe_latest(skewed, ["k"], [F.col("v").desc()])
    assert got.count() == 20001
    assert got.where("k = 7").count() == 1
    assert [tuple(r) for r in duplicate_keys(skewed, ["k"]).collect()] == [(7, 10000)]


def test_dedupe_is_deterministic_on_ties(spark):
    rows = [(1, 5, "a"), (1, 5, "b"), (1, 5, None), (2, None, "x"), (2, 1, "y")]
    df = spark.createDataFrame(rows, "k int, t int, v string")
    for parts in (1, 3):
        got = dedupe_latest(df.repartition(parts), ["k"], [F.col("t").desc_nulls_last()])
        assert sorted(map(tuple, got.collect())) == [(1, 5, "b"), (2, 1, "y")]


def test_fragments_follow_their_ordinals(spark):
    df = spark.createDataFrame([("t", 10, "c"), ("t", 2, "b"), ("t", 1, "a"), ("u", 1, None)], "g string, n int, x string")
    got = dict(map(tuple, ordered_concat(df, ["g"], "n", "x", ",", "s").collect()))
    assert got == {"t": "a,b,c", "u": None}


def test_delimiter_is_a_value(spark):
    from tidemark.operators.numbering import ordered_concat
    rows = spark.createDataFrame([(1, 2, "b"), (1, 1, "a")], "g int, n int, t string")
    for delimiter in ("'", "\\", "', '", '"'):
        assert ordered_concat(rows, ["g"], "n", "t", delimiter, "x").first().x == f"a{delimiter}b"
