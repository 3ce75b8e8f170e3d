"""What the physical plans must look like to hold at scale."""

import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as entry
from tidemark.functions import rowversion
from tidemark.operators.joins import inner_distinct, semi_exists
from tidemark.operators.merge import MergeRules, audit_stamp, except_rows, merge, new_rows, vanished_rows
from tidemark.operators.quality import dedupe_latest
from tidemark.registry.common import MERGE_TS, staged_orders, stamped_orders, table
from tidemark.sources.extract import Delta, extract

SF = "/root/testdata/sf0.001"


def plan(df):
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


def count(df, operator):
    return len(re.findall(rf"\b{operator}\b", plan(df)))


@pytest.mark.parametrize("delta, mark, pushed", [
    (Delta("o_orderkey"), "700", "GreaterThan(o_orderkey,700)"),
    (Delta("o_orderdate", "datetime"), "2000-01-01 00:00:00.000", "GreaterThan(o_orderdate,2000-01-01T00:00)"),
])
def test_mark_reaches_the_scan(spark, delta, mark, pushed):
    df = extract(table(spark, SF, "orders"), delta=delta, mark=mark).select("o_orderkey")
    assert pushed in plan(df)
    assert "o_totalprice" not in plan(df)


def test_rowversion_mark_reaches_the_scan(spark, tmp_path):
    path = str(tmp_path / "rv")
    table(spark, SF, "orders").select("o_orderkey", rowversion.from_number(F.col("o_orderkey")).alias("rv")).write.parquet(path)
    df = extract(spark.read.parquet(path), delta=Delta("rv", "rowversion"), mark="0x10", upper="0x20")
    assert "GreaterThan(rv," in plan(df) and "LessThanOrEqual(rv," in plan(df)
    assert sorted(r[0] for r in df.select("o_orderkey").collect()) == list(range(17, 33))


def test_constant_delta_is_folded(spark):
    df = extract(table(spark, SF, "orders"), delta=Delta.constant(), mark="0")
    assert "Filter (" not in plan(df)


def test_full_merge_shuffles_each_side_once(spark):
    df = merge(staged_orders(spark, SF), stamped_orders(spark, SF), ["o_orderkey"], merge_ts=MERGE_TS, keys_not_null=True)
    assert count(df, "Exchange hashpartitioning") == 2
    assert "FullOuter" in plan(df)


def test_small_delta_does_not_shuffle_the_target(spark):
    df = merge(staged_orders(spark, SF), stamped_orders(spark, SF), ["o_orderkey"], merge_ts=MERGE_TS,
               rules=MergeRules("ignore"), keys_not_null=True, source_bytes=1000)
    text = plan(df)
    assert "SortMergeJoin" not in text
    # The only shuffle moves the keys that target and delta share.
    assert re.findall(r"Exchange hashpartitioning\((\w+)", text) == ["o_orderkey"]
    assert "_hash" in text


def test_large_delta_is_not_broadcast(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "10MB")
    try:
        df = merge(staged_orders(spark, SF), stamped_orders(spark, SF), ["o_orderkey"], merge_ts=MERGE_TS,
                   keys_not_null=True, source_bytes=20 * 2**20)
        assert "Broadcast" not in plan(df)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_dedupe_limits_before_the_shuffle(spark):
    df = dedupe_latest(table(spark, SF, "lineitem"), ["l_orderkey"], [F.col("l_shipdate").desc()])
    text = plan(df)
    assert text.index("Final") < text.index("Exchange hashpartitioning") < text.index("Partial")


@pytest.fixture
def eager_skew(spark):
    """Thresholds low enough for the skew of a small table to count as skew."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "10KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64KB",
    }
    before = {k: spark.conf.get(k, None) for k in settings}
    for k, v in settings.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def final_plan(df):
    df._jdf.collectAsList()  # runs this very plan, so that its final form is known
    return plan(df)


@pytest.fixture
def hot(spark):
    """A third of the rows share key 7; the other table repeats every key and 7 a thousand times."""
    left = spark.range(0, 60000, numPartitions=8).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"))
    keys = F.when(F.col("id") < 1000, 7).otherwise(F.floor(F.col("id") / 2)).alias("k")
    return left, spark.range(0, 60000, numPartitions=8).select(keys)


@pytest.mark.parametrize("join, keeps_known", [
    (lambda left, right: semi_exists(left, right, {"k": "k"}), True),
    (lambda left, right: inner_distinct(left, right, ["k"]), True),
    (lambda left, right: new_rows(left, right, ["k"]), False),
    (lambda left, right: vanished_rows(left, right, ["k"]), False),
], ids=["semi", "inner", "new", "vanished"])
def test_hot_keys_are_split(spark, eager_skew, hot, join, keeps_known):
    left, right = hot
    known = {r.k for r in right.distinct().collect()}
    want = sum(r["count"] for r in left.groupBy("k").count().collect() if (r.k in known) == keeps_known)
    df = join(left, right)
    assert "skew=true" in final_plan(df)
    assert df.count() == want


def test_hot_target_key_is_split_in_a_merge(spark, eager_skew, hot):
    left, right = hot
    target = audit_stamp(left, "2024-01-01")
    source = audit_stamp(dedupe_latest(right.withColumn("v", F.lit("x")), ["k"], []), "2024-01-02")
    df = merge(target, source, ["k"], merge_ts="2024-01-03", unique_target=False, keys_not_null=True)
    assert "skew=true" in final_plan(df)
    assert df.where("k = 7 AND v = 'x'").count() == 20001


def test_except_shuffles_once(spark):
    orders = table(spark, SF, "orders")
    df = except_rows(orders, orders.where("o_orderkey > 5"), orders.columns)
    assert count(df, "Exchange hashpartitioning") == 1


def test_dedupe_feeds_the_merge_without_another_shuffle(spark):
    df = entry.queries()["dedupe_then_merge"](spark, SF)
    assert count(df, "Exchange hashpartitioning") == 2


@pytest.mark.parametrize("name", sorted(entry.CORE))
def test_no_python_rows_and_no_cross_joins(spark, name):
    text = plan(entry.queries()[name](spark, SF))
    for word in ("PythonEval", "PythonUDF", "MapInPandas", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert word not in text


def nullable_keys(spark, side, rows=30_000):
    """A third of the rows have no key, and are copies of one row."""
    key = F.when(F.col("id") % 3 > 0, F.col("id"))
    df = spark.range(0, rows, numPartitions=6).select(key.alias("k"), F.when(key.isNull(), 7).otherwise(F.col("id") * side).alias("v"))
    return audit_stamp(df, "2024-01-01")


@pytest.mark.parametrize("unique_target", [True, False])
def test_null_keys_stay_in_one_join(spark, tmp_path, unique_target):
    for side in (1, 2):
        nullable_keys(spark, side).write.parquet(str(tmp_path / str(side)))
    old, new = (spark.read.parquet(str(tmp_path / str(side))) for side in (1, 2))
    df = merge(old, new, ["k"], merge_ts=MERGE_TS, unique_target=unique_target)
    if unique_target:
        assert count(df, "FileScan parquet") == 2 and count(df, "Exchange hashpartitioning") == 2 and "Union" not in plan(df)
    rows = df.groupBy(F.col("k").isNull().alias("no_key"), "AUD_isDeleted").count().collect()
    assert {(r.no_key, r.AUD_isDeleted): r["count"] for r in rows} == {(True, 0): 10_000, (True, 1): 10_000, (False, 0): 20_000}


def test_null_keys_are_spread(spark):
    """The copies of a row without a key come from six partitions and go to as many."""
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        df = merge(nullable_keys(spark, 1), nullable_keys(spark, 2), ["k"], merge_ts=MERGE_TS)
        sizes = [r["count"] for r in df.where("k IS NULL").groupBy(F.spark_partition_id()).count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert len(sizes) > 2 and max(sizes) < 15_000 and sum(sizes) == 20_000
