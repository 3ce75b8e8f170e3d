"""Tables and staged states the registered queries work on."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.contract import CREATED, DELETED, MODIFIED
from tidemark.operators.merge import audit_stamp
from tidemark.functions.text import timestamp_literal

STAGED_AT = "1996-01-01 00:00:00"
RUN1 = "2024-02-01 00:00:00"
RUN2 = "2024-02-02 00:00:00"
MERGE_TS = "2024-02-02 00:30:00"
EVENT_MARK = "2024-01-15 00:00:00.000"

ORDER_COLUMNS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority"]
CONVERSATION_COLUMNS = ["conv_id", "turn", "role", "text"]
AUDIT_NAMES = [CREATED, MODIFIED, DELETED]


def registry():
    """Two empty dictionaries, queries and their SQL, and the decorator that fills them."""
    queries, oracles = {}, {}

    def query(sql: str, name: str | None = None):
        def register(fn):
            queries[name or fn.__name__] = fn
            oracles[name or fn.__name__] = sql
            return fn
        return register

    return queries, oracles, query


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def staged_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as an earlier load left them: the ones placed before 2000, some fields since
    changed at the source, some rows already marked deleted."""
    orders = table(spark, sf_dir, "orders").where(F.col("o_orderdate") < timestamp_literal("2000-01-01 00:00:00"))
    staged = timestamp_literal(STAGED_AT)
    return orders.withColumns({
        "o_orderstatus": F.when(F.col("o_orderstatus") != "P", F.col("o_orderstatus")),
        "o_totalprice": F.when(F.col("o_orderpriority") == "1-URGENT", F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")),
        CREATED: staged,
        MODIFIED: staged,
        DELETED: (F.col("o_orderpriority").isin("1-URGENT", "2-HIGH", "5-LOW") & (F.col("o_totalprice") < 50000)).cast("int"),
    })


STAGED_ORDERS = f"""
    SELECT o_orderkey, o_custkey,
           CASE WHEN o_orderstatus <> 'P' THEN o_orderstatus END AS o_orderstatus,
           CASE WHEN o_orderpriority = '1-URGENT' THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
           o_orderdate, o_orderpriority,
           TIMESTAMP '{STAGED_AT}' AS "AUD_CreateDatetime",
           TIMESTAMP '{STAGED_AT}' AS "AUD_LastModDatetime",
           CAST(CASE WHEN o_orderpriority IN ('1-URGENT', '2-HIGH', '5-LOW') AND o_totalprice < 50000
                THEN 1 ELSE 0 END AS INTEGER) AS "AUD_isDeleted"
    FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01 00:00:00'"""


def source_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the source holds them now: finished low-priority ones are gone, and a pending
    medium-priority order has no status."""
    orders = table(spark, sf_dir, "orders")
    gone = (F.col("o_orderpriority") == "5-LOW") & (F.col("o_orderstatus") == "F")
    unknown = (F.col("o_orderpriority") == "3-MEDIUM") & (F.col("o_orderstatus") == "P")
    return orders.where(~gone).withColumn("o_orderstatus", F.when(~unknown, F.col("o_orderstatus")))


SOURCE_ORDERS = """
    SELECT o_orderkey, o_custkey,
           CASE WHEN NOT (o_orderpriority = '3-MEDIUM' AND o_orderstatus = 'P') THEN o_orderstatus END AS o_orderstatus,
           o_totalprice, o_orderdate, o_orderpriority
    FROM orders WHERE NOT (o_orderpriority = '5-LOW' AND o_orderstatus = 'F')"""


def stamped_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit_stamp(source_orders(spark, sf_dir), RUN2)


def merge_sql(
    target: str,
    source: str,
    keys: Sequence[str],
    columns: Sequence[str],
    *,
    missing: str = "soft_delete",
    undelete: bool = False,
    only_active: bool = False,
    started: str = RUN2,
    merge_ts: str = MERGE_TS,
    with_action: bool = False,
) -> str:
    """The merge as one FULL JOIN, for comparison with the Spark plan."""
    compare = [c for c in columns if c not in keys]
    on = " AND ".join(f"t.{k} = s.{k}" for k in keys)
    is_new = "t._t IS NULL"
    both = "(t._t IS NOT NULL AND s._s IS NOT NULL)"
    differs = " OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in compare)
    if undelete:
        differs += ' OR t."AUD_isDeleted" = 1'
    updated = f"({both} AND ({differs}))"
    deleted = "(s._s IS NULL" + (' AND t."AUD_isDeleted" = 0' if only_active else "") + ")"
    if missing == "ignore":
        deleted = "FALSE"
    fields = [f"CASE WHEN {is_new} OR {updated} THEN s.{c} ELSE t.{c} END AS {c}" for c in columns]
    fields += [
        f"""CASE WHEN {is_new} THEN TIMESTAMP '{started}' ELSE t."AUD_CreateDatetime" END AS "AUD_CreateDatetime" """,
        f"""CASE WHEN {is_new} OR {updated} THEN TIMESTAMP '{started}'
             WHEN {deleted} THEN TIMESTAMP '{merge_ts}' ELSE t."AUD_LastModDatetime" END AS "AUD_LastModDatetime" """,
        f"""CAST(CASE WHEN {is_new} {f"OR {updated}" if undelete else ""} THEN 0
             WHEN {deleted} THEN 1 ELSE t."AUD_isDeleted" END AS INTEGER) AS "AUD_isDeleted" """,
    ]
    if with_action:
        fields.append(f"CASE WHEN {is_new} THEN 'inserted' WHEN {updated} THEN 'updated' "
                      f"WHEN {deleted} THEN 'deleted' ELSE 'unchanged' END AS merge_action")
    select = ",\n       ".join(fields)
    return f"""
SELECT {select}
FROM (SELECT *, 1 AS _t FROM ({target}) a) t
FULL JOIN (SELECT *, 1 AS _s FROM ({source}) b) s ON {on}"""
