"""Merges, joins, aggregates and sinks (J, E, A, G and W operators)."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions import rowversion
from tidemark.functions.text import timestamp_literal
from tidemark.operators.joins import inner_distinct, left_chain, semi_exists, update_from
from tidemark.operators.merge import (
    MergeRules,
    apply_row_actions,
    audit_stamp,
    except_rows,
    memory_bytes,
    merge,
    merge_counts,
    new_rows,
    row_differs,
    vanished_rows,
)
from tidemark.operators.numbering import first_pending, min_pending, ordered_concat, row_numbers, sort_rows, surrogate_keys
from tidemark.operators.quality import dedupe_latest, duplicate_keys
from tidemark.plans.load import APPEND, INCREMENT, LoadSpec, Stage
from tidemark.plans.marks import highest
from tidemark.registry.common import (
    CONVERSATION_COLUMNS,
    EVENT_MARK,
    MERGE_TS,
    ORDER_COLUMNS,
    RUN1,
    RUN2,
    SOURCE_ORDERS,
    STAGED_AT,
    STAGED_ORDERS,
    merge_sql,
    registry,
    source_orders,
    staged_orders,
    stamped_orders,
    table,
)
from tidemark.registry.extracts import CUSTOMER, EVENTS, ORDERS
from tidemark.session import new_workdir
from tidemark.sources.extract import Delta, extract
from tidemark.sources.checksums import except_by_slices
from tidemark.sources.keys import KeyRegistry
from tidemark.sources.storage import VersionedTable

QUERIES, ORACLES, query = registry()
KEY = ["o_orderkey"]


# --- merge ----------------------------------------------------------------

@query(merge_sql(STAGED_ORDERS, SOURCE_ORDERS, KEY, ORDER_COLUMNS))
def merge_soft_delete(spark, sf_dir):
    return merge(staged_orders(spark, sf_dir), stamped_orders(spark, sf_dir), KEY, merge_ts=MERGE_TS, keys_not_null=True)


def stamped_lines(lines):
    return f"""SELECT l_orderkey, l_partkey, TIMESTAMP '{STAGED_AT}' AS "AUD_CreateDatetime", TIMESTAMP '{STAGED_AT}' AS "AUD_LastModDatetime",
        CAST(0 AS INTEGER) AS "AUD_isDeleted" FROM ({lines})"""


RECENT = f"SELECT * FROM ({SOURCE_ORDERS}) WHERE o_orderdate > TIMESTAMP '1999-06-01 00:00:00'"


def recent_orders(spark, sf_dir):
    return extract(stamped_orders(spark, sf_dir), delta=Delta("o_orderdate", "datetime"), mark="1999-06-01 00:00:00")


@query(merge_sql(STAGED_ORDERS, RECENT, KEY, ORDER_COLUMNS, missing="ignore"))
def merge_upsert_only(spark, sf_dir):
    """A delta: the keys it lacks are left alone."""
    return merge(staged_orders(spark, sf_dir), recent_orders(spark, sf_dir), KEY, merge_ts=MERGE_TS,
                 rules=MergeRules("ignore"), keys_not_null=True)


@query(merge_sql(STAGED_ORDERS, RECENT, KEY, ORDER_COLUMNS, missing="ignore"))
def merge_upsert_split(spark, sf_dir):
    """The same rows from the form for targets that may repeat a key: a left join and an anti join."""
    return merge(staged_orders(spark, sf_dir), recent_orders(spark, sf_dir), KEY, merge_ts=MERGE_TS,
                 rules=MergeRules("ignore"), unique_target=False)


@query(merge_sql(STAGED_ORDERS, RECENT, KEY, ORDER_COLUMNS, missing="ignore"))
def merge_broadcast(spark, sf_dir):
    """A landed delta whose measured size decides: within the session's limit the target is only scanned."""
    folder = new_workdir(spark, "delta")
    recent_orders(spark, sf_dir).write.parquet(folder)
    delta = spark.read.parquet(folder)
    return merge(staged_orders(spark, sf_dir), delta, KEY, merge_ts=MERGE_TS, rules=MergeRules("ignore"), keys_not_null=True,
                 source_bytes=memory_bytes(delta))


def _some_keys(rows):
    """A third of the keys unknown."""
    return rows.withColumn("o_orderkey", F.when(F.col("o_orderkey") % 3 > 0, F.col("o_orderkey")))


_NO_KEY = "SELECT * REPLACE (CASE WHEN o_orderkey % 3 > 0 THEN o_orderkey END AS o_orderkey) FROM ({})"


@query(merge_sql(_NO_KEY.format(STAGED_ORDERS), _NO_KEY.format(SOURCE_ORDERS), KEY, ORDER_COLUMNS))
def merge_null_keys(spark, sf_dir):
    """Rows without a key match nothing: old ones are soft-deleted, new ones inserted."""
    return merge(_some_keys(staged_orders(spark, sf_dir)), _some_keys(stamped_orders(spark, sf_dir)), KEY, merge_ts=MERGE_TS)


_HOT_LINES = "SELECT * REPLACE (CASE WHEN l_orderkey % 3 = 0 THEN 0 ELSE l_orderkey END AS l_orderkey) FROM lineitem"


@query(merge_sql(stamped_lines(_HOT_LINES), f"SELECT l_orderkey, max(l_partkey) AS l_partkey FROM ({_HOT_LINES}) GROUP BY l_orderkey",
                 ["l_orderkey"], ["l_orderkey", "l_partkey"], missing="ignore"))
def merge_split_hot(spark, sf_dir):
    """A target that repeats its keys, one of them in a third of the rows, updated by one row per key: Spark may split the hot key."""
    key = F.when(F.col("l_orderkey") % 3 == 0, 0).otherwise(F.col("l_orderkey")).cast("bigint").alias("l_orderkey")
    lines = table(spark, sf_dir, "lineitem").select(key, "l_partkey")
    latest = lines.groupBy("l_orderkey").agg(F.max("l_partkey").alias("l_partkey"))
    return merge(audit_stamp(lines, STAGED_AT), audit_stamp(latest, RUN2), ["l_orderkey"], merge_ts=MERGE_TS, rules=MergeRules("ignore"),
                 keys_not_null=True, unique_target=False)


@query(merge_sql(STAGED_ORDERS, RECENT, KEY, ORDER_COLUMNS))
def merge_delta_literal(spark, sf_dir):
    """The literal rule applied to a delta: every row it lacks is marked deleted."""
    return merge(staged_orders(spark, sf_dir), recent_orders(spark, sf_dir), KEY, merge_ts=MERGE_TS)


@query(merge_sql(STAGED_ORDERS, SOURCE_ORDERS, KEY, ORDER_COLUMNS, undelete=True, only_active=True))
def merge_undelete(spark, sf_dir):
    """Returning keys become active again; rows deleted earlier keep their time of deletion."""
    return merge(staged_orders(spark, sf_dir), stamped_orders(spark, sf_dir), KEY, merge_ts=MERGE_TS,
                 rules=MergeRules(undelete=True, only_active=True), keys_not_null=True)


_STAGED_TALK = f"""
    SELECT conv_id, turn, CASE WHEN role = 'system' THEN NULL ELSE role END AS role,
           CASE WHEN length(text) > 400 THEN NULL ELSE text END AS text,
           TIMESTAMP '{STAGED_AT}' AS "AUD_CreateDatetime", TIMESTAMP '{STAGED_AT}' AS "AUD_LastModDatetime",
           0 AS "AUD_isDeleted"
    FROM conversations WHERE turn < 4"""
_SOURCE_TALK = "SELECT conv_id, turn, role, text FROM conversations WHERE NOT (role = 'assistant' AND length(text) < 120)"


@query(merge_sql(_STAGED_TALK, _SOURCE_TALK, ["conv_id", "turn"], CONVERSATION_COLUMNS))
def merge_composite_key(spark, sf_dir):
    talk = table(spark, sf_dir, "conversations").select(*CONVERSATION_COLUMNS)
    staged = talk.where("turn < 4").withColumns({
        "role": F.when(F.col("role") != "system", F.col("role")),
        "text": F.when(F.length("text") <= 400, F.col("text")),
    })
    staged = audit_stamp(staged, STAGED_AT)
    source = audit_stamp(talk.where(~((F.col("role") == "assistant") & (F.length("text") < 120))), RUN2)
    return merge(staged, source, ["conv_id", "turn"], merge_ts=MERGE_TS)


@query(f"""SELECT s.o_orderkey, CAST(CASE WHEN {" OR ".join(f"s.{c} IS DISTINCT FROM t.{c}" for c in ORDER_COLUMNS[1:])}
    THEN 1 ELSE 0 END AS INTEGER) AS differs FROM ({SOURCE_ORDERS}) s JOIN ({STAGED_ORDERS}) t ON s.o_orderkey = t.o_orderkey""")
def changed_flag(spark, sf_dir):
    """Row difference of matched keys, NULL equal to NULL."""
    old, new = staged_orders(spark, sf_dir).alias("t"), source_orders(spark, sf_dir).alias("s")
    differs = row_differs([F.col(f"s.{c}") for c in ORDER_COLUMNS[1:]], [F.col(f"t.{c}") for c in ORDER_COLUMNS[1:]])
    return new.join(old, F.col("s.o_orderkey") == F.col("t.o_orderkey")).select(
        "s.o_orderkey", differs.cast("int").alias("differs"))


@query(f"SELECT s.* FROM ({SOURCE_ORDERS}) s WHERE NOT EXISTS (SELECT 1 FROM ({STAGED_ORDERS}) t WHERE t.o_orderkey = s.o_orderkey)")
def new_keys(spark, sf_dir):
    return new_rows(source_orders(spark, sf_dir), staged_orders(spark, sf_dir), KEY)


@query(f"""SELECT t.o_orderkey, t.o_orderdate, t.o_orderpriority FROM ({STAGED_ORDERS}) t
    WHERE NOT EXISTS (SELECT 1 FROM ({SOURCE_ORDERS}) s WHERE t.o_orderkey = s.o_orderkey)""")
def vanished_keys(spark, sf_dir):
    staged = staged_orders(spark, sf_dir).select("o_orderkey", "o_orderdate", "o_orderpriority")
    return vanished_rows(staged, source_orders(spark, sf_dir), KEY)


_COLS = ", ".join(ORDER_COLUMNS)


@query(f"SELECT {_COLS} FROM ({SOURCE_ORDERS}) EXCEPT SELECT {_COLS} FROM ({STAGED_ORDERS})")
def changed_rows_except(spark, sf_dir):
    return except_rows(source_orders(spark, sf_dir), staged_orders(spark, sf_dir), ORDER_COLUMNS)


_REPRICED = """SELECT o_orderkey, o_custkey, o_orderstatus, CASE WHEN o_orderkey % 5000 = 7 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice,
    o_orderdate, o_orderpriority FROM orders WHERE o_orderkey % 7000 <> 9"""


@query(f"SELECT {_COLS} FROM ({_REPRICED}) EXCEPT SELECT {_COLS} FROM orders")
def changed_slices_except(spark, sf_dir):
    """Rows of a copy that the original lacks; slices whose checksums agree are not compared."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS)
    price = F.when(F.col("o_orderkey") % 5000 == 7, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice"))
    copy = orders.withColumn("o_totalprice", price).where("o_orderkey % 7000 <> 9")
    folder, sides = new_workdir(spark, "slices"), []
    for name, rows in (("copy", copy), ("original", orders)):
        sides.append(VersionedTable(spark, f"{folder}/{name}", orders.schema, slice_by="o_orderkey div 512"))
        sides[-1].write(rows)
    return except_by_slices(*sides, ORDER_COLUMNS)


@query(f"""SELECT merge_action, CAST(count(*) AS BIGINT) AS row_count
    FROM ({merge_sql(STAGED_ORDERS, SOURCE_ORDERS, KEY, ORDER_COLUMNS, with_action=True)}) GROUP BY 1""")
def load_stats(spark, sf_dir):
    return merge_counts(merge(staged_orders(spark, sf_dir), stamped_orders(spark, sf_dir), KEY,
                              merge_ts=MERGE_TS, keys_not_null=True, with_action=True))


@query("""SELECT * FROM (
    SELECT o_orderkey, o_custkey, CASE WHEN o_orderpriority = '1-URGENT' THEN 'F' ELSE o_orderstatus END AS o_orderstatus,
           o_totalprice FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01' AND o_orderpriority <> '5-LOW'
    UNION ALL
    SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice FROM orders
    WHERE o_orderdate >= TIMESTAMP '2000-01-01' AND o_orderpriority = '3-MEDIUM')""", name="apply_row_actions")
def row_actions(spark, sf_dir):
    """Tagged rows: urgent orders are updated (also ones the target lacks: dropped), low ones
    deleted, medium ones inserted (also ones the target has: left as they are)."""
    orders = table(spark, sf_dir, "orders").select(*ORDER_COLUMNS[:4], "o_orderdate", "o_orderpriority")
    target = orders.where(F.col("o_orderdate") < timestamp_literal("2000-01-01 00:00:00")).select(*ORDER_COLUMNS[:4])
    action = (
        F.when(F.col("o_orderpriority") == "1-URGENT", "update")
        .when(F.col("o_orderpriority") == "5-LOW", "delete")
        .when(F.col("o_orderpriority") == "3-MEDIUM", "insert")
    )
    rows = orders.withColumn("row_action", action).where("row_action IS NOT NULL").withColumn(
        "o_orderstatus", F.when(F.col("row_action") == "update", "F").otherwise(F.col("o_orderstatus")))
    return apply_row_actions(target, rows.select(*ORDER_COLUMNS[:4], "row_action"), KEY)


# --- joins ----------------------------------------------------------------

@query("""SELECT c_custkey, n_name, r_name FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey AND c_acctbal > 0
    LEFT JOIN region ON n_regionkey = r_regionkey AND r_name <> 'ASIA'""", name="left_chain")
def left_joins(spark, sf_dir):
    return left_chain(
        table(spark, sf_dir, "customer"),
        (table(spark, sf_dir, "nation"), (F.col("c_nationkey") == F.col("n_nationkey")) & (F.col("c_acctbal") > 0)),
        (table(spark, sf_dir, "region"), (F.col("n_regionkey") == F.col("r_regionkey")) & (F.col("r_name") != "ASIA")),
    ).select("c_custkey", "n_name", "r_name")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, l_partkey, l_suppkey FROM lineitem
    JOIN (SELECT DISTINCT l_partkey, l_suppkey FROM lineitem WHERE l_returnflag = 'R') USING (l_partkey, l_suppkey)""", name="inner_distinct")
def inner_distinct_pairs(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem")
    rows = lines.select("l_orderkey", "l_linenumber", "l_quantity", "l_partkey", "l_suppkey")
    return inner_distinct(rows, lines.where("l_returnflag = 'R'"), ["l_partkey", "l_suppkey"])


@query("""SELECT o_orderkey, o_orderdate FROM orders o
    WHERE EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey AND l_returnflag = 'R')""", name="semi_exists")
def semi_join(spark, sf_dir):
    returned = table(spark, sf_dir, "lineitem").where("l_returnflag = 'R'")
    return semi_exists(table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate"), returned, {"o_orderkey": "l_orderkey"})


# --- aggregates, numbering, sorting ----------------------------------------

@query("SELECT CAST(greatest(max(o_orderkey), 7500) AS VARCHAR) AS mark FROM orders")
def watermark_max_id(spark, sf_dir):
    return highest(table(spark, sf_dir, "orders"), Delta("o_orderkey"), "7500")


@query("SELECT strftime(max(ts), '%Y-%m-%d %H:%M:%S.%f') AS mark FROM events")
def watermark_max_text(spark, sf_dir):
    delta = Delta("ts", "datetime")
    return highest(table(spark, sf_dir, "events"), delta, delta.first_mark)


_NUMBERED = "SELECT row_number() OVER (ORDER BY o_orderdate, o_orderkey) AS rn, o_orderkey, o_orderstatus FROM orders"


@query(f"SELECT min(rn) AS next_number FROM ({_NUMBERED}) WHERE NOT o_orderstatus = 'F'", name="min_pending")
def next_pending(spark, sf_dir):
    """The lowest number among the orders not yet finished."""
    return first_pending(table(spark, sf_dir, "orders"), ["o_orderdate", "o_orderkey"], F.col("o_orderstatus") == "F")


@query("SELECT DISTINCT l_partkey, l_suppkey FROM lineitem")
def distinct_pairs(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select("l_partkey", "l_suppkey").distinct()


@query(_NUMBERED, name="row_numbers")
def numbered_rows(spark, sf_dir):
    rows = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    return row_numbers(rows, [F.col("o_orderdate"), F.col("o_orderkey")], name="rn").drop("o_orderdate")


@query("SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate FROM lineitem ORDER BY l_shipdate, l_orderkey, l_linenumber")
def sorted_scan(spark, sf_dir):
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate")
    return sort_rows(rows, [F.col("l_shipdate"), F.col("l_orderkey"), F.col("l_linenumber")])


@query("""SELECT o_orderkey, o_orderkey + 1 AS id FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'
    UNION ALL
    SELECT o_orderkey, row_number() OVER (ORDER BY o_orderdate, o_orderkey)
        + (SELECT max(o_orderkey + 1) FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01') AS id
    FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'""")
def surrogate_key(spark, sf_dir):
    """New rows take ids after the highest one in use."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    old = F.col("o_orderdate") < timestamp_literal("2000-01-01 00:00:00")
    existing = orders.where(old).select("o_orderkey", (F.col("o_orderkey") + 1).alias("id"))
    fresh = surrogate_keys(orders.where(~old), existing, "id", [F.col("o_orderdate"), F.col("o_orderkey")])
    return existing.unionByName(fresh.select("o_orderkey", "id"))


_TWO_BATCHES = """SELECT o_orderkey, o_orderstatus, row_number() OVER (ORDER BY o_orderdate >= TIMESTAMP '2000-01-01', o_orderdate, o_orderkey) AS id
    FROM orders"""


def _registered_orders(spark, sf_dir):
    """Orders numbered by a key registry in two runs, the second of them replayed."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    registry = KeyRegistry(spark, new_workdir(spark, "keys"), orders.schema)
    old = F.col("o_orderdate") < timestamp_literal("2000-01-01 00:00:00")
    for run, rows in (("1", orders.where(old)), ("2", orders.where(~old)), ("2", orders.where(~old))):
        registry.add(rows, [F.col("o_orderdate"), F.col("o_orderkey")], run)
    return registry.read()


@query(_TWO_BATCHES)
def surrogate_key_two_runs(spark, sf_dir):
    """Keys that go on from one run to the next."""
    return _registered_orders(spark, sf_dir).drop("o_orderdate")


@query(f"SELECT min(id) AS next_number FROM ({_TWO_BATCHES}) WHERE o_orderstatus <> 'F'", name="min_pending_stored")
def next_stored(spark, sf_dir):
    """The lowest stored number of an order not yet finished."""
    return min_pending(_registered_orders(spark, sf_dir), "id", F.col("o_orderstatus") == "F")


@query("""SELECT l_orderkey, string_agg(fragment, ' ' ORDER BY l_linenumber) AS lines FROM (
    SELECT l_orderkey, l_linenumber, '[' || l_linenumber || 'x' || count(*) || ':' || max(l_partkey) || ']' AS fragment
    FROM lineitem GROUP BY l_orderkey, l_linenumber) GROUP BY l_orderkey""")
def ordered_listagg(spark, sf_dir):
    """One fragment per line number, joined in line order; repeated lines collapse before the shuffle."""
    fragments = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(
        F.count(F.lit(1)).alias("n"), F.max("l_partkey").alias("part"))
    number = F.col("l_linenumber").cast("string")
    fragments = fragments.withColumn("fragment", F.concat(
        F.lit("["), number, F.lit("x"), F.col("n").cast("string"), F.lit(":"), F.col("part").cast("string"), F.lit("]")))
    return ordered_concat(fragments, ["l_orderkey"], "l_linenumber", "fragment", " ", "lines")


_LINE_TIES = ["l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus"]
LINE_COLUMNS = ["l_orderkey", "l_linenumber", *_LINE_TIES, "l_shipdate"]


@query(f"""SELECT {", ".join(LINE_COLUMNS)} FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, {", ".join(c + " DESC NULLS LAST" for c in _LINE_TIES)}) AS rn FROM lineitem) WHERE rn = 1""", name="dedupe_latest")
def latest_per_key(spark, sf_dir):
    lines = table(spark, sf_dir, "lineitem").select(*LINE_COLUMNS)
    return dedupe_latest(lines, ["l_orderkey", "l_linenumber"], [F.col("l_shipdate").desc_nulls_last()])


@query("""SELECT l_orderkey, l_linenumber, CAST(count(*) AS BIGINT) AS row_count FROM lineitem
    GROUP BY ALL HAVING count(*) > 1""", name="duplicate_keys")
def repeated_keys(spark, sf_dir):
    return duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


_STAGED_LINES = f"""
    SELECT l_orderkey, l_linenumber, max(l_partkey) AS l_partkey, max(l_suppkey) AS l_suppkey, max(l_shipdate) AS l_shipdate,
           TIMESTAMP '{STAGED_AT}' AS "AUD_CreateDatetime", TIMESTAMP '{STAGED_AT}' AS "AUD_LastModDatetime", 0 AS "AUD_isDeleted"
    FROM lineitem WHERE l_linestatus = 'F' GROUP BY l_orderkey, l_linenumber"""
_LATEST_LINES = """
    SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
        SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC NULLS LAST, l_partkey DESC NULLS LAST, l_suppkey DESC NULLS LAST) AS rn
        FROM lineitem) WHERE rn = 1"""
_LINE_KEY = ["l_orderkey", "l_linenumber"]


@query(merge_sql(_STAGED_LINES, _LATEST_LINES, _LINE_KEY, [*_LINE_KEY, "l_partkey", "l_suppkey", "l_shipdate"]))
def dedupe_then_merge(spark, sf_dir):
    """A source that repeats its keys: the latest row of each key is merged."""
    lines = table(spark, sf_dir, "lineitem")
    staged = lines.where("l_linestatus = 'F'").groupBy(*_LINE_KEY).agg(
        F.max("l_partkey").alias("l_partkey"), F.max("l_suppkey").alias("l_suppkey"), F.max("l_shipdate").alias("l_shipdate"))
    source = dedupe_latest(lines.select(*_LINE_KEY, "l_partkey", "l_suppkey", "l_shipdate"), _LINE_KEY,
                           [F.col("l_shipdate").desc_nulls_last()])
    return merge(audit_stamp(staged, STAGED_AT), audit_stamp(source, RUN2), _LINE_KEY, merge_ts=MERGE_TS, keys_not_null=True)


# --- sinks ----------------------------------------------------------------

def stamped_sql(columns, source, at):
    return f"""SELECT {", ".join(columns)}, TIMESTAMP '{at}' AS "AUD_CreateDatetime", TIMESTAMP '{at}' AS "AUD_LastModDatetime",
    CAST(0 AS INTEGER) AS "AUD_isDeleted" FROM {source}"""


@query(stamped_sql(EVENTS.names, f"events WHERE ts > TIMESTAMP '{EVENT_MARK}'", RUN2))
def diff_load(spark, sf_dir):
    """Truncate and fill the diff, twice: the second run leaves only its own rows."""
    stage = Stage(spark, new_workdir(spark, "diff-load"))
    for condition, at in (("event_type = 'error'", RUN1), (f"ts > timestamp_ntz'{EVENT_MARK}'", RUN2)):
        spec = LoadSpec("events", EVENTS, lambda s: table(s, sf_dir, "events"), INCREMENT, where=condition)
        stage.run(spec, at)
    return stage.diff(spec)


@query(f"SELECT {', '.join(EVENTS.names)} FROM events")
def append_load(spark, sf_dir):
    """Append what lies past the mark: a first run, a second with new rows, a third with none."""
    stage = Stage(spark, new_workdir(spark, "append"))
    events = table(spark, sf_dir, "events")
    early = events.where(F.col("ts") <= timestamp_literal(EVENT_MARK))
    first = LoadSpec("events", EVENTS, lambda _: early, pattern=APPEND, delta=Delta("ts", "datetime"))
    later = LoadSpec("events", EVENTS, lambda _: events, pattern=APPEND, delta=Delta("ts", "datetime"))
    for spec, at in ((first, RUN1), (later, RUN2), (later, MERGE_TS)):
        stage.run(spec, at)
    return stage.target(later)


@query(stamped_sql(CUSTOMER.names, "customer", RUN2))
def full_refresh(spark, sf_dir):
    stage = Stage(spark, new_workdir(spark, "refresh"))
    spec = LoadSpec("customer", CUSTOMER, lambda s: table(s, sf_dir, "customer"))
    stage.run(spec, RUN1)
    stage.run(spec, RUN2)
    return stage.target(spec)


@query("SELECT o_orderkey, '0x' || lpad(hex(o_orderkey), 16, '0') AS rowver FROM orders")
def insert_select(spark, sf_dir):
    """Copy a versioned table into one that keeps the version as plain bytes."""
    versioned = table(spark, sf_dir, "orders").select("o_orderkey", rowversion.from_number(F.col("o_orderkey")).alias("rowver"))
    copy = VersionedTable(spark, new_workdir(spark, "copy"), versioned.schema)
    copy.write(versioned)
    return copy.read().select("o_orderkey", rowversion.to_hex_text(F.col("rowver")).alias("rowver"))


@query("""SELECT 'truncated' AS state, CAST(0 AS BIGINT) AS row_count
    UNION ALL SELECT 'reloaded', CAST(count(*) AS BIGINT) FROM orders WHERE o_orderstatus = 'O'""")
def truncate_reload(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    kept = VersionedTable(spark, new_workdir(spark, "truncate"), orders.schema)
    kept.write(orders)
    kept.truncate()
    empty = kept.read()
    kept.write(orders.where("o_orderstatus = 'O'"))
    counts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(state).alias("state"), "row_count")
              for state, df in (("truncated", empty), ("reloaded", kept.read()))]
    return counts[0].unionAll(counts[1])


@query("""SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_mktsegment ELSE o_orderpriority END AS o_orderpriority,
    CASE WHEN c_custkey IS NOT NULL AND o_orderstatus = 'O' THEN 'X' ELSE o_orderstatus END AS o_orderstatus
    FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_acctbal < 0) ON o_custkey = c_custkey""")
def update_from_join(spark, sf_dir):
    """Set columns of the orders whose customer is overdrawn."""
    overdrawn = table(spark, sf_dir, "customer").where("c_acctbal < 0").select(
        F.col("c_custkey").alias("o_custkey"), "c_mktsegment")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus")
    return update_from(orders, overdrawn, ["o_custkey"], {
        "o_orderpriority": F.col("c_mktsegment"),
        "o_orderstatus": F.when(F.col("o_orderstatus") == "O", "X").otherwise(F.col("o_orderstatus")),
    }).drop("o_custkey")


@query(merge_sql(STAGED_ORDERS, SOURCE_ORDERS, KEY, ORDER_COLUMNS))
def post_load_hook(spark, sf_dir):
    """The merge as a hook that runs after the diff has been written."""
    stage = Stage(spark, new_workdir(spark, "post-load"))
    target = VersionedTable(spark, f"{stage.root}/target", ORDERS.target_schema())
    target.write(staged_orders(spark, sf_dir))

    def merge_diff(_):
        target.write(merge(target.read(), stage.target(spec), KEY, merge_ts=MERGE_TS, keys_not_null=True))

    spec = LoadSpec("orders_diff", ORDERS, lambda s: source_orders(s, sf_dir), post_load=merge_diff)
    stage.run(spec, RUN2)
    return target.read()


@query(stamped_sql(ORDERS.names, "orders WHERE o_orderstatus = 'O'", RUN1))
def pre_post_source_hook(spark, sf_dir):
    """One hook prepares what the source query reads, another clears it away after the read."""
    stage = Stage(spark, new_workdir(spark, "source-hooks"))
    view = f"open_orders_{stage.root[-12:]}"
    spec = LoadSpec(
        "orders", ORDERS, lambda s: s.table(view),
        pre_source=lambda s: table(s, sf_dir, "orders").where("o_orderstatus = 'O'").createOrReplaceTempView(view),
        post_source=f"DROP VIEW {view}",
    )
    stage.run(spec, RUN1)
    return stage.target(spec)
