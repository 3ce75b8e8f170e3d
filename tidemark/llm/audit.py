"""What filters remove in every order they may run in: masks of failures, folded over all orders by higher-order functions.

A text's failures are a mask of five bits. Documents are counted by part, mask and label; from there on only these
cells count, of which a part has 128 at most. A cell folds along each of the 120 orders and gives 600 structs, one
for each step, weighted by its documents; the cells of a part merge by elementwise sums.
"""

from __future__ import annotations

from itertools import permutations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.session import new_workdir

FILTERS = "ABCDE"
ORDERS = ["".join(p) for p in permutations(FILTERS)]
STEPS = len(FILTERS)
SIGNS = "#$%&*|"
COPY = 1 << FILTERS.index("E")
COUNTS = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")


def failures(text: Column, words: Column) -> Column:
    """The mask of the filters that look at one text alone, its first bit for A; ``words`` may hold empty ones."""
    words = F.array_remove(words, "")
    n = F.size(words).cast("bigint")
    capitals = F.octet_length(text) - F.octet_length(F.regexp_replace(text, "[A-Z]+", ""))
    signs = F.lit(False)
    for s in SIGNS:
        signs = signs | F.contains(text, F.lit(s))
    failed = [n < 50, 100 * F.size(F.array_distinct(words)).cast("bigint") < 65 * n,
              100 * capitals.cast("bigint") > 5 * F.char_length(text).cast("bigint"), signs]
    return sum((F.when(f, 1 << k).otherwise(0) for k, f in enumerate(failed)), F.lit(0))


def cells(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail which filters, by label.

    One narrow row for each document is written; the smallest id of each text then meets it under (text code, id), so
    that the copies of a text, however many, are dealt out by their ids.
    """
    spark, path = docs.sparkSession, new_workdir(docs.sparkSession, "audit")
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    marks = (labels.where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("id"))
             .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic")))
    looked = (docs.select(F.col("doc_id").alias("id"), F.coalesce(F.col("source").cast("string"), F.lit("")).alias("part"), text.alias("text"))
              .select("id", "part", "text", F.split("text", r"[\x20\x09-\x0D]+").alias("words"))
              .select("id", "part", F.unhex(F.sha2("text", 256)).alias("code"), failures(F.col("text"), F.col("words")).alias("mask")))
    rows = looked.join(marks, "id", "left").withColumns({c: F.coalesce(c, F.lit(False)) for c in ("good", "toxic")})
    rows.write.parquet(path)
    rows = spark.read.schema(rows.schema).parquet(path)
    least = rows.where("id IS NOT NULL").groupBy("code").agg(F.min("id").alias("id")).withColumn("least", F.lit(True))
    mask = F.col("mask") + F.when(F.col("id").isNotNull() & F.col("least").isNull(), COPY).otherwise(0)
    return (rows.join(least, ["code", "id"], "left").groupBy("part", mask.alias("mask"), "good", "toxic")
            .agg(F.count("*").alias("n")))


def _step(cell: Column, state: Column, letter: Column) -> Column:
    """The state after one more filter: whether the cell's documents are still there, and the counts of the steps so far."""
    bit = F.call_function("shiftleft", F.lit(1), letter)
    fails = cell["mask"].bitwiseAND(bit) != 0
    goes, n, none = state["alive"] & fails, cell["n"], F.lit(0).cast("bigint")
    counts = {
        "kept": F.when(state["alive"] & ~fails, n), "removed": F.when(goes, n), "redundant": F.when(fails & ~state["alive"], n),
        "unique_fails": F.when(cell["mask"] == bit, n), "good_lost": F.when(goes & cell["good"], n), "toxic_lost": F.when(goes & cell["toxic"], n)}
    row = F.struct(letter.alias("letter"), *(counts[c].otherwise(none).alias(c) for c in COUNTS))
    return F.struct((state["alive"] & ~fails).alias("alive"), F.concat(state["out"], F.array(row)).alias("out"))


def audit(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row for each part, order of the filters and step, with the counts of documents and the filter's Shapley sum.

    The filters fail a text (A) of under 50 words, (B) whose distinct words are under 65 % of them, (C) with over 5 %
    capitals, (D) that holds one of six signs, (E) that a document of smaller id has as well. A part is a value of
    ``source``; null joins the empty name. A null text is an empty one: it fails A alone, and E beside another. Rows that repeat an id and a text
    are no copies of each other, and a row without an id is never a copy; each counts as a document. A document
    labelled twice is good or toxic if one label says so, without a label it is neither. An empty table has no
    parts and gives no rows. Other columns are not read.
    """
    orders = F.expr("array(" + ",".join("array(" + ",".join(str(FILTERS.index(c)) for c in o) + ")" for o in ORDERS) + ")")
    row = "struct<letter:int," + ",".join(f"{c}:bigint" for c in COUNTS) + ">"
    start = F.struct(F.lit(True).alias("alive"), F.array().cast(f"array<{row}>").alias("out"))

    def folded(cell: Column) -> Column:
        return F.flatten(F.transform(orders, lambda o: F.aggregate(o, start, lambda s, letter: _step(cell, s, letter), lambda s: s["out"])))

    def added(left: Column, right: Column) -> Column:
        return F.struct(right["letter"].alias("letter"), *((left[c] + right[c]).alias(c) for c in COUNTS))

    zero = F.array_repeat(F.struct(F.lit(0).alias("letter"), *(F.lit(0).cast("bigint").alias(c) for c in COUNTS)), STEPS * len(ORDERS)).cast(f"array<{row}>")
    of_part = cells(docs, labels).groupBy("part").agg(F.collect_list(F.struct("mask", "good", "toxic", "n")).alias("cells"))
    merged = of_part.select("part", F.aggregate("cells", zero, lambda acc, cell: F.zip_with(acc, folded(cell), added)).alias("steps"))
    sums = F.transform(F.sequence(F.lit(0), F.lit(STEPS - 1)), lambda k: F.aggregate(
        "steps", F.lit(0).cast("bigint"), lambda a, s: a + F.when(s["letter"] == k, s["removed"]).otherwise(F.lit(0).cast("bigint"))))
    names = F.array(*map(F.lit, ORDERS))
    return (merged.select("part", "steps", sums.alias("sums")).select("part", "sums", F.posexplode("steps").alias("at", "s"))
            .select("part", names[F.expr(f"at div {STEPS}").cast("int")].alias("filter_order"), (F.col("at") % STEPS + 1).cast("int").alias("step"),
                    *(F.col("s")[c].alias(c) for c in COUNTS), F.col("sums")[F.col("s")["letter"]].alias("shapley")))


AUDIT_SQL = f"""
WITH t AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS body, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS words FROM documents),
     marks AS (SELECT doc_id, coalesce(bool_or(quality = 1), false) AS good, coalesce(bool_or(toxic = 1), false) AS toxic FROM labels GROUP BY doc_id),
     f AS (SELECT t.part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic,
             (CASE WHEN len(words) < 50 THEN 1 ELSE 0 END) + (CASE WHEN 100 * len(list_distinct(words)) < 65 * len(words) THEN 2 ELSE 0 END)
             + (CASE WHEN 100 * length(regexp_replace(body, '[^A-Z]', '', 'g')) > 5 * length(body) THEN 4 ELSE 0 END)
             + (CASE WHEN regexp_matches(body, '[{SIGNS}]') THEN 8 ELSE 0 END)
             + (CASE WHEN coalesce(t.doc_id > min(t.doc_id) OVER (PARTITION BY body), false) THEN 16 ELSE 0 END) AS mask
           FROM t LEFT JOIN marks ON t.doc_id = marks.doc_id),
     cells AS (SELECT part, mask, good, toxic, count(*) AS n FROM f GROUP BY ALL),
     letters AS (SELECT unnest(range(5)) AS k),
     orders AS (SELECT [a.k, b.k, c.k, d.k, e.k] AS o FROM letters a, letters b, letters c, letters d, letters e
                WHERE len(list_distinct([a.k, b.k, c.k, d.k, e.k])) = 5),
     steps AS (SELECT o, s.k + 1 AS step, o[s.k + 1] AS letter, list_sum(list_transform(o[1:s.k], lambda x: CAST(1 << x AS BIGINT))) AS earlier FROM orders, letters s),
     counted AS (SELECT part, o, step, letter,
             sum(CASE WHEN mask & (coalesce(earlier, 0)::BIGINT | (1 << letter)) = 0 THEN n ELSE 0 END) AS kept,
             sum(CASE WHEN mask & (1 << letter) <> 0 AND mask & coalesce(earlier, 0)::BIGINT = 0 THEN n ELSE 0 END) AS removed,
             sum(CASE WHEN mask & (1 << letter) <> 0 AND mask & coalesce(earlier, 0)::BIGINT <> 0 THEN n ELSE 0 END) AS redundant,
             sum(CASE WHEN mask = (1 << letter) THEN n ELSE 0 END) AS unique_fails,
             sum(CASE WHEN good AND mask & (1 << letter) <> 0 AND mask & coalesce(earlier, 0)::BIGINT = 0 THEN n ELSE 0 END) AS good_lost,
             sum(CASE WHEN toxic AND mask & (1 << letter) <> 0 AND mask & coalesce(earlier, 0)::BIGINT = 0 THEN n ELSE 0 END) AS toxic_lost
           FROM cells, steps GROUP BY part, o, step, letter)
SELECT part, array_to_string(list_transform(o, lambda x: substr('{FILTERS}', CAST(x + 1 AS BIGINT), 1)), '') AS filter_order, CAST(step AS INTEGER) AS step,
       {", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in COUNTS)},
       CAST(sum(removed) OVER (PARTITION BY part, letter) AS BIGINT) AS shapley
FROM counted"""
