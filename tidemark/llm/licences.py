"""Licence scans: normalised text against templates by the Dice coefficient over word bigrams, by DataFrame functions alone."""

from __future__ import annotations

import json
from collections.abc import Callable
from functools import reduce
from math import ceil, floor

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Names of licences, and the notices that works carry for them (short forms, as published).
TEMPLATES = {
    "Apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License. '
        "You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "MIT": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files",
    ],
    "GPL-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as "
        "published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "BSD-3-Clause": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met",
    ],
    "CC-BY-4.0": ["Licensed under CC BY 4.0.", "This work is licensed under a Creative Commons Attribution 4.0 International License."],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0.", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."],
    "CC-BY-SA-4.0": ["Licensed under CC BY-SA 4.0.", "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."],
    "CC0-1.0": ["Released into the public domain under CC0 1.0."],
    "Proprietary": ["All rights reserved."],
}


LINE_BREAK = r"\r\n|[\n\r]"


def undotted(text: Column) -> Column:
    """Lower case, without points except before digits, as version numbers have them."""
    return F.regexp_replace(F.lower(text), r"\.(?![0-9])", "")


def spaced(plain: Column) -> Column:
    """Words of letters and digits, one space apart."""
    return F.trim(F.regexp_replace(plain, r"[^\p{L}\p{N}.]++", " "))


def normalised(text: Column) -> Column:
    """Words of letters and digits, lower case, one space apart; version numbers keep their point."""
    return spaced(undotted(text))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), body), 0)


def bigrams(words: Column) -> Column:
    """Pairs of neighbouring words, as often as they occur."""
    return F.zip_with(F.slice(words, 1, F.greatest(F.lit(0), F.size(words) - 1)), F.slice(words, 2, F.size(words)), lambda a, b: F.concat_ws(" ", a, b))


def templates(spark: SparkSession, named: dict[str, list[str]]) -> DataFrame:
    """(licence, form, grams, size) of templates; their number is the caller's, not the data's."""
    rows = [(name, i, text) for name, forms in named.items() for i, text in enumerate(forms)]
    df = spark.createDataFrame(rows, "licence string, form int, body string")
    pairs = df.select("licence", "form", bigrams(F.split(normalised(F.col("body")), " ")).alias("pairs"))
    return pairs.select("licence", "form", F.array_distinct("pairs").alias("grams"), F.size("pairs").alias("size")).where("size > 0")


def scan(docs: DataFrame, named: dict[str, list[str]] | None = None, least: float = 0.8, id_column: str = "doc_id",
         text_column: str = "text") -> DataFrame:
    """(id, line, licence, form, shared, size, dice, last_line) of every line and of every window of words that is close to a template.

    ``dice`` is 2 * shared / (bigrams of the line or window + bigrams of the template), at least ``least``; bigrams are counted
    as often as they occur, shared ones once. A line is what lies between line breaks, counted from 0; it gets its best template,
    and ties go to the licence and form that come first by name and number. Windows are taken from the words of the whole text, across line
    breaks: they begin and end with a bigram of the template, as the closest do, and each such beginning gets its
    closest end. Of windows that overlap, the one with the largest shared * dice counts. ``line`` and ``last_line`` are those of its first
    and last word. A window within a line that is reported for the same licence is not reported again; a line within a wider window is.
    Null or empty texts and an empty table give no rows; repeated rows repeat theirs. Only the id and text columns are read.

    A template of n bigrams can only reach the threshold if n * least / (2 - least) of them occur. So a text without any of its
    longest bigrams, one more than may be missing, has no line or window for it; texts that lack those of all templates are passed over.
    The others are judged in their own row; nothing is shuffled. Which of the overlapping windows count takes the square of their number in a text.
    """
    named = named or TEMPLATES
    low, high = least / (2 - least), (2 - least) / least
    known = [(r.licence, r.form, r.grams, r["size"], max(1, ceil(r["size"] * low - 1e-9)), floor(r["size"] * high + 1e-9))
             for r in templates(docs.sparkSession, named).orderBy("licence", "form").collect()]
    anchors = sorted({g for _, _, grams, _, need, _ in known for g in sorted(grams, key=lambda g: (-len(g), g))[:max(0, len(grams) - need + 1)]})
    grams = sorted({g for t in known for g in t[2]})
    fields = "licence string, form int, grams array<string>, size int, need int, most int"
    if not anchors:
        known, anchors, grams = [("", 0, [""], 1, 1, 0)], [""], [""]
        docs = docs.where("false")
    listed = F.from_json(F.lit(json.dumps([dict(zip(("licence", "form", "grams", "size", "need", "most"), t)) for t in known])), f"array<struct<{fields.replace(' ', ':').replace(',:', ',')}>>")

    plain = docs.select(F.col(id_column).alias("id"), undotted(F.col(text_column)).alias("plain")).withColumn("flat", spaced(F.col("plain")))
    met = plain.where(reduce(lambda x, y: x | y, [F.contains("flat", F.lit(g)) for g in anchors])).select("id", "plain")
    lines = met.select("id", F.transform(F.split("plain", LINE_BREAK), lambda x: F.filter(F.split(spaced(x), " "), lambda w: w != "")).alias("lines"))

    def result(t: Column, shared: Column, n: Column, first: Column, last: Column, start: Column, end: Column, by: Callable[[Column, Column], Column]) -> Column:
        dice = 2 * shared / (n + t["size"])
        return F.struct(F.negative(by(shared, dice)).alias("order"), t.licence.alias("licence"), t.form.alias("form"), start.alias("start"), end.alias("end"),
                        first.alias("line"), last.alias("last_line"), shared.alias("shared"), t["size"].alias("size"), dice.alias("dice"))

    def judged(words: Column, line: Column) -> Column:
        """The best template of a line, or null."""
        n = F.size(words) - 1
        fitting = lambda t: (n >= t.need) & (n <= t.most)
        return F.when(n.between(min(t[4] for t in known), max(t[5] for t in known)), let(F.array_distinct(bigrams(words)), lambda held: F.array_min(F.transform(
            F.filter("templates", fitting),
            lambda t: result(t, F.size(F.array_intersect(held, t.grams)), n, line, line, F.lit(0), n, lambda _, dice: dice)))))

    def window(t: Column, a: Column) -> Column:
        """The closest window that begins with the hit of this number, or null."""
        h, enough = F.get(t.hits, a), F.get(t.hits, a + t.need - 1)

        def best(ahead: Column) -> Column:
            return F.array_min(F.transform(ahead, lambda y, b: result(
                t, F.size(F.array_distinct(F.transform(F.slice(ahead, 1, b + 1), lambda z: z.gram))), y.at - h.at + 1, h.first, y.last, h.at, y.at, lambda _, dice: dice)))

        return F.when(enough.at - h.at < t.most, let(F.filter(F.slice(t.hits, a + 1, t.most), lambda y: y.at - h.at < t.most), best))

    near = lambda found: F.filter(found, lambda x: x.isNotNull() & (x.dice >= least))
    placed = lines.withColumn("words", F.flatten(F.transform("lines", lambda x, i: F.transform(x, lambda w: F.struct(w.alias("word"), i.alias("line"))))))
    after = F.slice("words", 2, F.size("words"))
    pairs = F.transform(F.zip_with(F.slice("words", 1, F.greatest(F.lit(0), F.size("words") - 1)), after, lambda x, y: F.struct(
        F.concat_ws(" ", x.word, y.word).alias("gram"), x.line.alias("first"), y.line.alias("last"))), lambda x, i: F.struct(i.alias("at"), x.gram.alias("gram"), x.first.alias("first"), x.last.alias("last")))
    hits = placed.select("id", "lines", listed.alias("templates"), F.filter(pairs, lambda x: x.gram.isin(grams)).alias("hits"))
    whole = hits.select("id", "hits", "templates", near(F.transform("lines", judged)).alias("whole"))
    own = whole.select("id", "whole", F.transform("templates", lambda t: F.struct(
        t.licence.alias("licence"), t.form.alias("form"), t["size"].alias("size"), t.need.alias("need"), t.most.alias("most"),
        F.filter("hits", lambda h: F.array_contains(t.grams, h.gram)).alias("hits"))).alias("own"))
    windows = own.select("id", "whole", near(F.flatten(F.transform("own", lambda t: F.transform(t.hits, lambda _, a: window(t, a))))).alias("windows"))
    ranked = F.array_sort(F.transform("windows", lambda x: x.withField("order", -x.shared * x.dice)))
    overlap = lambda x, y: (x.start <= y.end + 1) & (y.start <= x.end + 1)
    apart = F.aggregate("ranked", F.slice("ranked", 1, 0), lambda taken, x: F.when(F.exists(taken, lambda y: overlap(x, y)), taken).otherwise(F.concat(taken, F.array(x))))
    further = F.filter("apart", lambda x: ~F.exists("whole", lambda y: (y.licence == x.licence) & (y.line == x.line) & (y.line == x.last_line)))
    kept = windows.where((F.size("whole") > 0) | (F.size("windows") > 0)).select("id", "whole", ranked.alias("ranked")).select("id", "whole", apart.alias("apart"))
    rows = kept.select("id", F.explode(F.concat("whole", further)).alias("x"))
    whole_numbers = [F.col(f"x.{c}").cast("bigint").alias(c) for c in ("line", "shared", "size", "last_line")]
    return rows.select(F.col("id").alias(id_column), whole_numbers[0], "x.licence", "x.form", *whole_numbers[1:3], "x.dice", whole_numbers[3])
