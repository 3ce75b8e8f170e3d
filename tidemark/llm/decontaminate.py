"""Test passages in documents by Wu-Manber search: block shift tables skip, suffix buckets select, bytes confirm.

Documents and test items become streams of terms with one space around each. The windows of the items are the search
strings. Strings of like length form a group; a group's table says, for the block that ends a text window of the
group's least length, how far the window may move on. Where it may not move, the bucket of that block names the
strings that end there, and those are compared byte by byte. Many windows of a stream move at a time.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rolling import chunks
from tidemark.llm.terms import eights, ramps, stream, terms
from tidemark.session import new_workdir

CHUNK_BYTES = 1 << 20
# Bytes of a block at most, stretch of a stream that one window walks, string and text pairs compared at a time.
BLOCK = 8
LANE = 512
PAIRS = 1 << 14
# Terms of a piece of a long item, and bytes of items searched for in one pass.
PIECE_TERMS = 2000
PASS_BYTES = 1 << 20
SPREAD = np.uint64(0x9E3779B97F4A7C15)


@dataclass
class Group:
    """Strings of which the shortest has ``least`` bytes; ``strings`` are sorted by the bucket of their block."""

    least: int
    block: int
    bits: int
    shift: np.ndarray
    buckets: np.ndarray
    strings: np.ndarray

    def bucket(self, eight: np.ndarray) -> np.ndarray:
        if self.block < 8:
            eight = eight & np.uint64((1 << 8 * self.block) - 1)
        return (eight * SPREAD) >> np.uint64(64 - self.bits)


@dataclass
class Strings:
    """All search strings in one buffer, the terms of each, and which items have it."""

    data: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    terms: np.ndarray
    item_from: np.ndarray
    item_of: np.ndarray
    items: list[str]
    groups: list[Group]


def windows(text: bytes, size: int) -> list[tuple[bytes, int]]:
    """The distinct windows of ``size`` terms with their numbers of terms; the whole text if it has fewer, but not none."""
    buf, first, last, _ = terms([text])
    if not len(first):
        return []
    data, spaces = stream(buf, first, last)
    held, k = data.tobytes(), min(size, len(first))
    return [(w, k) for w in {held[a:b + 1] for a, b in zip(spaces.tolist(), spaces[k:].tolist())}]


def compiled(items: list[tuple[str, bytes]], size: int) -> Strings:
    """Shift tables and buckets of the windows of some items."""
    names = sorted({i for i, _ in items})
    number = {n: k for k, n in enumerate(names)}
    owners: dict[bytes, set[int]] = {}
    count: dict[bytes, int] = {}
    for name, text in items:
        for w, k in windows(text, size):
            owners.setdefault(w, set()).add(number[name])
            count[w] = k
    strings = sorted(owners, key=len)
    lengths = np.array([len(w) for w in strings], np.int64)
    data = np.frombuffer(b"".join(strings) + bytes(BLOCK), np.uint8)
    starts = np.cumsum(lengths) - lengths
    held = [sorted(owners[w]) for w in strings]
    sizes = np.array([len(h) for h in held], np.int64)
    out = Strings(data, starts, lengths, np.array([count[w] for w in strings], np.int64), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64),
                  np.array([i for h in held for i in h], np.int64), names, [])
    eight = eights(data)
    octave = np.floor(np.log2(np.maximum(lengths, 1))).astype(np.int64)
    for o in np.unique(octave):
        who = np.flatnonzero(octave == o)
        least = int(lengths[who].min())
        block = min(BLOCK, least)
        places = least - block + 1
        bits = int(np.clip(np.ceil(np.log2(8.0 * len(who) * places)), 8, 22))
        group = Group(least, block, bits, np.full(1 << bits, min(places, 65535), np.uint16), np.zeros(0), who)
        for j in range(places):
            np.minimum.at(group.shift, group.bucket(eight[starts[who] + j]), min(places - 1 - j, 65535))
        last = group.bucket(eight[starts[who] + places - 1])
        order = np.argsort(last, kind="stable")
        group.buckets, group.strings = last[order], who[order]
        out.groups.append(group)
    return out


def occurrences(data: np.ndarray, n: int, known: Strings) -> tuple[np.ndarray, np.ndarray]:
    """(place, string) of each occurrence in ``data[:n]``; eight bytes more have to follow."""
    eight, known_eight = eights(data), eights(known.data)
    found: list[tuple[np.ndarray, np.ndarray]] = []
    for g in known.groups:
        end = n - g.least + 1
        at = np.arange(0, max(end, 0), LANE)
        stop = np.minimum(at + LANE, end)
        ahead = g.least - g.block
        stays: list[np.ndarray] = []
        while len(at):
            step = g.shift[g.bucket(eight[at + ahead])]
            stays.append(at[step == 0])
            at = at + np.maximum(step, 1)
            going = at < stop
            at, stop = at[going], stop[going]
        if not stays:
            continue
        at = np.concatenate(stays)
        bucket = g.bucket(eight[at + ahead])
        low, high = np.searchsorted(g.buckets, bucket, "left"), np.searchsorted(g.buckets, bucket, "right")
        at, low, many = at[high > low], low[high > low], (high - low)[high > low]
        mask = np.uint64((1 << 8 * g.block) - 1) if g.block < 8 else np.uint64(0xFFFFFFFFFFFFFFFF)
        cut = 0
        while cut < len(at):
            # Pairs are formed for some places at a time, so that their number stays bounded by the strings.
            upto = max(cut + 1, int(np.searchsorted(np.cumsum(many[cut:]), PAIRS, "right")) + cut)
            part = slice(cut, upto)
            place, string = np.repeat(at[part], many[part]), g.strings[ramps(low[part], many[part])]
            near = (eight[place] & mask) == (known_eight[known.starts[string]] & mask)
            near &= place + known.lengths[string] <= n
            place, string = place[near], string[near]
            # The end of the longest string first: it tells most strings of a common beginning apart.
            tail = place + known.lengths[string] - g.block
            near = (eight[tail] & mask) == (known_eight[known.starts[string] + known.lengths[string] - g.block] & mask)
            place, string = place[near], string[near]
            for i in range(0, len(place), PAIRS):
                p, s = place[i:i + PAIRS], string[i:i + PAIRS]
                lengths = known.lengths[s]
                same = data[ramps(p, lengths)] == known.data[ramps(known.starts[s], lengths)]
                equal = np.logical_and.reduceat(same, np.cumsum(lengths) - lengths)
                found.append((p[equal], s[equal]))
            cut = upto
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate([f[0] for f in found]), np.concatenate([f[1] for f in found])


def search(texts: list[bytes], known: Strings) -> list[tuple[int, np.ndarray, list[str]]]:
    """For each text its number of terms, the places of the terms that an occurrence covers, and the items found."""
    buf, first, last, owner = terms(texts)
    data, spaces = stream(buf, first, last)
    counts = np.bincount(owner, minlength=len(texts))
    place, string = occurrences(data, len(data) - BLOCK, known)
    begin = np.searchsorted(spaces, place)
    k = known.terms[string]
    inside = owner[begin] == owner[begin + k - 1] if len(begin) else np.zeros(0, bool)
    begin, k, string = begin[inside], k[inside], string[inside]
    edge = np.zeros(len(first) + 1, np.int64)
    np.add.at(edge, begin, 1)
    np.add.at(edge, begin + k, -1)
    covered = np.flatnonzero(np.cumsum(edge[:-1]) > 0)
    text, seen = owner[begin], {}
    pairs = np.unique(np.stack([text, string], 1), axis=0) if len(text) else np.zeros((0, 2), np.int64)
    for t, s in pairs.tolist():
        seen.setdefault(t, []).append(known.item_of[known.item_from[s]:known.item_from[s + 1]])
    base = np.cumsum(counts) - counts
    hit_from, hit_to = np.searchsorted(covered, base), np.searchsorted(covered, base + counts)
    return [(int(n), (covered[a:b] - z).astype(np.int32), [known.items[i] for i in np.unique(np.concatenate(seen[t]))] if t in seen else [])
            for t, (n, a, b, z) in enumerate(zip(counts, hit_from, hit_to, base))]


def _pieces(items: DataFrame, size: int, id_column: str, text_column: str) -> DataFrame:
    """(item, piece) of the items: their terms in pieces of bounded number, which overlap so that each window lies in one."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, text in zip(b.column(0).to_pylist(), b.column(1)):
                buf, first, last, _ = terms([text.as_py()])
                starts = range(0, max(1, len(first) - size + 1), PIECE_TERMS)
                cut = [buf[first[i]:last[min(i + PIECE_TERMS + size - 1, len(first)) - 1]].tobytes() for i in starts] if len(first) else []
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(cut), pa.string()), pa.array(cut, pa.binary())], names=["item", "piece"])

    rows = items.select(F.col(id_column).cast("string").alias("item"), F.col(text_column).cast("string").cast("binary").alias("text"))
    return rows.where("item IS NOT NULL AND text IS NOT NULL").mapInArrow(run, "item string, piece binary").distinct()


def find_passages(docs: DataFrame, items: DataFrame, size: int = 10, id_column: str = "doc_id", text_column: str = "text",
                  item_column: str = "item_id", item_text: str = "text", pass_bytes: int = PASS_BYTES) -> DataFrame:
    """(id, n_words, hits, items) of every row: its number of terms, the places of those that a window covers, and the items found.

    A window is ``size`` consecutive terms of an item; an item of fewer terms, but not none, is one window. Whole texts
    are searched. A null or empty text has no terms; neither has a null item, and an item without an id takes no part.
    Items that repeat an id are one item; items that share a window are all found by it. Rows that repeat an id give a
    row each, a row without an id as well; an empty table gives none, without items nothing is hit. Only the id
    and text columns are read. A task holds a few times the longest text.

    The items' strings go to the executors in passes of bounded size. One pass suffices for about a megabyte of items and
    shuffles nothing; what further passes find is merged by id and text.
    """
    spark = docs.sparkSession
    path = new_workdir(spark, "passages")
    _pieces(items, size, item_column, item_text).write.parquet(path)
    pieces = spark.read.schema("item string, piece binary").parquet(path)
    total = pieces.agg(F.sum(F.octet_length("piece") + 64)).first()[0] or 0
    passes = max(1, -(-total // pass_bytes))
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").cast("binary").alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    dealt = pieces.withColumn("pass", F.pmod(F.xxhash64("item", "piece"), F.lit(passes)))

    def one(rows: DataFrame, k: int) -> DataFrame:
        # Read within the pass's bound, as the number of passes follows the size of all pieces.
        held = dealt.where(F.col("pass") == k).select("item", "piece").collect()
        sent = spark.sparkContext.broadcast(compiled([(r.item, bytes(r.piece)) for r in held], size))
        others = [f for f in rows.schema if f.name != "text"]

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = sent.value
            for b in batches:
                found = [r for _, texts in chunks(range(b.num_rows), (t.as_py() for t in b.column(b.num_columns - 1)), CHUNK_BYTES)
                         for r in search(texts, known)]
                yield pa.RecordBatch.from_arrays(
                    [*b.columns[:-1], pa.array([r[0] for r in found], pa.int64()), pa.array([r[1] for r in found], pa.list_(pa.int32())),
                     pa.array([r[2] for r in found], pa.list_(pa.string()))], names=[*(f.name for f in others), "n_words", "hits", "items"])

        schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in others)
        return rows.mapInArrow(run, f"{schema}, n_words bigint, hits array<int>, items array<string>")

    if passes == 1:
        found = one(source, 0)
    else:
        coded = source.select("id", F.sha2(F.coalesce("text", F.lit(b"")), 256).alias("code"), "text")
        parts = [one(coded, k) for k in range(passes)]
        rows = parts[0].withColumn("base", F.lit(1))
        for p in parts[1:]:
            rows = rows.unionByName(p.where(F.size("hits") > 0).withColumn("base", F.lit(0)))
        # Rows of one id and text find the same in a pass, so a group holds one value for each pass.
        merged = rows.groupBy("id", "code").agg(
            F.sum("base").alias("copies"), F.max("n_words").alias("n_words"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_set("hits")))).alias("hits"),
            F.array_distinct(F.flatten(F.collect_set("items"))).alias("items"))
        found = merged.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int"))))
    return found.select(F.col("id").cast(kind).alias(id_column), "n_words", "hits", "items")


def digest(found: DataFrame, id_column: str = "doc_id") -> DataFrame:
    """Numbers of terms, hit terms and items, a hash of the sorted item ids, and whether anything was hit."""
    return found.select(
        id_column, "n_words", F.size("hits").cast("bigint").alias("n_hit"), F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"), (F.size("hits") > 0).alias("contaminated"))


DECONTAMINATION_SQL = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
     d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents, fold),
     b AS (SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
           FROM benchmark, fold WHERE item_id IS NOT NULL),
     windows AS (SELECT DISTINCT item, least(len(w), 10) AS k, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS said
                 FROM (SELECT item, w, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS i FROM b WHERE len(w) > 0)),
     sizes AS (SELECT DISTINCT k FROM windows),
     places AS (SELECT r, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM d, sizes WHERE len(w) >= k),
     hits AS (SELECT p.r, p.i, p.k, windows.item FROM (SELECT r, i, k, array_to_string(w[i:i + k - 1], ' ') AS said FROM places) p
              JOIN windows ON p.k = windows.k AND p.said = windows.said),
     covered AS (SELECT r, count(DISTINCT spot) AS n FROM (SELECT r, unnest(range(i, i + k)) AS spot FROM hits) GROUP BY r),
     named AS (SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(covered.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(named.n, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, covered.n IS NOT NULL AS contaminated
FROM d LEFT JOIN covered ON covered.r = d.r LEFT JOIN named ON named.r = d.r"""
