"""Ranked lexical search: documents in a tree of frequent terms, searched depth first within bounds of its subtrees.

A document is restricted to the terms that any item asks for, most frequent first; documents of a page that begin alike share
a path of its tree. A node knows the largest number of occurrences of every term below it and the least length factor m, which
bound the score of every document below. An item descends only where that bound reaches its k-th score so far.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tidemark.llm.rolling import chunks, mix
from tidemark.llm.terms import eights, ramps, terms
from tidemark.session import new_workdir

CHUNK_BYTES = 1 << 20
# Documents of a page and of a leaf, entries of a page, pairs of item and term of one pass, cells of a table at a time.
PAGE_DOCS = 4096
PAGE_ENTRIES = 1 << 20
LEAF = 32
PASS_PAIRS = 50_000
CELLS = 1 << 22
# Scores that wait until the best of each item are chosen anew.
PENDING = 1 << 14
MASKS = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


class Vocabulary:
    """Known terms, found by their first and last eight bytes and length; longer ones are compared as a whole."""

    def __init__(self, words: list[bytes]) -> None:
        self.size = len(words)
        self.lengths = np.array([len(w) for w in words], np.int64)
        ends = np.cumsum(self.lengths)
        self.data = np.frombuffer(b"".join(words) + bytes(8), np.uint8)
        self.starts = ends - self.lengths
        self.head, self.tail, codes = self._codes(self.data, self.starts, ends)
        self.order = np.argsort(codes, kind="stable")
        self.codes = codes[self.order]
        alike = np.unique(codes, return_counts=True)[1]
        self.alike = int(alike.max(initial=0))

    @staticmethod
    def _codes(data: np.ndarray, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        eight, lengths = eights(data), last - first
        head = eight[first] & MASKS[np.minimum(lengths, 8)]
        tail = np.where(lengths > 8, eight[np.maximum(last - 8, 0)], head)
        return head, tail, mix(head ^ mix(tail + lengths.astype(np.uint64)))

    def find(self, buf: np.ndarray, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The number of each word of the buffer, -1 for one that is not known."""
        out = np.full(len(first), -1, np.int64)
        if not self.size or not len(first):
            return out
        data = np.concatenate([buf, np.zeros(8, np.uint8)])
        head, tail, codes = self._codes(data, first, last)
        low, high = np.searchsorted(self.codes, codes, "left"), np.searchsorted(self.codes, codes, "right")
        for r in range(self.alike):
            who = np.flatnonzero(low + r < high)
            known = self.order[low[who] + r]
            same = (self.lengths[known] == (last - first)[who]) & (self.head[known] == head[who]) & (self.tail[known] == tail[who])
            who, known = who[same], known[same]
            long = np.flatnonzero(self.lengths[known] > 16)
            if len(long):
                sizes = self.lengths[known[long]]
                equal = np.logical_and.reduceat(data[ramps(first[who[long]], sizes)] == self.data[ramps(self.starts[known[long]], sizes)],
                                                np.cumsum(sizes) - sizes)
                who, known = np.delete(who, long[~equal]), np.delete(known, long[~equal])
            out[who] = known
        return out


@dataclass
class Asked:
    """The items of a pass: the terms of each, as ranks by falling frequency, and their weights."""

    items: list
    starts: np.ndarray
    terms: np.ndarray
    weights: np.ndarray
    rank: np.ndarray
    documents: int
    occurrences: int

    @property
    def size(self) -> int:
        return len(self.rank)

    def factors(self, n: np.ndarray) -> np.ndarray:
        """The length factor m of documents of ``n`` terms."""
        if int(n.max(initial=0)) * self.documents * 50 < 1 << 62:
            return 50 + (50 * n * self.documents) // self.occurrences
        return np.array([50 + (50 * int(x) * self.documents) // self.occurrences for x in n], np.int64)


def worth(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """What ``tf`` occurrences count for, before weights: it rises with them and falls with m."""
    return (1_000_000_000 * tf) // (1000 * tf + 20 * m)


@dataclass
class Tree:
    """The nodes of a page, a parent before its children: children, documents of the leaves, and the subtree bounds."""

    children: list[list[int]]
    leaves: list[np.ndarray | None]
    most: np.ndarray
    least: np.ndarray


def plant(starts: np.ndarray, terms_: np.ndarray, tf: np.ndarray, m: np.ndarray, size: int) -> Tree:
    """The tree of some documents, whose terms lie by falling frequency. A path is followed while documents part from it
    and more than a leaf's worth remain; those that end on it are a leaf of their own."""
    lengths = np.diff(starts)
    children: list[list[int]] = [[]]
    leaves: list[np.ndarray | None] = [None]
    todo = [(0, np.arange(len(lengths)), 0)]
    while todo:
        node, docs, depth = todo.pop()
        parts = [docs]
        while len(docs) > LEAF:
            ended = lengths[docs] <= depth
            going = docs[~ended]
            if not len(going):
                break
            here = terms_[starts[going] + depth]
            if not ended.any() and (here == here[0]).all():
                depth += 1
                continue
            order = np.argsort(here, kind="stable")
            parts = np.split(going[order], np.flatnonzero(np.diff(here[order])) + 1)
            if ended.any():
                parts.append(docs[ended])
            break
        if len(parts) == 1 and len(parts[0]) == len(docs):
            leaves[node] = docs
            continue
        # Thin branches side by side make one leaf: a node of its own would bound no better.
        held: list[np.ndarray] = []
        for p in sorted(parts, key=len):
            if held and (len(held[-1]) + len(p) <= LEAF):
                held[-1] = np.concatenate([held[-1], p])
            else:
                held.append(p)
        for p in held:
            children[node].append(len(children))
            children.append([])
            leaves.append(None)
            whole = len(p) <= LEAF or (lengths[p] <= depth).all()
            if whole:
                leaves[-1] = p
            else:
                todo.append((len(children) - 1, p, depth + 1))
    most, least = np.zeros((len(children), size), np.int32), np.full(len(children), np.iinfo(np.int64).max)
    for node in range(len(children) - 1, -1, -1):
        if leaves[node] is not None:
            docs = leaves[node]
            at = ramps(starts[docs], lengths[docs])
            np.maximum.at(most[node], terms_[at], tf[at])
            least[node] = m[docs].min()
        for c in children[node]:
            np.maximum(most[node], most[c], out=most[node])
            least[node] = min(least[node], least[c])
    return Tree(children, leaves, most, least)


class Best:
    """The ``k`` best documents of every item so far; equal scores rank by ascending id."""

    def __init__(self, asked: Asked, k: int, floor: np.ndarray) -> None:
        self.asked, self.k = asked, k
        self.floor = floor
        # The score that a document needs at least to matter.
        self.needed = np.maximum(floor, 1)
        self.item, self.score, self.id = (np.zeros(0, np.int64) for _ in range(3))
        self._waiting: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self._count = 0

    def add(self, item: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        self._waiting.append((item, score, ids))
        self._count += len(item)
        if self._count >= PENDING:
            self.settle()

    def settle(self) -> None:
        columns = [(self.item, self.score, self.id), *self._waiting]
        item, score, ids = (np.concatenate(c) for c in zip(*columns))
        order = np.lexsort((ids, -score, item))
        item, score, ids = item[order], score[order], ids[order]
        head = np.searchsorted(item, np.arange(len(self.asked.items)))
        place = np.arange(len(item)) - head[item]
        kept = place < self.k
        self.item, self.score, self.id = item[kept], score[kept], ids[kept]
        last = place[kept] == self.k - 1
        self.needed[self.item[last]] = np.maximum(self.needed[self.item[last]], self.score[last])
        self._waiting, self._count = [], 0


def summed(table: np.ndarray, asked: Asked, chosen: np.ndarray) -> np.ndarray:
    """For each row of worths by term, the weighted sum over the terms of each chosen item."""
    sizes = np.diff(asked.starts)[chosen]
    at = ramps(asked.starts[chosen], sizes)
    return np.add.reduceat(table[:, asked.terms[at]] * asked.weights[at], np.cumsum(sizes) - sizes, axis=1)


def descend(tree: Tree, starts: np.ndarray, terms_: np.ndarray, tf: np.ndarray, m: np.ndarray, ids: np.ndarray, asked: Asked, best: Best) -> None:
    """Takes every item down the tree, depth first and the higher bounds first, and scores the leaves it reaches."""
    every = np.arange(len(asked.items))
    pairs = max(1, len(asked.terms))
    step = max(1, CELLS // max(pairs, asked.size))
    bounds = np.concatenate([summed(worth(tree.most[i:i + step].astype(np.int64), tree.least[i:i + step][:, None]), asked, every)
                             for i in range(0, len(tree.least), step)])
    stack = [(0, every)]
    while stack:
        node, alive = stack.pop()
        # Looked at again, as the k-th scores have risen since the node was put aside.
        alive = alive[bounds[node, alive] >= best.needed[alive]]
        if not len(alive):
            continue
        if tree.leaves[node] is None:
            stack += [(c, alive) for c in sorted(tree.children[node], key=lambda c: int(bounds[c, alive].sum()))]
            continue
        for docs in np.array_split(tree.leaves[node], -(-len(tree.leaves[node]) // LEAF)):
            sizes = starts[docs + 1] - starts[docs]
            at = ramps(starts[docs], sizes)
            row = np.repeat(np.arange(len(docs)), sizes)
            table = np.zeros((len(docs), asked.size), np.int64)
            table[row, terms_[at]] = worth(tf[at], m[docs][row])
            for part in np.array_split(alive, -(-pairs * len(docs) // CELLS)):
                if not len(part):
                    continue
                scores = summed(table, asked, part)
                doc, item = np.nonzero(scores >= best.needed[part])
                if len(doc):
                    best.add(part[item], scores[doc, item], ids[docs[doc]])


def pages(batch: pa.RecordBatch, asked: Asked) -> Iterator[tuple[np.ndarray, ...]]:
    """(starts, terms as ranks, tf, m, ids) of pages of a batch, each document's terms by falling frequency."""
    ids, n = batch.column(0).to_numpy(), batch.column(1).to_numpy()
    offsets = batch.column(2).offsets.to_numpy().astype(np.int64)
    rank = asked.rank[batch.column(2).flatten().to_numpy()]
    tf = batch.column(3).flatten().to_numpy().astype(np.int64)
    offsets -= offsets[0]
    m, a = asked.factors(n.astype(np.int64)), 0
    while a < len(ids):
        b = min(len(ids), a + PAGE_DOCS)
        b = max(a + 1, min(b, int(np.searchsorted(offsets, offsets[a] + PAGE_ENTRIES, "right")) - 1))
        part = slice(offsets[a], offsets[b])
        starts = offsets[a:b + 1] - offsets[a]
        owner = np.repeat(np.arange(b - a), np.diff(starts))
        order = np.lexsort((rank[part], owner))
        yield starts, rank[part][order], tf[part][order], m[a:b], ids[a:b]
        a = b


def _vectors(docs: DataFrame, words: list[bytes]) -> DataFrame:
    """(id, n, terms, tf) of every row: its number of terms, and those of the vocabulary by number with their occurrences."""
    sent = docs.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = Vocabulary(sent.value)
        for b in batches:
            for places, texts in chunks(range(b.num_rows), (t.as_py() for t in b.column(1)), CHUNK_BYTES):
                buf, first, last, owner = terms(texts)
                found = known.find(buf, first, last)
                cell, tf = np.unique(owner[found >= 0] * max(known.size, 1) + found[found >= 0], return_counts=True)
                starts = np.searchsorted(cell, np.arange(len(texts) + 1) * max(known.size, 1)).astype(np.int32)
                lists = [pa.ListArray.from_arrays(pa.array(starts), pa.array(v.astype(np.int32))) for v in (cell % max(known.size, 1), tf)]
                yield pa.RecordBatch.from_arrays(
                    [b.column(0).slice(places[0], len(places)), pa.array(np.bincount(owner, minlength=len(texts)).astype(np.int64)), *lists],
                    names=["id", "n", "terms", "tf"])

    rows = docs.select(F.col("id"), F.col("text").cast("string").cast("binary").alias("text"))
    return rows.mapInArrow(run, "id bigint, n bigint, terms array<int>, tf array<int>")


def _asked_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item, term) of the items, each once."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for name, text in zip(b.column(0), b.column(1)):
                buf, first, last, _ = terms([text.as_py()])
                data = buf.tobytes()
                found = sorted({data[x:y] for x, y in zip(first.tolist(), last.tolist())})
                yield pa.RecordBatch.from_arrays([pa.array([name.as_py()] * len(found), b.schema.field(0).type), pa.array(found, pa.binary())],
                                                 names=["item", "term"])

    rows = items.select(F.col(item_column).alias("item"), F.col(text_column).cast("string").cast("binary").alias("text"))
    rows = rows.where("item IS NOT NULL AND text IS NOT NULL")
    return rows.mapInArrow(run, f"item {rows.schema['item'].dataType.simpleString()}, term binary").distinct()


def _searched(vectors: DataFrame, asked: Asked, k: int, floor: np.ndarray, kind: str) -> DataFrame:
    """(item, id, score): of every task, the ``k`` best documents of each item that reach the item's floor."""
    sent = vectors.sparkSession.sparkContext.broadcast((asked, floor))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        asked, floor = sent.value
        best = Best(asked, k, floor)
        for b in batches:
            for starts, rank, tf, m, ids in pages(b, asked):
                descend(plant(starts, rank, tf, m, asked.size), starts, rank, tf, m, ids, asked, best)
        best.settle()
        names = pa.array([asked.items[i] for i in best.item.tolist()], item_type)
        yield pa.RecordBatch.from_arrays([names, pa.array(best.id), pa.array(best.score)], names=["item", "id", "score"])

    item_type = to_arrow_type(T.StructType.fromDDL(f"item {kind}")["item"].dataType)
    return vectors.where("id IS NOT NULL AND size(terms) > 0").mapInArrow(run, f"item {kind}, id bigint, score bigint")


def ranked(docs: DataFrame, items: DataFrame, k: int = 50, id_column: str = "doc_id", text_column: str = "text", item_column: str = "item_id",
           item_text: str = "text", pass_pairs: int = PASS_PAIRS) -> DataFrame:
    """(item, rank, id, score): each item's ``k`` highest-scoring documents with a score above 0, ties by ascending id.

    Every row is a document, rows that repeat an id or a text as well; one without an id counts in the statistics and is not
    returned. Null and empty texts hold no terms and count nowhere. Items that repeat an id are one item with the terms of all;
    a null, an empty item or one without an id gets no rows. Empty tables give none. Only the id and text columns are read.

    The restricted vectors are written once and searched in pages of bounded size, in the partitions they were written in.
    One page, dealt by a hash, is searched first: its k-th scores are floors for all others, and a task keeps
    its best from page to page. What is shuffled is ``k`` rows an item and task at most. Items are asked in passes of bounded
    pairs of item and term; an item of more terms makes a pass that holds it whole.
    """
    spark = docs.sparkSession
    work = new_workdir(spark, "lexical")
    asked_terms = _asked_terms(items, item_column, item_text)
    kind = asked_terms.schema["item"].dataType.simpleString()
    asked_terms.write.parquet(f"{work}/asked")
    asked_terms = spark.read.schema(asked_terms.schema).parquet(f"{work}/asked")
    passes = max(1, -(-asked_terms.count() // pass_pairs))
    dealt = asked_terms.withColumn("pass", F.pmod(F.xxhash64("item"), F.lit(passes)))
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).alias("text"))
    found = []
    for p in range(passes):
        # Read within the pass's bound, as the number of passes follows the number of pairs.
        pairs = [(r.item, bytes(r.term)) for r in dealt.where(F.col("pass") == p).select("item", "term").collect()]
        words = sorted({t for _, t in pairs})
        _vectors(source, words).write.parquet(f"{work}/vectors-{p}")
        vectors = spark.read.schema("id bigint, n bigint, terms array<int>, tf array<int>").parquet(f"{work}/vectors-{p}")
        about = vectors.agg(F.count_if(F.col("n") > 0).alias("documents"), F.sum("n").alias("occurrences")).first()
        df = np.zeros(len(words), np.int64)
        for r in vectors.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).collect():
            df[r.term] = r.df
        asked = _asked(pairs, words, df, about.documents, about.occurrences or 1)
        if not asked.items:
            continue
        page = F.pmod(F.xxhash64("id"), F.lit(max(1, -(-about.documents // PAGE_DOCS)))) == 0
        floor = np.zeros(len(asked.items), np.int64)
        place = {name: i for i, name in enumerate(asked.items)}
        first = _best(_searched(vectors.where(page), asked, k, floor, kind), k)
        for r in first.where(F.col("rank") == k).select("item", "score").collect():
            floor[place[r.item]] = r.score
        found.append(_searched(vectors, asked, k, floor, kind))
    if not found:
        found = [spark.createDataFrame([], f"item {kind}, id bigint, score bigint")]
    rows = found[0]
    for f in found[1:]:
        rows = rows.unionByName(f)
    return _best(rows, k).select(F.col("item").alias(item_column), "rank", F.col("id").alias(id_column), "score")


def _asked(pairs: list[tuple], words: list[bytes], df: np.ndarray, documents: int, occurrences: int) -> Asked:
    rank = np.empty(len(words), np.int64)
    rank[np.lexsort((np.arange(len(words)), -df))] = np.arange(len(words))
    weight = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * int(d) + 1))) for d in df], np.int64)
    number = {w: i for i, w in enumerate(words)}
    of_item: dict = {}
    for item, term in pairs:
        of_item.setdefault(item, []).append(number[term])
    items = sorted(of_item)
    held = [np.array(sorted(of_item[i], key=lambda t: rank[t]), np.int64) for i in items]
    flat = np.concatenate(held) if held else np.zeros(0, np.int64)
    starts = np.concatenate([[0], np.cumsum([len(h) for h in held])]).astype(np.int64)
    return Asked(items, starts, rank[flat], weight[flat], rank, documents, occurrences)


def _best(rows: DataFrame, k: int) -> DataFrame:
    """The ``k`` best of every item; Spark cuts each task's rows to as many before they are shuffled."""
    order = Window.partitionBy("item").orderBy(F.col("score").desc(), "id")
    return rows.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


RANKED_SQL = r"""
WITH fold AS (SELECT 'ABCDEFGHIJKLMNOPQRSTUVWXYZ' AS up, 'abcdefghijklmnopqrstuvwxyz' AS low),
     d AS (SELECT row_number() OVER () AS r, doc_id,
             regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents, fold),
     about AS (SELECT CAST(count(*) AS BIGINT) AS docs, CAST(sum(len(w)) AS BIGINT) AS total FROM d WHERE len(w) > 0),
     q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), up, low), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t
           FROM benchmark, fold WHERE item_id IS NOT NULL),
     held AS (SELECT r, t, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(w) AS t FROM d) WHERE t IN (SELECT t FROM q) GROUP BY r, t),
     weights AS (SELECT t, CAST(floor(1000 * ln((2 * docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS weight FROM held, about GROUP BY t, docs),
     worth AS (SELECT held.r, doc_id, held.t, weight * ((1000000000 * tf) // (1000 * tf + 20 * (100 - 50 + (50 * len(w) * docs) // total))) AS part
               FROM held JOIN d ON held.r = d.r JOIN weights ON held.t = weights.t, about),
     scores AS (SELECT item_id, r, doc_id, CAST(sum(part) AS BIGINT) AS score FROM worth JOIN q ON worth.t = q.t GROUP BY item_id, r, doc_id)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 AND doc_id IS NOT NULL QUALIFY rank <= 50"""
