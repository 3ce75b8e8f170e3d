"""Exact set-similarity join on word shingles: the universe of tokens is split into segments, and sets within reach share one.

Two sets with a Jaccard similarity of t at least differ in H = (1-t)/(1+t) * (|r|+|s|) tokens at most. If hashing
deals the tokens to segments, each difference spoils one segment: sets that both announce more than H segments
that hold tokens agree in one of them. A band of sizes can instead announce about half as many segments together
with their one-deletion neighbourhoods, which stand a difference each; what is cheaper by the number of sets in
the band is taken. Segments without tokens, which unlike sets share, cost most and are passed over.
"""

from __future__ import annotations

import zlib
from bisect import bisect_right
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.components import components, files, landed
from tidemark.llm.rolling import LOWER, chunks, codes, joined, mix, words
from tidemark.session import FREE_SHUFFLES, new_workdir, settings
from tidemark.sources.storage import SharedFiles

CHUNK_BYTES = 1 << 18
# Sizes of a band grow by this power of the ratio of sizes that can link, so that a set meets the band below its own about
# one time in so many; segments there are more of than needed, so that sets can pass over empty ones.
BAND_POWER = 3.2
SPARE = 1.2
LARGEST = 1 << 40
# Bytes of text, and shingles of pairs that are compared, that one file is to stand for.
FILE_BYTES, FILE_SHINGLES = 1 << 22, 1 << 20
# Bits, in words of 64, of the parities by which pairs are passed over: a differing token flips one bit. Parities of unlike sets
# differ in half of their bits at most, so large sets have more of them, up to a bound; the first number is compared where pairs form.
SKETCH_WORDS, MOST_WORDS = 16, 1 << 12
# Rows go to a Python worker in small batches, as both sides hold them.
WHILE_LINKING = FREE_SHUFFLES | {"spark.sql.execution.arrow.maxRecordsPerBatch": "1000"}
# Of the cost model: the share of shingles of three words taken to be common, which falls with their length as a power,
# and the cost of a false candidate in announced rows.
COMMON, FALSE_COST = 0.02, 20


@dataclass(frozen=True)
class Rule:
    """Sets link when ``whole`` * intersection >= ``part`` * union."""

    shingle: int = 3
    part: int = 90
    whole: int = 100

    def largest_partner(self, n: int) -> int:
        return n * self.whole // self.part

    def smallest_partner(self, n: int) -> int:
        return -(-n * self.part // self.whole)

    def differences(self, r: int, s: int) -> int:
        return (self.whole - self.part) * (r + s) // (self.whole + self.part)

    def reach(self, n: int) -> int:
        """Differences that a set of this size can have with any set it links to, none smaller than itself."""
        return self.differences(n, self.largest_partner(n))


@dataclass(frozen=True)
class Scheme:
    """How a band of sizes announces itself: into how many segments, and whether with one-deletion neighbourhoods."""

    segments: int
    deletions: bool


@dataclass(frozen=True)
class Bands:
    """Bands of set sizes; band k starts at ``starts[k]``. ``schemes`` may be filled by ``allocate``."""

    rule: Rule
    schemes: tuple[Scheme, ...] = ()

    @cached_property
    def starts(self) -> list[int]:
        out = [1]
        while out[-1] < LARGEST:
            out.append(max(out[-1] + 1, int(out[-1] * (self.rule.whole / self.rule.part) ** BAND_POWER)))
        return out

    def band(self, n: int) -> int:
        return bisect_right(self.starts, n) - 1

    def options(self, band: int) -> list[Scheme]:
        needed = self.rule.reach(self.starts[band + 1] - 1) + 1
        if needed == 1:
            return [Scheme(1, False)]
        half = (needed + 1) // 2
        return [Scheme(int(needed * SPARE) + 1, False), Scheme(half if half == 1 else int(half * SPARE) + 1, True)]

    def cost(self, band: int, scheme: Scheme, sets: int) -> float:
        size = self.starts[band]
        needed = self.rule.reach(size) + 1
        per_segment = size / scheme.segments
        common = COMMON ** (self.rule.shingle / 3)
        # Unlike sets agree in a segment that holds common tokens alone, or one other that a deletion takes away.
        alike = np.exp(-per_segment * (1 - common)) - np.exp(-per_segment)
        if scheme.deletions:
            used = (needed + 1) // 2
            rows, alike = used * (1 + per_segment), alike * (1 + per_segment * (1 - common))
        else:
            used = rows = needed
        return sets * rows + FALSE_COST * used * (sets * alike) ** 2 / 2

    def allocate(self, sets: dict[int, int]) -> Bands:
        """The cheaper scheme of each band, by how many sets may meet there: its own and those above that probe it."""
        chosen = []
        for k in range(len(self.starts) - 1):
            n = sets.get(k, 0) + sets.get(k + 1, 0)
            chosen.append(min(self.options(k), key=lambda s: self.cost(k, s, n)))
        return Bands(self.rule, tuple(chosen))

    def announce(self, tokens: np.ndarray) -> np.ndarray:
        """The keys of a set of distinct token fingerprints; sets that link share one."""
        if not len(tokens):
            return np.zeros(0, np.uint64)
        n = len(tokens)
        needed = self.rule.reach(n) + 1
        out = []
        for k in range(self.band(self.rule.smallest_partner(n)), self.band(n) + 1):
            out.append(self._keys(tokens, k, min(needed, self.rule.reach(self.starts[k + 1] - 1) + 1)))
        return np.unique(np.concatenate(out))

    def _keys(self, tokens: np.ndarray, k: int, needed: int) -> np.ndarray:
        scheme = self.schemes[k]
        m = scheme.segments
        salt = mix(np.array([k * 2 + scheme.deletions + 1], np.uint64))[0]
        where = ((tokens >> np.uint64(32)) * np.uint64(m) >> np.uint64(32)).astype(np.int64)
        terms = mix(tokens ^ salt)
        held = np.bincount(where, minlength=m)
        order = np.argsort(where, kind="stable")
        sums = np.zeros(len(tokens) + 1, np.uint64)
        np.cumsum(terms[order], out=sums[1:])
        ends = np.cumsum(held)
        content = sums[ends] - sums[ends - held]
        place = mix(np.arange(m, dtype=np.uint64) + salt)
        # A segment without tokens stands no difference, with one it stands equality only.
        units = np.minimum(held, 2) if scheme.deletions else np.minimum(held, 1)
        reached = np.cumsum(units)
        if reached[-1] >= needed:
            used = np.flatnonzero(held[: np.searchsorted(reached, needed) + 1])
            spread = used[held[used] > 1]
        else:
            # Too few segments hold tokens: all are announced, empty ones as well, and two such sets agree in one.
            used = spread = np.arange(m)
        keys = mix(content[used] ^ place[used])
        if scheme.deletions:
            chosen = np.zeros(m, bool)
            chosen[spread] = True
            rows = np.flatnonzero(chosen[where])
            keys = np.concatenate([keys, mix((content[where[rows]] - terms[rows]) ^ place[where[rows]])])
        return keys


def shingle_sets(texts: list[bytes], k: int) -> list[np.ndarray]:
    """For each text its distinct shingles of ``k`` words, as sorted fingerprints; of fewer words, all as one.

    Words and shingles are 64-bit codes of chained blocks: two that differ agree with a chance of 2^-64, whatever they hold.
    """
    buf, starts, ends = joined(texts, b"\n")
    if not len(buf):
        return [np.zeros(0, np.uint64) for _ in texts]
    buf = LOWER[buf]
    first, last = words(buf)
    word = codes(buf, first, last)
    from_, to = np.searchsorted(first, starts), np.searchsorted(first, ends)
    run = word
    for j in range(1, k):
        run = mix(run[:-1] * np.uint64(2 * j + 1) + word[j:]) if len(run) > 1 else run[:0]
    out = []
    for a, b in zip(from_, to):
        if b - a >= k:
            out.append(np.unique(run[a:b - k + 1]))
        elif b > a:
            short = word[a:a + 1]
            for j in range(1, b - a):
                short = mix(short * np.uint64(2 * j + 1) + word[a + j:a + j + 1])
            out.append(mix(short + np.uint64(b - a)))
        else:
            out.append(np.zeros(0, np.uint64))
    return out


def _sets(batches: Iterator[pa.RecordBatch], k: int):
    for b in batches:
        for ids, texts in chunks(b.column(0).to_pylist(), (t.as_py() for t in b.column(1)), CHUNK_BYTES):
            yield ids, [len(t) for t in texts], shingle_sets(texts, k)


def _describe(docs: DataFrame, rule: Rule) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, sizes, sets in _sets(batches, rule.shingle):
            total = [int(s.sum(dtype=np.uint64)) for s in sets]
            mixed = [int(mix(s + np.uint64(77)).sum(dtype=np.uint64)) for s in sets]
            signed = lambda xs: np.array(xs, np.uint64).astype(np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array([len(s) for s in sets], pa.int64()), pa.array(signed(total)), pa.array(signed(mixed)),
                 pa.array(sizes, pa.int64())], names=["id", "n", "f1", "f2", "bytes"])
    return docs.mapInArrow(run, "id bigint, n bigint, f1 bigint, f2 bigint, bytes bigint")


def _announced(docs: DataFrame, bands: Bands) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, _, sets in _sets(batches, bands.rule.shingle):
            keys = [bands.announce(s) if i is not None else s[:0] for i, s in zip(ids, sets)]
            owner = np.repeat(np.array([i or 0 for i in ids], np.int64), [len(x) for x in keys])
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(keys).astype(np.int64)), pa.array(owner)], names=["key", "id"])
    return docs.mapInArrow(run, "key bigint, id bigint")


def _sketch(tokens: np.ndarray, rule: Rule) -> np.ndarray:
    """Parities of a set, in words: enough that linked sets of its size differ in four of nine bits at most."""
    n = SKETCH_WORDS
    while 64 * n < rule.differences(len(tokens), len(tokens)) * 9 // 4 and n < MOST_WORDS:
        n *= 2
    bits = np.bincount((mix(tokens + np.uint64(99)) >> np.uint64(32)).astype(np.int64) % (64 * n), minlength=64 * n) & 1
    return np.packbits(bits.astype(np.uint8)).view(np.uint64)


def _folded(sketch: np.ndarray, n: int) -> np.ndarray:
    """The same set's sketch of ``n`` words: sizes are powers of two times one number."""
    return np.bitwise_xor.reduce(sketch.reshape(-1, n), axis=0)


def _packed(docs: DataFrame) -> DataFrame:
    """(id, packed text), which takes about a quarter of the room of its fingerprints."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts = [zlib.compress((t.as_py() or "").encode("utf-8", "surrogatepass"), 1) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([pa.array(b.column(0).to_pylist(), pa.int64()), pa.array(texts, pa.binary())], names=["id", "packed"])
    return docs.mapInArrow(run, "id bigint, packed binary")


def _sketches(packed: DataFrame, rule: Rule) -> DataFrame:
    """(id, sketch, wide): the parities in ``SKETCH_WORDS`` words, and in all that the set has if these are more."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for ids, texts in chunks(b.column(0).to_pylist(), (zlib.decompress(t.as_py()) for t in b.column(1)), CHUNK_BYTES):
                found = [_sketch(s, rule) for s in shingle_sets(texts, rule.shingle)]
                wide = [x.tobytes() if len(x) > SKETCH_WORDS else None for x in found]
                found = [_folded(x, SKETCH_WORDS).view(np.int64).tolist() for x in found]
                yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(found, pa.list_(pa.int64())), pa.array(wide, pa.binary())],
                                                 names=["id", "sketch", "wide"])
    return packed.mapInArrow(run, "id bigint, sketch array<bigint>, wide binary")


def _told(pairs: DataFrame, sketches: DataFrame, rule: Rule) -> DataFrame:
    """The pairs (a, b, n), n being the sum of sizes, but for those whose wide parities differ in more bits than a link allows."""
    left = sketches.select(F.col("id").alias("a"), F.col("wide").alias("left"))
    right = sketches.select(F.col("id").alias("b"), F.col("wide").alias("right"))

    def near(n: int, x: bytes | None, y: bytes | None) -> bool:
        if x is None or y is None:
            return True
        p, q = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
        size = min(len(p), len(q))
        return int(np.bitwise_count(_folded(p, size) ^ _folded(q, size)).sum()) <= rule.differences(n, 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = [near(n.as_py(), x.as_py(), y.as_py()) for n, x, y in zip(b.column(2), b.column(3), b.column(4))]
            yield b.select([0, 1, 2]).filter(pa.array(keep, pa.bool_()))
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "n", "left", "right")
    # An id that is repeated may have several sets: a pair stays if any two of theirs may link.
    return both.mapInArrow(run, "a bigint, b bigint, n bigint").groupBy("a", "b").agg(F.max("n").alias("n"))


def _verified(pairs: DataFrame, packed: DataFrame, rule: Rule) -> DataFrame:
    """(a, b, shared, total) of candidate pairs: the sizes of intersection and union."""
    left = packed.select(F.col("id").alias("a"), F.col("packed").alias("left"))
    right = packed.select(F.col("id").alias("b"), F.col("packed").alias("right"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            shared, total, x = [], [], None
            texts = (zlib.decompress(t.as_py()) for pair in zip(batch.column(2), batch.column(3)) for t in pair)
            for places, held in chunks(range(2 * batch.num_rows), texts, CHUNK_BYTES):
                for i, y in zip(places, shingle_sets(held, rule.shingle)):
                    if i % 2:
                        both = int((x[np.minimum(np.searchsorted(x, y), len(x) - 1)] == y).sum()) if len(x) else 0
                        shared.append(both)
                        total.append(len(x) + len(y) - both)
                    x = y
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(shared, pa.int64()), pa.array(total, pa.int64())],
                                             names=["a", "b", "shared", "total"])
    both = pairs.join(left, "a").join(right, "b").select("a", "b", "left", "right")
    return both.mapInArrow(run, "a bigint, b bigint, shared bigint, total bigint")


def _classes(source: DataFrame, rule: Rule, work: str) -> tuple[DataFrame, DataFrame]:
    """About every row, and the component of every class of equal sets (n, f1, f2); both are written to the folder ``work``.

    Of the tables written on the way, those that follow the size of the input are removed after their last use.
    """
    shared = SharedFiles(source.sparkSession, work)
    land = lambda df, name, most=None: landed(df, f"{work}/{name}", most)
    drop = lambda *names: [shared.remove(f"{work}/{name}") for name in names]
    about = land(_describe(source, rule), "about")
    # Tables whose rows are known to be few go to few files: each is a process or a request to where they are kept.
    held = about.agg(F.count("*").alias("rows"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes")).first()
    by_rows, by_bytes = files(held.rows), files(held.bytes, FILE_BYTES)
    classes = land(about.where("n > 0 AND id IS NOT NULL").groupBy("n", "f1", "f2").agg(F.min("id").alias("rep")), "classes", by_rows)
    bands = Bands(rule)
    edges = F.array(*[F.lit(s) for s in bands.starts])
    # One row for each band of sizes.
    sizes = classes.groupBy(F.size(F.filter(edges, lambda s: s <= F.col("n"))).alias("k")).agg(F.count("*").alias("c")).collect()
    bands = bands.allocate({r.k - 1: r.c for r in sizes})

    # Announced twice, which costs less than to keep the keys: they outweigh the texts.
    keys = _announced(source, bands)
    heads = keys.groupBy("key").agg(F.min("id").alias("head"), F.max("id").alias("last")).where("head < last").select("key", "head")
    heads = land(heads, "heads")
    rep_of = land(about.join(classes, ["n", "f1", "f2"]).select("id", "rep", "n"), "reps", by_rows)
    # A key's smallest id stands for its class as well: equal sets announce the same keys.
    single = rep_of.where("id = rep").select(F.col("id").alias("own"), "n").distinct()
    grouped = land(keys.join(heads, "key").join(single, F.col("id") == F.col("own")).select("key", "head", "id", "n"), "grouped")
    drop("heads", "reps")
    by_keys = files(grouped.count())
    first = grouped.where("head <> id").groupBy(F.col("head").alias("a"), F.col("id").alias("b")).agg((2 * F.max("n")).alias("n"))
    first = land(first, "first", by_keys)
    needed = first.select(F.col("a").alias("id")).union(first.select("b")).distinct()
    # One plan at every size: what the ids of candidates weigh is not bounded, so they are not broadcast.
    texts = land(_packed(source).join(needed.hint("merge"), "id", "left_semi"), "texts", by_bytes)

    is_link = f"{rule.whole} * shared >= {rule.part} * total"
    # Sets that share a key differ little in size: the shingles of one tell what a pair takes.
    checking = lambda pairs: files(pairs.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0], FILE_SHINGLES)
    checked = land(_verified(first.select("a", "b"), texts, rule), "checked", checking(first))
    links = checked.where(is_link).select("a", "b")
    found = components(links, f"{work}/components-0", links.count())

    far = checked.select(F.col("a").alias("head"), F.col("b").alias("id"), (1 - F.col("shared") / F.col("total")).alias("far"))
    placed = grouped.join(found, "id", "left").withColumn("component", F.coalesce("component", "id")).join(far, ["head", "id"], "left")
    placed = land(placed.select("key", "id", "n", "component", F.coalesce("far", F.lit(0.0)).alias("far")), "placed", by_keys)
    drop("grouped", "first")
    mixed = placed.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low < high").select("key")
    sketches = land(_sketches(texts, rule), "sketches", by_bytes)
    first_words = sketches.select("id", *(F.col("sketch")[i].alias(f"s{i}") for i in range(SKETCH_WORDS)))
    open_ = land(placed.join(land(mixed, "mixed", by_keys), "key").join(first_words, "id"), "open", max(by_keys, by_bytes))
    drop("placed", "mixed")
    other = open_.select("key", *(F.col(c).alias(f"{c}_b") for c in open_.columns if c != "key"))
    apart = " + ".join(f"bit_count(s{i} ^ s{i}_b)" for i in range(SKETCH_WORDS))
    last = (open_.join(other, "key").where("component < component_b")
            .where(f"n * {rule.whole} >= n_b * {rule.part} AND n_b * {rule.whole} >= n * {rule.part}")
            .where(f"abs(far - far_b) <= {1 - rule.part / rule.whole} + 1e-9")
            .where(f"({apart}) * {rule.whole + rule.part} <= {rule.whole - rule.part} * (n + n_b)")
            .groupBy(F.least("id", "id_b").alias("a"), F.greatest("id", "id_b").alias("b")).agg(F.max(F.col("n") + F.col("n_b")).alias("n")))
    last = land(last, "last")
    # A pair's texts travel with it, and of unlike large sets there may be as many pairs as the square of their number.
    told = land(_told(last, sketches, rule), "told", files(last.count()))
    rest = land(_verified(told.select("a", "b"), texts, rule), "rest", checking(told))
    drop("texts", "sketches", "last", "told")
    links = links.unionByName(rest.where(is_link).select("a", "b"))
    final = components(links, f"{work}/final", links.count())

    named = land(classes.join(final, classes["rep"] == final["id"], "left")
                 .select("n", "f1", "f2", F.coalesce("component", "rep").alias("component_id")), "named", by_rows)
    return about, named


def linked(docs: DataFrame, rule: Rule = Rule(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``n_shingles``, ``component_id``) of every row: the size of its set, and the smallest id it reaches by links.

    Words are runs without ASCII white space, A to Z lower-cased. A null or empty text has the empty set and links
    with nothing, and so does a row without an id (its component is null). Rows that repeat an id are one document
    with several sets. Equal sets are joined first; an empty table returns none. Only the id and text columns are read.

    No group is expanded into its pairs: every key's sets are checked against the smallest id among them. Only where
    they then still lie in different components are pairs formed, between components alone, and only those that two
    bounds leave: the distances from the common set may differ by no more than a link allows (the Jaccard distance is a
    metric), and hashed token parities by no more bits than a link may have differing tokens. Pairs of large sets, of which a
    fixed number of bits tells little, are then held to parities that grow with the set, before any text travels for them.
    """
    spark, work = docs.sparkSession, new_workdir(docs.sparkSession, "jaccard")
    source = docs.select(F.col(id_column).cast("bigint").alias("id"), F.col(text_column).cast("string").alias("text"))
    with settings(spark, WHILE_LINKING):
        about, named = _classes(source, rule, work)
    # Rows of one id with several sets carry the smallest component of them.
    result = about.join(named, ["n", "f1", "f2"], "left")
    return result.select(F.col("id").alias(id_column), F.col("n").alias("n_shingles"),
                         F.when(F.col("id").isNotNull(), F.coalesce("component_id", "id")).alias("component_id"))
