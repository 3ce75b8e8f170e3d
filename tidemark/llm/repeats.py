"""Removal of long byte strings that documents of smaller ids hold, by a sparse suffix index in levels.

Every string of ``length`` bytes holds the gram of least hash among its own: its anchor. Consecutive strings with
one anchor make a stretch, and only stretches are indexed, in suffix order of (anchor, content) fingerprints. What
a stretch shares whole with an earlier document is settled by that order alone; only where an anchor
continues in several ways are the strings of its stretches compared one by one.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rolling import Rolling, joined, mix

# Bytes of text handled at once, and whose entries are sent in one go; bytes of text that a part stands for.
# Every byte of a piece stands for some hundred bytes of arrays, and a worker keeps what it once took.
PIECE_BYTES = 1 << 18
SENT_BYTES, STRETCH_BYTES = 1 << 23, 8
PART_BYTES = 1 << 22
LEAST_PARTS = 1021
LEAST_GROUPS = 509
# Strings that need a look are dealt to this many heaps, or one for so many bytes of text.
LEAST_LOOKS, LOOK_BYTES = 256, 1 << 25
# Answers that a task holds until it sends them off.
ANSWER_ROWS = 1 << 20
# Doc-id ranges whose entries enter a part's levels one after the other.
BATCHES = 8
# An anchor with more stretches than this has its strings dealt out by content instead of by anchor.
HOT_STRETCHES = 256
# Anchors in at least this share of a bounded sample of documents are dealt out by content from the start.
SAMPLE_DOCS, HOT_SHARE = 2048, 0.01
ALL = np.uint32(0xFFFFFFFF)
CHECK, HOT = np.uint32(1), np.uint32(2)


@dataclass(frozen=True)
class Window:
    """Strings of ``length`` bytes with anchors of ``gram`` bytes; 32 strings at most can share an anchor."""

    length: int = 50
    gram: int = 20

    def __post_init__(self) -> None:
        if not 0 <= self.length - self.gram < 32 or self.gram < 1:
            raise ValueError("the gram must be shorter than the length by 31 bytes at most")

    @property
    def choices(self) -> int:
        return self.length - self.gram + 1


@dataclass
class Stretches:
    """Stretches of a list of texts: the text each lies in, its first and last string's start in ``buf``, and fingerprints."""

    buf: np.ndarray
    owner: np.ndarray
    first: np.ndarray
    last: np.ndarray
    anchor: np.ndarray
    content: np.ndarray


def pieces(texts: Iterable[bytes], length: int) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Texts in lists of bounded size; a long one comes in pieces that overlap so that no string is lost or met twice."""
    owner, offset, held, size = [], [], [], 0
    for i, text in enumerate(texts):
        for at in range(0, max(1, len(text) - length + 1), PIECE_BYTES):
            part = text[at:at + PIECE_BYTES + length - 1]
            if held and size + len(part) > PIECE_BYTES:
                yield owner, offset, held
                owner, offset, held, size = [], [], [], 0
            owner.append(i)
            offset.append(at)
            held.append(part)
            size += len(part)
    if held:
        yield owner, offset, held


def stretches(texts: list[bytes], window: Window) -> Stretches:
    buf, starts, ends = joined(texts)
    size, gram, choices = window.length, window.gram, window.choices
    none = np.zeros(0, np.int64)
    if len(buf) < size:
        return Stretches(buf, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    roll = Rolling(buf, seed=9)
    grams = roll.grams(gram)
    bits = np.uint64(len(grams).bit_length())
    # Hash above, place below: the least of a window is its least hash, the leftmost of equal ones.
    least = (grams >> bits << bits) | np.arange(len(grams), dtype=np.uint64)
    span = 1
    while span * 2 <= choices:
        least = np.minimum(least[:-span], least[span:])
        span *= 2
    if span < choices:
        least = np.minimum(least[: len(least) - (choices - span)], least[choices - span:])
    count = np.maximum(ends - starts - size + 1, 0)
    owner = np.repeat(np.arange(len(texts)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count) + np.repeat(starts, count)
    place = (least[at] & ((np.uint64(1) << bits) - np.uint64(1))).astype(np.int64)
    if not len(at):
        return Stretches(buf, none, none, none, none.astype(np.uint64), none.astype(np.uint64))
    new = np.ones(len(at), bool)
    new[1:] = (place[1:] != place[:-1]) | (owner[1:] != owner[:-1])
    head = np.flatnonzero(new)
    first, last = at[head], at[np.append(head[1:], len(at)) - 1]
    return Stretches(buf, owner[head], first, last, grams[place[head]], roll.spans(first, last + size))


def pack(*columns: np.ndarray) -> bytes:
    """Columns of one length as bytes: fingerprints as they are, ids as compressed differences."""
    out = [np.uint32(len(columns[0])).tobytes()]
    for c in columns:
        data = np.diff(c, prepend=c.dtype.type(0)).tobytes() if c.dtype == np.int64 else c.tobytes()
        data = pa.compress(data, "zstd", asbytes=True) if c.dtype in (np.int64, np.uint8) else data
        out += [np.uint32(len(data)).tobytes(), data]
    return b"".join(out)


def unpack(data: bytes, *kinds: type) -> list[np.ndarray]:
    n, at, out = int(np.frombuffer(data, np.uint32, 1)[0]), 4, []
    for kind in kinds:
        size = int(np.frombuffer(data, np.uint32, 1, at)[0])
        body = data[at + 4:at + 4 + size]
        if kind is np.int64:
            out.append(np.cumsum(np.frombuffer(pa.decompress(body, n * 8, "zstd", asbytes=True), np.int64)))
        else:
            out.append(np.frombuffer(body, kind))
        at += 4 + size
    return out


def gathered(bodies, *kinds: type) -> list[np.ndarray]:
    held = [unpack(b, *kinds) for b in bodies]
    return [np.concatenate(c) for c in zip(*held)] if held else [np.zeros(0, k) for k in kinds]


def dealt(keys: np.ndarray, count: int, *columns: np.ndarray) -> Iterator[tuple[int, bytes]]:
    """Rows of the columns by ``keys`` modulo ``count``, packed."""
    part = (keys % keys.dtype.type(count)).astype(np.int64)
    order = np.argsort(part, kind="stable")
    cuts = np.flatnonzero(np.diff(part[order])) + 1
    for rows in np.split(order, cuts):
        if len(rows):
            yield int(part[rows[0]]), pack(*(c[rows] for c in columns))


def leaders(*keys: np.ndarray) -> np.ndarray:
    """Of sorted rows, which differ from the row before in one of the keys."""
    out = np.ones(len(keys[0]), bool)
    for i, k in enumerate(keys):
        differs = k[1:] != k[:-1]
        out[1:] = differs if not i else out[1:] | differs
    return out


class Levels:
    """Sorted runs of (high, low, doc), one entry for each key, each run more than twice as long as the next.

    A new run is merged with the last level as long as that is not much longer, so an entry is merged as often as
    the logarithm of the number of runs.
    """

    def __init__(self) -> None:
        self.runs: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []

    def holds(self, high: np.ndarray, low: np.ndarray) -> np.ndarray:
        found = np.zeros(len(high), bool)
        for run_high, run_low, _ in self.runs:
            at = np.searchsorted(run_high, high)
            open_ = np.flatnonzero(~found)
            while len(open_):
                inside = open_[at[open_] < len(run_high)]
                inside = inside[run_high[at[inside]] == high[inside]]
                same = run_low[at[inside]] == low[inside]
                found[inside[same]] = True
                open_ = inside[~same]
                at[open_] += 1
        return found

    def add(self, high: np.ndarray, low: np.ndarray, doc: np.ndarray) -> None:
        run = high, low, doc
        while self.runs and len(self.runs[-1][0]) <= 2 * len(run[0]):
            run = self.merged(self.runs.pop(), run)
        self.runs.append(run)

    @staticmethod
    def merged(x: tuple, y: tuple) -> tuple:
        high, low, doc = (np.concatenate(c) for c in zip(x, y))
        order = np.lexsort((doc, low, high))
        high, low, doc = high[order], low[order], doc[order]
        keep = leaders(high, low)
        return high[keep], low[keep], doc[keep]

    def whole(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        out = self.runs[0]
        for run in self.runs[1:]:
            out = self.merged(out, run)
        return out


def settle(anchor: np.ndarray, content: np.ndarray, doc: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """For every entry: ALL if an earlier document holds the stretch, CHECK or HOT if its strings need a look, 0 otherwise."""
    high = (anchor.astype(np.uint64) << np.uint64(32)) | (content >> np.uint64(32))
    low = (content & np.uint64(0xFFFFFFFF)).astype(np.uint32)
    out = np.zeros(len(doc), np.uint32)
    by_doc = np.argsort(doc, kind="stable")
    levels, start = Levels(), 0
    while start < len(doc):
        end = min(len(doc), start + max(1, -(-len(doc) // BATCHES)))
        # A document's entries enter together, so that whatever the levels hold is of smaller ids.
        end = int(np.searchsorted(doc[by_doc], doc[by_doc[end - 1]], "right"))
        rows = by_doc[start:end]
        rows = rows[np.lexsort((doc[rows], low[rows], high[rows]))]
        head = leaders(high[rows], low[rows])
        least = doc[rows][head][np.cumsum(head) - 1]
        known = levels.holds(high[rows][head], low[rows][head])[np.cumsum(head) - 1]
        out[rows[known | (least < doc[rows])]] = ALL
        levels.add(high[rows][head], low[rows][head], doc[rows][head])
        start = end
    if not levels.runs:
        return out
    all_high, _, _ = levels.whole()
    names, ways = np.unique(all_high >> np.uint64(32), return_counts=True)
    ways = ways[np.searchsorted(names, anchor.astype(np.uint64))]
    rest = out == 0
    out[rest & (ways > 1)] = CHECK
    out[rest & ((ways > HOT_STRETCHES) | hot)] = HOT
    return out


def least_before(keys: tuple[np.ndarray, ...], doc: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For rows with equal keys: whether a smaller document has them, and whether the row is the first of the smallest."""
    order = np.lexsort((doc, *keys))
    head = leaders(*(k[order] for k in keys))
    least = doc[order][head][np.cumsum(head) - 1]
    before, first = np.zeros(len(doc), bool), np.zeros(len(doc), bool)
    before[order], first[order] = least < doc[order], head
    return before, first


def together(keys: np.ndarray, sizes: np.ndarray, limit: int) -> Iterator[np.ndarray]:
    """Rows in lists of about ``limit`` in total size, those of one key in one list."""
    order = np.argsort(keys, kind="stable")
    begin = np.cumsum(sizes[order]) - sizes[order]
    head = np.flatnonzero(leaders(keys[order]))
    yield from np.split(order, head[np.flatnonzero(np.diff(begin[head] // limit)) + 1])


def masks(doc: np.ndarray, content: np.ndarray, offset: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """One row for each (doc, stretch) with a bit for each of its strings."""
    order = np.lexsort((content, doc))
    head = leaders(doc[order], content[order])
    bits = np.uint32(1) << offset[order].astype(np.uint32)
    return doc[order][head], content[order][head], np.bitwise_or.reduceat(bits, np.flatnonzero(head)) if len(bits) else bits


def taken(buf: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The bytes of many places, one after the other."""
    return buf[np.repeat(start - (np.cumsum(size) - size), size) + np.arange(size.sum())]


def strings(s: Stretches, chosen: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The strings of chosen stretches: which stretch, which of its strings, and its fingerprint."""
    counts = s.last[chosen] - s.first[chosen] + 1
    which = np.repeat(chosen, counts)
    offset = np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
    at = s.first[which] + offset
    return which, offset, Rolling(s.buf, seed=13).spans(at, at + size)


BODY = "part int, kind string, body binary"
PRIME, FACTORS = 2147483647, (48271, 69621)


def scattered(doc: np.ndarray) -> np.ndarray:
    """Ids in an order of their own, so that ids of any common step fall into all groups."""
    x = doc % PRIME * FACTORS[0] % PRIME
    return (x ^ (x >> 15)) * FACTORS[1] % PRIME


def group_of(doc: Column, groups: int) -> Column:
    """The group of an id: ``scattered`` modulo ``groups``."""
    x = F.pmod(F.pmod(doc, F.lit(PRIME)) * FACTORS[0], F.lit(PRIME))
    return F.pmod(F.pmod(x.bitwiseXOR(F.shiftright(x, 15)) * FACTORS[1], F.lit(PRIME)), F.lit(groups)).cast("int")


def in_parts(batches: Iterator[pd.DataFrame]) -> Iterator[list[tuple[str, bytes]]]:
    """(kind, body) of one part after the other, of rows that come sorted by part."""
    last, held = None, []
    for df in batches:
        for part, kind, body in zip(df["part"], df["kind"], df["body"]):
            if held and part != last:
                yield held
                held = []
            last = part
            held.append((kind, body))
    if held:
        yield held


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=["part", "kind", "body"])


def _texts(column: Iterable[str | None]) -> Iterator[bytes]:
    return (b"" if t is None else t.encode("utf-8", "surrogatepass") for t in column)


def _strings_of(column: pa.Array) -> Iterator[str | None]:
    """One text after the other; a batch may hold far more of them than fit a task as Python's strings."""
    return (t.as_py() for t in column)


def _entries(docs: DataFrame, window: Window, parts: int, hot: np.ndarray) -> DataFrame:
    """Stretches of all documents, dealt by anchor, those of hot anchors by content."""
    def flush(held: list[tuple]) -> Iterator[tuple]:
        anchor, content, doc, is_hot = (np.concatenate(c) for c in zip(*held))
        # Of equal stretches the smallest document goes on; the others are settled here.
        before, first = least_before((content, anchor), doc)
        name = (anchor >> np.uint64(32)).astype(np.uint32)
        key = np.where(is_hot, content, anchor)
        for rows in (np.flatnonzero(first & is_hot), np.flatnonzero(first & ~is_hot)):
            for part, body in dealt(key[rows], parts, name[rows], content[rows], doc[rows]):
                yield part, "hot" if is_hot[rows[0]] else "entry", body
        rows = np.flatnonzero(before)
        if len(rows):
            d, c, _ = masks(doc[rows], content[rows], np.zeros(len(rows), np.int64))
            yield int(c[0] % np.uint64(parts)), "done", pack(d, c, np.full(len(d), ALL))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0

        def out():
            rows = list(flush(held))
            return pa.RecordBatch.from_arrays([pa.array([r[0] for r in rows], pa.int32()), pa.array([r[1] for r in rows], pa.string()),
                                               pa.array([r[2] for r in rows], pa.binary())], names=["part", "kind", "body"])
        for b in batches:
            ids = b.column(0).to_numpy()
            for owner, _, texts in pieces(_texts(_strings_of(b.column(1))), window.length):
                s = stretches(texts, window)
                doc = ids[np.array(owner, np.int64)[s.owner]] if len(s.owner) else np.zeros(0, np.int64)
                held.append((s.anchor, s.content, doc, np.isin(s.anchor, hot)))
                # A run of one character makes a stretch of each of its bytes.
                size += max(len(s.buf), STRETCH_BYTES * len(s.owner))
                if size >= SENT_BYTES:
                    yield out()
                    held, size = [], 0
        if held:
            yield out()
    return docs.mapInArrow(run, BODY)


def _hot_anchors(docs: DataFrame, window: Window) -> np.ndarray:
    """Anchors of many documents in a sample bounded by SAMPLE_DOCS; their number is bounded by it as well."""
    ids = docs.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(SAMPLE_DOCS)
    sample = docs.join(F.broadcast(ids), "doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for owner, _, texts in pieces(_texts(_strings_of(b.column(1))), window.length):
                s = stretches(texts, window)
                pairs = np.unique(np.stack([np.array(owner, np.uint64)[s.owner], s.anchor]), axis=1) if len(s.owner) else np.zeros((2, 0), np.uint64)
                names, counts = np.unique(pairs[1], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(names.astype(np.int64)), pa.array(counts.astype(np.int64))], names=["anchor", "n"])
    counted = sample.mapInArrow(run, "anchor bigint, n bigint").groupBy("anchor").agg(F.sum("n").alias("n"))
    rows = counted.where(F.col("n") >= max(2, int(SAMPLE_DOCS * HOT_SHARE))).select("anchor").collect()
    return np.array([r.anchor for r in rows], np.int64).astype(np.uint64)


def remove_repeats(docs: DataFrame, window: Window = Window(), id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_bytes, ``kept`` binary, ``removed`` array of (start, end)) for every row, bytes counted in UTF-8.

    Removed is every byte covered by a string of ``window.length`` bytes that also starts in a document of a smaller
    id; strings are judged on the input. A null text counts as empty, shorter texts lose nothing. Rows without an id
    neither lose nor remove anything; rows that repeat an id never remove from each other. An empty table gives none.

    Stretches (one for some sixteen bytes) are shuffled as fingerprints in packs, equal ones of a pack once; a
    document gets back what was settled. Texts are shuffled once, by id, and read for the few strings
    that need a look and again for the result. Anchors of many documents are dealt out by content, so no
    key's rows meet in one task. A task holds one part of the index at a time, whatever number of parts it gets.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_column).cast("bigint").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    known = rows.where("doc_id IS NOT NULL")
    total = known.agg(F.sum(F.octet_length("text")).alias("n")).first().n or 0
    parts, groups = max(LEAST_PARTS, total // PART_BYTES), max(LEAST_GROUPS, total // PART_BYTES)
    tasks, looks = int(spark.conf.get("spark.sql.shuffle.partitions")), max(LEAST_LOOKS, total // LOOK_BYTES)
    hot = spark.sparkContext.broadcast(_hot_anchors(known, window))

    def answers(found: list[list[np.ndarray]]) -> Iterator[pd.DataFrame]:
        """What a task found out, dealt to the groups of documents in one go."""
        if found:
            doc, content, mask = (np.concatenate(c) for c in zip(*found))
            yield _frame([(p, "status", b) for p, b in dealt(scattered(doc), groups, doc, content, mask)])

    def looked(batches: Iterator[pd.DataFrame], look: Callable[[list[tuple[str, bytes]]], list[list[np.ndarray]]]) -> Iterator[pd.DataFrame]:
        """What a look finds in every part; one part is held at a time, and a bounded number of answers."""
        found: list[list[np.ndarray]] = []
        for sent in in_parts(batches):
            found += look(sent)
            if sum(len(f[0]) for f in found) >= ANSWER_ROWS:
                yield from answers(found)
                found = []
        yield from answers(found)

    def first_look(sent: list[tuple[str, bytes]]) -> list[list[np.ndarray]]:
        found = [unpack(b, np.int64, np.uint64, np.uint32) for k, b in sent if k == "done"]
        sent = [(k, b) for k, b in sent if k != "done"]
        if sent:
            sizes = [int(np.frombuffer(b, np.uint32, 1)[0]) for _, b in sent]
            anchor, content, doc = gathered([b for _, b in sent], np.uint32, np.uint64, np.int64)
            state = settle(anchor, content, doc, np.repeat([k == "hot" for k, _ in sent], sizes))
            keep = np.flatnonzero(state)
            found.append([doc[keep], content[keep], state[keep]])
        return found

    def second_look(statuses: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        doc, content, state = gathered(statuses["body"], np.int64, np.uint64, np.uint32)
        out: list[tuple] = []
        settled = np.flatnonzero(state == ALL)
        if len(settled):
            out.append((int(content[settled[0]] % np.uint64(looks)), "status", pack(doc[settled], content[settled], state[settled])))
        asked = np.flatnonzero((state == CHECK) | (state == HOT))
        if not len(asked):
            return _frame(out)
        # An entry is known by its document and content; of equal rows one is looked at.
        code = mix(content[asked] + mix(doc[asked].astype(np.uint64)))
        order = np.argsort(code)
        code, wanted = code[order], state[asked][order]
        here = texts[texts["doc_id"].isin(np.unique(doc[asked]))]
        ids = here["doc_id"].to_numpy()
        cold_rows: list[tuple] = []
        hot_rows: list[tuple] = []
        for owner, _, held in pieces(_texts(here["text"]), window.length):
            s = stretches(held, window)
            if not len(s.owner):
                continue
            d = ids[np.array(owner, np.int64)[s.owner]]
            mine = mix(s.content + mix(d.astype(np.uint64)))
            at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
            what = np.where(code[at] == mine, wanted[at], np.uint32(0))
            some = np.flatnonzero(what)
            some = some[np.unique(mine[some], return_index=True)[1]]
            cold = some[what[some] == CHECK]
            cold = cold[np.argsort(s.anchor[cold] % np.uint64(looks), kind="stable")]
            sizes = s.last[cold] - s.first[cold] + window.length
            cold_rows.append((s.anchor[cold], d[cold], s.content[cold], sizes, taken(s.buf, s.first[cold], sizes)))
            which, offset, name = strings(s, some[what[some] == HOT], window.length)
            hot_rows.append((name, s.anchor[which], d[which], s.content[which], offset))
        if cold_rows:
            anchor, d, c, sizes, data = (np.concatenate(x) for x in zip(*cold_rows))
            part = (anchor % np.uint64(looks)).astype(np.int64)
            order = np.argsort(part, kind="stable")
            data = taken(data, np.cumsum(sizes)[order] - sizes[order], sizes[order])
            ends = np.cumsum(sizes[order])
            for rows in np.split(np.arange(len(order)), np.flatnonzero(np.diff(part[order])) + 1):
                if len(rows):
                    pick = order[rows]
                    body = data[ends[rows[0]] - sizes[pick[0]]:ends[rows[-1]]]
                    out.append((int(part[pick[0]]), "strings", pack(d[pick], c[pick], anchor[pick], sizes[pick].astype(np.uint32)) + pa.compress(body.tobytes(), "zstd", asbytes=True)))
            name, anchor, d, c, offset = (np.concatenate(x) for x in zip(*hot_rows))
            before, _ = least_before((name, anchor), d)
            rows = np.flatnonzero(before)
            if len(rows):
                md, mc, mm = masks(d[rows], c[rows], offset[rows])
                out.append((int(mc[0] % np.uint64(looks)), "status", pack(md, mc, mm)))
            # A string may lie in several stretches of its first document: each of them asks.
            rows = np.flatnonzero(~before)
            out += [(p, "names", b) for p, b in dealt(name[rows], looks, name[rows], anchor[rows], d[rows], c[rows], offset[rows].astype(np.uint32))]
        return _frame(out)

    def repeated(name: np.ndarray, anchor: np.ndarray, doc: np.ndarray, content: np.ndarray, offset: np.ndarray) -> list[list[np.ndarray]]:
        """Which strings a smaller document holds."""
        before, _ = least_before((name, anchor), doc)
        rows = np.flatnonzero(before)
        return [list(masks(doc[rows], content[rows], offset[rows]))] if len(rows) else []

    def third_look(sent: list[tuple[str, bytes]]) -> list[list[np.ndarray]]:
        found = [unpack(b, np.int64, np.uint64, np.uint32) for k, b in sent if k == "status"]
        for kind in sorted({k for k, _ in sent} - {"status"}):
            bodies = [b for k, b in sent if k == kind]
            if kind == "names":
                name, anchor, doc, content, offset = gathered(bodies, np.uint64, np.uint64, np.int64, np.uint64, np.uint32)
                for some in together(name, np.ones(len(name), np.int64), PIECE_BYTES):
                    found += repeated(name[some], anchor[some], doc[some], content[some], offset[some])
            else:
                cols, texts = [], []
                for body in bodies:
                    d, c, a, sizes = unpack(body, np.int64, np.uint64, np.uint64, np.uint32)
                    at = 4
                    for _ in range(4):
                        at += 4 + int(np.frombuffer(body, np.uint32, 1, at)[0])
                    texts.append(pa.decompress(body[at:], int(sizes.sum()), "zstd", asbytes=True))
                    cols.append((d, c, a, sizes.astype(np.int64)))
                doc, content, anchor, sizes = (np.concatenate(x) for x in zip(*cols))
                buf, begin = np.frombuffer(b"".join(texts), np.uint8), np.cumsum(sizes) - sizes
                for some in together(anchor, sizes, PIECE_BYTES):
                    size = sizes[some]
                    ends = np.cumsum(size)
                    s = Stretches(taken(buf, begin[some], size), doc[some], ends - size, ends - window.length, anchor[some], content[some])
                    which, offset, name = strings(s, np.arange(len(some)), window.length)
                    found += repeated(name, s.anchor[which], s.owner[which], s.content[which], offset)
        return found

    def finish(statuses: pd.DataFrame, texts: pd.DataFrame) -> pd.DataFrame:
        doc, content, mask = gathered(statuses["body"], np.int64, np.uint64, np.uint32)
        code = mix(content + mix(doc.astype(np.uint64)))
        order = np.argsort(code, kind="stable")
        code, mask = code[order], mask[order]
        if len(code):
            head = np.flatnonzero(leaders(code))
            code, mask = code[head], np.bitwise_or.reduceat(mask, head)
        data, ids = list(_texts(texts["text"])), texts["doc_id"].to_numpy()
        sizes = np.fromiter(map(len, data), np.int64, len(data))
        begin = np.cumsum(sizes + 1) - sizes - 1
        # Where removed runs begin and end, in all texts one after the other with a place between them.
        change = np.zeros(int((sizes + 1).sum()) + 1, np.int32)
        touched = np.flatnonzero(np.isin(ids, np.unique(doc)))
        for owner, shift, held in pieces([data[i] for i in touched], window.length):
            s = stretches(held, window)
            if not len(s.owner) or not len(code):
                continue
            row = touched[np.array(owner, np.int64)]
            moved = begin[row] + np.array(shift, np.int64) - np.cumsum([0, *map(len, held)])[:-1]
            mine = mix(s.content + mix(ids[row][s.owner].astype(np.uint64)))
            at = np.minimum(np.searchsorted(code, mine), len(code) - 1)
            hits = np.flatnonzero(code[at] == mine)
            bits, count = mask[at[hits]], s.last[hits] - s.first[hits] + 1
            place = s.first[hits] + moved[s.owner[hits]]
            full = np.uint32(1) << (count - 1).astype(np.uint32)
            full |= full - np.uint32(1)
            whole = (bits & full) == full
            some = np.flatnonzero(~whole)
            which = np.repeat(some, count[some])
            offset = np.arange(len(which)) - np.repeat(np.cumsum(count[some]) - count[some], count[some])
            on = (bits[which] >> offset.astype(np.uint32)) & np.uint32(1) == 1
            starts = np.concatenate([place[whole], (place[which] + offset)[on]])
            ends = np.concatenate([(place + count - 1 + window.length)[whole], (place[which] + offset + window.length)[on]])
            np.add.at(change, starts, 1)
            np.add.at(change, ends, -1)
        covered = np.cumsum(change, out=change) > 0
        marked = [covered[a:a + n] for a, n in zip(begin, sizes)]
        out = []
        for i, t, m in zip(ids, data, marked):
            edges = np.flatnonzero(np.diff(m.astype(np.int8), prepend=0, append=0))
            kept = np.frombuffer(t, np.uint8)[~m].tobytes() if len(edges) else t
            out.append((i, len(t), kept, [{"start": int(a), "end": int(b)} for a, b in zip(edges[::2], edges[1::2])]))
        return pd.DataFrame(out, columns=["doc_id", "n_bytes", "kept", "removed"])

    texts = known.select("doc_id", "text", group_of(F.col("doc_id"), groups).alias("part")).groupBy("part")
    def of_parts(rows: DataFrame, look: Callable) -> DataFrame:
        return rows.repartition(tasks, "part").sortWithinPartitions("part").mapInPandas(lambda batches: looked(batches, look), BODY)

    settled = of_parts(_entries(known, window, parts, hot.value), first_look)
    settled = of_parts(settled.groupBy("part").cogroup(texts).applyInPandas(second_look, BODY), third_look)
    spans = "array<struct<start:bigint,end:bigint>>"
    result = settled.groupBy("part").cogroup(texts).applyInPandas(finish, f"doc_id bigint, n_bytes bigint, kept binary, removed {spans}")
    data = F.coalesce(F.col("text"), F.lit("")).cast("binary")
    alone = rows.where("doc_id IS NULL").select(
        "doc_id", F.octet_length(data).cast("bigint").alias("n_bytes"), data.alias("kept"), F.expr(f"cast(array() AS {spans})").alias("removed"))
    return result.unionByName(alone).withColumnRenamed("doc_id", id_column)


def digest(removed: DataFrame) -> DataFrame:
    """What was removed, in figures, and the hash of the bytes that stay."""
    return removed.select(
        "doc_id", "n_bytes", (F.col("n_bytes") - F.octet_length("kept")).cast("bigint").alias("n_removed"),
        F.size("removed").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))
