"""Subword encoding by the best path through a piece lattice, as a max-plus scan over chunks, and decoding.

A text is encoded into the pieces whose log probabilities sum highest. A chunk's effect on the rest of a text is a
matrix: the best sum from each place where its first piece may begin to each where the next chunk's first may. Matrices
multiply associatively with max and plus, which fixes the places for all chunks of a giant text; each
chunk is then traced back on its own.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from functools import cached_property
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.terms import ramps
from tidemark.session import new_workdir

# Fixed value: the mark that model files write for a space. Here pieces hold the space itself, so that a mark in a
# text is a character like any other.
MARK = "▁"
SPACE = " "
# Characters of a chunk, words remembered by a task, and the grid on which scores are exact sums.
CHUNK = 1 << 16
REMEMBERED, LONGEST_REMEMBERED = 300_000, 64
GRID = 1 << 20
NEVER = -(1 << 60)
STIR = np.uint64(0x9E3779B97F4A7C15)
# Characters of the texts whose words are looked up together, and of the words whose paths are found together.
TOGETHER = 1 << 20
CELLS = 1 << 17
CELL_BITS = 20
# Rows decoded together.
DECODED = 256


@dataclass
class Vocabulary:
    """Pieces with their ids and scores on a grid, the ids of the 256 bytes, and the score of a byte."""

    pieces: dict[str, tuple[int, int]]
    bytes_: list[int]
    byte_score: int
    memory: dict[str, bytes] = field(default_factory=dict, repr=False)

    @cached_property
    def longest(self) -> int:
        return max([1, *map(len, self.pieces)])

    @cached_property
    def texts(self) -> dict[int, bytes]:
        out = {i: p.encode() for p, (i, _) in self.pieces.items()}
        return out | {b: bytes([k]) for k, b in enumerate(self.bytes_)}

    @cached_property
    def cuts_at_space(self) -> bool:
        """Whether no piece holds a space after another character, so that words are encoded one by one."""
        return not any(SPACE in p.lstrip(SPACE) for p in self.pieces)

    @cached_property
    def tree(self) -> dict[str, tuple[int, int] | None]:
        """Every beginning of a piece, with its id and score where it is a piece itself."""
        out: dict[str, tuple[int, int] | None] = {}
        for p in self.pieces:
            for j in range(1, len(p)):
                out.setdefault(p[:j], None)
        return out | self.pieces

    @cached_property
    def units(self) -> re.Pattern:
        """Parts of a text that are encoded one by one: words with the spaces before them, and line breaks if no piece joins them."""
        alone = all(p == "\n" or "\n" not in p for p in self.pieces)
        return re.compile(r"\n| *[^ \n]+| +" if alone else r" *[^ ]+| +")

    def __getstate__(self) -> dict:
        return {"pieces": self.pieces, "bytes_": self.bytes_, "byte_score": self.byte_score}

    def __setstate__(self, state: dict) -> None:
        self.__init__(**state)

    def step(self, char: str) -> tuple[list[int], int]:
        """A character by its bytes."""
        data = char.encode("utf-8", "surrogatepass")
        return [self.bytes_[b] for b in data], self.byte_score * len(data)

    def best(self, text: str) -> tuple[list[int], int]:
        """The best pieces of a text and their sum. Bytes score below every piece, so they serve characters without one."""
        n, tree = len(text), self.tree
        score, back = [NEVER] * (n + 1), [0] * (n + 1)
        score[0] = 0
        for i in range(n):
            s, j = score[i], i + 1
            hit = tree.get(text[i:j], False)
            if not hit:
                b = s + self.step(text[i])[1]
                if b > score[j]:
                    score[j], back[j] = b, i
            while hit is not False:
                if hit is not None and s + hit[1] > score[j]:
                    score[j], back[j] = s + hit[1], i
                j += 1
                if j > n:
                    break
                hit = tree.get(text[i:j], False)
        out, at = [], n
        while at:
            i = back[at]
            hit = self.pieces.get(text[i:at])
            out.append((hit[0],) if hit else self.step(text[i])[0])
            at = i
        return [i for ids in reversed(out) for i in ids], score[n]

    @cached_property
    def table(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Pieces by fingerprint: a sparse table of places, the next place of the same cell, then fingerprints and
        (id, score) by place; place 0 is none."""
        names = sorted(self.pieces, key=len)
        prints = np.zeros(len(names) + 1, np.uint64)
        at = 1
        for n in sorted({len(p) for p in names}):
            group = [p for p in names if len(p) == n]
            prints[at:at + len(group)] = self._prints(_codes(group, n))[n - 1][:, 0]
            at += len(group)
        values = np.array([(0, NEVER), *(self.pieces[p] for p in names)], np.int64)
        places, after = np.zeros(1 << CELL_BITS, np.int32), np.zeros(len(prints), np.int32)
        for i, cell in enumerate((prints[1:] >> np.uint64(64 - CELL_BITS)).tolist(), 1):
            after[i], places[cell] = places[cell], i
        return places, after, prints, values

    def _found(self, h: np.ndarray) -> np.ndarray:
        """The places of pieces by fingerprint, 0 where there is none."""
        places, after, prints, _ = self.table
        at = places[(h >> np.uint64(64 - CELL_BITS)).astype(np.int64)].ravel()
        flat = h.ravel()
        other = np.flatnonzero((at > 0) & (prints[at] != flat))
        while len(other):
            at[other] = after[at[other]]
            other = other[(at[other] > 0) & (prints[at[other]] != flat[other])]
        return at.reshape(h.shape)

    def _prints(self, codes: np.ndarray) -> list[np.ndarray]:
        """Fingerprints of the substrings of every row, by length and by where they start."""
        out, h = [], np.zeros(codes.shape, np.uint64)
        for n in range(1, min(self.longest, codes.shape[1]) + 1):
            h = (h[:, : codes.shape[1] - n + 1] + codes[:, n - 1:]) * STIR
            out.append(h ^ (h >> np.uint64(29)))
        return out

    def best_many(self, units: list[str]) -> dict[str, bytes]:
        """The pieces ``best`` finds for many short texts, as ids of 32 bits, those of one length together."""
        out: dict[str, bytes] = {}
        by_size: dict[int, list[str]] = {}
        for u in units:
            by_size.setdefault(len(u), []).append(u)
        for n, group in by_size.items():
            if n > LONGEST_REMEMBERED or len(group) < 8:
                out.update((u, _packed(self.best(u)[0])) for u in group)
                continue
            rows = CELLS // n
            for at in range(0, len(group), rows):
                out.update(self._best_of(group[at:at + rows], n))
        return out

    def _best_of(self, group: list[str], n: int) -> dict[str, bytes]:
        """The pieces of texts of ``n`` characters each."""
        m, values = len(group), self.table[3]
        found = [self._found(h) for h in self._prints(_codes(group, n))]
        score = np.full((m, n + 1), NEVER, np.int64)
        back, piece = np.zeros((m, n + 1), np.int64), np.zeros((m, n + 1), np.int64)
        score[:, 0] = 0
        for j in range(1, n + 1):
            for size in range(min(j, len(found)), 0, -1):
                at = found[size - 1][:, j - size]
                s = score[:, j - size] + values[at, 1]
                better = (at > 0) & (s > score[:, j])
                score[better, j], back[better, j], piece[better, j] = s[better], size, at[better]
        rows, place, steps = np.arange(m), np.full(m, n), []
        while (place > 0).any():
            steps.append(np.where(place > 0, values[piece[rows, place], 0], -1))
            place = place - np.maximum(back[rows, place], (place > 0) & (back[rows, place] == 0))
        ids = np.stack(steps[::-1], axis=1).astype(np.int32)
        # A row's ids stand at its end. Characters without a piece are spelt one text at a time.
        data, ends = ids.tobytes(), ids.itemsize * ids.shape[1] * (rows + 1)
        starts = ends - ids.itemsize * (ids >= 0).sum(axis=1)
        sure = (found[0] > 0).all(axis=1)
        return {u: data[a:b] if plain else _packed(self.best(u)[0]) for u, a, b, plain in zip(group, starts.tolist(), ends.tolist(), sure.tolist())}

    @cached_property
    def scores(self) -> dict[int, int]:
        return {b: self.byte_score for b in self.bytes_} | dict(self.pieces.values())

    def encode_all(self, texts: list[str]) -> list[np.ndarray]:
        """Best pieces of texts that start and end at piece boundaries."""
        if not self.cuts_at_space:
            return [np.array(self.best(t)[0] if t else [], np.int32) for t in texts]
        units, memory = [self.units.findall(t) for t in texts], self.memory
        if len(memory) > REMEMBERED:
            memory.clear()
        found = self.best_many(list(set(chain.from_iterable(units)) - memory.keys()))
        memory.update(found)
        out = [np.frombuffer(b"".join(map(memory.__getitem__, us)), np.int32) for us in units]
        for u in found:
            if len(u) > LONGEST_REMEMBERED:
                del memory[u]
        return out

    def encoded(self, text: str) -> tuple[list[int], int]:
        ids = self.encode_all([text])[0].tolist()
        return ids, sum(map(self.scores.__getitem__, ids))

    def cuts(self, text: str, start: int, end: int) -> tuple[int, int] | None:
        """The first and the last place in a chunk where a piece has to begin."""
        if not self.cuts_at_space:
            return None
        is_cut = lambda i: i > 0 and text[i] == SPACE and text[i - 1] != SPACE
        first = start
        while (first := text.find(SPACE, first, end)) >= 0 and not is_cut(first):
            first += 1
        if first < 0:
            return None
        last = end
        while not is_cut(last := text.rfind(SPACE, start, last)):
            pass
        return first, last

    def transfer(self, text: str, start: int, end: int) -> np.ndarray:
        """Best sums from text[start + j] to the first boundary at or after ``end``, text[end + k], for all j and k."""
        size, n = self.longest, len(text)
        out = np.full((size, size), NEVER, np.int64)
        cuts = self.cuts(text, start, end)
        # All paths meet in a place where a piece has to begin: what lies before and after only adds up.
        if cuts:
            middle = self.encoded(text[cuts[0]:cuts[1]])[1]
            after = self.reach(text, cuts[1], end)
            for j in range(min(size, cuts[0] - start + 1)):
                before = self.encoded(text[start + j:cuts[0]])[1]
                for k, s in after.items():
                    out[j, k] = before + middle + s
            return out
        for j in range(size):
            if start + j < end:
                for k, s in self.reach(text, start + j, end).items():
                    out[j, k] = s
            elif start + j <= n:
                out[j, start + j - end] = 0
        return out

    def reach(self, text: str, start: int, end: int) -> dict[int, int]:
        """Best sums from ``start`` to every first boundary at or after ``end``, by how far after."""
        n, size, tree = len(text) - start, self.longest, self.tree
        score = [NEVER] * (end - start + size + 1)
        score[0] = 0
        for i in range(end - start):
            s, j = score[i], i + 1
            if s == NEVER:
                continue
            hit = tree.get(text[start + i:start + j], False)
            if not hit:
                score[j] = max(score[j], s + self.step(text[start + i])[1])
            while hit is not False:
                if hit is not None and s + hit[1] > score[j]:
                    score[j] = s + hit[1]
                j += 1
                if j > n:
                    break
                hit = tree.get(text[start + i:start + j], False)
        return {k: score[end - start + k] for k in range(size) if score[end - start + k] > NEVER}

    def entries(self, text: str, start: int, end: int, ahead: np.ndarray) -> list[int]:
        """For each first boundary text[end + k] at or after ``end``, where the chunk's own first piece begins on the path of the whole
        text, as text[start + j]; ``ahead`` are the best sums of the text up to each such beginning.

        Of equal sums the piece that begins first wins, at every place from the right; one that begins in front of the chunk does so first.
        """
        size, n, tree = self.longest, len(text), self.tree
        cuts = self.cuts(text, start, end)
        # All paths meet where a piece has to begin: how they go on from there is no matter.
        stop = cuts[0] if cuts else end
        score = [NEVER] * (end - start + size + 1)
        enter = [0] * len(score)
        for j in range(min(size, len(score))):
            score[j], enter[j] = int(ahead[j]), j
        for i in range(stop - start):
            s, j = score[i], i + 1
            if s == NEVER:
                continue
            hit = tree.get(text[start + i:start + j], False)
            if not hit:
                b = s + self.step(text[start + i])[1]
                if b > score[j]:
                    score[j], enter[j] = b, enter[i]
            while hit is not False:
                if hit is not None and s + hit[1] > score[j]:
                    score[j], enter[j] = s + hit[1], enter[i]
                j += 1
                if start + j > n:
                    break
                hit = tree.get(text[start + i:start + j], False)
        return [enter[stop - start]] * size if cuts else enter[end - start:end - start + size]

    def encode(self, text: str) -> list[int]:
        return self.encoded(marked(text))[0]

    def decode(self, ids: list[int]) -> str:
        texts = self.texts
        return b"".join([texts[i] for i in ids]).decode("utf-8", "surrogatepass")[1:]

    @cached_property
    def spelling(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """The bytes of all ids one after the other, where each id's begin, and how many they are."""
        most = max(self.texts, default=0) + 1
        parts = [self.texts.get(i, b"") for i in range(most)]
        lengths = np.array([len(p) for p in parts], np.int64)
        return np.frombuffer(b"".join(parts), np.uint8), np.cumsum(lengths) - lengths, lengths

    def decode_all(self, lists: list[np.ndarray | None]) -> list[str | None]:
        """The texts of many lists of ids, None for None."""
        data, starts, lengths = self.spelling
        held = [x for x in lists if x is not None]
        ids = np.concatenate(held) if held else np.zeros(0, np.int64)
        buf = data[ramps(starts[ids], lengths[ids])].tobytes()
        ends = np.concatenate([[0], np.cumsum(lengths[ids])])[np.cumsum([0, *map(len, held)])]
        texts = iter([buf[a:b].decode("utf-8", "surrogatepass")[1:] for a, b in zip(ends, ends[1:])])
        return [None if x is None else next(texts) for x in lists]


def _packed(ids: list[int]) -> bytes:
    return np.array(ids, np.int32).tobytes()


def _codes(texts: list[str], n: int) -> np.ndarray:
    """Texts of one length as rows of code points, moved off zero."""
    return np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), "<u4").reshape(-1, n).astype(np.uint64) + np.uint64(7)


def marked(text: str) -> str:
    """The text as the lattice sees it, with a space in front."""
    return SPACE + text if text else ""


def vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file. A unigram model keeps its scores; where pieces are only ranked, the rank r scores
    -ln(r + 2), the shape word frequencies have."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    plain = [i for i in range(count) if not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i) or model.is_byte(i))]
    scores = {i: model.get_score(i) for i in plain}
    if all(float(s).is_integer() for s in scores.values()):
        scores = {i: -float(np.log(2 - s)) for i, s in scores.items()}
    least = min(scores.values(), default=-1.0)
    pieces = {model.id_to_piece(i).replace(MARK, SPACE): (i, round(s * GRID)) for i, s in scores.items()}
    named = {model.id_to_piece(i): i for i in range(count) if model.is_byte(i)}
    # Without byte pieces the ids after the last one stand for bytes, so that every text has a path.
    bytes_ = [named.get(f"<0x{b:02X}>", count + b) for b in range(256)]
    return Vocabulary(pieces, bytes_, round((least - 10.0) * GRID))


def combined(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The product of two transfer matrices under max and plus."""
    return np.maximum((x[:, :, None] + y[None, :, :]).max(axis=1), NEVER)


def sums_ahead(matrices: list[np.ndarray]) -> list[np.ndarray]:
    """The best sums of the text up to each place where a chunk's first piece can begin, chunk by chunk."""
    ahead = [np.full(len(matrices[0]), NEVER, np.int64)]
    ahead[0][0] = 0
    for m in matrices[:-1]:
        ahead.append(combined(ahead[-1][None, :], m)[0])
    return ahead


def states(entries: list[list[int]]) -> list[int]:
    """Where each chunk's first piece begins, and last where the text ends: 0 in front of the first chunk and at the end."""
    out = [0]
    for found in reversed(entries):
        out.append(found[out[-1]])
    return out[::-1]


def encode_batches(words: Vocabulary, batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, ids) of batches of (id, text), in smaller batches: what is held at once does not grow with the batches."""
    for b in batches:
        held, size = [], 0
        for n, t in enumerate(b.column(1), 1):
            held.append(marked(t.as_py()))
            size += len(held[-1])
            if size >= TOGETHER or n == b.num_rows:
                out = words.encode_all(held)
                ids = pa.ListArray.from_arrays(pa.array(np.cumsum([0, *map(len, out)]).astype(np.int32)), pa.array(np.concatenate(out)))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(n - len(held), len(held)), ids], names=["id", "ids"])
                held, size = [], 0


def _rows(batch: pa.RecordBatch, *places: int) -> Iterator[tuple]:
    """The values of some columns, row by row."""
    return zip(*((v.as_py() for v in batch.column(c)) for c in places))


def encode(docs: DataFrame, words: Vocabulary, chunk: int = CHUNK, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, ``ids``) of every row: the pieces of its whole text.

    Null and empty texts have no pieces; every other text decodes to itself, whatever characters it holds. Equal texts are
    encoded alike; repeated rows give repeated rows, an empty table none. Other columns are not read.

    Of segmentations with equal sums, the one counts whose last piece begins first, and so on from right to left, at every
    length of text. Texts up to ``chunk`` characters are encoded where they are read. Longer ones are cut into chunks that are dealt
    to all tasks; a text's matrices, two kilobytes for each chunk, meet in one group for the sums ahead of each chunk. From these every
    chunk finds where its first piece begins for each place where its last may end, which fixes the boundaries in a second group.
    """
    spark = docs.sparkSession
    source = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
    kind = source.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(words)
    size = words.longest
    if chunk <= size:
        raise ValueError("a chunk must be longer than the longest piece")

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from encode_batches(sent.value, batches)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, text in enumerate(b.column(1)):
                plain = marked(text.as_py())
                starts = range(0, len(plain), chunk)
                # A chunk sees the character before it and as much after it as a piece can reach.
                yield pa.RecordBatch.from_arrays(
                    [pa.concat_arrays([b.column(0).slice(i, 1)] * len(starts)), pa.array([b.column(2)[i].as_py()] * len(starts), pa.int64()),
                     pa.array(range(len(starts)), pa.int64()), pa.array([len(plain)] * len(starts), pa.int64()),
                     pa.array([plain[max(0, a - 1):a + chunk + size] for a in starts], pa.string())], names=["id", "row", "k", "n", "text"])

    def bounds(k: int, n: int) -> tuple[int, int]:
        start = 1 if k else 0
        return start, start + min(chunk, n - k * chunk)

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sent.value.transfer(t, *bounds(k, n)).astype("<i8").tobytes() for k, n, t in _rows(b, 1, 2, 3)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.binary())], names=["row", "k", "matrix"])

    def look_ahead(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("k")
        found = sums_ahead([np.frombuffer(m, "<i8").reshape(size, size) for m in df["matrix"]])
        return pd.DataFrame({"row": df["row"].to_numpy(), "k": df["k"].to_numpy(), "ahead": [a.astype("<i8").tobytes() for a in found]})

    def enter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [sent.value.entries(t, *bounds(k, n), np.frombuffer(a, "<i8")) for k, n, t, a in _rows(b, 1, 2, 3, 4)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int32()))], names=["row", "k", "entries"])

    def join_up(df: pd.DataFrame) -> pd.DataFrame:
        df = df.sort_values("k")
        found = states(df["entries"].tolist())
        return pd.DataFrame({"row": df["row"].to_numpy(), "k": df["k"].to_numpy(), "enter": found[:-1], "leave": found[1:]})

    def trace(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, (k, n, text, enter, leave) in enumerate(_rows(b, 2, 3, 4, 5, 6)):
                start, end = bounds(k, n)
                found = sent.value.encode_all([text[start + enter:end + leave]])[0]
                ids = pa.ListArray.from_arrays(pa.array([0, len(found)], pa.int32()), pa.array(found))
                yield pa.RecordBatch.from_arrays([b.column(0).slice(i, 1), b.column(1).slice(i, 1), ids, b.column(2).slice(i, 1)], names=["id", "row", "ids", "k"])

    short = source.where(F.length("text") < chunk).mapInArrow(whole, f"id {kind}, ids array<int>")
    path = new_workdir(spark, "pieces")
    schema = f"id {kind}, row bigint, k bigint, n bigint, text string"
    long_ = source.where(F.length("text") >= chunk).withColumn("row", F.monotonically_increasing_id())
    long_.mapInArrow(cut, schema).write.parquet(path)
    held = spark.read.schema(schema).parquet(path).repartition("row", "k")
    matrices = held.select("row", "k", "n", "text").mapInArrow(measure, "row bigint, k bigint, matrix binary")
    ahead = matrices.groupBy("row").applyInPandas(look_ahead, "row bigint, k bigint, ahead binary")
    entries = (held.join(ahead, ["row", "k"]).select("row", "k", "n", "text", "ahead")
               .mapInArrow(enter, "row bigint, k bigint, entries array<int>"))
    fixed = entries.groupBy("row").applyInPandas(join_up, "row bigint, k bigint, enter bigint, leave bigint")
    traced = (held.join(fixed, ["row", "k"]).select("id", "row", "k", "n", "text", "enter", "leave")
              .mapInArrow(trace, f"id {kind}, row bigint, ids array<int>, k bigint"))
    joined = traced.groupBy("row").agg(F.first("id").alias("id"), F.flatten(F.transform(F.array_sort(F.collect_list(F.struct("k", "ids"))), lambda x: x.ids)).alias("ids"))
    return short.unionByName(joined.select("id", "ids")).withColumnRenamed("id", id_column)


def decode(encoded: DataFrame, words: Vocabulary, id_column: str = "doc_id") -> DataFrame:
    """(id, ``ids``, ``text``) of every row's ``ids``; no ids give an empty text, null ids null. Other columns are not read."""
    sent = encoded.sparkSession.sparkContext.broadcast(words)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            lists = b.column(1)
            for at in range(0, b.num_rows, DECODED):
                part = lists.slice(at, DECODED)
                texts = pa.array(sent.value.decode_all([None if x is None else np.asarray(x, np.int64) for x in _arrays(part)]), pa.string())
                yield pa.RecordBatch.from_arrays([b.column(0).slice(at, DECODED), part, texts], names=["id", "ids", "text"])

    source = encoded.select(F.col(id_column).alias("id"), F.col("ids").cast("array<int>").alias("ids"))
    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(run, f"id {kind}, ids array<int>, text string").withColumnRenamed("id", id_column)


def _arrays(lists: pa.ListArray) -> Iterator[np.ndarray | None]:
    """The lists as arrays, null ones as None."""
    valid = lists.is_valid().to_numpy(zero_copy_only=False)
    offsets, values = lists.offsets.to_numpy(), lists.values.to_numpy(zero_copy_only=False)
    for ok, a, b in zip(valid, offsets, offsets[1:]):
        yield values[a:b] if ok else None
