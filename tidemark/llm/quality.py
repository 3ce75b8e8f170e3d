"""Supervised subword embeddings: hashed word and character n-gram vectors, averaged and fed to a softmax."""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rolling import Rolling, chunks, joined, mix, words

CHUNK_BYTES = 1 << 18


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled documents the model is fitted on, and ``bits`` the size of its table."""

    bits: int = 17
    dim: int = 8
    grams: tuple[int, ...] = (3, 4)
    epochs: int = 6
    rate: float = 0.6
    max_rows: int = 6000
    seed: int = 11


@dataclass
class Model:
    """``vectors`` holds one row per hashed feature; ``output`` and ``bias`` are the softmax layer of two classes."""

    settings: Settings
    vectors: np.ndarray
    output: np.ndarray
    bias: np.ndarray
    prior: float = 0.5
    margin: np.ndarray = field(init=False)

    def __post_init__(self) -> None:
        # The layers are linear, so each feature's share of the log odds can be read from one table.
        self.margin = (self.vectors @ (self.output[:, 1] - self.output[:, 0])).astype(np.float64)

    def scores(self, texts: list[bytes]) -> np.ndarray:
        buckets, owner = features(texts, self.settings)
        n = np.bincount(owner, minlength=len(texts))
        total = np.bincount(owner, weights=self.margin[buckets], minlength=len(texts))
        odds = total / np.maximum(n, 1) + (self.bias[1] - self.bias[0])
        return 1 / (1 + np.exp(-np.clip(odds, -500, 500)))


def features(texts: list[bytes], settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """Hashed features of all texts, and the text each belongs to: words, pairs of neighbouring
    words, and the character n-grams of the text with its white space."""
    buf, starts, ends = joined(texts, b"\n")
    empty = np.zeros(0, np.int64)
    if not len(buf):
        return empty, empty
    roll = Rolling(buf, seed=3)
    first, last = words(buf)
    word, owner = roll.spans(first, last), np.searchsorted(ends, first, "right")
    parts, owners = [word], [owner]
    same = np.flatnonzero(owner[1:] == owner[:-1])
    parts.append(mix(word[same] * np.uint64(3) + word[same + 1]))
    owners.append(owner[same])
    owner_of = np.repeat(np.arange(len(texts)), np.append(starts[1:], len(buf)) - starts) if settings.grams else owner
    for n in settings.grams:
        gram = roll.grams(n)
        inside = np.flatnonzero(np.arange(len(gram)) + n <= ends[owner_of[: len(gram)]])
        parts.append(gram[inside])
        owners.append(owner_of[inside])
    return (np.concatenate(parts) >> np.uint64(64 - settings.bits)).astype(np.int64), np.concatenate(owners)


def train(rows: list[tuple[np.ndarray, np.ndarray, int]], settings: Settings) -> Model:
    """Stochastic gradient descent, one document at a time; ``rows`` are (buckets, counts, label)."""
    rng = np.random.default_rng(settings.seed)
    vectors = rng.uniform(-1, 1, (1 << settings.bits, settings.dim)).astype(np.float32) / settings.dim
    output = np.zeros((settings.dim, 2), np.float32)
    labels = np.array([y for _, _, y in rows])
    if not len(rows) or labels.min() == labels.max():
        share = labels.mean() if len(rows) else 0.5
        bias = np.log(np.clip([1 - share, share], 0.01, 0.99))
        return Model(settings, vectors * 0, output, bias)
    bias = np.log([(labels == 0).mean(), (labels == 1).mean()])
    steps, done = settings.epochs * len(rows), 0
    for _ in range(settings.epochs):
        for k in rng.permutation(len(rows)):
            buckets, counts, y = rows[k]
            rate = settings.rate * (1 - done / steps)
            done += 1
            if not len(buckets):
                continue
            weight = (counts / counts.sum()).astype(np.float32)
            held = vectors[buckets]
            mean = weight @ held
            z = mean @ output + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            # A feature that fills a small share of a text still has to move: steps are scaled to its root.
            vectors[buckets] = held - np.outer(np.sqrt(weight), (rate * output @ p).astype(np.float32))
            output -= (rate * np.outer(mean, p)).astype(np.float32)
            bias = bias - 0.1 * rate * p
    return Model(settings, vectors, output, bias)


def fit(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), id_column: str = "doc_id",
        text_column: str = "text", label_column: str = "quality") -> Model:
    """Fits the model on at most ``settings.max_rows`` labelled documents, chosen by a hash of their ids.

    Labels are 0 or 1; rows with another or no label, or without an id, teach nothing. A document labelled
    twice takes its lower label, one stored twice its smaller text. Without labelled documents every score is
    one half, with one class alone the share of that class. Features are counted in parallel; one task runs the
    descent over the bounded sample and returns the model, whose size the settings fix.
    """
    chosen = (labels.select(F.col(id_column).alias("id"), F.col(label_column).cast("int").alias("label"))
              .where("id IS NOT NULL AND label IN (0, 1)").groupBy("id").agg(F.min("label").alias("label"))
              .orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(settings.max_rows))
    sample = (docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text"))
              .join(F.broadcast(chosen), "id").select("id", "label", "text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, ys, out = b.column(0).to_pylist(), b.column(1).to_pylist(), []
            for text in b.column(2):
                bucket, n = np.unique(features([text.as_py().encode()], settings)[0], return_counts=True)
                out.append([zlib.compress(x.astype("<i4").tobytes(), 1) for x in (bucket, n)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, b.schema.field(0).type), pa.array(ys, pa.int32()), pa.array([o[0] for o in out], pa.binary()),
                 pa.array([o[1] for o in out], pa.binary())], names=["id", "label", "buckets", "counts"])

    def descend(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = {}
        for b in batches:
            for i, y, *packed in zip(*b.columns):
                i, y, (bucket, n) = i.as_py(), y.as_py(), (np.frombuffer(zlib.decompress(x.as_py()), "<i4") for x in packed)
                if i not in held or (bucket.tobytes(), n.tobytes()) < tuple(x.astype("<i4").tobytes() for x in held[i][:2]):
                    held[i] = bucket, n.astype(np.min_scalar_type(n.max(initial=0))), y
        m = train([row for _, row in sorted(held.items(), key=lambda r: str(r[0]))], settings)
        yield pa.RecordBatch.from_arrays(
            [pa.array([m.vectors.astype("<f4").tobytes()], pa.binary()), pa.array([m.output.astype("<f4").tobytes()], pa.binary()),
             pa.array([m.bias.tolist()], pa.list_(pa.float64()))], names=["vectors", "output", "bias"])

    kind = sample.schema["id"].dataType.simpleString()
    counted = sample.mapInArrow(count, f"id {kind}, label int, buckets binary, counts binary")
    # The features of the sample move, packed, to the one task that descends; scan and count stay in theirs.
    row = counted.repartition(1).mapInArrow(descend, "vectors binary, output binary, bias array<double>").first()
    if row is None:
        return train([], settings)
    return Model(settings, np.frombuffer(row.vectors, "<f4").reshape(-1, settings.dim),
                 np.frombuffer(row.output, "<f4").reshape(settings.dim, 2), np.array(row.bias))


def score(docs: DataFrame, model: Model, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per document: its id and ``score``, the probability of label 1, from its whole text alone.

    A null text counts as empty and scores the model's bias; equal texts score alike, repeated rows give repeated
    rows; an empty table gives none. Other columns are not read. The model is sent to each executor once; its
    size is fixed by the settings it was fitted with. No shuffle.
    """
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"))
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [sent.value.scores(held) for _, held in chunks(range(b.num_rows), (t.as_py() for t in b.column(1)), CHUNK_BYTES)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(np.concatenate(out) if out else [], pa.float64())], names=["id", "score"])

    kind = source.schema["id"].dataType.simpleString()
    return source.mapInArrow(apply, f"id {kind}, score double").withColumnRenamed("id", id_column)


HELD_OUT = "pmod(crc32(cast(doc_id AS string)), 4) = 2"


def scored(docs: DataFrame, labels: DataFrame, settings: Settings = Settings(), threshold: float = 0.7) -> DataFrame:
    """Scores of all documents by a model that never saw the held-out quarter of the labels."""
    model = fit(docs, labels.where(f"NOT ({HELD_OUT})"), settings)
    return score(docs, model).select(
        "doc_id", F.coalesce(F.expr(HELD_OUT), F.lit(False)).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
