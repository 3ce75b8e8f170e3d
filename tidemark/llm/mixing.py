"""Mixing to target weights by soft membership: domain posteriors from a classifier, document rates by projected gradient."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Iterator, Mapping
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.quality import Settings as Features
from tidemark.llm.quality import features
from tidemark.llm.rolling import chunks, joined, words
from tidemark.session import new_workdir

CHUNK_BYTES = 1 << 20
# Lengths of a preconditioned step that are tried together, and tasks that count the labelled sample.
TRIED = np.array([1.0, 1 / 2, 1 / 8, 1 / 32])
SAMPLE_TASKS = 16


@dataclass(frozen=True)
class Settings:
    """``max_rows`` bounds the labelled documents the classifier is fitted on; ``sharpness`` how many features' worth of
    evidence a posterior rests on. The descent ends once no domain misses its target by more than ``tolerance`` of all tokens, or the
    targets are shown to be out of reach by as much as they are missed, or after ``steps`` steps."""

    max_rows: int = 4000
    bits: int = 14
    grams: tuple[int, ...] = ()
    sharpness: float = 12.0
    steps: int = 200
    tolerance: float = 0.002


@dataclass
class Domains:
    """Log probabilities of hashed features in each domain: words, pairs of words, and character n-grams if asked."""

    names: list[str]
    weights: np.ndarray
    settings: Settings

    @property
    def hashed(self) -> Features:
        return Features(bits=self.settings.bits, grams=self.settings.grams)

    def posteriors(self, texts: list[bytes]) -> np.ndarray:
        bucket, owner = features(texts, self.hashed)
        n = np.maximum(np.bincount(owner, minlength=len(texts)), 1)
        log = np.stack([np.bincount(owner, weights=w[bucket], minlength=len(texts)) / n for w in self.weights], axis=1)
        odds = np.exp(self.settings.sharpness * (log - log.max(axis=1, keepdims=True)))
        return odds / odds.sum(axis=1, keepdims=True)


def fit_domains(docs: DataFrame, labels: DataFrame, names: list[str], settings: Settings = Settings(), id_column: str = "doc_id",
                text_column: str = "text", domain_column: str = "lang") -> Domains:
    """A classifier of ``names`` from labelled documents, at most ``settings.max_rows`` of them by a hash of their ids.

    Rows of ``labels`` without an id or with a domain that is not among the names teach nothing; a document labelled
    twice takes its smaller domain. A domain without examples is as likely as any by its features.
    """
    chosen = (labels.select(F.col(id_column).alias("id"), F.col(domain_column).alias("domain")).where(F.col("id").isNotNull() & F.col("domain").isin(names))
              .groupBy("id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64(F.col("id").cast("string")), "id").limit(settings.max_rows))
    sample = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text")).join(F.broadcast(chosen), "id").select("domain", "text")
    hashed = Features(bits=settings.bits, grams=settings.grams)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 1 << settings.bits), np.int64)
        for b in batches:
            for rows, texts in chunks(b.column(0).to_pylist(), (t.as_py() for t in b.column(1)), CHUNK_BYTES):
                bucket, owner = features(texts, hashed)
                np.add.at(total, (np.array([names.index(d) for d in rows], np.int64)[owner], bucket), 1)
        yield pa.RecordBatch.from_arrays([pa.array([0]), pa.array([total.astype("<i8").tobytes()], pa.binary())], names=["one", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((len(names), 1 << settings.bits), np.int64)
        for b in batches:
            for data in b.column(0).to_pylist():
                total += np.frombuffer(data, "<i8").reshape(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    # The sample moves to a fixed number of tasks, each of which sends a table of fixed size to the one that adds them.
    dealt = sample.repartition(SAMPLE_TASKS, F.xxhash64("text"))
    row = dealt.mapInArrow(count, "one bigint, counts binary").select("counts").repartition(1).mapInArrow(add, "counts binary").first()
    total = np.frombuffer(row.counts, "<i8").reshape(len(names), -1) if row else np.zeros((len(names), 1 << settings.bits))
    smooth = total + 0.5
    return Domains(names, np.log(smooth / smooth.sum(axis=1, keepdims=True)), settings)


def rates(p: np.ndarray, moves: np.ndarray) -> np.ndarray:
    """The rates of documents after some moves: each starts at 1, goes down by the product of its posteriors and the move, and
    is projected to 0 where it would fall below."""
    out = np.ones(len(p))
    for move in moves:
        out = np.maximum(0, out - p @ move)
    return out


@dataclass
class Sums:
    """After some moves: expected tokens of the domains, their second moments over documents of a rate above 0, and the least
    product of posteriors and the asked direction."""

    totals: np.ndarray
    moments: np.ndarray
    low: float


def sums(n: np.ndarray, p: np.ndarray, moves: np.ndarray, tries: np.ndarray, direction: np.ndarray) -> list[Sums]:
    """The sums of some documents after the moves and each of the tries."""
    before, low, out = rates(p, moves), float((p @ direction)[n > 0].min(initial=np.inf)), []
    for move in tries:
        rate = np.maximum(0, before - p @ move)
        held = n * (rate > 0)
        out.append(Sums((n * rate) @ p, (p * held[:, None]).T @ p, low))
    return out


def solve(measured: Callable[[np.ndarray, np.ndarray, np.ndarray], list[Sums]], share: np.ndarray, tokens: float,
          settings: Settings) -> tuple[np.ndarray, np.ndarray]:
    """The moves after which the rates meet the shares, or come as close as any rates can, and what they then miss.

    Projected gradient on the squared misses: the gradient of a document's rate is its tokens times the product of its posteriors
    and the misses, so a move is one vector for all documents. It is preconditioned by the tokens and by the
    inverse of the domains' moments over the documents that are still in use, which makes the first step exact where none is
    projected; shorter steps and the plain gradient step, which always descends, are tried beside it. All totals that rates can
    give form a cone: a direction that is nonnegative on all posteriors bounds the distance of the shares from it.
    """
    none = np.zeros(len(share))
    moves = np.zeros((0, len(share)))
    here = measured(moves, none[None], none)[0]
    steepest = np.linalg.eigvalsh(here.moments / tokens).max()
    for _ in range(settings.steps):
        miss = here.totals / tokens - share
        if np.abs(miss).max() <= settings.tolerance:
            break
        exact = np.linalg.lstsq(here.moments / tokens, miss, rcond=None)[0]
        tries = np.concatenate([TRIED[:, None] * exact, miss[None] / steepest])
        found = measured(moves, tries, miss)
        normal = miss - min(found[0].low, 0.0)
        bound = max(0.0, -float(share @ normal) / (float(np.linalg.norm(normal)) or 1.0))
        if np.linalg.norm(miss) - bound <= settings.tolerance / 10:
            break
        left = [np.linalg.norm(x.totals / tokens - share) for x in found]
        best = int(np.argmin(left))
        if left[best] >= np.linalg.norm(miss) * (1 - 1e-9):
            break
        moves, here = np.concatenate([moves, tries[best:best + 1]]), found[best]
    return moves, here.totals / tokens - share


def mix_to_targets(docs: DataFrame, domains: Domains, targets: Mapping[str, float], settings: Settings = Settings(),
                   id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, n_tokens, ``posteriors``, ``rate``, ``copies``, ``reached``) of every row, lists in the order of the domains' names.

    Rates are nonnegative and descend from 1, over all documents, on the squared misses of the targets by the expected token
    totals of the domains, rate * tokens * posterior, until the targets are met, however rare a domain is. Targets are shares of
    the tokens there are; missing domains count as 0. ``reached`` are the shares that the rates give; a target that no
    rates can meet is reported by a warning as well, with the share that comes closest. ``copies`` is the rate rounded up or down by a hash of the id and the text, so that its mean
    is the rate. Tokens are runs without white space. A null or empty text has no tokens, even posteriors and a rate
    all the same; repeated rows get equal rates; an empty table gives none. Other columns are not read.

    Posteriors are written once. Each step is one sum over them with some rows for each task, their number that of the domains
    squared; what the driver holds is one vector of the domains for each step taken, from which every task derives its rates.
    """
    spark = docs.sparkSession
    d = len(domains.names)
    share = np.array([float(targets.get(n, 0.0)) for n in domains.names])
    share = share / share.sum() if share.sum() > 0 else np.full(d, 1 / d)
    source = docs.select(F.col(id_column).alias("id"), F.col(text_column).cast("string").alias("text"), F.xxhash64(F.col(id_column), F.col(text_column)).alias("code"))
    kind = source.schema["id"].dataType.simpleString()
    sent = spark.sparkContext.broadcast(domains)

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n, p = [np.zeros(0, np.int64)], [np.zeros((0, d))]
            for _, texts in chunks(range(b.num_rows), (t.as_py() for t in b.column(1)), CHUNK_BYTES):
                buf, starts, ends = joined(texts, b"\n")
                first = words(buf)[0]
                n.append(np.searchsorted(first, ends) - np.searchsorted(first, starts))
                p.append(sent.value.posteriors(texts))
            rows = pa.FixedSizeListArray.from_arrays(pa.array(np.concatenate(p).ravel()), d).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(np.concatenate(n)), rows], names=["id", "code", "n_tokens", "posteriors"])

    schema = f"id {kind}, code bigint, n_tokens bigint, posteriors array<double>"
    path = new_workdir(spark, "mixing")
    source.mapInArrow(judge, schema).write.parquet(path)
    judged = spark.read.schema(schema).parquet(path)

    def matrix(column: pa.Array) -> np.ndarray:
        return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, d)

    each = d + d * d + 1

    def measured(moves: np.ndarray, tries: np.ndarray, direction: np.ndarray) -> list[Sums]:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            out = np.zeros((len(tries), each))
            out[:, -1] = np.inf
            for b in batches:
                for row, x in zip(out, sums(b.column(0).to_numpy().astype(float), matrix(b.column(1)), moves, tries, direction)):
                    row[:-1] += np.concatenate([x.totals, x.moments.ravel()])
                    row[-1] = min(row[-1], x.low)
            yield pa.RecordBatch.from_arrays([pa.array(out.ravel()), pa.array(range(out.size), pa.int32())], names=["x", "k"])
        rows = judged.select("n_tokens", "posteriors").mapInArrow(run, "x double, k int").groupBy("k").agg(F.sum("x").alias("x"), F.min("x").alias("low")).collect()
        out = np.zeros((len(tries), each))
        for r in rows:
            out[divmod(r.k, each)] = r.low if r.k % each == each - 1 else r.x
        return [Sums(x[:d], x[d:-1].reshape(d, d), x[-1]) for x in out]

    moves, miss, tokens = np.zeros((0, d)), -share, float(judged.agg(F.sum("n_tokens")).first()[0] or 0)
    if tokens:
        moves, miss = solve(measured, share, tokens, settings)
        missed = [f"{n}: {s:.4g}, closest {s + m:.4g}" for n, s, m in zip(domains.names, share, miss) if abs(m) > settings.tolerance]
        if missed:
            warnings.warn(f"targets that no rates meet ({'; '.join(missed)})", stacklevel=2)

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield b.append_column("rate", pa.array(rates(matrix(b.column(3)), moves)))

    rated = judged.mapInArrow(apply, schema + ", rate double")
    dice = F.pmod(F.xxhash64("code"), F.lit(1 << 30)) / float(1 << 30)
    return rated.select(F.col("id").alias(id_column), "n_tokens", "posteriors", "rate", (F.floor("rate") + (dice < F.col("rate") % 1).cast("int")).cast("int").alias("copies"),
                        F.array(*(F.lit(float(x)) for x in share + miss)).alias("reached"), "code")
