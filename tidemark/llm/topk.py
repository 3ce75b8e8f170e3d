"""Exact top-k by inner product: blocks of a document range, ordered by summed term maxima, read until no bound reaches the k-th."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.vectors import best_of, matrix, usable
from tidemark.session import new_workdir

# Rows of a block, blocks of a page, queries of a chunk.
BLOCK_ROWS = 512
PAGE_BLOCKS = 32
QUERY_ROWS = 1024
EXACT = 2.0**52


def products(asks: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Integer inner products: by floating point where no partial sum can leave its exact range, else by integers."""
    most = np.abs(asks).max(initial=0).astype(float) * np.abs(rows).max(initial=0).astype(float) * max(1, rows.shape[1])
    if most < EXACT:
        return (asks.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return asks @ rows.T


def scan(asks: np.ndarray, own: np.ndarray, blocks: list[tuple], k: int) -> list[tuple[int, int, int]]:
    """(query, id, score) of each query's ``k`` best in a page of blocks (ids, rows, maxima, minima).

    Each query takes the blocks by falling bound and stops at the first whose bound is below its k-th score; an
    equal bound is still read, as a smaller id may win the tie.
    """
    up, down = np.maximum(asks, 0), np.minimum(asks, 0)
    high, low = np.stack([b[2] for b in blocks]), np.stack([b[3] for b in blocks])
    bounds = up.astype(np.float64) @ high.T.astype(np.float64) + down.astype(np.float64) @ low.T.astype(np.float64)
    order = np.argsort(-bounds, axis=1, kind="stable")
    best: list[list[tuple[int, int]]] = [[] for _ in own]
    # A hair above the computed bound is a bound whatever the rounding.
    margin = np.abs(bounds).max(initial=0) * 1e-12
    alive = np.arange(len(own))
    for step in range(len(blocks)):
        alive = np.array([q for q in alive if len(best[q]) < k or bounds[q, order[q, step]] + margin >= -best[q][k - 1][0]], np.int64)
        if not len(alive):
            break
        for b in np.unique(order[alive, step]):
            who = alive[order[alive, step] == b]
            ids, rows = blocks[b][:2]
            scores = products(asks[who], rows)
            for q, s in zip(who, scores):
                near = np.flatnonzero(ids != own[q])
                if len(best[q]) == k:
                    near = near[s[near] >= -best[q][-1][0]]
                if len(near) > k:
                    kth = np.partition(s[near], len(near) - k)[len(near) - k]
                    near = near[s[near] >= kth]
                if len(near):
                    best[q] = sorted({*best[q], *((-int(s[j]), int(ids[j])) for j in near)})[:k]
    return [(int(own[q]), i, -down_score) for q, rows in enumerate(best) for down_score, i in rows]


def top_products(df: DataFrame, queries: DataFrame, k: int, scale: int = 256, id_column: str = "vec_id",
                 vector_column: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): each query's ``k`` highest integer inner products, exactly.

    Components count as floor(scale * x). Null vectors, vectors with null or non-finite components and rows without
    an id take no part; empty vectors neither. A query is never its own candidate; rows that repeat an id and a
    vector count once, and so do queries that repeat an id. Ties go to the smaller id; fewer than ``k`` candidates
    give fewer rows, an empty table none. Shorter vectors count as filled up with zeros.

    Rows are cut into blocks of a range of ids, each with its forward index (the components of its rows) and the
    maximum and minimum of every term. The stated queries meet all blocks, in chunks and pages of bounded size; a
    page's blocks are read by falling bound. What is shuffled at the end is ``k`` rows for each query and page.
    """
    spark = df.sparkSession
    rows = usable(df, id_column, vector_column)
    asked = usable(queries, id_column, vector_column).groupBy("id").agg(F.min("vector").alias("vector"))
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim")).first()
    # Rows and queries may differ in length.
    dim = max(about.dim or 1, asked.agg(F.max(F.size("vector"))).first()[0] or 1)
    pages = max(1, -(-about.n // (BLOCK_ROWS * PAGE_BLOCKS)))
    chunks = max(1, -(-asked.count() // QUERY_ROWS))

    def whole(column: pa.Array) -> np.ndarray:
        return np.floor(scale * matrix(column, dim)).astype(np.int64)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, x = b.column(0).to_numpy(), whole(b.column(1))
            packs = [slice(i, i + BLOCK_ROWS) for i in range(0, len(ids), BLOCK_ROWS)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([int(ids[p][0]) for p in packs], pa.int64()),
                 *(pa.array([f(p).astype("<i8").tobytes() for p in packs], pa.binary())
                   for f in (lambda p: ids[p], lambda p: x[p], lambda p: x[p].max(axis=0), lambda p: x[p].min(axis=0)))],
                names=["first", "ids", "rows", "high", "low"])

    schema = "first bigint, ids binary, rows binary, high binary, low binary"
    path = new_workdir(spark, "blocks")
    ranges = max(1, -(-about.n // (8 * BLOCK_ROWS)))
    rows.repartitionByRange(ranges, "id").sortWithinPartitions("id").mapInArrow(cut, schema).write.parquet(path)
    blocks = (spark.read.schema(schema).parquet(path).withColumn("page", F.pmod(F.xxhash64("ids"), F.lit(pages)))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunks - 1)))))
    asks = (asked.withColumn("chunk", F.pmod(F.xxhash64("id"), F.lit(chunks)).cast("int"))
            .withColumn("page", F.explode(F.sequence(F.lit(0), F.lit(pages - 1)).cast("array<bigint>"))))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        held = []
        for ids, data, high, low in zip(right["ids"], right["rows"], right["high"], right["low"]):
            held.append((np.frombuffer(ids, "<i8"), np.frombuffer(data, "<i8").reshape(-1, dim),
                         np.frombuffer(high, "<i8"), np.frombuffer(low, "<i8")))
        out = []
        if len(left) and held:
            vectors = np.zeros((len(left), dim), np.int64)
            for i, v in enumerate(left["vector"]):
                vectors[i, : len(v)] = np.floor(scale * np.asarray(v, np.float64)).astype(np.int64)
            out = scan(vectors, left["id"].to_numpy(), held, k)
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype("int64")

    hits = asks.groupBy("page", "chunk").cogroup(blocks.groupBy("page", "chunk")).applyInPandas(
        meet, "query_id bigint, id bigint, score bigint")
    return best_of("query_id", hits, k)
