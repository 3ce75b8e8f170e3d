"""Approximate nearest neighbours by inner product: a forest of random-projection trees, one shared queue, exact reranking."""

from __future__ import annotations

import heapq
import pickle
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.rolling import mix
from tidemark.llm.vectors import best_of, inner, matrix, usable
from tidemark.session import new_workdir

# Adjacent leaves that are searched together, rows of a leaf in one part, and queries in one group.
LEAVES_TOGETHER = 8
PART_ROWS = 4096
QUERY_ROWS = 2048
# Trees of the smallest forest that is considered.
FEWEST_TREES = 2
SLACK = 1e-9


@dataclass(frozen=True)
class Settings:
    """``sample`` bounds the vectors the trees are fitted on; every vector is indexed.

    ``recall`` is aimed at on the sample, by how large a share of the index a search may visit. ``trees`` are grown, and
    of these the first 2, 4 and so on are compared by the rows a search scores: more trees, each one more copy of the
    vectors, are used where they score at most ``gain`` of what fewer do.
    """

    trees: int = 8
    sample: int = 8192
    leaf: int = 64
    recall: float = 0.96
    gain: float = 0.8
    probes: int = 192
    seed: int = 5


@dataclass
class Forest:
    """Complete trees: ``planes[t, node]`` splits by ``x @ plane > offset``; children of n are 2n+1 and 2n+2."""

    planes: np.ndarray
    offsets: np.ndarray
    longest: float
    share: float = 1.0

    @property
    def depth(self) -> int:
        return (self.planes.shape[1] + 1).bit_length() - 1

    @property
    def leaves(self) -> int:
        return self.planes.shape[1] + 1

    def first(self, trees: int) -> Forest:
        return Forest(self.planes[:trees], self.offsets[:trees], self.longest, self.share)

    def lifted(self, x: np.ndarray) -> np.ndarray:
        """One more component brings all vectors to the same length, so that the largest product is the smallest angle."""
        rest = np.sqrt(np.maximum(self.longest**2 - (x * x).sum(axis=1), 0))
        return np.column_stack([x, rest])

    def place(self, x: np.ndarray) -> np.ndarray:
        """The leaf of every row in every tree, leaves numbered through all trees."""
        y, out = self.lifted(x), np.empty((len(x), len(self.planes)), np.int64)
        for t, (planes, offsets) in enumerate(zip(self.planes, self.offsets)):
            right = y @ planes.T > offsets
            node = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                node = 2 * node + 1 + right[np.arange(len(x)), node]
            out[:, t] = t * self.leaves + node - (self.leaves - 1)
        return out

    def visit(self, q: np.ndarray) -> Iterator[int]:
        """Leaves of all trees through one queue, the most promising branch first."""
        inside = self.leaves - 1
        margin = np.stack([p[:, :-1] @ q - o for p, o in zip(self.planes, self.offsets)])
        queue = [(-np.inf, t, 0) for t in range(len(self.planes))]
        while queue:
            p, t, node = heapq.heappop(queue)
            if node >= inside:
                yield t * self.leaves + node - inside
                continue
            m = margin[t, node]
            heapq.heappush(queue, (max(p, m), t, 2 * node + 1))
            heapq.heappush(queue, (max(p, -m), t, 2 * node + 2))

    def search(self, q: np.ndarray, counts: np.ndarray, least: int) -> list[int]:
        """Leaves to read: until they hold the wanted share of the index, and ``least`` rows of every tree at least."""
        wanted = max(self.share * counts.sum(), least * len(self.planes))
        held, out = 0, []
        for leaf in self.visit(q):
            if held >= wanted:
                break
            held += int(counts[leaf])
            if counts[leaf]:
                out.append(leaf)
        return out


def grow(x: np.ndarray, longest: float, settings: Settings, k: int) -> Forest:
    """Trees over a sample: each node splits at the median along the line through two of its points.

    The share to search is the one at which the wanted recall is reached within the sample, where the nearest
    are farther away than among all rows. Of the forest's trees as many are kept as are worth their copies of the rows.
    """
    rng = np.random.default_rng(settings.seed)
    depth = max(0, int(np.log2(max(1, len(x) / settings.leaf))))
    forest = Forest(np.zeros((settings.trees, 2**depth - 1, x.shape[1] + 1)), np.zeros((settings.trees, 2**depth - 1)), longest)
    y = forest.lifted(x)
    for t in range(settings.trees):
        held = {0: np.arange(len(x))}
        for node in range(2**depth - 1):
            rows = held.pop(node)
            a, b = y[rng.choice(rows, 2)] if len(rows) else y[:2]
            plane = a - b
            size = np.linalg.norm(plane)
            plane = plane / size if size else rng.normal(size=y.shape[1])
            along = y[rows] @ plane
            cut = float(np.median(along)) if len(rows) else 0.0
            forest.planes[t, node], forest.offsets[t, node] = plane, cut
            held[2 * node + 1], held[2 * node + 2] = rows[along <= cut], rows[along > cut]
    fewest = min(FEWEST_TREES, settings.trees)
    if len(x) <= 4 * k:
        return forest.first(fewest)
    where = forest.place(x)
    probes = rng.choice(len(x), min(settings.probes, len(x)), replace=False)
    near = []
    for q in probes:
        scores = x @ x[q]
        scores[q] = -np.inf
        near.append(np.argpartition(-scores, k)[:k])
    sizes = [fewest]
    while sizes[-1] < settings.trees:
        sizes.append(min(2 * sizes[-1], settings.trees))
    forests = [forest.first(n) for n in sizes]
    for f, n in zip(forests, sizes):
        f.share = needed_share(f, where[:, :n], x[probes], near, settings.recall)
    # Every tree holds all rows, so a share of more trees is more rows to score, and more copies to write and to move.
    best = forests[0]
    for f in forests[1:]:
        if f.share * len(f.planes) <= settings.gain * best.share * len(best.planes):
            best = f
    return best


def needed_share(forest: Forest, where: np.ndarray, asks: np.ndarray, near: list[np.ndarray], recall: float) -> float:
    """The share of the index to search until the queue has met the nearest rows of the asks as often as wanted."""
    counts = np.bincount(where.ravel(), minlength=len(forest.planes) * forest.leaves)
    needed = []
    for q, rows in zip(asks, near):
        visited = np.full(len(counts), np.inf)
        total = 0
        for leaf in forest.visit(q):
            total += counts[leaf]
            visited[leaf] = total
        needed.append(visited[where[rows]].min(axis=1) / counts.sum())
    return float(np.quantile(np.concatenate(needed), recall))


def nearest(df: DataFrame, queries: DataFrame, k: int, id_column: str = "vec_id", vector_column: str = "embedding",
            settings: Settings = Settings()) -> DataFrame:
    """(query_id, rank, vec_id, score): for each query its ``k`` nearest found by inner product, in double precision.

    Null or zero vectors, vectors with null or non-finite components, and rows without an id take no part, neither
    as query nor as candidate. A query is never its own candidate. Rows that repeat an id and a vector count once,
    and so do queries that repeat an id. Ties go to the smaller id; fewer than ``k`` candidates give fewer rows, an
    empty table none. Shorter vectors count as filled up with zeros.

    The trees are fitted by one task on a bounded sample and sent to all; every row is written to its leaf of every
    tree, in parts of bounded size, so that a leaf of many equal vectors is shared out. Each query goes only to the
    parts of the leaves that its queue reached, and leaves each with its ``k`` best.
    """
    spark = df.sparkSession
    rows = usable(df, id_column, vector_column, zeros=False)
    asked = usable(queries, id_column, vector_column, zeros=False).groupBy("id").agg(F.min("vector").alias("vector"))
    about = rows.agg(F.count("*").alias("n"), F.max(F.size("vector")).alias("dim"),
                     F.max(F.aggregate("vector", F.lit(0.0), lambda a, x: a + x * x)).alias("square")).first()
    # Rows and queries may differ in length.
    dim, longest = max(about.dim or 1, asked.agg(F.max(F.size("vector"))).first()[0] or 1), float(about.square or 0) ** 0.5

    def fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = [matrix(b.column(0), dim) for b in batches]
        x = np.concatenate(held) if held else np.zeros((0, dim))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(grow(x, longest, settings, k))], pa.binary())], names=["forest"])

    sample = rows.orderBy(F.xxhash64("id"), "id").limit(settings.sample).select("vector")
    fitted = sample.coalesce(1).mapInArrow(fit, "forest binary").first()
    forest = pickle.loads(fitted.forest) if fitted else grow(np.zeros((0, dim)), longest, settings, k)
    sent = spark.sparkContext.broadcast(forest)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column(1), dim)
            ids, leaf = b.column(0).to_numpy(), sent.value.place(x)
            for t in range(leaf.shape[1]):
                order = np.argsort(leaf[:, t], kind="stable")
                cuts = np.flatnonzero(np.diff(leaf[order, t])) + 1
                packs = [p for p in np.split(order, cuts) if len(p)]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([int(leaf[p[0], t]) for p in packs], pa.int64()), pa.array([len(p) for p in packs], pa.int64()),
                     pa.array([ids[p].astype("<i8").tobytes() for p in packs], pa.binary()),
                     pa.array([x[p].astype("<f8").tobytes() for p in packs], pa.binary())], names=["leaf", "n", "ids", "rows"])

    path = new_workdir(spark, "forest")
    # Few rows to a pack would cost more than they hold, so rows are first gathered by the thousands.
    (rows.repartition(max(1, -(-about.n // (2 * PART_ROWS)))).mapInArrow(place, "leaf bigint, n bigint, ids binary, rows binary")
     .write.parquet(path))
    index = spark.read.schema("leaf bigint, n bigint, ids binary, rows binary").parquet(path)
    trees = len(forest.planes)
    counts = np.zeros(trees * forest.leaves, np.int64)
    # One row for each leaf: the settings bound their number.
    for row in index.groupBy("leaf").agg(F.sum("n").alias("n")).collect():
        counts[row.leaf] = row.n
    parts = np.maximum(1, -(-np.add.reduceat(counts, np.arange(0, len(counts), LEAVES_TOGETHER)) // (PART_ROWS * LEAVES_TOGETHER)))
    sent_counts = spark.sparkContext.broadcast((counts, parts))
    chunk_count = max(1, -(-asked.count() // QUERY_ROWS))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, parts = sent_counts.value
        for b in batches:
            x, ids = matrix(b.column(1), dim), b.column(0).to_numpy()
            # Mixed, as the ids of queries may have a step in common with the number of chunks.
            chunk = (mix(ids.astype(np.uint64)) % np.uint64(chunk_count)).tolist()
            out: list[tuple] = []
            for i, c, q in zip(ids.tolist(), chunk, x):
                data, by_group = q.astype("<f8").tobytes(), {}
                for leaf in sent.value.search(q, counts, k + 1):
                    by_group.setdefault(leaf // LEAVES_TOGETHER, []).append(leaf)
                for g, leaves in by_group.items():
                    out += [(g, p, c, i, leaves, data) for p in range(int(parts[g]))]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(zip(*out) if out else [[]] * 6, (
                    pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary()))],
                names=["together", "part", "chunk", "query_id", "leaves", "vector"])

    routed = asked.mapInArrow(route, "together bigint, part bigint, chunk bigint, query_id bigint, leaves array<bigint>, vector binary")

    parts_of = F.element_at(F.array(*[F.lit(int(p)) for p in parts]), F.col("together").cast("int") + 1)
    blocks = (index.withColumn("together", F.expr(f"leaf div {LEAVES_TOGETHER}"))
              .withColumn("part", F.pmod(F.xxhash64("ids"), parts_of))
              .withColumn("chunk", F.explode(F.sequence(F.lit(0), F.lit(chunk_count - 1)).cast("array<bigint>"))))

    def rank(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        packs: dict[int, list] = {}
        for leaf, ids, data in zip(left["leaf"], left["ids"], left["rows"]):
            packs.setdefault(leaf, []).append((np.frombuffer(ids, "<i8"), np.frombuffer(data, "<f8").reshape(-1, dim)))
        blocks = {leaf: tuple(np.concatenate(c) for c in zip(*p)) for leaf, p in packs.items()}
        out: list[tuple] = []
        # Queries that read the same leaves are scored in one product.
        for leaves, group in right.groupby(right["leaves"].map(tuple)):
            here = [blocks[leaf] for leaf in leaves if leaf in blocks]
            if not here:
                continue
            ids, x = (np.concatenate(c) for c in zip(*here))
            asks = np.frombuffer(b"".join(group["vector"]), "<f8").reshape(-1, dim)
            scores = asks @ x.T
            for qid, q, s in zip(group["query_id"], asks, scores):
                s[ids == qid] = -np.inf
                near = np.flatnonzero(s > -np.inf)
                # Leaves of several trees may be here, and with them a row as many times.
                most = k * trees
                if len(near) > most:
                    kth = np.partition(s, len(s) - most)[len(s) - most]
                    near = np.flatnonzero((s >= kth - SLACK * longest**2) & (s > -np.inf))
                exact = inner(q, x[near])
                order = np.lexsort((ids[near], -exact))
                found, exact = ids[near][order], exact[order]
                new = np.ones(len(found), bool)
                new[1:] = (found[1:] != found[:-1]) | (exact[1:] != exact[:-1])
                for i, e in zip(found[new][:k].tolist(), exact[new][:k].tolist()):
                    out.append((qid, i, e))
        return pd.DataFrame(out, columns=["query_id", "id", "score"]).astype({"query_id": "int64", "id": "int64", "score": "float64"})

    keys = ["together", "part", "chunk"]
    hits = routed.groupBy(*keys).cogroup(blocks.groupBy(*keys)).applyInPandas(
        lambda asks, packs: rank(packs, asks), "query_id bigint, id bigint, score double")
    return best_of("query_id", hits, k)
