"""Exact top-k search by inner product with multi-resolution segment statistics.

A vector is cut into segments; each is known by its mean and its deviation (the length
of what the mean leaves). For two vectors the squared distance is at least the sum over
segments of w (difference of means)^2 + (difference of deviations)^2, so with the norms
of both the inner product is at most the sum of w mean mean' + dev dev'. Segments are
tried coarse to fine; a candidate that can't reach the query's k-th best score so far is
out, and only survivors get their exact product. The bound leaves room for rounding. The
k-th score starts from a bounded number of candidates of the largest norms.

Queries reach the tasks in blocks of a fixed size, one after another: each is broadcast, every
task passes over its candidates once and returns at most k rows a query, the result is
written, and the broadcast is freed before the next.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import load, stored

K = 10
SCALE = 1024
#: Queries in a block: 4096 vectors of 1024 doubles are 32 MB.
BLOCK = 4096
#: Candidates compared at once, and components of a segment at each level.
STEP = 2048
LEVELS = (16, 4, 2)
#: Candidates of the largest norms from which the k-th scores start.
SEEDS = 1024
#: Whole numbers up to this are exact as doubles.
EXACT = 2.0**53


def scaled(df: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """`vec_id` and floor(1024 x) of each component x as a double. Vectors that are null or hold a null or non-finite component, and rows without id, are left out."""
    values = F.col(f"`{vector}`").cast("array<double>")
    odd = F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return df.select(F.col(f"`{vec_id}`").cast("long").alias("vec_id"), values.alias("v")).where("vec_id IS NOT NULL AND v IS NOT NULL").where(~odd_safe(odd)).select("vec_id", F.transform("v", lambda x: F.floor(x * SCALE).cast("double")).alias("v"))


def odd_safe(odd):
    return F.coalesce(odd, F.lit(True))


def summary(x: np.ndarray, width: int) -> np.ndarray:
    """Means times the root of the width, and deviations, of segments of `width` components of the rows of `x`."""
    edges = np.arange(0, x.shape[1], width)
    n = np.diff(np.append(edges, x.shape[1]))
    means = np.add.reduceat(x, edges, axis=1) / n
    apart = x - np.repeat(means, n, axis=1)
    return np.hstack((means * np.sqrt(n), np.sqrt(np.add.reduceat(apart * apart, edges, axis=1))))


def products(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Integer inner products of the rows of `a` and `b`. Vectors whose products may be too large to be exact as doubles are an error."""
    if len(a) and (np.linalg.norm(a, axis=1) * np.linalg.norm(b, axis=1)).max() >= EXACT:
        raise OverflowError("inner products beyond 2**53 are not exact here: scale the vectors down")
    return np.einsum("ij,ij->i", a, b)


class Block:
    """Queries of one dimension and their best candidates so far."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int, floor: np.ndarray | None = None):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.levels = [summary(vectors, w) for w in LEVELS]
        self.floor = np.full(len(ids), -np.inf) if floor is None else floor
        self.scores = np.full((len(ids), k), -np.inf)
        self.found = np.full((len(ids), k), np.iinfo(np.int64).max)
        self.pairs, self.survived = 0, [0] * len(LEVELS)

    def offer(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        for at in range(0, len(ids), STEP):
            own, x = ids[at : at + STEP], vectors[at : at + STEP]
            worst = np.maximum(self.scores[:, -1], self.floor)
            self.pairs += len(self.ids) * len(own)
            alive = None
            for i, (width, queries) in enumerate(zip(LEVELS, self.levels)):
                bound = summary(x, width)
                if alive is None:
                    most = queries @ bound.T
                    alive = np.argwhere(most + 1e-6 * np.abs(most) + 1 >= worst[:, None])
                elif 4 * len(alive) > len(self.ids) * len(own):  # one product of the summaries beats gathering them by pairs
                    most = (queries @ bound.T)[alive[:, 0], alive[:, 1]]
                    alive = alive[most + 1e-6 * np.abs(most) + 1 >= worst[alive[:, 0]]]
                else:
                    most = np.einsum("ij,ij->i", queries[alive[:, 0]], bound[alive[:, 1]])
                    alive = alive[most + 1e-6 * np.abs(most) + 1 >= worst[alive[:, 0]]]
                self.survived[i] += len(alive)
            alive = alive[self.ids[alive[:, 0]] != own[alive[:, 1]]]
            for part in np.array_split(alive, 1 + len(alive) // 65_536):
                exact = products(self.vectors[part[:, 0]], x[part[:, 1]])
                hit = exact >= np.maximum(self.scores[part[:, 0], -1], self.floor[part[:, 0]])
                self.keep(part[hit, 0], own[part[hit, 1]], exact[hit])

    def keep(self, query: np.ndarray, ids: np.ndarray, scores: np.ndarray) -> None:
        if not len(query):
            return
        changed = np.unique(query)
        q = np.concatenate((query, np.repeat(changed, self.k)))
        i = np.concatenate((ids, self.found[changed].ravel()))
        s = np.concatenate((scores, self.scores[changed].ravel()))
        order = np.lexsort((i, -s, q))
        q, i, s = q[order], i[order], s[order]
        first = np.searchsorted(q, changed)
        take = first[:, None] + np.arange(self.k)
        self.scores[changed], self.found[changed] = s[take], i[take]


def by_size(rows: list) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """Ids and vectors of the rows (`vec_id`, `v`) of each dimension but 0."""
    sizes: dict[int, list] = {}
    for r in rows:
        if r.v:
            sizes.setdefault(len(r.v), []).append(r)
    return {d: (np.array([r.vec_id for r in own]), np.array([r.v for r in own], np.float64)) for d, own in sizes.items()}


def floors(ids: np.ndarray, vectors: np.ndarray, seeds: tuple[np.ndarray, np.ndarray] | None, k: int) -> np.ndarray:
    """Scores that the k-th best of each query reaches at least: its k-th among the seeds."""
    if seeds is None or len(seeds[0]) < k:
        return np.full(len(ids), -np.inf)
    scores = np.where(ids[:, None] == seeds[0], -np.inf, vectors @ seeds[1].T)
    return np.partition(scores, -k, axis=1)[:, -k]


def top_k(queries: DataFrame, candidates: DataFrame, k: int = K, block: int = BLOCK) -> DataFrame:
    """`query_id`, `rank` (from 1), `vec_id`, `score`: each query's `k` highest integer inner products, ties to smaller ids.

    Both inputs hold `vec_id` and `v` as `scaled` makes them. A query meets every row with another id (rows that
    repeat its id are its own), of the same length; repeated candidate rows count each; of repeated query rows
    the one with the smallest vector counts. Fewer than `k` candidates give fewer rows, none give none. Inner
    products that may pass 2**53 are an error.
    """
    spark = candidates.sparkSession
    asked = queries.groupBy("vec_id").agg(F.min("v").alias("v"))
    asked = stored(asked, "topk-queries")
    n_blocks = -(-asked.count() // block)
    empty = candidates.limit(0).selectExpr("vec_id AS query_id", "vec_id", "CAST(0 AS BIGINT) AS score")
    norm = F.aggregate("v", F.lit(0.0), lambda total, x: total + x * x)
    seeds = by_size(candidates.orderBy(norm.desc(), "vec_id").limit(SEEDS).collect()) if n_blocks else {}

    def search(held):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            blocks = {d: Block(ids, vectors, k, floor) for d, (ids, vectors, floor) in held.value.items()}
            for batch in batches:
                ids, lists = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1)
                sizes = np.diff(lists.offsets.to_numpy())
                for d in set(np.unique(sizes).tolist()) & blocks.keys():
                    own = lists.filter(pa.array(sizes == d))
                    blocks[d].offer(ids[sizes == d], own.flatten().to_numpy().reshape(-1, d))
            for b in blocks.values():
                row, col = np.nonzero(np.isfinite(b.scores))
                yield pa.RecordBatch.from_arrays([pa.array(b.ids[row]), pa.array(b.found[row, col]), pa.array(b.scores[row, col].astype(np.int64))], names=["query_id", "vec_id", "score"])

        return run

    found = empty
    # Blocks by the place of the id among all ids would need a sort; a hash deals them out just as well, in parts a little uneven.
    part = F.pmod(F.xxhash64("vec_id"), F.lit(max(1, n_blocks)))
    for i in range(n_blocks):
        own = by_size(asked.where(part == i).collect())
        held = spark.sparkContext.broadcast({d: (ids, v, floors(ids, v, seeds.get(d), k)) for d, (ids, v) in own.items()})
        found = found.union(stored(candidates.select("vec_id", "v").mapInArrow(search(held), "query_id long, vec_id long, score long"), "topk-found"))
        held.unpersist()
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def query(spark, sf_dir: str) -> DataFrame:
    rows = stored(scaled(load(spark, sf_dir, "embeddings"), "vec_id", "embedding"), "topk-vectors")
    return top_k(rows.where("vec_id % 100 = 0"), rows)


ORACLE = """
WITH e AS (SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS v FROM embeddings
           WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.v, c.v) AS BIGINT) AS score
           FROM e q JOIN e c ON q.vec_id <> c.vec_id AND len(q.v) = len(c.v) WHERE q.vec_id % 100 = 0),
     r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 10
"""
