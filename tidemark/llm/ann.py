"""Approximate nearest neighbours by collision-counting hashing over sorted single projections.

Every block of vectors keeps, for each of many random unit directions, its
vectors sorted by their projection. A query's own projection is the centre of
a window in each sorted array; virtual rehashing doubles the windows round by
round without rebuilding anything. A vector that falls into the windows of at
least `threshold` directions has collided often enough and is verified by its
exact cosine. A query stops when k vectors are verified and the distance of
its k-th best, MARGIN times, lies inside the current radius (a nearer vector
would then have collided often enough, but for about one in ten thousand), or when the windows
cover everything: then all the rest is verified and the answer is exact.

Vectors are dealt to blocks by a hash of their id, of a size that fits a task;
every query visits every block and a top-k for each query merges the blocks.
So no block depends on how vectors cluster: equal vectors spread over blocks.
The work is queries times vectors in the worst case, and where vectors have no
structure at all it is near that: at the distance of a random vector's nearest
neighbours most of a block lies in the windows. What is copied: a query to each
block, a block to each set of ASKS queries, for which its arrays are sorted
once.

Cases: vectors that are null, of length zero, or hold null or non-finite
components take no part (neither as query nor as candidate), nor do rows with
a null id. Very small and very large components are scaled by a power of two
first, which changes no cosine. Vectors of another dimension than the query's
are not its candidates. Ties of score go to the smaller id. Repeated ids are
separate rows: each row asks for itself, and only that row is no candidate of
it; rows that repeat id and vector get the same answers. Fewer than k
candidates: all are returned. An empty table gives no rows. Other columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common

DIRECTIONS = 64
#: Collisions that make a vector a candidate.
THRESHOLD = 38
#: Half-width of the first windows, on projections of unit vectors scaled by sqrt(dimension).
WIDTH = 0.5
#: A query stops at a radius of so many times the distance of its k-th best: with 64 directions, a vector at that distance has 50 collisions, give or take 3.3.
MARGIN = 1.25
#: Vectors of a block, and queries that visit one copy of it.
BLOCK, ASKS = 16_384, 8192


def directions(dim: int, m: int, seed: int) -> np.ndarray:
    a = np.random.default_rng(seed).standard_normal((m, dim))
    return a / np.linalg.norm(a, axis=1, keepdims=True) * np.sqrt(dim)


def cosine(x: np.ndarray, norms: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Cosines of the rows of x, which have these norms, with q in double precision; equal rows give equal values."""
    return np.einsum("ij,j->i", x, q) / (norms * np.sqrt(np.einsum("i,i->", q, q)))


def scaled(vectors: np.ndarray) -> np.ndarray:
    """Each row times a power of two that brings its largest component to 0.5 to 1, so squares neither vanish nor overflow."""
    return np.ldexp(vectors, -np.frexp(np.abs(vectors).max(-1, keepdims=True))[1])


class Index:
    """The sorted single-projection arrays of one block. `rows` tells rows of the same id apart, `times` says how often each occurs."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, m: int = DIRECTIONS, seed: int = 11, rows: np.ndarray | None = None, times: np.ndarray | None = None):
        vectors = scaled(vectors)
        self.ids, self.vectors = ids, vectors
        self.rows = np.zeros(len(ids), np.int64) if rows is None else rows
        self.times = np.ones(len(ids), np.int64) if times is None else times
        self.unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
        self.a = directions(vectors.shape[1], m, seed)
        projected = self.unit @ self.a.T
        self.projected = projected.T.copy()
        self.norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
        self.order = np.argsort(projected, axis=0, kind="stable").T.astype(np.int32).copy()
        self.sorted = np.sort(projected, axis=0).T.copy()

    def search(self, own: int, q: np.ndarray, k: int, threshold: int = THRESHOLD, width: float = WIDTH, margin: float = MARGIN, row: int = 0) -> list[tuple[int, float]]:
        """The k nearest (or fewer, if there are no more) of a query, which is the row `row` of the id `own`."""
        n, m = len(self.ids), len(self.a)
        q = scaled(q)
        centre = self.a @ (q / np.linalg.norm(q))
        counts = np.zeros(n, np.int16 if m < 1 << 15 else np.int32)
        low = np.array([np.searchsorted(self.sorted[j], centre[j]) for j in range(m)])
        high = low.copy()
        verified = np.zeros(n, bool)
        mine = (self.ids == own) & (self.rows == row)
        verified[mine & (self.times == 1)] = True  # the query's own row is no candidate
        found_at: list[np.ndarray] = []
        found_by: list[np.ndarray] = []
        top = np.zeros(0)  # the k best scores so far
        radius = width
        while True:
            left, right = centre - radius, np.nextafter(centre + radius, np.inf)
            ends = np.array([self.sorted[j].searchsorted((left[j], right[j])) for j in range(m)])
            if (ends[:, 1] - ends[:, 0] - (high - low)).sum() > n * m // 6:  # much is new: count anew, in the order of the vectors
                counts[:] = 0
                for p, a, b in zip(self.projected, left, right, strict=True):
                    counts += (p >= a) & (p < b)
            else:
                for j, (lo, hi) in enumerate(ends.tolist()):
                    counts[self.order[j, lo : low[j]]] += 1
                    counts[self.order[j, high[j] : hi]] += 1
            low, high = ends[:, 0], ends[:, 1]
            whole = bool((low == 0).all() and (high == n).all())
            fresh = np.flatnonzero(~verified if whole else (counts >= threshold) & ~verified)
            if len(fresh):
                verified[fresh] = True
                found_at.append(fresh)
                found_by.append(cosine(self.vectors[fresh], self.norms[fresh], q))
                top = np.sort(np.concatenate([top, found_by[-1]]))[-k:]
            enough = margin * np.sqrt(max(0.0, 2 - 2 * top[0])) if len(top) >= k else np.inf
            if whole or enough <= radius:
                break
            radius = enough if enough < np.inf else radius * 1.5
        if not found_at:
            return []
        at, by = np.concatenate(found_at), np.concatenate(found_by)
        best = np.lexsort((self.ids[at], -by))[:k]
        left = self.times - mine
        return [(int(self.ids[at[i]]), float(by[i])) for i in best for _ in range(min(int(left[at[i]]), k))][:k]


def usable(vector: Column) -> Column:
    fine = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & fine & F.exists(vector, lambda x: x != 0)


def _searcher(k: int, m: int, seed: int):  # noqa: ANN202
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def column(t: pa.Table, name: str) -> np.ndarray:
            return t.column(name).to_numpy()

        for _, table in common.sorted_groups(batches, "block"):
            asked = column(table, "asks")
            flat = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False)
            ids, rows, times, vectors = column(table, "vec_id"), column(table, "row"), column(table, "times"), flat.astype(np.float64).reshape(len(asked), -1)
            data = ~asked
            if not data.any() or not asked.any():
                continue
            index = Index(ids[data], vectors[data], m, seed, rows[data], times[data])
            found = [(int(i), int(r), v, s) for i, r, x in zip(ids[asked], rows[asked], vectors[asked], strict=True) for v, s in index.search(int(i), x, k, row=int(r))]
            if found:
                i, r, v, s = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(i, pa.int64()), pa.array(r, pa.int64()), pa.array(v, pa.int64()), pa.array(s, pa.float64())], names=["query_id", "row", "vec_id", "score"])

    return run


def _told_apart(vectors: DataFrame) -> DataFrame:
    """vec_id, v, row (tells rows of an id apart) and times (rows of this id and vector). Where all ids differ, nothing is shuffled for it; the result is the same."""
    total, ids = vectors.agg(F.count("*"), F.countDistinct("vec_id")).first()
    if total == ids:
        return vectors.select("vec_id", "v", F.lit(0).cast("long").alias("row"), F.lit(1).cast("long").alias("times"))
    return vectors.groupBy("vec_id", "v").agg(F.count("*").alias("times")).select("vec_id", "v", F.xxhash64("v").alias("row"), "times")


def search(vectors: DataFrame, queries: DataFrame, k: int = 5, block: int = BLOCK, m: int = DIRECTIONS, seed: int = 11) -> DataFrame:
    """The k nearest found for every query: query_id, rank, vec_id, score. Both tables hold vec_id and v, an array of double; queries are rows of vectors.

    Queries are themselves in sub-blocks by hash, so a task holds one block of vectors and one of queries.
    """
    data, asks = _told_apart(vectors), _told_apart(queries)
    sizes, n = data.agg(F.count("*")).first()[0], asks.agg(F.count("*")).first()[0]
    blocks = max(1, -(-sizes // block))
    # a table of few blocks has its queries dealt to more tasks, as far as there are cores
    parts = max(1, -(-n // ASKS), min(-(-n // 128), -(-data.sparkSession.sparkContext.defaultParallelism // blocks)))
    salt = F.xxhash64(F.col("vec_id"), F.lit(seed))
    data = data.select("*", F.lit(False).alias("asks"), F.pmod(salt, F.lit(blocks)).alias("b"), F.explode(F.sequence(F.lit(0), F.lit(parts - 1))).alias("p"))
    ask = asks.select("*", F.lit(True).alias("asks"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("b"), F.pmod(salt, F.lit(parts)).alias("p"))
    group = F.xxhash64((F.col("b") * F.lit(parts) + F.col("p")).cast("long"), F.size("v"))
    both = data.unionByName(ask).select("vec_id", "v", "row", "times", "asks", group.alias("block"))
    found = both.repartition(max(blocks * parts, 1), "block").sortWithinPartitions("block", "asks", "vec_id").mapInArrow(_searcher(k, m, seed), "query_id long, row long, vec_id long, score double")
    order = Window.partitionBy("query_id", "row").orderBy(F.col("score").desc(), "vec_id")
    best = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    again = asks.where("times > 1").select(F.col("vec_id").alias("_id"), F.col("row").alias("_row"), "times")
    if again.isEmpty():
        return best.select("query_id", "rank", "vec_id", "score")
    times = F.coalesce(F.col("times"), F.lit(1)).cast("int")
    best = best.join(again, (best.query_id == again._id) & (best.row == again._row), "left")
    return best.withColumn("_copy", F.explode(F.sequence(F.lit(1), times))).select("query_id", "rank", "vec_id", "score")


def op2_ann(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 5 nearest by cosine, in all of embeddings, of every row whose vec_id is divisible by 50."""
    common.tune(spark)
    v = common.read(spark, sf_dir, "embeddings").select("vec_id", F.col("embedding").cast("array<double>").alias("v"))
    v = v.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    return search(v, v.where(F.col("vec_id") % 50 == 0))
