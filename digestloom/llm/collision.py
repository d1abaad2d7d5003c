"""Nearest neighbours by collision counting over query-centred windows.

Each shard of vectors is projected on random lines; per line the projections lie in a sorted
array. A query opens a window around its own projection on every line. A vector in the window
collides with the query on that line; windows grow by a factor (virtual rehashing of one index,
no second hash table), and a growing window reads only the parts of the sorted arrays that it
did not hold before. A vector whose collisions reach a threshold is verified, once, with the
exact measure.

The difference of two projections on a Gaussian line is normal with their distance as deviation.
So the distance of the k-th best vector a query has verified gives the width at which any vector
as near collides often enough with probability ``sure``; there the query is done. Until it has
k vectors it goes on, at last to windows that hold the whole shard. No number or share of
vectors limits what is verified.

Largest inner products become nearest neighbours by one more coordinate, which lifts every
vector to the largest norm (a query is scaled to that norm and gets 0 there); that norm is the unit.

The query set is a stated part of the table; it goes to the shards in blocks of bounded size,
one broadcast after the other. Each task keeps the best of its shards per query, and a top-k
per query joins the tasks.

Edge cases: vectors that are null, empty, zero, or hold null or non-finite components take no
part; vectors meet only those of their own dimension; ties go to the smaller id; candidates of
the query's own id are left out; a repeated query is answered once for each row; fewer than k
candidates are all returned; other columns are not read.
"""

from __future__ import annotations

import math
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.operators.skew import top_per_group
from digestloom.session import materialise

K = 20
LINES = 64
# Collisions, as a share of the lines, that make a candidate.
THRESHOLD = 0.7
# Probability that a vector as near as the k-th best found is verified.
SURE = 0.95
# Growth of windows, and how many steps below the last width of one query the next one starts.
GROWTH = 1.2
STEPS_BACK = 1
SHARD_VECTORS = 8192
BLOCK_QUERIES = 32768


def usable(column) -> F.Column:
    """Vectors that take part."""
    sound = F.forall(column, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.coalesce((F.size(column) > 0) & sound & F.exists(column, lambda x: x != 0), F.lit(False))


def lines(dimension: int, count: int, seed: int) -> np.ndarray:
    return np.random.default_rng(seed).standard_normal((dimension, count))


def stop_width(count: int, threshold: int, sure: float) -> float:
    """Half-width, in distances, at which a vector reaches the threshold with probability ``sure``."""
    low, high = 0.0, 1.0
    for _ in range(60):
        p = (low + high) / 2
        reached = sum(math.comb(count, i) * p**i * (1 - p) ** (count - i) for i in range(threshold, count + 1))
        low, high = (p, high) if reached < sure else (low, p)
    return NormalDist().inv_cdf(min((1 + high) / 2, 1 - 1e-12))


def _matrix(column: pa.Array, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dimension)


def _index(longest: float, count: int, seed: int, size: int):
    """Shards: ids, vectors, and per line the sorted projections and whose they are (shard numbers)."""

    def shard(ids, vectors):
        dimension = vectors.shape[1]
        # The largest norm is the unit of projections and windows.
        scaled = vectors / longest
        lift = np.sqrt(np.maximum(1 - np.einsum("ij,ij->i", scaled, scaled), 0.0))
        projected = np.column_stack([scaled, lift]) @ lines(dimension + 1, count, seed)
        order = np.argsort(projected, axis=0, kind="stable")
        values = np.take_along_axis(projected, order, axis=0)
        parts = [vectors.tobytes(), np.ascontiguousarray(values.T).tobytes(), np.ascontiguousarray(order.T, dtype=np.int32).tobytes()]
        return pa.RecordBatch.from_arrays(
            [pa.array([dimension], pa.int32()), pa.array([ids], pa.list_(pa.int64())), *(pa.array([p], pa.binary()) for p in parts)],
            names=["dimension", "ids", "vectors", "projections", "whose"],
        )

    def run(batches):
        held: dict[int, list] = {}
        for batch in batches:
            dimensions = np.diff(batch.column("v").offsets.to_numpy()) if batch.num_rows else np.empty(0, dtype=np.int64)
            for d in np.unique(dimensions).tolist():
                rows = batch.filter(pa.array(dimensions == d))
                held.setdefault(d, []).append((rows.column("id").to_pylist(), _matrix(rows.column("v"), d)))
                while sum(len(x[0]) for x in held[d]) >= size:
                    ids = [i for x in held[d] for i in x[0]]
                    vectors = np.concatenate([x[1] for x in held[d]])
                    yield shard(ids[:size], vectors[:size])
                    held[d] = [(ids[size:], vectors[size:])]
        for d, parts in held.items():
            ids = [i for x in parts for i in x[0]]
            if ids:
                yield shard(ids, np.concatenate([x[1] for x in parts]))

    return run


class Lines:
    """The sorted projections of a shard, one line behind the other, so that one bisection serves all."""

    def __init__(self, values: np.ndarray, whose: np.ndarray):
        self.n = values.shape[1]
        self.reach = float(np.abs(values).max()) + 1
        self.begins = np.arange(len(values)) * (2 * self.reach + 1)
        self.keys = (values + self.begins[:, None]).ravel()
        self.whose = whose.ravel()

    def places(self, at: np.ndarray, side: str) -> np.ndarray:
        return np.searchsorted(self.keys, np.clip(at, -self.reach, self.reach) + self.begins, side)


class Windows:
    """The windows of one query over the lines of a shard, and their collisions."""

    def __init__(self, lines: Lines, at, threshold: int):
        self.lines, self.at, self.threshold = lines, at, threshold
        self.low = self.high = lines.places(at, "left")
        self.count = np.zeros(lines.n, dtype=np.int64)
        self.read = 0

    def grow(self, width: float) -> np.ndarray:
        """Vectors that reach the threshold at this half-width and did not before."""
        low, high = self.lines.places(self.at - width, "left"), self.lines.places(self.at + width, "right")
        begins, ends = np.concatenate((low, self.high)), np.concatenate((self.low, high))
        entered = np.concatenate([self.lines.whose[a:b] for a, b in zip(begins.tolist(), ends.tolist())])
        self.low, self.high = low, high
        self.read += len(entered)
        before = self.count
        self.count = before + np.bincount(entered, minlength=len(before))
        return np.flatnonzero((self.count >= self.threshold) & (before < self.threshold))

    def whole(self) -> bool:
        return self.read == len(self.lines.keys)


def _search(handle, k, count, seed, longest, threshold, far):
    def best(held, rows):
        """Keep the k best (score, then id) of each query."""
        query, ids, score = (np.concatenate(x) for x in zip(held, rows))
        order = np.lexsort((ids, -score, query))
        query, ids, score = query[order], ids[order], score[order]
        begins = np.concatenate(([True], query[1:] != query[:-1]))
        rank = np.arange(len(query)) - np.maximum.accumulate(np.where(begins, np.arange(len(query)), 0))
        top = rank < k
        return query[top], ids[top], score[top]

    def run(batches):
        own, blocks = handle.value
        held = (np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64), np.empty(0))
        for batch in batches:
            for dimension, ids, *parts in zip(*(batch.column(c).to_pylist() for c in ("dimension", "ids", "vectors", "projections", "whose"))):
                if dimension not in blocks:
                    continue
                ids = np.array([np.iinfo(np.int64).max if i is None else i for i in ids], dtype=np.int64)
                n = len(ids)
                vectors = np.frombuffer(parts[0]).reshape(n, dimension)
                held_lines = Lines(np.frombuffer(parts[1]).reshape(count, n), np.frombuffer(parts[2], dtype=np.int32).reshape(count, n))
                number, queries = blocks[dimension]
                size = np.linalg.norm(queries, axis=1)
                projected = (queries / size[:, None] @ lines(dimension + 1, count, seed)[:dimension])
                width = 1.0
                found = []
                for i, query in enumerate(queries):
                    # Windows start below those that the query before ended with.
                    windows, width = Windows(held_lines, projected[i], threshold), width / GROWTH**STEPS_BACK
                    near, score = np.empty(0, dtype=np.int64), np.empty(0)
                    while True:
                        more = windows.grow(width)
                        more = more[ids[more] != own[number[i]]]
                        near, score = np.concatenate((near, more)), np.concatenate((score, np.einsum("ij,j->i", vectors[more], query)))
                        enough = math.inf
                        if len(score) >= k:
                            worst = np.partition(score, len(score) - k)[len(score) - k]
                            # All lie on the unit sphere.
                            enough = far * math.sqrt(max(2 - 2 * worst / size[i] / longest, 0.0))
                            top = score >= worst
                            near, score = near[top], score[top]
                        if windows.whole() or width >= enough or width == math.inf:
                            break
                        width = min(width * GROWTH, enough)
                    found.append((np.full(len(near), number[i]), ids[near], score))
                if found:
                    held = best(held, tuple(np.concatenate(x) for x in zip(*found)))
        query, ids, score = held
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(query), pa.array(own[query]),
                pa.array(ids, mask=ids == np.iinfo(np.int64).max), pa.array(score),
            ],
            names=["row", "query_id", "vec_id", "score"],
        )

    return run


def nearest(
    vectors: DataFrame,
    queries: DataFrame,
    *,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    k: int = K,
    n_lines: int = LINES,
    threshold: float = THRESHOLD,
    sure: float = SURE,
    shard_vectors: int = SHARD_VECTORS,
    block_queries: int = BLOCK_QUERIES,
    seed: int = 7,
) -> DataFrame:
    """The k vectors of largest inner product found for each query: ``query_id, rank, vec_id, score``."""
    spark = vectors.sparkSession

    def rows(frame):
        vector = F.col(vector_col).cast("array<double>")
        return frame.select(F.col(id_col).cast("long").alias("id"), vector.alias("v")).filter(usable(F.col("v")))

    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda a, x: a + x * x))
    longest = rows(vectors).agg(F.max(norm)).first()[0] or 0.0
    index = materialise(
        rows(vectors).mapInArrow(_index(longest, n_lines, seed, shard_vectors), "dimension int, ids array<long>, vectors binary, projections binary, whose binary"),
        "index",
    )
    asked = rows(queries).filter(F.col("id").isNotNull())
    n = asked.count()
    blocks = max(1, -(-n // block_queries))
    asked = materialise(asked.withColumn("block", F.pmod(F.xxhash64("id", "v"), F.lit(blocks))), "queries") if blocks > 1 else asked.withColumn("block", F.lit(0))
    collisions = max(1, int(threshold * n_lines))
    far = stop_width(n_lines, collisions, sure)
    parts, before = None, 0
    for number in range(blocks):
        # About block_queries rows: the bound of this broadcast.
        block = asked.filter(F.col("block") == number).select("id", "v").toArrow().combine_chunks()
        if not block.num_rows:
            continue
        ids = np.array(block.column("id").to_pylist(), dtype=np.int64)
        lists = block.column("v").combine_chunks()
        dimensions = np.array([len(x) for x in lists])
        grouped = {int(d): (np.flatnonzero(dimensions == d), _matrix(lists.filter(pa.array(dimensions == d)), int(d))) for d in np.unique(dimensions)}
        handle = spark.sparkContext.broadcast((ids, grouped))
        found = index.mapInArrow(
            _search(handle, k, n_lines, seed, longest, collisions, far), "row long, query_id long, vec_id long, score double"
        ).withColumn("row", F.col("row") + F.lit(before))
        before += block.num_rows
        parts = found if parts is None else parts.unionByName(found)
    if parts is None:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    order = [F.desc("score"), F.asc_nulls_last("vec_id")]
    return top_per_group(parts, ["row"], order, k, "rank").select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
