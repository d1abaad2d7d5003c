"""Hard negatives by segment summaries.

A vector is cut into segments of equal length, and for each segment its mean and its deviation
(the norm of what is left without the mean) are kept. Over a segment of length L an inner
product is ``L * mean * mean`` plus at most, and minus at most, the product of the deviations.
Summed over segments this bounds a score from both sides. A pair that the bounds of one segment
do not decide is looked at with two segments, four, and so on; only what the finest level leaves
open is scored exactly.

Two passes over the rows: the first finds each anchor's positives (rows of its label), the second
the negatives whose scores lie in the band of a positive. Summaries are stored with the vectors
in shards. Anchors are a stated query set and go to the shards in blocks of bounded size; each
task keeps the best rows of its shards per anchor (or anchor and positive), and a rank per group
joins the tasks, so no group is gathered and nothing is paired beyond the query set.

Components are scaled and rounded down, ``floor(scale * x)``, and scores are integers.

Edge cases: rows with a null id, a null label, a null vector or any component that is null or not
finite take no part, nor do rows whose rounded components reach 2^24 (their scores might not fit
64 bits); of rows that repeat an id, the one with the smallest label and vector counts; shorter
vectors are filled up with zeros; equal scores go by smaller id; fewer positives or negatives
than asked for are all returned; an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.operators.skew import top_per_group
from digestloom.session import materialise

SCALE = 256
POSITIVES = 5
NEGATIVES = 10
# A negative's score lies between these percentages of the positive's.
BAND = (30, 90)
SEGMENTS = (1, 2, 4, 8, 16)
SHARD_VECTORS = 4096
BLOCK_ANCHORS = 4096
GROUP_ANCHORS = 64
LARGEST = 1 << 24


def usable(id_col: str, label_col: str, vector_col: str) -> F.Column:
    sound = F.forall(vector_col, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return F.col(id_col).isNotNull() & F.col(label_col).isNotNull() & F.coalesce(sound, F.lit(False))


def rounded(rows: DataFrame, *, id_col: str, label_col: str, vector_col: str, scale: int) -> DataFrame:
    """``id, label, v`` of the rows that take part, one per id."""
    vector = F.transform(F.col(vector_col).cast("array<double>"), lambda x: F.floor(F.lit(float(scale)) * x).cast("long"))
    kept = rows.filter(usable(id_col, label_col, vector_col)).select(F.col(id_col).cast("long").alias("id"), F.col(label_col).cast("long").alias("label"), vector.alias("v"))
    kept = kept.filter(F.forall("v", lambda x: (x < LARGEST) & (x > -LARGEST)))
    again = materialise(kept.groupBy("id").count().filter("count > 1").select("id"), "repeated")
    if not again.limit(1).count():
        return kept
    first = kept.join(again, "id", "left_semi").groupBy("id").agg(F.min(F.struct("label", "v")).alias("row")).select("id", "row.label", "row.v")
    return kept.join(again, "id", "left_anti").unionByName(first)


def summaries(vectors: np.ndarray, segments: int) -> np.ndarray:
    """Means (times the root of the segment's length) and deviations of each vector's segments."""
    n, dimension = vectors.shape
    parts = vectors.reshape(n, segments, dimension // segments)
    mean = parts.mean(axis=2)
    deviation = np.sqrt(((parts - mean[:, :, None]) ** 2).sum(axis=2))
    return np.concatenate((mean * np.sqrt(dimension // segments), deviation), axis=1)


def _shards(dimension: int, levels: tuple[int, ...], size: int):
    """Rows to shards: ids, labels, vectors and the summaries of every level."""

    def shard(ids, labels, vectors):
        parts = [ids.tobytes(), labels.tobytes(), vectors.tobytes(), np.concatenate([summaries(vectors, s) for s in levels], axis=1).tobytes()]
        return pa.RecordBatch.from_arrays([pa.array([p], pa.binary()) for p in parts], names=["ids", "labels", "vectors", "summaries"])

    def run(batches):
        held, n = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            held.append(_arrays(batch, dimension))
            n += batch.num_rows
            while n >= size:
                whole = [np.concatenate(x) for x in zip(*held)]
                yield shard(*(x[:size] for x in whole))
                held, n = [[x[size:] for x in whole]], n - size
        if n:
            yield shard(*(np.concatenate(x) for x in zip(*held)))

    return run


def _arrays(batch, dimension: int):
    """Ids, labels and vectors, filled up with zeros."""
    lists = batch.column("v")
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
    vectors = np.zeros((len(lists), dimension))
    vectors[np.arange(dimension)[None, :] < lengths[:, None]] = lists.flatten().to_numpy(zero_copy_only=False)
    return batch.column("id").to_numpy(), batch.column("label").to_numpy(), vectors


def exact(vectors: np.ndarray, anchor: np.ndarray) -> np.ndarray:
    """Integer inner products: in double precision where that is exact, else in 64-bit integers."""
    largest = max(np.abs(vectors).max(initial=0.0), 1.0) * max(np.abs(anchor).max(initial=0.0), 1.0) * max(len(anchor), 1)
    if largest < 1 << 53:
        return (vectors @ anchor).astype(np.int64)
    return (vectors.astype(np.int64) * anchor.astype(np.int64)).sum(axis=1)


def bounds(rows: np.ndarray, anchors: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Lower and upper bounds of all scores from the summaries of one level."""
    half = rows.shape[1] // 2
    middle, reach = anchors[:, :half] @ rows[:, :half].T, anchors[:, half:] @ rows[:, half:].T
    # Room for rounding, from the norms: means and deviations squared add up to theirs.
    reach += 1e-12 * np.outer(np.linalg.norm(anchors, axis=1), np.linalg.norm(rows, axis=1)) + 1e-6
    return middle - reach, middle + reach


def _kth(values: np.ndarray, k: int) -> float:
    return np.partition(values, len(values) - k)[len(values) - k] if len(values) >= k else -np.inf


class Shard:
    def __init__(self, dimension, levels, ids, labels, vectors, stored):
        self.ids, self.labels = np.frombuffer(ids, dtype=np.int64), np.frombuffer(labels, dtype=np.int64)
        self.vectors = np.frombuffer(vectors).reshape(len(self.ids), dimension)
        stored = np.frombuffer(stored).reshape(len(self.ids), 2 * sum(levels))
        ends = np.cumsum([2 * s for s in levels])
        self.levels = [np.ascontiguousarray(stored[:, e - 2 * s : e]) for s, e in zip(levels, ends)]


class Bounds:
    """Bounds of some anchors' scores in a shard: of all rows at once, or of a few when few are open."""

    def __init__(self, shard: Shard, anchor_levels: list[np.ndarray], group: slice):
        self.shard, self.anchors, self.whole = shard, [x[group] for x in anchor_levels], {}

    def at(self, level: int, i: int, open_: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        rows, anchors = self.shard.levels[level], self.anchors[level]
        if 8 * len(open_) < len(rows):
            low, high = bounds(rows[open_], anchors[i : i + 1])
            return low[0], high[0]
        if level not in self.whole:
            self.whole[level] = bounds(rows, anchors)
        low, high = self.whole[level]
        return low[i, open_], high[i, open_]

    def refined(self, i: int, open_: np.ndarray, keep) -> np.ndarray:
        """Rows still open for an anchor after every level; ``keep(low, high)`` tells which stay."""
        for level in range(len(self.anchors)):
            if not len(open_):
                break
            open_ = open_[keep(*self.at(level, i, open_))]
        return open_


class Best:
    """The k best (score, then smaller id) of each group, over all shards of a task."""

    def __init__(self, k: int):
        self.k, self.held, self.least = k, {}, {}

    def add(self, group, scores, ids) -> None:
        if group in self.held:
            scores, ids = np.concatenate((self.held[group][0], scores)), np.concatenate((self.held[group][1], ids))
        first = np.lexsort((ids, -scores))[: self.k]
        self.held[group] = scores[first], ids[first]
        if len(first) == self.k:
            self.least[group] = int(scores[first[-1]])

    def floor(self, group) -> float:
        """A score below this is no use."""
        return self.least.get(group, -np.inf)


def _each_shard(batches, dimension, levels):
    for batch in batches:
        for row in zip(*(batch.column(c).to_pylist() for c in ("ids", "labels", "vectors", "summaries"))):
            yield Shard(dimension, levels, *row)


def _positives(handle, dimension: int, levels: tuple[int, ...], k: int):
    def run(batches):
        ids, labels, vectors = handle.value
        anchor_levels, best = [summaries(vectors, s) for s in levels], Best(k)
        for shard in _each_shard(batches, dimension, levels):
            by_label = {x: np.flatnonzero(shard.labels == x) for x in np.unique(shard.labels).tolist()}
            for at in range(0, len(ids), GROUP_ANCHORS):
                scored = Bounds(shard, anchor_levels, slice(at, at + GROUP_ANCHORS))
                for i in range(at, min(at + GROUP_ANCHORS, len(ids))):
                    own = int(ids[i])

                    def keep(low, high, own=own):
                        return high >= max(best.floor(own), _kth(low, k))

                    rows = by_label.get(int(labels[i]), np.empty(0, dtype=np.int64))
                    rows = scored.refined(i - at, rows[shard.ids[rows] != own], keep)
                    if len(rows):
                        best.add(own, exact(shard.vectors[rows], vectors[i]), shard.ids[rows])
        found = [(own, int(i), int(s)) for own, (scores, near) in best.held.items() for s, i in zip(scores, near)]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in range(3)], names=["anchor_id", "positive_id", "positive_score"])

    return run


def _negatives(handle, dimension: int, levels: tuple[int, ...], k: int, band: tuple[int, int]):
    least, most = band

    def run(batches):
        ids, labels, vectors, pairs = handle.value
        anchor_levels, best = [summaries(vectors, s) for s in levels], Best(k)
        for shard in _each_shard(batches, dimension, levels):
            for at in range(0, len(ids), GROUP_ANCHORS):
                scored = Bounds(shard, anchor_levels, slice(at, at + GROUP_ANCHORS))
                for i in range(at, min(at + GROUP_ANCHORS, len(ids))):
                    own, wanted = int(ids[i]), [x for x in pairs.get(int(ids[i]), ()) if least * x[1] <= most * x[1]]
                    if not wanted:
                        continue

                    def keep(low, high, own=own, wanted=wanted):
                        # Open for any positive: not surely outside its band, nor behind k that surely are in it.
                        kept = np.zeros(len(low), dtype=bool)
                        for positive, score in wanted:
                            inside = low[(100 * low >= least * score) & (100 * high <= most * score)]
                            floor = max(best.floor((own, positive)), _kth(inside, k))
                            kept |= (100 * high >= least * score) & (100 * low <= most * score) & (high >= floor)
                        return kept

                    rows = scored.refined(i - at, np.flatnonzero(shard.labels != labels[i]), keep)
                    scores = exact(shard.vectors[rows], vectors[i])
                    for positive, score in wanted:
                        fits = (100 * scores >= least * score) & (100 * scores <= most * score)
                        best.add((own, positive), scores[fits], shard.ids[rows[fits]])
        found = [(*group, int(i), int(s)) for group, (scores, near) in best.held.items() for s, i in zip(scores, near)]
        yield pa.RecordBatch.from_arrays([pa.array([x[j] for x in found], pa.int64()) for j in range(4)], names=["anchor_id", "positive_id", "negative_id", "negative_score"])

    return run


def _levels(dimension: int, wanted: tuple[int, ...]) -> tuple[tuple[int, ...], int]:
    """Numbers of segments, and the dimension with which the finest cuts vectors evenly."""
    levels = tuple(s for s in wanted if s == 1 or 2 * s <= dimension)
    return levels, -(-max(dimension, 1) // levels[-1]) * levels[-1]


def mine(
    rows: DataFrame,
    anchors: DataFrame,
    *,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    band: tuple[int, int] = BAND,
    segments: tuple[int, ...] = SEGMENTS,
    shard_vectors: int = SHARD_VECTORS,
    block_anchors: int = BLOCK_ANCHORS,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``.

    ``anchors`` are rows of ``rows``; each number of ``segments`` divides the next.
    """
    spark = rows.sparkSession
    columns = {"id_col": id_col, "label_col": label_col, "vector_col": vector_col, "scale": scale}
    sound = rounded(rows, **columns)
    longest = sound.agg(F.max(F.size("v"))).first()[0] or 0
    levels, dimension = _levels(longest, segments)
    shards = materialise(sound.mapInArrow(_shards(dimension, levels, shard_vectors), "ids binary, labels binary, vectors binary, summaries binary"), "shards")
    asked = materialise(rounded(anchors, **columns), "anchors")
    blocks = max(1, -(-asked.count() // block_anchors))
    parts = []
    for number in range(blocks):
        # About block_anchors rows: the bound of both broadcasts.
        block = asked.filter(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow().combine_chunks()
        if not block.num_rows:
            continue
        held = _arrays(block, dimension)
        handle = spark.sparkContext.broadcast(held)
        near = shards.mapInArrow(_positives(handle, dimension, levels, positives), "anchor_id long, positive_id long, positive_score long")
        order = [F.desc("positive_score"), F.asc("positive_id")]
        near = materialise(top_per_group(near, ["anchor_id"], order, positives).drop("rn"), "positives")
        pairs: dict[int, list] = {}
        for row in near.toLocalIterator():  # block_anchors times positives
            pairs.setdefault(row["anchor_id"], []).append((row["positive_id"], row["positive_score"]))
        handle = spark.sparkContext.broadcast((*held, pairs))
        far = shards.mapInArrow(_negatives(handle, dimension, levels, negatives, band), "anchor_id long, positive_id long, negative_id long, negative_score long")
        order = [F.desc("negative_score"), F.asc("negative_id")]
        far = top_per_group(far, ["anchor_id", "positive_id"], order, negatives, "rank")
        parts.append(far.join(F.broadcast(near), ["anchor_id", "positive_id"]))
    found = parts[0] if parts else spark.createDataFrame([], "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long")
    for part in parts[1:]:
        found = found.unionByName(part)
    return found.select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), "negative_id", "positive_score", "negative_score")
