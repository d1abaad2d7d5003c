"""Benchmark decontamination with suffix arrays over shards of the training text.

Every shard of documents (some megabytes inside one task) gets a suffix array of its words;
each suffix of the benchmark is searched in it by bisection. That gives all verbatim
occurrences, their places and their full lengths. Runs of words that are shorter than the
shortest window or hold a word the benchmark lacks cannot hold a match, so they are left out
of the array before it is sorted. Nothing is shuffled: a document is judged where it is read.

The benchmark is handed to the tasks in blocks of at most ``block_bytes`` of text; a larger
benchmark takes several passes over the same partitions, within one job.

Edge cases: a null or empty text has no words and is never contaminated; items without words
are never found; an item shorter than the window is one window of its own; equal items each
count; repeated ids of an item count once, a null id as the empty string; repeated documents
are each judged; other columns are not read by ``contamination`` and kept by ``decontaminate``.
"""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from digestloom.llm import columns, suffixes, words

WINDOW = 10
BLOCK_BYTES = 8 << 20
SHARD_BYTES = 8 << 20


class Block:
    """Benchmark items as numbered words: suffixes to search and the items they belong to."""

    def __init__(self, ids: list[str], texts: list[str | None], window: int):
        found = words.split(pa.array(texts, pa.string()), words.ALPHANUMERIC, True)
        self.ids = ids
        self.vocabulary = np.unique(found.name)
        number = np.searchsorted(self.vocabulary, found.name) + 1
        counts = np.diff(found.first)
        # One 0 behind each item ends its suffixes.
        self.tests = np.zeros(len(number) + len(ids), dtype=np.int64)
        item = np.repeat(np.arange(len(ids)), counts)
        self.tests[np.arange(len(number)) + item] = number
        length = np.minimum(counts, window)
        starts = np.concatenate(
            [first + i + np.arange(count - size + 1) for i, (first, count, size) in enumerate(zip(found.first, counts, length)) if count]
            or [np.empty(0, dtype=np.int64)]
        ).astype(np.int64)
        owner = np.repeat(np.arange(len(ids)), np.where(counts > 0, counts - length + 1, 0))
        size = length[owner]
        name = words.window_sums(self.tests.astype(np.uint64), starts, starts + size)
        # Equal windows are searched once; ``items`` lists all that hold them.
        _, first, group = np.unique(name, return_index=True, return_inverse=True)
        self.begin, self.size = starts[first], size[first]
        self.rest = np.array([self._rest(b) for b in self.begin], dtype=np.int64)
        groups, self.items = words.unique_pairs(group, owner)
        self.items_from = np.searchsorted(groups, np.arange(len(first) + 1))
        self.shortest = int(size.min()) if len(size) else 0
        self.longest = int(counts.max()) if len(counts) else 0

    def _rest(self, begin: int) -> int:
        return int(np.flatnonzero(self.tests[begin:] == 0)[0])

    def search(self, name: np.ndarray, text_of: np.ndarray):
        """Occurrences in a shard: window number, word, and words in common from there on."""
        none = (np.empty(0, dtype=np.int64),) * 3
        if not self.shortest or not len(name):
            return none
        at = np.searchsorted(self.vocabulary, name)
        number = np.where(self.vocabulary[np.minimum(at, len(self.vocabulary) - 1)] == name, at + 1, 0)
        known = number > 0
        if not known.any():
            return none
        begins = known.copy()
        begins[1:] &= ~known[:-1] | (text_of[1:] != text_of[:-1])
        run = np.cumsum(begins) - 1
        run_length = np.bincount(run[known], minlength=run[-1] + 1)
        kept = known & (run_length[run] >= self.shortest)
        place = np.flatnonzero(kept)
        if not len(place):
            return none
        # A 0 between runs, so that no suffix reaches from one into another.
        shift = np.concatenate(([0], np.cumsum(run[place][1:] != run[place][:-1])))
        seq = np.zeros(len(place) + shift[-1] + 1, dtype=np.int64)
        seq[np.arange(len(place)) + shift] = number[place]
        origin = np.zeros(len(seq), dtype=np.int64)
        origin[np.arange(len(place)) + shift] = place
        order = suffixes.suffix_array(seq, self.longest)
        low, high = suffixes.prefix_ranges(seq, order, self.tests, self.begin, self.size)
        hits = high - low
        window = np.repeat(np.arange(len(self.begin)), hits)
        suffix = order[words.ragged(low, hits)]
        length = suffixes.common_lengths(seq, suffix, self.tests, self.begin[window], self.rest[window])
        return window, origin[suffix], length


def blocks(benchmark: DataFrame, item_col: str, text_col: str, window: int, block_bytes: int):
    """Benchmark items, one bounded block after the other."""
    items = benchmark.select(
        F.coalesce(F.col(item_col).cast("string"), F.lit("")).alias("item"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("words"),
    )
    size = items.agg(F.sum(F.octet_length("words") + 16)).first()[0] or 0
    n = max(1, math.ceil(size / block_bytes))
    if n == 1:
        rows = items.collect()
        yield Block([r["item"] for r in rows], [r["words"] for r in rows], window)
        return
    numbered = items.withColumn("block", F.pmod(F.xxhash64("item", "words"), F.lit(2 * n)))
    for i in range(2 * n):
        rows = numbered.filter(F.col("block") == i).collect()
        if rows:
            yield Block([r["item"] for r in rows], [r["words"] for r in rows], window)


_STATE = T.StructType([T.StructField("_dl_spans", T.BinaryType()), T.StructField("_dl_items", T.ArrayType(T.StringType()))])


def _marked(block, window_of, word, size_of, found):
    """Which words lie in an occurrence."""
    delta = np.zeros(len(found.name) + 1, dtype=np.int64)
    np.add.at(delta, word, 1)
    np.add.at(delta, word + size_of[window_of], -1)
    return np.cumsum(delta[:-1]) > 0


def _scan(handle, text: str):
    """One pass: add the marks and items of one block to what earlier passes found."""

    def run(batches):
        block = handle.value
        for batch in words.gathered(batches, text, SHARD_BYTES):
            column = batch.column(text)
            found = words.split(column, words.ALPHANUMERIC, True)
            text_of = found.text_of()
            window, word, _ = block.search(found.name, text_of)
            hit = _marked(block, window, word, block.size, found)
            doc, seen = words.unique_pairs(text_of[word], window)
            many = block.items_from[seen + 1] - block.items_from[seen]
            slot = words.ragged(block.items_from[seen], many)
            doc, item = words.unique_pairs(np.repeat(doc, many), block.items[slot])
            cut = np.searchsorted(doc, np.arange(batch.num_rows + 1))
            before = batch.column("_dl_spans").to_pylist(), batch.column("_dl_items").to_pylist()
            spans, items = [], []
            for i in range(batch.num_rows):
                own = hit[found.first[i] : found.first[i + 1]]
                old = before[0][i]
                if old is not None and len(old):
                    own = own | np.unpackbits(np.frombuffer(old, dtype=np.uint8), count=len(own)).astype(bool)
                spans.append(np.packbits(own).tobytes() if own.any() else b"")
                names = {block.ids[j] for j in item[cut[i] : cut[i + 1]]}
                items.append(sorted(names.union(before[1][i] or ())))
            names = batch.schema.names
            out = [batch.column(n) for n in names if n not in ("_dl_spans", "_dl_items")]
            yield pa.RecordBatch.from_arrays(
                [*out, pa.array(spans, pa.binary()), pa.array(items, pa.list_(pa.string()))],
                names=[*(n for n in names if n not in ("_dl_spans", "_dl_items")), "_dl_spans", "_dl_items"],
            )

    return run


_RESULT = "n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean"


def _finish(text: str):
    def run(batches):
        for batch in batches:
            for part in words.chunks(batch, text):
                found = words.split(part.column(text), words.ALPHANUMERIC, True, names=False)
                spans, items = part.column("_dl_spans").to_pylist(), part.column("_dl_items").to_pylist()
                hits = [int(np.unpackbits(np.frombuffer(s, dtype=np.uint8)).sum()) if s else 0 for s in spans]
                rest = [n for n in part.schema.names if n not in (text, "_dl_spans", "_dl_items")]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in rest),
                        pa.array(np.diff(found.first), pa.int64()),
                        pa.array(hits, pa.int64()),
                        pa.array([len(x) for x in items], pa.int64()),
                        pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]),
                        pa.array([h > 0 for h in hits]),
                    ],
                    names=[*rest, "n_words", "n_hit", "n_items", "items_sha256", "contaminated"],
                )

    return run


def contamination(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per document: words, words inside benchmark windows, items found, verdict."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("_dl_text"))
    state = rows.withColumns({"_dl_spans": F.lit(None).cast("binary"), "_dl_items": F.lit(None).cast("array<string>")})
    for block in blocks(benchmark, item_col, item_text_col, window, block_bytes):
        schema = T.StructType([*rows.schema.fields, *_STATE.fields])
        state = state.mapInArrow(_scan(spark.sparkContext.broadcast(block), "_dl_text"), schema)
    state = state.withColumn("_dl_items", F.coalesce("_dl_items", F.array().cast("array<string>")))
    kind = rows.schema[id_col].dataType.simpleString()
    return state.mapInArrow(_finish("_dl_text"), f"`{id_col}` {kind}, {_RESULT}")


def decontaminate(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Documents without any benchmark window, all columns as they are."""
    spark = documents.sparkSession
    documents, back = columns.set_aside(documents)
    text_col = columns.renamed(text_col, back)
    state = documents.withColumns(
        {"_dl_text": F.col(text_col).cast("string"), "_dl_spans": F.lit(None).cast("binary"), "_dl_items": F.lit(None).cast("array<string>")}
    )
    schema = state.schema
    for block in blocks(benchmark, item_col, item_text_col, window, block_bytes):
        state = state.mapInArrow(_scan(spark.sparkContext.broadcast(block), "_dl_text"), schema)
    return state.filter(F.coalesce(F.octet_length("_dl_spans"), F.lit(0)) == 0).drop("_dl_text", "_dl_spans", "_dl_items").withColumnsRenamed(back)


def longest_matches(
    documents: DataFrame,
    benchmark: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """Longest verbatim match of each document and item: places in both and words in common.

    Ties go to the first place in the document, then in the item.
    """
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_dl_text"))

    def search(handle):
        def run(batches):
            block = handle.value
            item_at = np.concatenate(([0], np.flatnonzero(block.tests == 0) + 1))
            for batch in words.gathered(batches, "_dl_text", SHARD_BYTES):
                found = words.split(batch.column("_dl_text"), words.ALPHANUMERIC, True)
                text_of = found.text_of()
                window_of, word, length = block.search(found.name, text_of)
                rows = []
                for w, at, n in zip(window_of.tolist(), word.tolist(), length.tolist()):
                    doc = int(text_of[at])
                    for item in block.items[block.items_from[w] : block.items_from[w + 1]]:
                        own = block.tests[item_at[item] : item_at[item + 1] - 1]
                        part = block.tests[block.begin[w] : block.begin[w] + n]
                        # The common run may reach beyond this item's copy of the window.
                        places = [p for p in range(len(own)) if np.array_equal(own[p : p + block.size[w]], part[: block.size[w]])]
                        for p in places:
                            m = int(block.size[w])
                            while m < n and p + m < len(own) and own[p + m] == part[m]:
                                m += 1
                            rows.append((doc, block.ids[item], int(at - found.first[doc]), p, m))
                ids = batch.column("_id")
                yield pa.RecordBatch.from_arrays(
                    [
                        ids.take(pa.array([r[0] for r in rows], pa.int64())),
                        pa.array([r[1] for r in rows], pa.string()),
                        *(pa.array([r[i] for r in rows], pa.int64()) for i in (2, 3, 4)),
                    ],
                    names=[id_col, "item_id", "doc_word", "item_word", "n_words"],
                )

        return run

    kind = rows.schema["_id"].dataType.simpleString()
    parts = None
    for block in blocks(benchmark, item_col, item_text_col, window, block_bytes):
        part = rows.mapInArrow(
            search(spark.sparkContext.broadcast(block)),
            f"`{id_col}` {kind}, item_id string, doc_word long, item_word long, n_words long",
        )
        parts = part if parts is None else parts.unionByName(part)
    best = F.min(F.struct((-F.col("n_words")).alias("less"), "doc_word", "item_word")).alias("b")
    return (
        parts.groupBy(id_col, "item_id").agg(best)
        .select(id_col, "item_id", F.col("b.doc_word"), F.col("b.item_word"), (-F.col("b.less")).alias("n_words"))
    )
