"""Which filter removes what: counts for every order of five document filters.

The filters A to D look at one text; E fails a document whose text a smaller id has. For E a
counting Bloom sketch is filled with the 64-bit hashes of all texts: each task fills its own
part, parts are merged by addition (two is as good as more), and a text with a counter below
two is certainly unique. Only the other texts are shuffled, whole, to find the smallest id of
each exactly. A row with the failures of a document is a mask of five bits; counts of rows by
part, mask and label are additive, and everything that is reported for an order and a step is a
sum of such counts.

The merged sketch is broadcast while it has at most ``broadcast_bits`` (64 MB); a larger one is
looked up where it lies, by messages of hashes, and the hashes of possible repeats are joined.

Edge cases: a null text is an empty one; a null part is the empty string; a null id has no
smaller id and is smaller than none, so its row never fails E; rows that repeat an id do not fail
E through each other; a document has a label if any row of ``labels`` for its id says so, null
labels say nothing; no documents give no rows; other columns are not read. Texts whose 64-bit
hashes clash are told apart by SHA-256.
"""

from __future__ import annotations

import itertools

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.llm import plain_words
from digestloom.llm.words import mix
from digestloom.operators.skew import broadcast_if_small
from digestloom.session import materialise

FILTERS = "ABCDE"
LEAST_WORDS = 200
LEAST_DISTINCT = 50  # percent of the words
MOST_CAPITALS = 2  # percent of the code points
SYMBOLS = b"#$%&*|"

# Counters for each document, probes of a text, and counters of a block: a text's probes lie in one block.
COUNTERS_EACH = 8
PROBES = 2
BLOCK_COUNTERS = (1 << 19, 1 << 26)
MAX_BLOCKS = 4096
BROADCAST_BITS = 1 << 29
PENDING = 1 << 19


CAPITALS = bytes(range(65, 91))
INSIDE = bytes(range(0x80, 0xC0))  # bytes of a code point after its first


def failures(data: bytes) -> int:
    """Bits 0 to 3: a text's failures of the filters A to D."""
    words, distinct = plain_words.words_and_distinct(data)
    points = len(data.translate(None, INSIDE))
    capitals = len(data) - len(data.translate(None, CAPITALS))
    return (
        (words < LEAST_WORDS)
        + 2 * (100 * distinct < LEAST_DISTINCT * words)
        + 4 * (100 * capitals > MOST_CAPITALS * points)
        + 8 * (len(data) != len(data.translate(None, SYMBOLS)))
    )


def _judged(batches):
    """``own``, the failures, in place of the text, which is the last column."""
    for batch in batches:
        own = pa.array([failures(data) for data in plain_words.texts(batch.column("text"))], pa.int32())
        yield pa.RecordBatch.from_arrays([*batch.columns[:-1], own], names=[*batch.schema.names[:-1], "own"])


def text_hash(text: str = "text") -> Column:
    return F.xxhash64(F.coalesce(F.col(text), F.lit("")))


class Sketch:
    """Shape of a blocked counting Bloom sketch."""

    def __init__(self, rows: int, each: int = COUNTERS_EACH):
        least, most = BLOCK_COUNTERS
        counters = max(least, 1 << max(rows * each - 1, 1).bit_length())
        self.block = max(least, min(counters // MAX_BLOCKS, most))
        self.blocks = counters // self.block

    @property
    def bits(self) -> int:
        return self.block * self.blocks

    def probes(self, hashes: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Block of each hash, and the counters of its probes there."""
        mixed = mix(hashes.view(np.uint64).copy())
        block = (mixed % np.uint64(self.blocks)).astype(np.int64)
        places, at = [], mixed
        for _ in range(PROBES):
            at = mix(at + np.uint64(0x9E3779B97F4A7C15))
            places.append((at % np.uint64(self.block)).astype(np.int64))
        return block, places

    def fill(self, batches):
        """Messages ``block, once, more``: counters that a task raised once, and more often."""
        keys, counts = np.empty(0, dtype=np.int64), np.empty(0, dtype=np.int64)
        pending, size = [], 0

        def merged():
            new = np.concatenate([np.empty(0, dtype=np.int64), *pending])
            found, n = np.unique(new, return_counts=True)
            both, inverse = np.unique(np.concatenate((keys, found)), return_inverse=True)
            total = np.bincount(inverse, weights=np.concatenate((counts, n)), minlength=len(both))
            return both, np.minimum(total, 2).astype(np.int64)

        for batch in batches:
            block, places = self.probes(batch.column(0).to_numpy())
            # A text raises a counter once, also where two of its probes meet.
            own = np.sort(np.stack([block * self.block + p for p in places]), axis=0)
            fresh = np.concatenate((np.ones((1, own.shape[1]), dtype=bool), own[1:] != own[:-1]))
            pending.append(own[fresh])
            size += own.size
            if size > PENDING:
                keys, counts = merged()
                pending, size = [], 0
        keys, counts = merged()
        cut = np.searchsorted(keys, np.arange(self.blocks + 1) * self.block)
        sent = []
        for i in np.flatnonzero(np.diff(cut)).tolist():
            at, n = (keys[cut[i] : cut[i + 1]] - i * self.block).astype(np.uint32), counts[cut[i] : cut[i + 1]]
            sent.append((i, at[n == 1].tobytes(), at[n > 1].tobytes()))
            if len(sent) == 256:
                yield _messages(sent)
                sent = []
        yield _messages(sent)

    def merge(self, table: pa.Table) -> pa.Table:
        """A block's bits: which counters reached two."""
        counters = np.zeros(self.block, dtype=np.uint8)
        for once, more in zip(table.column("once"), table.column("more")):
            at = np.frombuffer(once.as_py(), dtype=np.uint32)
            counters[at] = np.minimum(counters[at] + 1, 2)
            counters[np.frombuffer(more.as_py(), dtype=np.uint32)] = 2
        return pa.table({"block": table.column("block")[:1], "bits": pa.array([np.packbits(counters >= 2).tobytes()], pa.binary())})

    def hits(self, bits: np.ndarray, places: list[np.ndarray]) -> np.ndarray:
        """Whether all probes of a text (numbered over all given bits) reached two."""
        found = np.ones(len(places[0]), dtype=bool)
        for at in places:
            found &= (bits[at >> 3] >> (7 - (at & 7)).astype(np.uint8)) & 1 == 1
        return found


def _messages(sent):
    return pa.RecordBatch.from_arrays(
        [pa.array([x[0] for x in sent], pa.int32()), *(pa.array([x[k] for x in sent], pa.binary()) for k in (1, 2))], names=["block", "once", "more"]
    )


def _by_broadcast(spark: SparkSession, shape: Sketch, blocks: DataFrame):
    """A column function: whether a hash may be there twice. The sketch has at most ``broadcast_bits``."""
    bits = np.zeros((shape.blocks, shape.block // 8), dtype=np.uint8)
    for row in blocks.toLocalIterator():
        bits[row["block"]] = np.frombuffer(row["bits"], dtype=np.uint8)
    handle = spark.sparkContext.broadcast(bits.reshape(-1))

    @F.pandas_udf("boolean")
    def possible(hashes: pd.Series) -> pd.Series:
        block, places = shape.probes(hashes.to_numpy(dtype=np.int64))
        return pd.Series(shape.hits(handle.value, [block * shape.block + p for p in places]))

    return possible


def _by_messages(shape: Sketch, hashes: DataFrame, blocks: DataFrame) -> DataFrame:
    """Distinct hashes that may be there twice, looked up where their blocks lie."""

    def ask(batches):
        for batch in batches:
            own = np.unique(batch.column(0).to_numpy())
            block, _ = shape.probes(own)
            order = np.argsort(block, kind="stable")
            own, block = own[order], block[order]
            begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1]))) if len(own) else np.empty(0, dtype=np.int64)
            parts = np.split(own, begins[1:]) if len(own) else []
            yield pa.RecordBatch.from_arrays([pa.array(block[begins], pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], names=["block", "asked"])

    def answer(asked: pa.Table, bits: pa.Table) -> pa.Table:
        found = []
        if bits.num_rows:
            held = np.frombuffer(bits.column("bits")[0].as_py(), dtype=np.uint8)
            for payload in asked.column("asked"):
                own = np.frombuffer(payload.as_py(), dtype=np.int64)
                found.append(own[shape.hits(held, shape.probes(own)[1])])
        return pa.table({"hash": np.unique(np.concatenate([np.empty(0, dtype=np.int64), *found]))})

    asked = hashes.mapInArrow(ask, "block int, asked binary")
    return asked.groupBy("block").cogroup(blocks.groupBy("block")).applyInArrow(answer, "hash long")


def earliest(docs: DataFrame, hashes: DataFrame, *, id_col: str, text_col: str, broadcast_bits: int = BROADCAST_BITS, each: int = COUNTERS_EACH) -> DataFrame:
    """``hash, digest, first_id, n_texts`` of texts that several rows have.

    ``hashes`` is a written table with a column ``hash`` per row of ``docs``; ``n_texts`` counts
    the repeated texts of one hash, ``digest`` tells them apart.
    """
    shape = Sketch(hashes.count(), each)
    blocks = materialise(hashes.select("hash").mapInArrow(shape.fill, "block int, once binary, more binary").groupBy("block").applyInArrow(lambda table: shape.merge(table), "block int, bits binary"), "sketch")
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("whole"), text_hash(text_col).alias("hash"))
    if shape.bits <= broadcast_bits:
        texts = texts.filter(_by_broadcast(docs.sparkSession, shape, blocks)("hash"))
    else:
        maybe = materialise(_by_messages(shape, hashes.select("hash"), blocks), "possible")
        texts = texts.join(broadcast_if_small(maybe), "hash", "left_semi")
    # Copies are combined in each task, so a text that a third of all rows share travels once a task.
    groups = texts.groupBy("hash", "whole").agg(F.min("id").alias("first_id"), F.count("*").alias("n"))
    found = materialise(groups.select("hash", F.sha2("whole", 256).alias("digest"), "first_id", "n"), "repeated")
    clashes = found.groupBy("hash").agg(F.count("*").alias("n_texts"))
    return found.filter("n > 1").join(broadcast_if_small(materialise(clashes.filter("n_texts > 1"), "clashes")), "hash", "left").select(
        "hash", "digest", "first_id", F.coalesce("n_texts", F.lit(1)).alias("n_texts")
    )


def masks(
    docs: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", part_col: str = "source", broadcast_bits: int = BROADCAST_BITS, each: int = COUNTERS_EACH
) -> DataFrame:
    """``part, mask, n, n_good, n_toxic``: additive counts of documents by their failures."""
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(part_col).cast("string"), F.lit("")).alias("part"), text_hash(text_col).alias("hash"), F.col(text_col).alias("text")
    )
    rows = materialise(texts.mapInArrow(_judged, f"id {id_type}, part string, hash long, own int"), "failures")
    firsts = materialise(earliest(docs, rows, id_col=id_col, text_col=text_col, broadcast_bits=broadcast_bits, each=each), "firsts")
    single = firsts.filter("n_texts = 1").select("hash", "first_id")
    later = F.coalesce(F.col("first_id") < F.col("id"), F.lit(False))
    clashing = firsts.filter("n_texts > 1")
    flagged = rows.join(broadcast_if_small(single), "hash", "left").select("id", "part", "own", "hash", later.alias("late"))
    if clashing.limit(1).count():
        # Different texts with one hash: their rows are judged by digest.
        among = clashing.select("hash").distinct()
        of_text = F.sha2(F.coalesce(F.col("text"), F.lit("")), 256).alias("digest")
        judged = (
            texts.join(broadcast_if_small(among), "hash", "left_semi")
            .select("id", "part", "hash", of_text, "text")
            .mapInArrow(_judged, f"id {id_type}, part string, hash long, digest string, own int")
            .join(broadcast_if_small(clashing.select("hash", "digest", "first_id")), ["hash", "digest"], "left")
            .select("id", "part", "own", "hash", later.alias("late"))
        )
        flagged = flagged.join(broadcast_if_small(among), "hash", "left_anti").select("id", "part", "own", "hash", "late").unionByName(judged)
    said = labels.filter("doc_id is not null").groupBy("doc_id").agg(
        F.coalesce(F.bool_or(F.col("quality") == 1), F.lit(False)).alias("good"), F.coalesce(F.bool_or(F.col("toxic") == 1), F.lit(False)).alias("toxic")
    )
    said = materialise(said.filter("good or toxic"), "labelled")
    marked = flagged.join(broadcast_if_small(said), flagged["id"] == said["doc_id"], "left")
    return marked.groupBy("part", (F.col("own") + F.when(F.col("late"), 16).otherwise(0)).cast("int").alias("mask")).agg(
        F.count("*").alias("n"), F.count_if(F.col("good")).alias("n_good"), F.count_if(F.col("toxic")).alias("n_toxic")
    )


def report(counts: DataFrame) -> DataFrame:
    """For each part, order of the filters and step: what the step's filter does there."""
    held = counts.groupBy("part").agg(F.collect_list(F.struct("mask", "n", "n_good", "n_toxic")).alias("held"))  # 32 masks at most
    orders = ["".join(x) for x in itertools.permutations(FILTERS)]
    steps = held.select("part", "held", F.explode(F.array(*map(F.lit, orders))).alias("filter_order"))
    steps = steps.select("part", "held", "filter_order", F.explode(F.sequence(F.lit(1), F.lit(len(FILTERS)))).alias("step"))
    letters = {name: 1 << i for i, name in enumerate(FILTERS)}
    name = F.expr("substring(filter_order, step, 1)")
    own = sum((F.when(name == x, bit).otherwise(0) for x, bit in letters.items()), F.lit(0))
    place = {x: F.instr("filter_order", x) for x in FILTERS}
    earlier = sum((F.when(place[x] < F.col("step"), bit).otherwise(0) for x, bit in letters.items()), F.lit(0))
    steps = steps.withColumns({"own": own, "earlier": earlier})

    def total(condition, value="n"):
        def add(sum_, x):
            return sum_ + F.when(condition(x["mask"]), x[value]).otherwise(0)

        return F.aggregate("held", F.lit(0).cast("long"), add)

    def fails(mask):
        return mask.bitwiseAND(F.col("own")) != 0

    def here(mask):
        return fails(mask) & (mask.bitwiseAND(F.col("earlier")) == 0)

    # A document that fails m filters is removed by each of them in 1 / m of all orders.
    parts = F.array(*(F.lit(len(orders) // m) for m in range(1, len(FILTERS) + 1)))

    def share(sum_, x):
        return sum_ + F.when(fails(x["mask"]), x["n"] * F.element_at(parts, F.bit_count(x["mask"]))).otherwise(0)

    return steps.select(
        "part", "filter_order", F.col("step").cast("int").alias("step"),
        total(lambda m: (m.bitwiseAND(F.col("own")) == 0) & (m.bitwiseAND(F.col("earlier")) == 0)).alias("kept"),
        total(here).alias("removed"),
        total(lambda m: fails(m) & (m.bitwiseAND(F.col("earlier")) != 0)).alias("redundant"),
        total(lambda m: m == F.col("own")).alias("unique_fails"),
        total(here, "n_good").alias("good_lost"),
        total(here, "n_toxic").alias("toxic_lost"),
        F.aggregate("held", F.lit(0).cast("long"), share).alias("shapley"),
    )


def audit(docs: DataFrame, labels: DataFrame, **options) -> DataFrame:
    """``masks`` and ``report`` over whole tables."""
    return report(materialise(masks(docs, labels, **options), "masks"))
