"""Documents gathered into shards, and an exchange that tells shards which names they share.

A shard is one row: some megabytes of whole documents as a compressed Arrow stream. Each shard
sends the different 64-bit names it holds, sorted and cut by leading bits; the task for a range
of names answers with one bit per name: does another shard hold it too? A name travels once
per shard however often it occurs, so a passage that a third of all documents share is no hot
key, and an answer is a bit, not a row.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import words
from digestloom.session import materialise

SHARD_BYTES = 4 << 20
# Names that the task for one range receives, about.
RANGE_NAMES = 1 << 20

MESSAGE = "shard long, part int, kind int, payload binary"
NAMES, NOTE = 0, 1


def pack(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_batch(batch)
    return sink.getvalue().to_pybytes()


def unpack(data: bytes) -> pa.RecordBatch:
    with pa.ipc.open_stream(data) as source:
        return source.read_next_batch()


def gather(documents: DataFrame, text: str, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``documents`` as shards: ``shard, n_bytes, body``."""

    def run(batches):
        for batch in words.gathered(batches, text, shard_bytes):
            size = batch.column(text).nbytes
            yield pa.RecordBatch.from_arrays([pa.array([size], pa.int64()), pa.array([pack(batch)], pa.binary())], names=["n_bytes", "body"])

    rows = documents.mapInArrow(run, "n_bytes long, body binary")
    return materialise(rows.withColumn("shard", F.monotonically_increasing_id()), "shards")


def parts_for(names: int) -> int:
    """Ranges of names, a power of two."""
    return 1 << max(6, math.ceil(math.log2(max(names, 1) / RANGE_NAMES)))


def ranges(names: np.ndarray, parts: int) -> list[tuple[int, np.ndarray]]:
    """Number and names of each range that has some, for sorted different names."""
    bounds = np.searchsorted(names, np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - parts.bit_length() + 1))
    return [(i, x) for i, x in enumerate(np.split(names, bounds)) if len(x)]


def send(shard: int, names: np.ndarray, parts: int) -> list[tuple]:
    """Messages for sorted different names, one per range."""
    return [(shard, i, NAMES, x.tobytes()) for i, x in ranges(names, parts)]


def messages(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.binary()]
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["shard", "part", "kind", "payload"])


def _answer(table: pa.Table) -> pa.Table:
    kinds = table.column("kind").to_pylist()
    payloads = table.column("payload").to_pylist()
    asked = [np.frombuffer(p, dtype=np.uint64) for p, k in zip(payloads, kinds) if k == NAMES]
    out = payloads
    if asked:
        _, inverse, counts = np.unique(np.concatenate(asked), return_inverse=True, return_counts=True)
        shared = counts[inverse] > 1
        bits = iter(np.split(shared, np.cumsum([len(a) for a in asked])[:-1]))
        out = [np.packbits(next(bits)).tobytes() if k == NAMES else p for p, k in zip(payloads, kinds)]
    return table.set_column(table.schema.get_field_index("payload"), "payload", pa.array(out, pa.binary()))


def exchange(sent: DataFrame) -> DataFrame:
    """Answers to all messages, one row per shard: notes come back as they were."""
    answers = sent.groupBy("part").applyInArrow(_answer, MESSAGE)
    # One entry per range and shard: bounded by the number of ranges.
    return answers.groupBy("shard").agg(F.sort_array(F.collect_list(F.struct("kind", "part", "payload"))).alias("answers"))


def with_answers(shards: DataFrame, answers: DataFrame) -> DataFrame:
    return shards.join(answers.hint("shuffle_hash"), "shard", "left")


def shared_names(names: np.ndarray, answers: list[dict] | None, parts: int) -> np.ndarray:
    """For sorted different names that were sent: held by another shard as well?"""
    bits = {a["part"]: a["payload"] for a in answers or () if a["kind"] == NAMES}
    bounds = np.searchsorted(names, np.arange(1, parts, dtype=np.uint64) << np.uint64(64 - parts.bit_length() + 1))
    return np.concatenate(
        [np.unpackbits(np.frombuffer(bits[i], dtype=np.uint8), count=len(x)).astype(bool) if len(x) else np.empty(0, dtype=bool)
         for i, x in enumerate(np.split(names, bounds))]
    )
