"""Counts of 64-bit keys over a whole table: summed in each task, then per range of keys."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import words

PART_KEYS = 1 << 20
PENDING = 1 << 20


class KeyCounts:
    """Counts of the keys given so far; memory follows the different keys, not their number."""

    def __init__(self):
        self.keys, self.n = np.empty(0, dtype=np.uint64), np.empty(0, dtype=np.int64)
        self.new: list[tuple[np.ndarray, np.ndarray]] = []
        self.pending = 0

    def add(self, keys: np.ndarray, n: np.ndarray | None = None) -> None:
        """Count each key once, or ``n`` times; with ``n`` the keys differ."""
        if n is None:
            keys, n = np.unique(keys, return_counts=True)
        self.new.append((keys, n))
        self.pending += len(keys)
        if self.pending > PENDING:
            self._merge()

    def _merge(self) -> None:
        keys, n = (np.concatenate(x) for x in zip((self.keys, self.n), *self.new))
        self.new, self.pending = [], 0
        self.keys, inverse = np.unique(keys, return_inverse=True)
        self.n = np.bincount(inverse, weights=n, minlength=len(self.keys)).astype(np.int64)

    def result(self) -> tuple[np.ndarray, np.ndarray]:
        self._merge()
        return self.keys, self.n


def parts_for(keys: int) -> int:
    return 1 << max(6, math.ceil(math.log2(max(keys, 1) / PART_KEYS)))


def count_keys(rows: DataFrame, keys_of: Callable[[pa.RecordBatch], Iterator[np.ndarray]], parts: int, least: int = 1) -> DataFrame:
    """``key, n`` (long) of all keys that ``keys_of`` finds in the batches, from ``least`` on."""
    shift = np.uint64(64 - parts.bit_length() + 1)

    def tally(batches):
        found = KeyCounts()
        for batch in batches:
            for keys in keys_of(batch):
                found.add(keys)
        keys, n = found.result()
        part = (words.mix(keys) >> shift).astype(np.int64)
        order = np.argsort(part, kind="stable")
        keys, n, cut = keys[order], n[order], np.searchsorted(part[order], np.arange(parts + 1))
        sent = [(i, keys[a:b].tobytes() + n[a:b].tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
        yield pa.RecordBatch.from_arrays(
            [pa.array([i for i, _ in sent], pa.int32()), pa.array([p for _, p in sent], pa.binary())], names=["part", "payload"]
        )
        del found, keys, n, part, order, sent
        words.give_back()

    def total(table: pa.Table) -> pa.Table:
        keys, n = [], []
        for payload in table.column("payload").to_pylist():
            half = len(payload) // 16
            keys.append(np.frombuffer(payload, dtype=np.int64, count=half))
            n.append(np.frombuffer(payload, dtype=np.int64, offset=8 * half))
        keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        n = np.bincount(inverse, weights=np.concatenate(n)).astype(np.int64)
        kept = n >= least
        return pa.table({"key": keys[kept], "n": n[kept]})

    return rows.mapInArrow(tally, "part int, payload binary").groupBy("part").applyInArrow(total, "key long, n long")


def text_bytes(rows: DataFrame, column: str = "text") -> int:
    return rows.agg(F.sum(F.octet_length(column))).first()[0] or 0
