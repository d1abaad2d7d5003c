"""Substring dedup by recompression: every word of a repeated window of words is removed.

Runs and then pairs of symbols are named in rounds, as in recompression: a run takes its symbol
and length, and a pair is joined where the first symbol is of the left and the second of the
right class of that round. Names and classes are hashes of what a symbol stands for, so all
tasks name alike and equal substrings get equal symbols in their interior. With each symbol
goes the stretch of words that decided it: wherever those words occur, the symbol occurs.

A window's anchor is the symbol of the highest round whose deciding words lie inside the
window, the one with the smallest name if there are several. It depends on the words of the
window alone, so two equal windows have the same anchor, and a word is an anchor at worst:
nothing is missed. In a first exchange shards learn which anchors occur elsewhere; only the
windows of those are named themselves, and a second exchange verifies them whole.

Windows with equal 64-bit names are taken as equal: among n different windows some two clash
with a chance of about n^2 / 2^65.

Edge cases: null and empty texts have no words; a text of fewer words than a window keeps
all; repeated rows are copies of each other and lose all their windows; ties are symbols of
the same name, which stand for the same words; other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import shards, words
from digestloom.session import materialise

WINDOW = 35
PAIR_ROUNDS = 5
# The symbols of all rounds of a shard take some sixty times its bytes.
SHARD_BYTES = 2 << 20

_FAR = np.int64(1) << np.int64(60)
_PAIR = words.spread(2, seed=11) | np.uint64(1)
_RUN = words.spread(2, seed=12) | np.uint64(1)
_ROUND = words.spread(64, seed=13)


def levels(name: np.ndarray, text_of: np.ndarray, rounds: int = PAIR_ROUNDS):
    """Symbols after each round: names, and first and past-last word of what decided them.

    Symbols at the ends of a text were decided by the end, which another occurrence need not
    have; their stretch reaches far out, so that no window contains it.
    """
    n = len(name)
    left, right = np.arange(n, dtype=np.int64), np.arange(1, n + 1, dtype=np.int64)
    out = [(name, left, right)]
    if not n:
        return out
    # Runs.
    first = np.flatnonzero(np.concatenate(([True], (name[1:] != name[:-1]) | (text_of[1:] != text_of[:-1]))))
    length = np.diff(np.append(first, n))
    run = words.mix(name[first] * _RUN[0] + length.astype(np.uint64) * _RUN[1])
    name, text = np.where(length > 1, run, name[first]), text_of[first]
    same = text[1:] == text[:-1]
    before = np.concatenate(([-_FAR], np.where(same, first[1:] - 1, -_FAR)))
    after = np.concatenate((np.where(same, (first + length)[:-1] + 1, _FAR), [_FAR]))
    left, right = before, after
    out.append((name, left, right))
    for number in range(rounds):
        is_right = (words.mix(name ^ _ROUND[number]) & np.uint64(1)).astype(bool)
        same = text[1:] == text[:-1]
        joined = ~is_right[:-1] & is_right[1:] & same
        first = np.append(joined, False)
        second = np.concatenate(([False], joined))
        # A symbol that stays was decided by the neighbour it might have joined.
        near_left = np.concatenate(([-_FAR], np.where(same, left[:-1], -_FAR)))
        near_right = np.concatenate((np.where(same, right[1:], _FAR), [_FAR]))
        new_left = np.where(is_right & ~second, near_left, left)
        new_right = np.where(~is_right & ~first, near_right, right)
        new_right[:-1] = np.where(joined, right[1:], new_right[:-1])
        pair = name.copy()
        pair[:-1] = np.where(joined, words.mix(name[:-1] * _PAIR[0] + name[1:] * _PAIR[1]), name[:-1])
        kept = ~second
        name, text, left, right = pair[kept], text[kept], new_left[kept], new_right[kept]
        out.append((name, left, right))
    return out


def window_starts(first: np.ndarray, window: int) -> np.ndarray:
    """First word of every window of every text."""
    counts = np.maximum(np.diff(first) - window + 1, 0)
    return words.ragged(first[:-1], counts)


def anchors(found: words.Words, starts: np.ndarray, window: int, rounds: int = PAIR_ROUNDS):
    """Anchor of each window: its key and the place of the symbol."""
    key = np.zeros(len(starts), dtype=np.uint64)
    place = np.zeros(len(starts), dtype=np.int64)
    open_ = np.arange(len(starts))
    parsed = levels(found.name, found.text_of(), rounds)
    for level in range(len(parsed) - 1, -1, -1):
        if not len(open_):
            break
        name, left, right = parsed[level]
        fit = right - left <= window
        name, left, right = name[fit], left[fit], right[fit]
        at = starts[open_]
        low = np.searchsorted(left, at)
        high = np.searchsorted(right, at + window, side="right")
        some = high > low
        mine, low, high = open_[some], low[some], high[some]
        if not len(mine):
            continue
        value = words.mix(name + _ROUND[level])
        best, best_at = value[low], low.copy()
        for step in range(1, int((high - low).max())):
            live = np.flatnonzero(low + step < high)
            other = value[low[live] + step]
            less = other < best[live]
            best[live[less]] = other[less]
            best_at[live[less]] = low[live[less]] + step
        key[mine] = best
        place[mine] = left[best_at] * np.int64(len(parsed)) + level
        open_ = open_[~some]
    return key, place


def _different(key: np.ndarray, place: np.ndarray):
    """Sorted different keys, those met at several places, and the key number of each window."""
    if not len(key):
        return key, np.empty(0, dtype=bool), np.empty(0, dtype=np.int64)
    turn = np.concatenate(([True], (key[1:] != key[:-1]) | (place[1:] != place[:-1])))
    names, inverse, counts = np.unique(key[turn], return_inverse=True, return_counts=True)
    return names, counts > 1, inverse[np.cumsum(turn) - 1]


def _ask_anchors(text: str, window: int, parts: int):
    def run(batches):
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body")):
                found = words.split(shards.unpack(body.as_py()).column(text), words.SPACE_SEPARATED, False)
                names, _, _ = _different(*anchors(found, window_starts(found.first, window), window))
                yield shards.messages(shards.send(shard, names, parts))

    return run


def _ask_windows(text: str, window: int, asked: int, parts: int):
    def run(batches):
        for batch in batches:
            for shard, body, answers in zip(batch.column("shard").to_pylist(), batch.column("body"), batch.column("answers").to_pylist()):
                found = words.split(shards.unpack(body.as_py()).column(text), words.SPACE_SEPARATED, False)
                starts = window_starts(found.first, window)
                names, repeated, number = _different(*anchors(found, starts, window))
                shared = (repeated | shards.shared_names(names, answers, asked))[number]
                picked = starts[shared]
                out = shards.send(shard, np.unique(words.window_sums(found.name, picked, picked + window)), parts)
                out.append((shard, shard % parts, shards.NOTE, np.packbits(shared).tobytes()))
                yield shards.messages(out)

    return run


def _settle(text: str, id_col: str, window: int, parts: int, with_text: bool):
    def run(batches):
        for batch in batches:
            for body, answers in zip(batch.column("body"), batch.column("answers").to_pylist()):
                rows = shards.unpack(body.as_py())
                found = words.split(rows.column(text), words.SPACE_SEPARATED, False)
                starts = window_starts(found.first, window)
                note = next(a["payload"] for a in answers if a["kind"] == shards.NOTE)
                picked = starts[np.unpackbits(np.frombuffer(note, dtype=np.uint8), count=len(starts)).astype(bool)]
                name = words.window_sums(found.name, picked, picked + window)
                names, inverse, counts = np.unique(name, return_inverse=True, return_counts=True)
                repeated = ((counts > 1) | shards.shared_names(names, answers, parts))[inverse]
                delta = np.zeros(len(found.name) + 1, dtype=np.int64)
                np.add.at(delta, picked[repeated], 1)
                np.add.at(delta, picked[repeated] + window, -1)
                keep = np.cumsum(delta[:-1]) == 0
                raw = found.data.tobytes()
                start, end = found.start.tolist(), found.end.tolist()
                kept = []
                for i in range(rows.num_rows):
                    a, b = int(found.first[i]), int(found.first[i + 1])
                    kept.append(b" ".join([raw[start[j] : end[j]] for j in (np.flatnonzero(keep[a:b]) + a).tolist()]))
                removed = np.concatenate(([0], np.cumsum(~keep)))[found.first]
                columns = [
                    rows.column(id_col),
                    pa.array(np.diff(found.first), pa.int64()),
                    pa.array(np.diff(removed), pa.int64()),
                    pa.array([hashlib.sha256(k).hexdigest() for k in kept]),
                ]
                names = [id_col, "n_words", "n_removed", "kept_sha256"]
                if with_text:
                    columns.append(pa.array(kept, pa.binary()).cast(pa.string()))
                    names.append("kept_text")
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def remove_repeats(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, with_text: bool = True
) -> DataFrame:
    """One row per document: words, words removed, SHA-256 of the kept words and their text."""
    rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("_dl_text"))
    held = shards.gather(rows, "_dl_text", SHARD_BYTES)
    size = held.agg(F.sum("n_bytes")).first()[0] or 0
    # A word takes some six bytes; a tenth of the windows have an anchor of their own.
    few, many = shards.parts_for(size // 60), shards.parts_for(size // 12)
    known = shards.exchange(held.mapInArrow(_ask_anchors("_dl_text", window, few), shards.MESSAGE))
    asked = shards.with_answers(held.select("shard", "body"), known)
    verified = shards.exchange(asked.mapInArrow(_ask_windows("_dl_text", window, few, many), shards.MESSAGE))
    kind = rows.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, n_words long, n_removed long, kept_sha256 string" + (", kept_text string" if with_text else "")
    judged = shards.with_answers(held.select("shard", "body"), verified)
    return judged.mapInArrow(_settle("_dl_text", id_col, window, many, with_text), schema)
