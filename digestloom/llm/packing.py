"""Best-fit packing of tokenised documents into fixed-length sequences, certified by bounds.

Tokenising writes one row per piece (a document, or a cut of a long one) to the shared folder.
Pieces are dealt at random to partitions of bounded size; each partition packs its pieces by
best-fit decreasing and certifies its bin count with the largest lower bound of a family of
dual feasible functions. Partitions above their bound give the pieces of their emptiest bins
back, a few for each bin of the gap; those are dealt anew, to fewer partitions, and packed
again. A certified partition gives back its emptiest bin only, for its bound rounds up.

Edge cases: a null or empty text is the end token alone; a text whose ids end exactly at a
piece boundary has a last piece with the end token alone; repeated documents are packed each;
an empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import functools
import itertools
import math
import os
import re
import zlib

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import words
from digestloom.session import materialise

CAPACITY = 4096
END = 1
# Pieces packed together in one task.
GROUP_PIECES = 400_000
ROUNDS = 3
# Bins given back for each bin above the bound.
EXCHANGED = 8
# Words whose ids a worker keeps; the table starts anew beyond.
# Words a worker keeps, some 150 bytes each, also from one task to the next.
CACHED_WORDS = 1_000_000

# Beyond these letters, changes of case or of form may make or join signs.
_LETTERS = "".join(c for c in map(chr, range(ord("ɐ"))) if c.isalpha() and c != "İ")
# On each line: letters and the signs behind them, or a word of another shape.
_SHAPES = re.compile(rf"^(?:([{_LETTERS}]+)([!-/:-@\[-`{{-~]*)|(.+))$", re.MULTILINE)


class CachedTokenizer:
    """Token ids of many texts; each white-space separated word is tokenised once.

    The tokenizer drops white space and never joins across it, so the ids of a text are those
    of its words. Letters and the signs behind them are tokenised apart, as its own pattern
    does; words of another shape, and texts with special tokens, are given to it as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        vocabulary = self.tokenizer.get_vocab()
        self.special = [t.content.lower().encode() for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.closes = np.zeros(max(vocabulary.values()) + 1, dtype=bool)
        self.closes[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        self.by_word = bool(self.closes.any())
        self.forget()

    def forget(self):
        self.slots = {}
        self.pool = [np.empty(0, dtype=np.uint32)]
        self.at = [np.empty(0, dtype=np.int64)]
        self.size = [np.empty(0, dtype=np.int64)]
        self.pooled = 0
        self.signs, self.sign_ids = {"": 0}, [np.empty(0, dtype=np.uint32)]

    def _direct(self, texts: list[str]) -> list[np.ndarray]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, dtype=np.uint32) for e in found]

    def _learn(self, spelt: bytes) -> tuple[np.ndarray, np.ndarray]:
        """Slots of new words, one on each line: their places in the order of the lines, and the slots."""
        found = _SHAPES.findall(spelt.decode("utf-8", "replace"))
        plain = [i for i, (stem, _, _) in enumerate(found) if stem]
        other = [i for i, (stem, _, _) in enumerate(found) if not stem]
        stems, signs = [found[i][0] for i in plain], [found[i][1] for i in plain]
        new = sorted({s for s in signs if s not in self.signs})
        self.signs.update(zip(new, range(len(self.signs), len(self.signs) + len(new))))
        self.sign_ids += self._direct(new)
        none = np.empty(0, dtype=np.uint32)
        joined = np.concatenate([none, *self._direct(["\n".join(stems[at : at + 100]) for at in range(0, len(stems), 100)])])
        ends = np.flatnonzero(self.closes[joined]) + 1
        assert len(ends) == len(plain), "a word of letters must be one unit"
        stem_size = np.diff(ends, prepend=0)
        held = np.array([len(x) for x in self.sign_ids], dtype=np.int64)
        sign = np.fromiter(map(self.signs.__getitem__, signs), dtype=np.int64, count=len(signs))
        size = stem_size + held[sign]
        at = np.cumsum(size) - size
        pool = np.empty(int(size.sum()), dtype=np.uint32)
        pool[words.ragged(at, stem_size)] = joined
        pool[words.ragged(at + stem_size, held[sign])] = np.concatenate(self.sign_ids)[words.ragged((np.cumsum(held) - held)[sign], held[sign])]
        whole = self._direct([found[i][2] for i in other])
        size = np.concatenate((size, np.array([len(x) for x in whole], dtype=np.int64)))
        first = sum(map(len, self.at))
        self.at.append(self.pooled + np.cumsum(size) - size)
        self.size.append(size)
        self.pool.append(np.concatenate([pool, *whole]))
        self.pooled += int(size.sum())
        for part in ("pool", "at", "size"):
            if len(getattr(self, part)) > 16:
                setattr(self, part, [np.concatenate(getattr(self, part))])
        return np.array(plain + other, dtype=np.int64), np.arange(first, first + len(size))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids of all texts, one after the other, and the offset of each text in them."""
        found = words.split(texts, words.SPACE_SEPARATED, True)
        raw = found.data.tobytes()
        if not self.by_word or any(s in raw for s in self.special):
            ids = self._direct([t or "" for t in texts.to_pylist()])
            return np.concatenate([np.empty(0, np.uint32), *ids]), np.concatenate(([0], np.cumsum([len(x) for x in ids]))).astype(np.int64)
        names, first, inverse = np.unique(found.name, return_index=True, return_inverse=True)
        listed = names.tolist()
        if len(self.slots) > CACHED_WORDS:
            self.forget()
        slot = np.fromiter(map(self.slots.get, listed, itertools.repeat(-1)), dtype=np.int64, count=len(listed))
        missing = np.flatnonzero(slot < 0)
        if len(missing):
            start, width = found.start[first[missing]], found.end[first[missing]] - found.start[first[missing]] + 1
            spelt = found.data[np.minimum(words.ragged(start, width), len(found.data) - 1)]
            spelt[np.cumsum(width) - 1] = 10
            place, slots = self._learn(spelt[:-1].tobytes())
            slot[missing[place]] = slots
            self.slots.update(zip(names[missing[place]].tolist(), slots.tolist()))
        pool, at, size = (np.concatenate(x) if len(x) > 1 else x[0] for x in (self.pool, self.at, self.size))
        slot = slot[inverse]
        sizes = size[slot]
        upto = np.concatenate(([0], np.cumsum(sizes)))
        return pool[words.ragged(at[slot], sizes)], upto[found.first]


@functools.cache
def tokenizer(path: str) -> CachedTokenizer:
    return CachedTokenizer(path)


def _pieces(path: str, capacity: int, end: int, keep_ids: bool):
    """Cut each text's ids, with the end token, into pieces."""
    last = np.array([end], dtype="<u4").tobytes()

    def run(batches):
        encoder = tokenizer(path)
        for batch in batches:
            for part in words.chunks(batch, "text", words.CHUNK_BYTES):
                ids, offsets = encoder.encode(part.column("text"))
                ids = ids.astype("<u4", copy=False)
                doc, piece, start, length, check, kept = [], [], [], [], [], []
                for i in range(part.num_rows):
                    a, b = int(offsets[i]), int(offsets[i + 1])
                    n = b - a + 1
                    for k in range(0, n, capacity):
                        cut = ids[a + k : min(a + k + capacity, b)].tobytes()
                        if k + capacity >= n:
                            cut += last
                        doc.append(i)
                        piece.append(k // capacity)
                        start.append(k)
                        length.append(len(cut) // 4)
                        check.append(zlib.crc32(cut))
                        if keep_ids:
                            kept.append(np.frombuffer(cut, dtype="<u4").astype(np.int64))
                names = ["doc_id", "piece", "start", "length", "ids_crc32"]
                columns = [
                    part.column("doc_id").take(pa.array(doc, pa.int64())),
                    pa.array(piece, pa.int32()),
                    *(pa.array(x, pa.int64()) for x in (start, length, check)),
                ]
                if keep_ids:
                    names.append("ids")
                    columns.append(pa.array(kept, pa.list_(pa.int64())))
                yield pa.RecordBatch.from_arrays(columns, names=names)

    return run


def pieces(
    documents: DataFrame,
    tokenizer_path: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    capacity: int = CAPACITY,
    end: int = END,
    keep_ids: bool = False,
) -> DataFrame:
    """Token pieces of each document: ids then the end token, cut to ``capacity``."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    kind = rows.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long"
    return rows.mapInArrow(_pieces(tokenizer_path, capacity, end, keep_ids), schema + (", ids array<long>" if keep_ids else ""))


def lower_bound(lengths: np.ndarray, capacity: int) -> int:
    """Bins that any packing needs: the best bound of a family of dual feasible functions.

    For a threshold t up to half the capacity, lengths above ``capacity - t`` count as whole
    bins, those below t as nothing, and the others as their share. With t = 0 this is the sum.
    """
    if not len(lengths):
        return 0
    counts = np.bincount(lengths, minlength=capacity + 1)
    sizes = np.arange(capacity + 1)
    number, total = np.cumsum(counts), np.cumsum(counts * sizes)
    t = np.arange(capacity // 2 + 1)
    whole = number[-1] - number[capacity - t]
    share = total[capacity - t] - np.where(t > 0, total[np.maximum(t - 1, 0)], 0)
    return int(np.max(whole + -(-share // capacity)))


def best_fit(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, list[int]]:
    """Best-fit decreasing: bin and offset of each piece, and the room left in each bin."""
    order = np.argsort(-lengths, kind="stable")
    bins = np.empty(len(lengths), dtype=np.int64)
    offsets = np.empty(len(lengths), dtype=np.int64)
    room: list[int] = []
    open_: list[list[int]] = [[] for _ in range(capacity + 1)]
    mask = 0  # bit r is set when a bin with room r is open
    for i, length in zip(order.tolist(), lengths[order].tolist()):
        fit = mask >> length
        if fit:
            r = length + (fit & -fit).bit_length() - 1
            bin_ = open_[r].pop()
            if not open_[r]:
                mask ^= 1 << r
        else:
            r, bin_ = capacity, len(room)
            room.append(capacity)
        bins[i], offsets[i] = bin_, capacity - r
        room[bin_] = left = r - length
        if left:
            open_[left].append(bin_)
            mask |= 1 << left
    return bins, offsets, room


_PACKED = "bin long, offset long, n_bins long, bound long, released boolean"


def _pack_group(capacity: int, last: bool):
    def run(group: pd.DataFrame) -> pd.DataFrame:
        group = group.sort_values(["length", "doc_id", "piece"], ascending=[False, True, True], kind="stable")
        lengths = group["length"].to_numpy()
        bins, offsets, room = best_fit(lengths, capacity)
        bound = lower_bound(lengths, capacity)
        # What a better mix may save: as many bins as the gap, and the one that rounding leaves.
        room = np.array(room, dtype=np.int64)
        partly = np.zeros(len(room), dtype=bool)
        partly[np.argsort(-room, kind="stable")[: 1 + EXCHANGED * (len(room) - bound)]] = True
        partly &= room > 0
        return group.assign(
            bin=bins, offset=offsets, n_bins=len(room), bound=bound,
            released=partly[bins] & (not last),
        )

    return run


def pack(items: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """Place pieces (``doc_id, piece, length``, any other columns) into sequences.

    Adds ``sequence_id`` and ``offset``, and of the partition that placed the piece
    ``n_bins`` and ``bound`` with ``pack_round``: the certificate of its last packing.
    """
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in items.schema.fields)
    full = F.col("length") >= capacity
    done = [
        items.filter(full).select(
            *items.columns,
            # No other sequence can hold such a piece; ids count down from -1.
            (-1 - F.monotonically_increasing_id()).alias("sequence_id"), F.lit(0).cast("long").alias("offset"),
            F.lit(1).cast("long").alias("n_bins"), F.lit(1).cast("long").alias("bound"), F.lit(-1).alias("pack_round"),
        )
    ]
    rest = items.filter(~full)
    for number in range(rounds + 1):
        n = rest.count()
        groups = max(1, math.ceil(n / group_pieces))
        last = number == rounds or groups == 1
        dealt = rest.withColumn("_group", F.pmod(F.xxhash64("doc_id", "piece", F.lit(number)), F.lit(groups)))
        placed = materialise(
            dealt.groupBy("_group").applyInPandas(_pack_group(capacity, last), f"{schema}, _group long, {_PACKED}"), "packed"
        )
        sequence = F.shiftleft(F.lit(number + 1).cast("long"), 56) + F.shiftleft(F.col("_group"), 32) + F.col("bin")
        done.append(
            placed.filter(~F.col("released")).select(
                *items.columns, sequence.alias("sequence_id"), "offset", "n_bins", "bound", F.lit(number).alias("pack_round")
            )
        )
        if last:
            break
        rest = placed.filter("released").select(*items.columns)
    result = done[0]
    for part in done[1:]:
        result = result.unionByName(part)
    return result


def best_fit_packing(documents: DataFrame, tokenizer_path: str, *, id_col: str = "doc_id", text_col: str = "text",
                     capacity: int = CAPACITY, end: int = END) -> DataFrame:
    """Tokenise and pack a table of documents; one row per piece."""
    items = materialise(
        pieces(documents, tokenizer_path, id_col=id_col, text_col=text_col, capacity=capacity, end=end), "pieces"
    )
    return pack(items, capacity=capacity).select(
        F.col("doc_id").alias(id_col), "piece", "start", "length", "ids_crc32", "sequence_id", "offset", "n_bins", "bound", "pack_round"
    )
