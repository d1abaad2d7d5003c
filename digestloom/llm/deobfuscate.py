"""Noisy-channel restoration of disguised words: a character model and a Viterbi decoder.

The model counts 4-grams of UTF-8 bytes in the plain words of a corpus. The decoder reads a
token as a lattice: a letter stands for itself or repeats the one before, a digit or sign
stands for a letter it resembles or for nothing, and between the letters of a spaced-out run a
new word may begin. The path with the best product of channel and model wins.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import counts, words

# Letters that signs are used for.
LOOKALIKES = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "gb", "7": "t", "8": "b", "9": "g",
    "@": "a", "$": "s", "!": "i", "|": "il", "+": "t", "(": "c", "<": "c", "€": "e", "£": "l", "¡": "i",
}
LETTER = np.zeros(256, dtype=bool)
LETTER[list(range(97, 123)) + list(range(128, 256))] = True

ORDER = 4
# Probabilities that a worker keeps.
MAX_KNOWN = 100_000

# Natural logs of what the channel does: swap a letter for a sign, add a sign, stretch a letter to
# three or more, type one twice, add a space.
_SWAP, _DROP, _STRETCH, _TWICE, _BREAK = -1.0, -1.5, -0.3, -8.0, -0.5


def lowered(data: np.ndarray) -> np.ndarray:
    """Lower case of two-byte Latin letters; ASCII is lower case already."""
    out = data.copy()
    if len(data) > 1:
        upper = (data[:-1] == 0xC3) & (data[1:] >= 0x80) & (data[1:] <= 0x9E) & (data[1:] != 0x97)
        out[1:][upper] += 32
    return out


class Tokens:
    """White-space separated tokens of some texts, with the letters at their core.

    ``name`` is that of the core: the token without the signs around it.
    """

    def __init__(self, texts: pa.Array):
        found = words.split(texts, words.SPACE_SEPARATED, True, names=False)
        self.first, self.start, self.end = found.first, found.start, found.end
        self.data = lowered(found.data)
        n = len(self.data)
        letter = LETTER[self.data]
        place = np.flatnonzero(letter)
        low, high = np.searchsorted(place, self.start), np.searchsorted(place, self.end)
        self.some = high > low
        last = max(len(place) - 1, 0)
        padded = place if len(place) else np.zeros(1, dtype=np.int64)
        self.core = np.where(self.some, padded[np.minimum(low, last)], self.start)
        self.core_end = np.where(self.some, padded[np.maximum(np.minimum(high - 1, last), 0)] + 1, self.start)
        self.plain = self.some & (high - low == self.core_end - self.core)
        self.name = words.window_sums(words._BYTES[self.data], self.core, self.core_end, words._BASE)
        # Tokens to decode: signs between letters, look-alikes at the edge, letters in threes, most letters doubled.
        thrice = np.zeros(n + 1, dtype=np.int64)
        if n > 2:
            same = letter[2:] & (self.data[2:] == self.data[1:-1]) & (self.data[1:-1] == self.data[:-2]) & (self.data[2:] < 128)
            thrice[3:] = np.cumsum(same)
        size = self.core_end - self.core
        repeats = self.plain & (size > 2) & (thrice[self.core_end] - thrice[np.minimum(self.core + 2, n)] > 0)
        twice = np.zeros(n + 1, dtype=np.int64)
        if n > 1:
            twice[2:] = np.cumsum(letter[1:] & (self.data[1:] == self.data[:-1]) & (self.data[1:] < 128))
        doubled = twice[self.core_end] - twice[np.minimum(self.core + 1, n)]
        repeats |= self.plain & (size > 3) & (2 * doubled >= size - 1)
        before = self.data[np.maximum(self.core - 1, 0)]
        before2 = self.data[np.maximum(self.core - 2, 0)]
        led = self.some & (self.core > self.start) & _EDGE[before] & ~((self.core - 1 > self.start) & (before == before2))
        after = self.data[np.minimum(self.core_end, max(n - 1, 0))] if n else before
        after2 = self.data[np.minimum(self.core_end + 1, max(n - 1, 0))] if n else before
        trailed = self.some & (self.core_end < self.end) & _TAIL[after] & ~((self.core_end + 1 < self.end) & (after == after2))
        self.odd = repeats | (self.some & ~self.plain) | led | trailed

    def text(self, i: int) -> str:
        return self.data[self.start[i] : self.end[i]].tobytes().decode("utf-8", "replace")

    def spaced_runs(self) -> list[tuple[int, int]]:
        """First and past-last token of runs of at least three single letters in one text."""
        size = self.core_end - self.core
        lead = self.data[np.minimum(self.core, max(len(self.data) - 1, 0))] if len(self.data) else size
        whole = self.end - self.start
        single = ((size == 1) & self.some | (size == 2) & (lead >= 0xC2) & (lead < 0xE0)) & (whole == size)
        alone = np.zeros(len(size), dtype=bool)
        at = np.flatnonzero((whole == 1) & ~self.some)
        alone[at] = _EDGE[self.data[self.start[at]]]
        single |= alone
        text_of = np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))
        begins = single.copy()
        begins[1:] &= ~single[:-1] | (text_of[1:] != text_of[:-1])
        ends = single.copy()
        ends[:-1] &= ~single[1:] | (text_of[1:] != text_of[:-1])
        a, b = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        long_ = b - a >= 3
        return list(zip(a[long_].tolist(), b[long_].tolist()))


_EDGE = np.zeros(256, dtype=bool)
_EDGE[[ord(c) for c in LOOKALIKES if ord(c) < 128]] = True
# Behind a word, an exclamation mark or a bracket is what it seems.
_TAIL = _EDGE.copy()
_TAIL[[ord(c) for c in "!|(<"]] = False


def _grams(batches):
    """Counts of byte 4-grams of the plain words of a task; a word begins and ends with 0."""
    total = counts.KeyCounts()
    for batch in words.gathered(batches, "text", words.CHUNK_BYTES):
        tokens = Tokens(batch.column("text"))
        plain = np.flatnonzero(tokens.plain & ~tokens.odd)
        _, first, often = np.unique(tokens.name[plain], return_index=True, return_counts=True)
        picked = plain[first]
        size = tokens.core_end[picked] - tokens.core[picked]
        # Each word with one 0 behind it and three before it.
        width = size + 4
        at = np.cumsum(width) - width
        seq = np.zeros(int(width.sum()), dtype=np.uint32)
        seq[words.ragged(at + 3, size)] = tokens.data[words.ragged(tokens.core[picked], size)]
        ends = words.ragged(at + 3, size + 1)
        gram = (seq[ends - 3] << 24) | (seq[ends - 2] << 16) | (seq[ends - 1] << 8) | seq[ends]
        keys, inverse = np.unique(gram, return_inverse=True)
        total.add(keys.astype(np.uint64), np.bincount(inverse, weights=np.repeat(often, size + 1)).astype(np.int64))
    keys, n = total.result()
    yield pa.RecordBatch.from_arrays([pa.array(keys.astype(np.int64)), pa.array(n)], names=["gram", "n"])


def character_counts(documents: DataFrame) -> DataFrame:
    """``gram, n`` over all texts (column ``text``)."""
    return documents.select("text").mapInArrow(_grams, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _place(keys: np.ndarray, key: int) -> int | None:
    """Where a key is among sorted ones."""
    at = int(keys.searchsorted(np.uint32(key)))
    return at if at < len(keys) and keys[at] == key else None


class Model:
    """Interpolated byte 4-gram model (Witten-Bell) over plain words.

    Every gram counts. Sorted arrays take some 50 bytes for each different 4-gram, whose number
    follows the letters and scripts of a corpus and not its size.
    """

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        self.levels: list[tuple[np.ndarray, ...]] = []
        for order in range(1, ORDER + 1):
            keep = np.uint64((1 << (8 * order)) - 1)
            keys, inverse = np.unique(grams.astype(np.uint64) & keep, return_inverse=True)
            n = np.bincount(inverse, weights=counts) if len(keys) else np.empty(0)
            contexts, inverse = np.unique(keys >> np.uint64(8), return_inverse=True)
            total = np.bincount(inverse, weights=n) if len(keys) else np.empty(0)
            kinds = np.bincount(inverse) if len(keys) else np.empty(0)
            self.levels.append((keys.astype(np.uint32), n, contexts.astype(np.uint32), total, kinds))
        self.known: dict[int, float] = {}

    def log(self, context: int, byte: int) -> float:
        """Natural log of the probability of a byte behind three bytes."""
        key = (context << 8 | byte) & 0xFFFFFFFF
        found = self.known.get(key)
        if found is None:
            p = 1 / 256
            for order, (grams, n, contexts, totals, kinds) in enumerate(self.levels, 1):
                tail = key & ((1 << (8 * order)) - 1)
                at = _place(contexts, tail >> 8)
                if at is None:
                    # A longer context holds this one.
                    break
                held, k = _place(grams, tail), int(kinds[at])
                p = ((0 if held is None else float(n[held])) + k * p) / (float(totals[at]) + k)
            if len(self.known) > MAX_KNOWN:
                self.known.clear()
            found = self.known[key] = math.log(p)
        return found

    def word(self, context: int, letters: bytes) -> tuple[float, int]:
        score = 0.0
        for b in letters:
            score += self.log(context, b)
            context = (context << 8 | b) & 0xFFFFFF
        return score, context


def restore(token: str, model: Model, spaced: bool = False) -> list[str]:
    """Words of the best reading of a token, or of a spaced-out run of letters.

    The best partial reading of every pair of a model context and a last letter is kept, which is
    all that decides how a reading goes on; so the result is the best of all readings.
    """
    # context, last letter -> score, reading as a linked list
    states: dict[tuple[int, str], tuple[float, tuple | None]] = {(0, ""): (0.0, None)}
    for at, c in enumerate(token):
        near = token[max(at - 2, 0) : at + 3]
        repeat = _STRETCH if c * 3 in near else _TWICE
        choices: list[tuple[str, float]] = []
        if c.isalpha() and c not in LOOKALIKES:
            choices.append((c, 0.0))
        else:
            choices += [(x, _SWAP) for x in LOOKALIKES.get(c, "")]
            choices.append(("", _DROP))
        grown: dict[tuple[int, str], tuple[float, tuple | None]] = {}

        def offer(state, score, reading):
            held = grown.get(state)
            if held is None or score > held[0]:
                grown[state] = (score, reading)

        for (context, last), (score, reading) in states.items():
            for letter, cost in choices:
                if not letter:
                    offer((context, last), score + cost, reading)
                    continue
                gain, onward = model.word(context, letter.encode())
                offer((onward, letter), score + cost + gain, (letter, reading))
                if letter == last:
                    offer((context, last), score + cost + repeat, reading)
                if spaced and reading is not None:
                    end = model.log(context, 0)
                    gain, onward = model.word(0, letter.encode())
                    offer((onward, letter), score + cost + _BREAK + end + gain, (letter, (" ", reading)))
        states = grown
    best = max(states.items(), key=lambda x: x[1][0] + model.log(x[0][0], 0))
    out, reading = [], best[1][1]
    while reading is not None:
        out.append(reading[0])
        reading = reading[1]
    return "".join(reversed(out)).split()
