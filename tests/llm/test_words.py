"""Words as arrays against regular expressions."""

import random

import numpy as np
import pyarrow as pa
import pytest

from digestloom.llm import counts, packing, queries, words
from tests.llm import brute


def spelt(found, i):
    return [found.data[a:b].tobytes().decode() for a, b in zip(found.start[found.first[i] : found.first[i + 1]], found.end[found.first[i] : found.first[i + 1]])]


@pytest.mark.parametrize("chunk", [1 << 20, 64, 7])
@pytest.mark.parametrize("seed", [1, 2])
def test_words_equal_patterns(monkeypatch, chunk, seed):
    monkeypatch.setattr(words, "CHUNK_BYTES", chunk)
    rng = random.Random(seed)
    signs = "abZ09 \t\n\x0b\x0c\r\x1c\x85\xa0.-éÉ한🙂_@"
    texts = ["".join(rng.choice(signs) for _ in range(rng.choice([0, 1, 5, 40, 900]))) for _ in range(60)] + [None, "", " ", "x" * 500]
    column = pa.array(texts, pa.string())
    for pattern, table in ((brute.SPACED, words.SPACE_SEPARATED), (brute.ALNUM, words.ALPHANUMERIC)):
        found = words.split(column, table, True)
        for i, text in enumerate(texts):
            assert spelt(found, i) == brute.words(text, pattern=pattern)
        names = {}
        for i in range(len(texts)):
            for word, name in zip(spelt(found, i), found.name[found.first[i] : found.first[i + 1]].tolist()):
                assert names.setdefault(word, name) == name
        assert len(set(names.values())) == len(names)
    part = words.split(column.slice(3, 10), words.SPACE_SEPARATED, False)
    assert spelt(part, 0) == brute.words(texts[3], lower=False)


def test_batches_keep_rows():
    rng = random.Random(5)
    texts = ["t" * rng.choice([0, 3, 50, 400]) for _ in range(100)]
    batch = pa.RecordBatch.from_arrays([pa.array(range(100)), pa.array(texts)], names=["id", "text"])
    for size in (1, 60, 10_000):
        for cut in (words.chunks(batch, "text", size), words.gathered(iter([batch.slice(0, 37), batch.slice(37)]), "text", size)):
            assert [r["text"] for part in cut for r in part.to_pylist()] == texts


def test_windows_are_named_by_content():
    values = np.array([1, 2, 3, 1, 2, 3, 4], dtype=np.uint64)
    names = words.window_sums(values, np.array([0, 3, 4]), np.array([3, 6, 7]))
    assert names[0] == names[1] != names[2]
    assert list(words.shingles(values, 3)[[0, 3]] == words.shingles(values, 3)[[3, 4]]) == [True, False]
    assert len(words.shingles(values[:2], 3)) == 0


def test_new_words_take_few_calls_of_the_tokenizer(monkeypatch):
    encoder = packing.CachedTokenizer(queries.tokenizer_path())
    letters = "abcdefghij"
    texts = [" ".join(f"{a}{b}{c}{sign}" for c in letters) for a in letters for b in letters for sign in ("", ",", "!)")]
    texts += ["don't x² Été, 日本 a_b", None, "", " ... İx "]
    calls, direct = [], encoder._direct
    monkeypatch.setattr(encoder, "_direct", lambda x: calls.append(x) or direct(x))
    ids, offsets = encoder.encode(pa.array(texts))
    # Signs, words of letters and others: one call each, and not one for each hundred words.
    assert len(calls) == 3
    for i, plain in enumerate(direct([t or "" for t in texts])):
        assert ids[offsets[i] : offsets[i + 1]].tolist() == plain.tolist()


def test_counts_of_keys_are_summed_over_batches(monkeypatch):
    monkeypatch.setattr(counts, "PENDING", 3)
    found = counts.KeyCounts()
    for keys, n in (([5, 7], [2, 3]), ([7, 9, 7], None), ([5], [10]), ([], None)):
        found.add(np.array(keys, dtype=np.uint64), None if n is None else np.array(n))
    keys, n = found.result()
    assert dict(zip(keys.tolist(), n.tolist())) == {5: 12, 7: 5, 9: 1}
