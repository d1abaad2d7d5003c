"""Jaccard join, substring dedup, decontamination and line dedup against plain Python."""

import random

import numpy as np
import pyarrow as pa
import pytest

from digestloom.llm import decontaminate, jaccard_join, line_dedup, queries, recompression
from tests.llm import brute

DOCS = "doc_id long, text string, lang string, node long, n_words long, score double, part int"


@pytest.fixture(scope="module")
def spark(spark):
    queries.ship(spark)
    return spark


def frame(spark, docs):
    """Documents with extra columns whose names the operators use inside."""
    return spark.createDataFrame([(d, t, "en", 1, 2, 0.5, 3) for d, t in docs], DOCS)


def corpus(seed, n=60, vocabulary=400):
    """Texts with copies, edited copies, shared passages and lines, and runs of one word."""
    rng = random.Random(seed)
    words = [f"W{i}é" if i % 7 == 0 else f"w{i}" for i in range(vocabulary)]
    make = lambda k: [rng.choice(words) for _ in range(k)]
    passage, line = make(50), make(9)
    docs = []
    for i in range(n):
        kind = rng.random()
        if docs and kind < 0.2:
            text = rng.choice(docs)[1] or ""
        elif docs and kind < 0.5:
            w = (rng.choice(docs)[1] or "").split(" ")
            for _ in range(rng.randint(0, 1 + len(w) // 40)):
                w[rng.randrange(len(w))] = rng.choice(words)
            text = " ".join(w)
        else:
            w = make(rng.choice([1, 3, 4, 5, 6, 9, 30, 60, 120]))
            if rng.random() < 0.4:
                at = rng.randint(0, len(w))
                w[at:at] = passage
            if rng.random() < 0.2:
                w += ["ha"] * rng.randint(30, 90)
            for _ in range(len(w) // 15):
                w.insert(rng.randint(0, len(w)), "\n")
            text = " ".join(w)
            if rng.random() < 0.3:
                text += "\n" + " ".join(line)
        docs.append((i, text))
    return docs


EDGES = [
    (100, None), (101, ""), (102, " \t\n "), (103, "one"), (104, "one two three four five"), (105, "ONE two three four five"),
    (None, "lost a b c d e f g h i"), (None, None), (106, "lost a b c d e f g h i"), (106, "lost a b c d e f g h i"),
    (107, " nb   wide\x00zero"), (108, "x" * 300_000 + " " + "y " * 400_000),
]


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


@pytest.mark.parametrize("seed", [1, 2])
def test_jaccard_join(spark, seed):
    docs = corpus(seed) + EDGES
    found = rows(jaccard_join.near_duplicates(frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(docs), key=repr)


def test_jaccard_join_of_long_lists(spark, monkeypatch):
    """Every list is long, so all pairs beyond neighbours come from the second look."""
    monkeypatch.setattr(jaccard_join, "PAIRED_LIST", 2)
    docs = corpus(3, n=80, vocabulary=40)
    found = rows(jaccard_join.near_duplicates(frame(spark, docs)), "doc_id", "n_shingles", "component_id")
    assert found == sorted(brute.components(docs), key=repr)


def test_lists_of_nodes_are_not_sent_to_the_driver(spark, monkeypatch):
    """Spark sizes arrays too low: neither the lists of a node nor rows that hold them are broadcast."""
    rng = random.Random(4)
    nodes = [(i, 40 + i % 3, i % 5) for i in range(30)]
    held = {(k, i): rng.choice([-1, k % 4]) for i, _, _ in nodes for k in rng.sample(range(25), 12)}
    join = object.__new__(jaccard_join._Join)
    join.spark, join.percent, join.bound = spark, 80, 10
    join.nodes = spark.createDataFrame([(i, n, bytes([i] * 8)) for i, n, _ in nodes], "node long, n long, cells binary")
    found = [(2, i, None, k, nodes[i][1], at) for (k, i), at in held.items()] + [(0, 1, 2, None, None, None)]
    join.found = spark.createDataFrame(found, "kind int, a long, b long, key long, n long, place long")
    known = spark.createDataFrame([(i, c) for i, _, c in nodes if c], "node long, component long")
    met = []

    def seen(percent, bound, best):
        def run(table):
            of = table.to_pylist()
            met = [(r["a"], hash((r["key"], r["n"], r["place"], r["component"], r["cells"][0], *sorted(r["earlier"])))) for r in of]
            return pa.table({"a": pa.array([x for x, _ in met], pa.int64()), "b": pa.array([y for _, y in met], pa.int64())})

        return run

    monkeypatch.setattr(jaccard_join, "_crossing", seen)
    pairs = join._pairs_of_long_lists(known, 0)
    assert "BroadcastExchange" not in pairs._jdf.queryExecution().executedPlan().toString()
    component = {i: c or i for i, _, c in nodes}
    mixed = {k for k in range(25) if len({component[i] for x, i in held if x == k}) > 1}
    for (k, i), at in held.items():
        if k in mixed:
            before = sorted(x for (x, j), place in held.items() if j == i and x in mixed and (place, x) < (at, k))
            met.append((i, hash((k, nodes[i][1], at, component[i], i, *before))))
    assert sorted(map(tuple, pairs.collect())) == sorted(met) and len(met) > 300


def test_prefixes_meet():
    """Sets at the threshold share a key, whether enumerated or scanned."""
    assert [jaccard_join.prefix_length(n, 80) for n in (1, 4, 5, 9, 10, 300)] == [1, 1, 2, 2, 3, 61]
    assert jaccard_join.boundary(100, 0, 80) <= jaccard_join.boundary(100, 200, 80)


@pytest.mark.parametrize("seed", [4, 5])
def test_substring_dedup(spark, seed):
    docs = corpus(seed) + EDGES
    found = rows(recompression.remove_repeats(frame(spark, docs)), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.without_repeats(docs), key=repr)


def test_substring_dedup_short_windows(spark):
    docs = corpus(6, vocabulary=30)
    found = rows(recompression.remove_repeats(frame(spark, docs), window=4), "doc_id", "n_words", "n_removed", "kept_sha256")
    assert found == sorted(brute.without_repeats(docs, window=4), key=repr)


ITEMS = "item_id long, text string, node long"


@pytest.mark.parametrize("block_bytes", [1 << 20, 300])
def test_contamination(spark, block_bytes):
    docs = corpus(7, vocabulary=60) + EDGES
    rng = random.Random(8)
    items = [(None, None), (1, ""), (2, "one two"), (3, "y y y y y y y y y y y y")]
    for i in range(12):
        w = brute.words(docs[rng.randrange(60)][1], pattern=brute.ALNUM)
        at = rng.randint(0, max(len(w) - 5, 0))
        items.append((rng.choice([10, 11, 12, 13]), " ".join(w[at : at + rng.randint(1, 25)])))
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], ITEMS)
    df = frame(spark, docs)
    found = rows(
        decontaminate.contamination(df, bench, block_bytes=block_bytes), "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"
    )
    expected = brute.contamination(docs[:-1], items)
    long_row = [r for r in found if r[0] == 108]
    assert [r for r in found if r[0] != 108] == sorted(expected, key=repr)
    assert long_row == [(108, 400_001, 400_000, 1, brute.sha("3"), True)]
    clean = rows(decontaminate.decontaminate(df, bench, block_bytes=block_bytes), "doc_id")
    assert clean == sorted(((r[0],) for r in found if not r[5]), key=repr)


def test_longest_matches(spark):
    docs = frame(spark, [(1, "z a b c d e f g h i j k q"), (2, "nothing here")])
    bench = spark.createDataFrame([(5, "p a b c d e f g h i j k r", 0)], ITEMS)
    assert rows(decontaminate.longest_matches(docs, bench), "doc_id", "item_id", "doc_word", "item_word", "n_words") == [(1, "5", 1, 1, 11)]


@pytest.mark.parametrize(("paired", "whole", "few"), [(8, 8, 8), (2, 2, 8), (2, 512, 8), (2, 12, 1), (2, 512, 0)])
def test_line_dedup(spark, monkeypatch, paired, whole, few):
    for name, value in (("PAIRED_LIST", paired), ("WHOLE_LIST", whole), ("FEW", few)):
        monkeypatch.setattr(line_dedup, name, value)
    docs = corpus(9, n=50, vocabulary=80) + EDGES[:-1]
    kept, removed = brute.kept_lines(docs)
    found = rows(line_dedup.remove_repeated_lines(frame(spark, docs)), "doc_id", "text", "_dl_removed")
    expected = [(d, None if t is None else k, r) for (d, t), k, r in zip(docs, kept, removed)]
    assert found == sorted(expected, key=repr)


def test_digests_end_in_one_python_step(spark):
    docs = frame(spark, [(1, "a b c d\nx y z"), (2, "x y z\n\na b c e"), (3, None), (4, "a b c d\n\xfc")])
    found = line_dedup.digests(docs)
    # A second one behind it would hold as many workers again.
    assert found._jdf.queryExecution().optimizedPlan().toString().count("MapInArrow") == 1
    kept = [(1, "a b c d\nx y z", 0), (2, "\na b c e", 1), (3, "", 0), (4, "\xfc", 1)]
    assert rows(found, "doc_id", "kept_sha256", "n_removed") == [(d, brute.sha(t), n) for d, t, n in kept]
    longer = line_dedup.remove_repeated_lines(docs, least_words=4)
    assert rows(longer, "doc_id", "_dl_removed") == [(1, 0), (2, 0), (3, 0), (4, 1)]


def test_pairs_and_bitsets_of_lists():
    a, b = np.array([5, 2, 2, -1, 5]), np.array([2, 5, 2, 7, 2])
    assert jaccard_join.different_pairs(a, b).tolist() == [[-1, 2, 2], [7, 2, 5]]
    assert jaccard_join.different_pairs(a[:0], b[:0]).shape == (2, 0)
    # The lists stay Arrow arrays: no Python object for each key.
    lists = pa.chunked_array([[[0]], [[-9, 70], [], [70]]]).combine_chunks().slice(1)
    bits = jaccard_join._bitsets(lists)
    assert [[bool(x & y) for y in bits[:, 0].tolist()] for x in bits[:, 0].tolist()] == [[True, False, True], [False, False, False], [True, False, True]]


def test_empty_tables(spark):
    docs, bench = frame(spark, []), spark.createDataFrame([], ITEMS)
    assert jaccard_join.near_duplicates(docs).count() == 0
    assert recompression.remove_repeats(docs).count() == 0
    assert line_dedup.digests(docs).count() == 0
    assert decontaminate.contamination(docs, bench).count() == 0
    some = frame(spark, [(1, "a b"), (2, None)])
    assert rows(decontaminate.contamination(some, bench), "doc_id", "n_hit") == [(1, 0), (2, 0)]
    assert decontaminate.decontaminate(some, bench).columns == some.columns


def test_components_without_gathering(spark, monkeypatch):
    """Beyond the bound of a task the edges are contracted in rounds."""
    from digestloom.llm import components

    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(60)] + [(rng.randrange(100, 160), rng.randrange(100, 160)) for _ in range(45)] + [(200, -5), (7, 7)]
    df = spark.createDataFrame(edges, "a long, b long")
    one = rows(components.components(df), "node", "component")
    monkeypatch.setattr(components, "FOREST_EDGES", 10)
    assert rows(components.components(df), "node", "component") == one
    assert dict(one)[60] == 0 and dict(one)[200] == -5
    assert components.components(df.limit(0)).count() == 0


def test_the_join_removes_what_it_is_done_with(spark, monkeypatch):
    import os

    from digestloom.llm import jaccard_join

    written, write = [], jaccard_join.materialise
    monkeypatch.setattr(jaccard_join, "materialise", lambda df, name: written.append((name, write(df, name))) or written[-1][1])
    text = "one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen"
    docs = spark.createDataFrame([(1, f"{text} x"), (2, f"{text} y"), (3, "else")], "doc_id long, text string")
    found = {r["doc_id"]: r["component_id"] for r in jaccard_join.near_duplicates(docs).collect()}
    assert found == {1: 1, 2: 1, 3: 3}
    left = [name for name, df in written if name in ("prefixes", "wanted", "sets", "spanning") and os.path.exists(df.scratch_path)]
    assert {"prefixes", "wanted", "sets"} <= {name for name, _ in written} and not left
