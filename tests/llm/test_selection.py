"""Mixing, hard negatives and the filter audit against plain Python, and their edge cases."""

import itertools
import math
import random

import pytest
from pyspark.sql import functions as F

from digestloom.llm import filter_audit, hard_negatives, mixing, plain_words
from digestloom.llm.queries import QUERIES, table
from tests.llm import brute

SF = "/root/testdata/sf0.01"


def by_source(rows, docs):
    source = {d["doc_id"]: d["source"] for d in docs}
    out = {}
    for r in rows:
        out.setdefault(source[r["doc_id"]], []).append(r)
    return out


def water_level(sizes, weights, share, most):
    """Targets by plain rounds: what is above a cap is shared again by weight."""
    target, capped, left = {}, set(), share * sum(sizes.values())
    while True:
        open_ = {s: weights[s] for s in sizes if s not in capped}
        if not open_:
            break
        target |= {s: left * w / sum(open_.values()) for s, w in open_.items()}
        above = {s for s in open_ if target[s] > most * sizes[s]}
        if not above:
            break
        target |= {s: most * sizes[s] for s in above}
        capped |= above
        left = share * sum(sizes.values()) - sum(target[s] for s in capped)
    return target


def test_mix_meets_its_targets(spark):
    docs = table(spark, SF, "documents").select("doc_id", "source", "text").collect()
    rows = QUERIES["op11_source_mixing"](spark, SF).collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(d["doc_id"] for d in docs)
    words = {d["doc_id"]: len(brute.words(d["text"])) for d in docs}
    groups = by_source(rows, docs)
    sizes = {s: sum(words[r["doc_id"]] for r in group) for s, group in groups.items()}
    weights = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sorted(sizes))}
    targets = water_level(sizes, weights, 1.5, 2)
    assert abs(sum(targets.values()) - 1.5 * sum(sizes.values())) < 1e-3
    for source, group in groups.items():
        assert {r["source_size"] for r in group} == {sizes[source]}
        assert all(math.isclose(r["target"], targets[source]) for r in group)
        assert all(r["size"] == words[r["doc_id"]] and r["taken"] % max(r["size"], 1) == 0 and r["taken"] <= 2 * r["size"] for r in group)
        # The document that crosses the budget ends nearer to it than without it.
        assert 2 * abs(sum(r["taken"] for r in group) - targets[source]) <= max(r["size"] for r in group)
        epochs = targets[source] // sizes[source]
        assert all(r["taken"] >= epochs * r["size"] for r in group)
    again = QUERIES["op11_source_mixing"](spark, SF).collect()
    assert sorted(map(tuple, rows)) == sorted(map(tuple, again))


def test_better_documents_are_drawn_more_often(spark):
    rows = [(i, "s", "w " * 10, 4.0 if i % 2 else 1.0) for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string, q double")
    taken = mixing.mix(docs, quality=F.col("q"), share=0.25, max_epochs=1).collect()
    good = sum(r["copies"] for r in taken if r["doc_id"] % 2)
    bad = sum(r["copies"] for r in taken if r["doc_id"] % 2 == 0)
    # With t the key that is reached: 1 - exp(-4t) and 1 - exp(-t) add up to a half, t = 0.111.
    assert good + bad == 1000 and abs(good - 718) < 60
    plan = mixing.mix(docs.limit(30).withColumn("_mix_id", F.lit(7)), share=1.5)
    mixed = mixing.repeated(docs.withColumn("copies", F.lit("own")), plan)
    assert mixed.columns == [*docs.columns, "copies"] and mixed.count() == 45


def test_mix_edges(spark):
    schema = "doc_id long, source string, text string, size string, target string, key string, tie string"
    rows = [(1, None, "a b c"), (1, None, "a b c"), (None, "x", None), (None, "x", ""), (2, "x", "a " * 50), (3, "", "x y z\x0b"), (4, "é", " "), (None, "x", "a b"), (None, "x", "a b")]
    docs = spark.createDataFrame([(*r, "", "", "", "") for r in rows], schema)
    out = mixing.mix(docs).collect()
    assert sorted(r["size"] for r in out) == sorted(len(brute.words(t)) for _, _, t in rows)
    # By code point "" comes before "x" and "é", null last: weights 3, 1, 2 and 3 again.
    sizes, weights = {"": 2, "x": 54, "é": 0, None: 6}, {"": 3, "x": 1, "é": 2, None: 3}
    targets = water_level(sizes, weights, 1.5, 2)
    assert {(r["source_size"], round(r["target"], 6)) for r in out} == {(sizes[s], round(targets[s], 6)) for s in sizes}
    assert mixing.mix(docs.limit(0)).count() == 0
    assert {r["taken"] for r in mixing.mix(docs.filter("source = 'é'")).collect()} == {0}


@pytest.mark.parametrize("text", ["", "one", " a  b\tc\n", "x" * 50 + " y", "a b " * 40, "é ü　z"])
def test_pieces_hold_the_same_words(text):
    data, words = text.encode(), brute.words(text, lower=False)
    assert plain_words.n_words(data) == len(words)
    assert [w for p in plain_words.pieces(data, 7) for w in p.split()] == [w.encode() for w in words]
    assert plain_words.words_and_distinct(data) == (len(words), len(set(words)))


def brute_negatives(rows, anchors, positives=5, negatives=10):
    kept = {}
    for i, label, v in sorted(((i, x, v) for i, x, v in rows if None not in (i, x, v) and all(y is not None and math.isfinite(y) for y in v)), key=lambda r: (r[0], r[1], [math.floor(256 * y) for y in r[2]])):
        kept.setdefault(i, (label, [math.floor(256 * y) for y in v]))
    out = []
    for a in (x for x in anchors if x in kept):
        label, v = kept[a]
        scores = sorted((-sum(x * y for x, y in zip(v, w)), i, x == label) for i, (x, w) in kept.items() if i != a)
        for score, p, _ in [s for s in scores if s[2]][:positives]:
            band = [(n, -s) for s, n, same in scores if not same and 30 * -score <= 100 * -s <= 90 * -score]
            out += [(a, p, rank, n, -score, s) for rank, (n, s) in enumerate(band[:negatives], 1)]
    return sorted(out)


COLUMNS = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def found(df):
    return sorted(tuple(r[c] for c in COLUMNS) for r in df.collect())


@pytest.mark.parametrize("dimension, shard, block", [(16, 30, 3), (7, 1000, 4096), (1, 64, 4096)])
def test_negatives_equal_brute_force(spark, dimension, shard, block):
    rnd = random.Random(dimension)
    centres = [[rnd.gauss(0, 1) for _ in range(dimension)] for _ in range(4)]
    rows = [(i, rnd.randrange(3), [x + rnd.gauss(0, 0.3) for x in centres[i % 4]]) for i in range(200)]
    rows += [(1000 + i, i % 3, rows[0][2]) for i in range(40)]  # ties
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").repartition(5)
    got = hard_negatives.mine(df, df.filter("vec_id % 20 = 0"), shard_vectors=shard, block_anchors=block)
    assert found(got) == brute_negatives(rows, [i for i, *_ in rows if i % 20 == 0])


def test_negatives_edges(spark):
    inf, nan = float("inf"), float("nan")
    rows = [
        (0, 1, [1.0, 1.0]), (1, 1, [1.0, 0.9]), (2, 1, None), (3, None, [1.0, 1.0]), (None, 1, [1.0, 1.0]), (4, 2, [inf, 1.0]), (5, 2, [nan, 0.0]),
        (6, 2, [None, 1.0]), (7, 2, [0.9]), (8, 2, []), (9, 2, [0.5, 0.5]), (9, 2, [0.5, 0.5]), (10, 2, [0.4, 0.6]), (11, 2, [0.4, 0.6]), (12, 1, [-1.0, -1.0]), (13, 3, [1e30, 0.0]),
    ]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>").withColumns({"id": F.lit("x"), "v": F.lit(1), "rank": F.lit(2)})
    anchors = df.filter("vec_id in (0, 12)")
    assert found(hard_negatives.mine(df, anchors)) == brute_negatives([r for r in rows if r[0] != 13], [0, 12])
    assert hard_negatives.mine(df.limit(0), anchors.limit(0)).count() == 0
    assert hard_negatives.mine(df, anchors.limit(0)).columns == COLUMNS


def test_large_components_are_exact():
    import numpy as np

    big = np.array([[float((1 << 24) - 1)] * 64, [float(-(1 << 24) + 1)] * 64])
    assert hard_negatives.exact(big, big[0]).tolist() == [64 * ((1 << 24) - 1) ** 2, -64 * ((1 << 24) - 1) ** 2]
    rows, anchors = hard_negatives.summaries(big, 4), hard_negatives.summaries(big[:1], 4)
    low, high = hard_negatives.bounds(rows, anchors)
    assert low[0, 0] <= 64 * ((1 << 24) - 1) ** 2 <= high[0, 0]


def brute_audit(docs, labels):
    first = {}
    for d, t, _ in docs:
        if d is not None:
            first[t or ""] = min(d, first.get(t or "", d))
    good, toxic = {d for d, q, _ in labels if q == 1}, {d for d, _, x in labels if x == 1}
    fails = []
    for d, t, part in docs:
        t = t or ""
        w = brute.words(t, lower=False)
        f = {"A": len(w) < 200, "B": 100 * len(set(w)) < 50 * len(w), "C": 100 * sum("A" <= c <= "Z" for c in t) > 2 * len(t), "D": any(c in "#$%&*|" for c in t), "E": d is not None and first[t] < d}
        fails.append((part or "", {x for x in f if f[x]}, d in good and d is not None, d in toxic and d is not None))
    out, removed = {}, {}
    for part in {x[0] for x in fails}:
        for order in map("".join, itertools.permutations("ABCDE")):
            left = [x for x in fails if x[0] == part]
            for step, name in enumerate(order, 1):
                here = [x for x in left if name in x[1]]
                left = [x for x in left if name not in x[1]]
                all_ = [x for x in fails if x[0] == part and name in x[1]]
                out[part, order, step] = [len(left), len(here), len(all_) - len(here), sum(x[1] == {name} for x in all_), sum(x[2] for x in here), sum(x[3] for x in here)]
                removed[part, name] = removed.get((part, name), 0) + len(here)
    return sorted((p, o, s, *v, removed[p, o[s - 1]]) for (p, o, s), v in out.items())


AUDIT = ["part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley"]


@pytest.mark.parametrize("broadcast_bits", [filter_audit.BROADCAST_BITS, 0])
def test_audit_equals_brute_force(spark, broadcast_bits):
    rnd = random.Random(5)
    words = ["alpha", "Beta", "GAMMA", "délta", "#x", "a|b", "e"]
    docs = [(i, " ".join(rnd.choice(words[: rnd.randrange(1, 8)]) + str(rnd.randrange(400)) for _ in range(rnd.choice([0, 3, 199, 200, 260]))), rnd.choice(["s", "t", "", None])) for i in range(60)]
    docs += [(100 + i, docs[i % 7][1], "s") for i in range(30)] + [(200, None, "t"), (201, "", "t"), (None, docs[0][1], "s"), (100, docs[0][1], "s"), (300, "word " * 300, "t"), (301, "\x0b\t \n", None)]
    labels = [(0, 1, None), (0, None, 0), (1, 0, 1), (2, 1, 1), (101, 1, 1), (None, 1, 1), (301, None, 1)]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string").withColumns({"part": F.lit("x"), "hash": F.lit(1), "own": F.lit("y"), "mask": F.lit(0)})
    said = spark.createDataFrame(labels, "doc_id long, quality int, toxic int").withColumn("good", F.lit("z"))
    got = filter_audit.audit(frame, said, broadcast_bits=broadcast_bits)
    assert sorted(tuple(r[c] for c in AUDIT) for r in got.collect()) == brute_audit(docs, labels)
    assert filter_audit.audit(frame.limit(0), said, broadcast_bits=broadcast_bits).count() == 0


def test_texts_with_one_hash_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "text_hash", lambda text="text": F.length(F.coalesce(F.col(text), F.lit(""))).cast("long"))
    docs = [(1, "ab", "s"), (2, "cd", "s"), (3, "ab", "s"), (4, "cd", "t"), (5, "ef", "t"), (6, "abc", "s"), (7, "abc", "s")]
    frame = spark.createDataFrame(docs, "doc_id long, text string, source string")
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert sorted(tuple(r[c] for c in AUDIT) for r in filter_audit.audit(frame, labels).collect()) == brute_audit(docs, [])


def test_sketch_clears_most_unique_texts():
    import numpy as np
    import pyarrow as pa

    shape = filter_audit.Sketch(200_000)
    hashes = np.random.default_rng(1).integers(-(1 << 62), 1 << 62, 200_000)
    hashes[-2000:] = hashes[:2000]
    parts = [pa.Table.from_batches(shape.fill([pa.record_batch([pa.array(x)], names=["hash"])])) for x in np.split(hashes, 4)]
    bits = {}
    for block in range(shape.blocks):
        rows = pa.concat_tables(parts).filter(pa.compute.equal(pa.concat_tables(parts).column("block"), block))
        bits[block] = np.frombuffer(shape.merge(rows).column("bits")[0].as_py(), dtype=np.uint8)
    block, places = shape.probes(hashes)
    hit = shape.hits(np.concatenate([bits[i] for i in range(shape.blocks)]), [block * shape.block + p for p in places])
    assert hit[:2000].all() and hit[-2000:].all() and hit[2000:-2000].mean() < 0.1
