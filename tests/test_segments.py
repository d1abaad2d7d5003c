"""Index segments: search by bounds, replays, merging, stored frequencies, and a run that keeps them."""

import random

import pytest
from pyspark.sql import functions as F

from digestloom.operators import isolate, keywords as kw, search as srch, segments
from digestloom.plans import daily_run
from digestloom.sources import posts as post_source
from tests.test_runs import AS_OF, ROWS, STYLE, counts, landed


def corpus(spark, n, seed=1):
    rnd = random.Random(seed)
    rows = [(i, " ".join(rnd.choice(["red", "blue", "green", f"w{rnd.randrange(50)}"]) for _ in range(rnd.choice([1, 5, 30, 80])))) for i in range(n)]
    rows += [(n, ""), (n + 1, None), (n + 2, "x")]  # without terms
    return spark.createDataFrame(rows, "doc_id long, text string")


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.fixture(scope="module")
def indexed(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("index"))
    docs = corpus(spark, 300)
    for run in (0, 1, 2, 0):
        segments.add_segment(docs.filter(F.pmod("doc_id", F.lit(3)) == run), path, str(run))
    return docs, path


@pytest.mark.parametrize("terms", [["red"], ["Red", "blue", "w7"], ["w1", "w2", "w3", "w1"], ["absent"], []])
@pytest.mark.parametrize(("k", "cells"), [(5, 1), (400, 8), (1, 2)])
def test_search_equals_a_scan_of_all_postings(spark, indexed, monkeypatch, terms, k, cells):
    docs, path = indexed
    found, read = segments.search_segments(segments.read_segments(spark, path), terms, k, first_cells=cells)
    expected = srch.search(srch.build_index(docs), terms, k)
    assert rows_of(found) == rows_of(expected)
    assert read["scored"] <= read["postings"]


def test_cells_that_cannot_matter_are_not_scored(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(segments, "CELL_DOCS", 16)
    rows = [(i, "rare " * (1 + i % 3) + " ".join(["other"] * (i % 200))) for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    segments.add_segment(docs, str(tmp_path / "i"), "r")
    found, read = segments.search_segments(segments.read_segments(spark, str(tmp_path / "i")), ["rare"], 10)
    assert rows_of(found) == rows_of(srch.search(srch.build_index(docs), ["rare"], 10))
    assert read["postings"] == 2000 and read["scored"] < 400
    blocks = spark.read.parquet(str(tmp_path / "i" / "blocks"))
    assert blocks.agg(F.max(F.size("postings"))).first()[0] <= 16
    bounds_only = blocks.filter(F.col("term").isin(["rare"])).select("cell", "most")
    plan = bounds_only._jdf.queryExecution().executedPlan().toString()
    assert "postings" not in plan.split("ReadSchema")[1] and "PushedFilters: [In(term" in plan or "EqualTo(term,rare)" in plan


def test_postings_are_shuffled_once_and_written_as_blocks_once(spark, tmp_path, monkeypatch):
    names = []
    write = segments.materialise
    monkeypatch.setattr(segments, "materialise", lambda df, name: (names.append(name), write(df, name))[1])
    segments.add_segment(corpus(spark, 600), str(tmp_path / "i"), "r")
    assert names == ["terms", "cells"]
    blocks = segments.read_segments(spark, str(tmp_path / "i")).blocks
    assert blocks.count() == blocks.select("term", "cell").distinct().count()
    assert blocks.filter("n != size(postings)").count() == 0


def test_merged_segments_answer_alike(spark, indexed, tmp_path):
    docs, path = indexed
    into = str(tmp_path / "merged")
    segments.merge_segments(spark, path, into)
    merged = segments.read_segments(spark, into)
    assert [r.run_id for r in merged.size.collect()] == ["merged"]
    for terms in (["red", "w7"], ["blue"]):
        assert rows_of(segments.search_segments(merged, terms, 7)[0]) == rows_of(srch.search(srch.build_index(docs), terms, 7))
    assert rows_of(segments.stored_frequencies(merged)[0]) == rows_of(kw.document_frequency(kw.document_terms(docs)))
    assert segments.stored_frequencies(merged)[1] == docs.count()
    segments.merge_segments(spark, str(tmp_path / "none"), into)
    assert segments.read_segments(spark, str(tmp_path / "none")) is None


def test_the_last_run_of_an_id_counts_when_merged(spark, tmp_path):
    path, into = str(tmp_path / "i"), str(tmp_path / "m")
    for run, text in (("r1", "old words"), ("r2", "new")):
        segments.add_segment(spark.createDataFrame([(1, text)], "doc_id long, text string"), path, run)
    segments.merge_segments(spark, path, into)
    merged = segments.read_segments(spark, into)
    assert rows_of(segments.stored_frequencies(merged)[0]) == [("new", 1)] and segments.stored_frequencies(merged)[1] == 1


def test_frequencies_after_a_replay_and_a_backfill(spark, tmp_path):
    path = str(tmp_path / "i")
    docs = corpus(spark, 60, seed=2)
    days = [docs.filter(F.pmod("doc_id", F.lit(4)) == d) for d in range(4)]
    segments.add_segment(days[3], path, "d1")  # a first try with other documents
    for name, day in (("d2", days[2]), ("d1", days[1]), ("d0", days[0])):
        segments.add_segment(day, path, name)
    known, n_docs = segments.stored_frequencies(segments.read_segments(spark, path))
    all_ = days[0].unionByName(days[1]).unionByName(days[2])
    assert n_docs == all_.count()
    assert rows_of(known) == rows_of(kw.document_frequency(kw.document_terms(all_)))
    stored = kw.tfidf_with(days[3], known, n_docs)
    plain = kw.tfidf_against(days[3], all_.select("text"))
    assert rows_of(stored.withColumn("score", F.round("score", 9))) == rows_of(plain.withColumn("score", F.round("score", 9)))
    others, n = segments.stored_frequencies(segments.read_segments(spark, path, except_run="d2"))
    assert n == days[0].count() + days[1].count() and rows_of(others) == rows_of(kw.document_frequency(kw.document_terms(days[0].unionByName(days[1]))))


def test_empty_segments(spark, tmp_path):
    path = str(tmp_path / "i")
    segments.add_segment(corpus(spark, 3).limit(0), path, "r")
    found, read = segments.search_segments(segments.read_segments(spark, path), ["red"], 3)
    assert found.collect() == [] and read == {"postings": 0, "scored": 0}


def test_an_unfinished_segment_is_not_read(spark, indexed, tmp_path):
    import shutil

    _, path = indexed
    copy = str(tmp_path / "copy")
    shutil.copytree(path, copy)
    shutil.rmtree(f"{copy}/size/run_id=1")
    left = segments.read_segments(spark, copy)
    assert {r.run_id for r in left.blocks.select("run_id").distinct().collect()} == {"0", "2"}


def test_runs_weigh_terms_by_what_others_published(spark, tmp_path):
    posts_dir, state_dir, index_dir = (str(tmp_path / n) for n in ("posts", "state", "index"))
    options = daily_run.Options(base_url="https://n.example", style=STYLE, keyword_method="tfidf")
    first = [(n, f"T{n}", "2026-07-19 09:00", "<p>alpha alpha common.</p>") for n in (1, 2, 3)]
    listing, pages = landed(spark, first)
    daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, options, index_dir=index_dir)
    known, n_docs = segments.stored_frequencies(segments.read_segments(spark, index_dir))
    assert rows_of(known) == [("alpha", 3), ("common", 3)] and n_docs == 3
    # "alpha" is everywhere: a word that only this article has comes first, though it is rarer in it.
    listing, pages = landed(spark, [*first, (4, "T4", "2026-07-19 09:00", "<p>alpha alpha news.</p>")])
    for _ in range(2):  # the second time as a replay, which does not count itself
        done = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r2", AS_OF, options, index_dir=index_dir)
        assert counts(done) == (1, 1, 0)
    by_run = {r.run_id: r for r in post_source.read_posts(spark, posts_dir).filter("run_id = 'r2'").collect()}
    weight = {"alpha": 2 * (1 + F_LN(5, 5)), "news": 1 * (1 + F_LN(5, 2))}
    assert by_run["r2"].keywords == sorted(weight, key=lambda t: (-weight[t], t)) and by_run["r2"].method == "tfidf+textrank"
    assert segments.stored_frequencies(segments.read_segments(spark, index_dir))[1] == 4


def F_LN(a, b):
    import math

    return math.log(a / b)


def test_a_segment_takes_the_tokens_of_the_run(spark, tmp_path):
    listing, pages = landed(spark, ROWS[:2])
    options = daily_run.Options(base_url="https://n.example", style=STYLE, tokenizer=isolate.guarded_rows(lambda t: ["tok", t[:5]], "array<string>"))
    daily_run.run(spark, listing, pages, str(tmp_path / "p"), str(tmp_path / "s"), "r1", AS_OF, options, index_dir=str(tmp_path / "i"))
    known, _ = segments.stored_frequencies(segments.read_segments(spark, str(tmp_path / "i")))
    assert rows_of(known) == [("Alpha", 1), ("Secon", 1), ("tok", 2)]
