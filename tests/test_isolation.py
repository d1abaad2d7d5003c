"""One bad article does not end a run; texts are cut by what the caller gives."""

import json
import os

import pytest
from pyspark.sql import functions as F

from digestloom.operators import isolate, textrank
from digestloom.plans import daily_run, methods
from digestloom.sources import posts as post_source, state as state_source
from tests.test_runs import AS_OF, ROWS, STYLE, article_id, counts, landed


def texts(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "doc_id int, text string").coalesce(1)


def split_words(text):
    if "bad" in text:
        raise ValueError(f"cannot read {text}")
    return text.split()


def test_failures_of_single_rows_stay_single(spark):
    calls = spark.sparkContext.accumulator(0)

    def batch(series):
        calls.add(1)
        return series.map(split_words)

    values = [f"w{i}" for i in range(200)]
    values[7], values[90], values[91], values[150] = "bad one", None, "a bad", ""
    rows = isolate.attempt(texts(spark, values), "words", isolate.guarded(batch, "array<string>"), "text", "cut").collect()
    rows = sorted(rows, key=lambda r: r.doc_id)
    assert {r.doc_id: r.error for r in rows if r.error} == {7: "cut: ValueError: cannot read bad one", 91: "cut: ValueError: cannot read a bad"}
    assert [r.words for r in rows] == [None if v is None or "bad" in v else v.split() for v in values]
    # Halving finds two rows of two hundred in some thirty calls, not two hundred.
    assert calls.value < 40


def test_a_batch_is_tried_in_portions(spark, monkeypatch):
    monkeypatch.setattr(isolate, "PORTION_BYTES", 4000)
    most = spark.sparkContext.accumulator(0)
    calls = spark.sparkContext.accumulator(0)

    def batch(*series):
        assert sum(map(len, series[0].dropna())) <= 4000
        calls.add(1)
        most.add(len(series[0]))
        return [str(row) for row in zip(*series)]

    rows = texts(spark, [None if i % 7 == 0 else f"{i}" * 40 for i in range(1000)])
    for columns in (["text"], ["text", "doc_id"]):
        before = calls.value
        given = rows.select("doc_id", "text", isolate.guarded(batch, "string")(*map(F.col, columns)).alias("x")).collect()
        assert [(r.x.value, r.x.error) for r in given] == [(None if r.text is None else str(tuple(r[c] for c in columns)), None) for r in given]
        assert len(given) == 1000 and calls.value - before > 20
    assert most.value == 2 * sum(1 for i in range(1000) if i % 7)


@pytest.mark.parametrize(
    ("function", "error"),
    [
        (lambda s: [1] * (len(s) + 1), "ValueError: 1 rows gave 2 results"),
        (lambda s: ["text"] * len(s), "ArrowInvalid"),
        (lambda s: None, "TypeError"),
        (lambda s: 1 / 0, "ZeroDivisionError: division by zero"),
    ],
)
def test_wrong_results_are_failures(spark, function, error):
    rows = isolate.attempt(texts(spark, ["a", None, "b"]), "n", isolate.guarded(function, "long"), "text", "count").orderBy("doc_id").collect()
    assert [r.n for r in rows] == [None] * 3
    assert [bool(r.error and r.error.startswith(f"count: {error}")) for r in rows] == [True, False, True]


def test_lack_of_memory_is_not_a_failure_of_the_row(spark):
    def hungry(series):
        raise MemoryError("worker")

    with pytest.raises(Exception, match="MemoryError"):
        isolate.attempt(texts(spark, ["a"]), "n", isolate.guarded(hungry, "long"), "text", "count").collect()


def test_an_error_is_kept_and_not_tried_again(spark):
    rows = texts(spark, ["a", "b"]).withColumn("error", F.when(F.col("doc_id") == 0, "before"))
    seen = isolate.attempt(rows, "x", isolate.guarded_rows(str.upper, "string"), "text", "up").orderBy("doc_id").collect()
    assert [(r.x, r.error) for r in seen] == [(None, "before"), ("B", None)]
    assert isolate.attempt(texts(spark, ["a"]).limit(0), "x", isolate.guarded_rows(str.upper, "string"), "text", "up").count() == 0


def failing_run(spark, tmp_path, **options):
    posts_dir, state_dir, failures = (str(tmp_path / n) for n in ("posts", "state", "failures"))
    listing, pages = landed(spark, ROWS)
    chosen = daily_run.Options(base_url="https://n.example", style=STYLE, **options)
    done = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, chosen, failures_dir=failures)
    failed = {r.article_id: r.error for r in spark.read.parquet(failures).collect()}
    posts = {r.article_id: r for r in post_source.read_posts(spark, posts_dir).collect()}
    state = {r.article_id for r in state_source.read_state(spark, state_dir).collect()}
    assert set(posts) == state
    return counts(done), failed, posts


def no_second(text):
    if "Second" in text:
        raise ValueError("second")
    return text.lower().replace(".", "").split()


def test_one_article_whose_tokenizer_raises(spark, tmp_path):
    for method in ("tf", "tfidf_batch"):
        folder = tmp_path / method
        tokenizer = isolate.guarded_rows(no_second, "array<string>")
        n, failed, posts = failing_run(spark, folder, tokenizer=tokenizer, keyword_method=method)
        assert n == (4, 3, 1) and failed == {article_id(2): "tokenizer: ValueError: second"}
        assert set(posts) == {article_id(i) for i in (1, 3, 5)}
        assert set(posts[article_id(1)].keywords) == {"alpha", "beta", "gamma"}
    # It is tried again: the next run, whose tokenizer is mended, posts it.
    listing, pages = landed(spark, ROWS)
    mended = daily_run.Options(base_url="https://n.example", style=STYLE, tokenizer=isolate.guarded_rows(str.split, "array<string>"))
    done = daily_run.run(spark, listing, pages, str(folder / "posts"), str(folder / "state"), "r2", AS_OF, mended)
    assert counts(done) == (1, 1, 0)


def test_methods_parsers_and_splitters_may_fail(spark, tmp_path):
    def keywords(text):
        return [text.split()[0]]  # fails on an empty text

    def parse(html):
        if "Same title" in html and "10:00" in html:
            raise RuntimeError("torn page")
        return {"title": "T", "published_at": "2026-07-19 09:00", "raw_text": html[:10] if "No body" not in html else ""}

    class Halves:
        def to_sentences(self, text):
            return [text[:4], text[4:]]

        def to_words(self, sentence):
            return list(sentence)

    n, failed, posts = failing_run(
        spark, tmp_path, keyword_method=isolate.guarded_rows(keywords, "array<string>", "first"), parser=isolate.guarded_rows(parse, "struct<title string, published_at string, raw_text string>"),
        splitter=textrank.python_splitter(Halves()), summary_sentences=1,
    )
    assert n == (4, 2, 2)
    assert failed == {article_id(2): "parser: RuntimeError: torn page", article_id(3): "keyword method: IndexError: list index out of range"}
    assert posts[article_id(1)].keywords == ["<h2"] and posts[article_id(1)].method == "first+textrank"
    assert posts[article_id(1)].summary in ("<h2 ", 'id="ar')


def test_corpus_texts_that_fail_are_left_out(spark):
    corpus = spark.createDataFrame([("alpha beta",), ("bad alpha",), ("alpha",)], "raw_text string")
    docs = texts(spark, ["alpha beta beta", "bad"]).withColumnRenamed("text", "raw_text")
    tokenizer = isolate.guarded_rows(split_words, "array<string>")
    got = methods.extract_keywords(docs, "tfidf", 3, "doc_id", "raw_text", tokenizer, corpus)
    plain = methods.extract_keywords(docs.filter("doc_id = 0"), "tfidf", 3, "doc_id", "raw_text", None, corpus.filter("NOT contains(raw_text, 'bad')"))
    rows = {r.doc_id: r for r in got.collect()}
    assert rows[0].keywords == plain.first().keywords and rows[1].keywords == [] and rows[1].error


def test_a_splitter_changes_graph_and_summary(spark):
    docs = texts(spark, ["一二三。四五一。一二六。七八九。二三一。", "", None])
    script = textrank.Splitter(
        lambda t: f"filter(split(coalesce({t}, ''), '(?<=。)'), s -> s <> '')", lambda s: f"split(replace({s}, '。', ''), '')"
    )
    parts = script.to_sentences("text")
    degrees = docs.select(F.expr(textrank.sentence_degrees(parts, script.word_lists)).alias("d")).first().d
    # Three words each: equal words over ln 3 + ln 3; the fourth sentence meets itself only.
    pairs = [[3, 1, 2, 0, 3], [1, 3, 1, 0, 1], [2, 1, 3, 0, 2], [0, 0, 0, 3, 0], [3, 1, 2, 0, 3]]
    import math

    assert degrees == pytest.approx([sum(row) / (2 * math.log(3)) for row in pairs])
    own = {r.doc_id: r.summary for r in methods.summarise(docs, "textrank", 2, "text", script).collect()}
    plain = {r.doc_id: r.summary for r in methods.summarise(docs, "textrank", 2, "text").collect()}
    assert own == {0: "一二三。 二三一。", 1: "", 2: ""} and plain[0] == docs.first().text

    class Python:
        def to_sentences(self, text):
            return [s + "。" for s in text.split("。") if s]

        def to_words(self, sentence):
            return list(sentence.strip("。"))

    guarded = methods.summarise(docs, "textrank", 2, "text", textrank.python_splitter(Python()))
    assert {r.doc_id: (r.summary, r.error) for r in guarded.collect()} == {k: (v, None) for k, v in own.items()}
    lead = methods.summarise(docs, "lead", 2, "text", textrank.python_splitter(Python()))
    assert lead.filter("doc_id = 0").first().summary == "一二三。 四五一。"


def test_word_lists_of_any_length(spark):
    row = spark.createDataFrame([(["a", "b", "c"], [["x", None, "X"], ["x"]])], "s array<string>, w array<array<string>>")
    got = row.select(F.expr(textrank.sentence_degrees("s", textrank.given_words("w"))).alias("d")).first().d
    import math

    assert got == pytest.approx([4 / (2 * math.log(2)) + 2 / math.log(2), 2 / math.log(2) + 1, 0])


def test_broken_state_documents_are_set_aside_within_a_run(spark, tmp_path):
    folder = tmp_path / "json"
    os.makedirs(folder)
    (folder / "good.json").write_text(json.dumps({"processed_ids": [article_id(1)], "last_run_at": "x"}))
    (folder / "bad.json").write_text('{"processed_ids": [')
    listing, pages = landed(spark, ROWS)
    options = daily_run.Options(base_url="https://n.example", style=STYLE)
    done = daily_run.run(
        spark, listing, pages, str(tmp_path / "posts"), str(tmp_path / "state"), "r1", AS_OF, options,
        state_json=str(folder), quarantine_dir=str(tmp_path / "quarantine"),
    )
    assert counts(done) == (3, 3, 0) and done.first().quarantined == 1
    assert spark.read.json(str(tmp_path / "quarantine")).first().value == '{"processed_ids": ['
    with pytest.raises(ValueError):
        daily_run.run(spark, listing, pages, "p", "s", "r", AS_OF, options, state_json="x")


def test_a_run_reads_only_the_days_of_its_ids(spark, tmp_path):
    state_dir = str(tmp_path / "state")
    days = [f"202606{d:02d}" for d in range(1, 11)]
    ids = spark.createDataFrame([(f"{d}{i:06d}",) for d in days for i in range(3)] + [(article_id(1),)], "article_id string")
    state_source.append_state(ids, state_dir, "r0", AS_OF)
    found = spark.createDataFrame([(article_id(1),), (article_id(2),)], "article_id string")
    read = state_source.read_state(spark, state_dir, except_run="r1", ids=found)
    assert len(read.inputFiles()) > 1  # the folder has all days
    plan = read._jdf.queryExecution().executedPlan().toString()
    assert "id_day" in plan and "PartitionFilters: [" in plan and "20260719" in plan
    assert [r.article_id for r in read.collect()] == [article_id(1)]
    listing, pages = landed(spark, ROWS)
    done = daily_run.run(spark, listing, pages, str(tmp_path / "posts"), state_dir, "r1", AS_OF, daily_run.Options(style=STYLE))
    assert counts(done) == (3, 3, 0)
