"""Operators against brute force, edge rows and hot keys."""

import math
import random
from collections import Counter
from itertools import combinations

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from digestloom.operators import discover as disc, keywords as kw, processed, quality, related
from digestloom.operators import search as srch, textrank, views
from digestloom.operators.skew import broadcast_if_small, global_row_number, hot_keys, salted_join
from digestloom import session
from digestloom.functions import text
from digestloom.plans import methods, queries


def docs_of(spark, texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")


# TextRank


def ranks_by_matrix(sentences):
    """The published definition, pair by pair."""
    words = [s.lower().split() for s in sentences]
    n = len(words)
    w = [[0.0] * n for _ in range(n)]
    for i in range(n):
        for j in range(n):
            same = sum(a == b for a in words[i] for b in words[j])
            norm = math.log(len(words[i])) + math.log(len(words[j]))
            w[i][j] = same / norm if norm > 0 else float(same)
    share = [[v / (sum(row) + 1e-7) for v in row] for row in w]
    p, change = [1.0 / n] * n, 1.0
    while change > 1e-4:
        nxt = [0.15 / n + 0.85 * sum(p[i] * share[i][j] for i in range(n)) for j in range(n)]
        change, p = math.dist(nxt, p), nxt
    return p, [sum(row) for row in w]


def random_text(rng, n):
    vocabulary = [f"w{i}" for i in range(25)]
    return " ".join(" ".join(rng.choices(vocabulary, k=rng.choice([1, 1, 2, 3, 5, 9]))) + "." for _ in range(n))


def test_ranks_equal_the_pair_matrix(spark):
    rng = random.Random(7)
    texts = [random_text(rng, n) for n in (1, 2, 5, 6, 13, 40)] + ["A. A. A. A. A.", "x y. z q."]
    rows = docs_of(spark, texts).select(
        "doc_id", F.expr(text.sentences("text")).alias("s"),
        F.expr(textrank.sentence_ranks(text.sentences("text"))).alias("r"),
        F.expr(textrank.sentence_degrees(text.sentences("text"))).alias("d"),
    )
    for row in rows.collect():
        ranks, degrees = ranks_by_matrix(row.s)
        assert row.r == pytest.approx(ranks, abs=1e-12)
        assert row.d == pytest.approx(degrees, rel=1e-12)


@pytest.mark.parametrize("portion", [1, 300, 1 << 21])
def test_batches_of_documents_are_ranked_as_each_by_itself(spark, monkeypatch, portion):
    monkeypatch.setattr(textrank, "PORTION_BYTES", portion)
    rng = random.Random(portion)
    texts = [random_text(rng, n) for n in (1, 0, 5, 6, 13, 40, 200)] + ["A. a. A. a. A.", "x y. z q.", None, "", "... !!. ?.", "S. S. S. S. S. S."]
    docs = docs_of(spark, texts).coalesce(1)
    lines = textrank.Splitter(lambda t: text.sentences(t, split_newlines=True), text.raw_tokens)
    for splitter, word_lists in ((textrank.Splitter(), None), (lines, lines.word_lists)):
        parts = splitter.to_sentences("text")
        rows = docs.select(
            F.expr(textrank.sentence_ranks(parts, word_lists=word_lists)).alias("r"), textrank.ranks(parts, word_lists).alias("own_r"),
            F.expr(textrank.sentence_degrees(parts, word_lists)).alias("d"), textrank.degrees(parts, word_lists).alias("own_d"),
            F.expr(textrank.sentence_ranks(parts, 0.5, 0.0, 3, word_lists)).alias("s"), textrank.ranks(parts, word_lists, 0.5, 0.0, 3).alias("own_s"),
        ).collect()
        for row in rows:
            assert row.own_r == pytest.approx(row.r, abs=1e-12) and row.own_s == pytest.approx(row.s, abs=1e-12)
            assert row.own_d == pytest.approx(row.d, rel=1e-12)
        whole = textrank.with_summary(docs, parts, 3, word_lists).select("doc_id", "summary").collect()
        assert whole == docs.select("doc_id", F.expr(textrank.summary_of(parts, 3, word_lists)).alias("summary")).collect()
    nothing = spark.sql("SELECT CAST(NULL AS ARRAY<STRING>) AS parts, 'kept' AS text")
    assert textrank.with_summary(nothing, "parts").collect() == [(None, "kept", None)]
    with pytest.raises(ValueError):
        textrank.with_summary(docs, "array(text)", 0)


def test_summary_queries_rank_whole_batches(spark, tmp_path):
    docs_of(spark, ["a b. c d. e f. g h. a z."]).write.parquet(str(tmp_path / "documents.parquet"))
    for name in ("textrank_summary", "textrank_line_summary", "textrank_ranks", "textrank_degrees", "textrank_line_degrees"):
        plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert plan.count("ArrowEvalPython ") == 1


def test_fixed_number_of_steps(spark):
    sql = textrank.sentence_ranks(text.sentences("text"), epsilon=0.0, max_steps=1)
    row = docs_of(spark, ["a b. a c. d e."]).select(F.expr(sql).alias("r")).first()
    assert sum(row.r) == pytest.approx(1.0, abs=1e-6)


def test_summary_edges(spark):
    texts = ["a b. c d. e f. g h.", "a b. c d. e f. g h. a z.", "", None, "one", "S. S. S. S. S. S."]
    got = [
        r.s for r in docs_of(spark, texts).orderBy("doc_id")
        .select(F.expr(textrank.textrank_summary("text")).alias("s")).collect()
    ]
    assert got[0] == texts[0]
    assert got[1].startswith("a b.") and got[1].endswith("a z.") and len(got[1].split(". ")) == 4
    assert got[2:] == ["", "", "one", "S. S. S. S."]
    with pytest.raises(ValueError):
        textrank.textrank_summary("text", 0)


# Keywords


def test_single_document_keywords(spark):
    texts = ["bb aa bb cc aa dd", "", None, "그리고 것", "zz yy xx ww vv uu tt ss"]
    rows = methods.extract_keywords(docs_of(spark, texts), "tf").orderBy("doc_id").collect()
    assert [r.keywords for r in rows] == [
        ["bb", "aa", "cc", "dd"], [], [], [], ["zz", "yy", "xx", "ww", "vv", "uu", "tt"],
    ]
    top = kw.keywords_topn(docs_of(spark, texts[:1])).filter("rn = 1").first()
    assert top.score == pytest.approx(2 / 6 * 1.15)


def test_tfidf_equals_brute_force_with_a_hot_term(spark):
    rng = random.Random(5)
    texts = [" ".join(["hot"] * rng.randint(1, 3) + rng.choices([f"t{i}" for i in range(30)], k=12)) for _ in range(60)]
    texts.append("")
    counts = [Counter(t.split()) for t in texts]
    df = Counter(t for c in counts for t in c)
    expected = {}
    for i, c in enumerate(counts):
        w = {t: n * (math.log((1 + len(texts)) / (1 + df[t])) + 1) for t, n in c.items()}
        norm = math.sqrt(sum(v * v for v in w.values())) or 1.0
        best = sorted(w, key=lambda t: (-round(w[t] / norm, 9), t))[:7]
        expected[i] = [(t, round(w[t] / norm, 6)) for t in best]
    rows = kw.tfidf_topn(docs_of(spark, texts)).orderBy("doc_id", "rn").collect()
    got = {i: [] for i in range(len(texts))}
    for r in rows:
        got[r.doc_id].append((r.term, round(r.score, 6)))
    assert got == expected


def test_tfidf_of_one_document_falls_back(spark):
    docs = docs_of(spark, ["bb aa bb cc aa dd"])
    tf = methods.extract_keywords(docs, "tf").first().keywords
    assert methods.extract_keywords(docs, "tfidf").first().keywords == tf
    assert methods.extract_keywords(docs, "tfidf_batch").first().keywords == tf


def test_tfidf_against_a_corpus(spark):
    """A document is weighed with the corpus, not with its batch."""
    docs = docs_of(spark, ["common rare rare2 common", "common other", None])
    corpus = spark.createDataFrame([("common thing",)] * 9 + [("rare2",)], "text string")
    got = {r.doc_id: r.keywords for r in methods.extract_keywords(docs, "tfidf", 2, corpus=corpus).collect()}
    weights = {
        "common": 2 * (math.log(12 / 11) + 1), "rare": math.log(12 / 2) + 1, "rare2": math.log(12 / 3) + 1,
    }
    best = sorted(weights, key=lambda t: (-weights[t], t))[:2]
    assert sorted(got.values()) == sorted([best, ["other", "common"], []])
    rows = kw.tfidf_against(docs, corpus, 3)
    assert sum(r.score ** 2 for r in rows.collect() if "rare" in r.term or r.tf_count == 2) == pytest.approx(1.0)


def test_methods_by_name_and_by_function(spark):
    docs = docs_of(spark, ["a. b. c."])

    def shout(docs, k, text_col):
        return docs.withColumn("summary", F.upper(text_col))

    done = methods.extraction_results(docs, "tfidf", shout, id_col="doc_id", text_col="text").first()
    assert (done.summary, done.method) == ("A. B. C.", "tfidf+shout")
    with pytest.raises(ValueError, match="needs the vectors"):
        methods.extract_keywords(docs, "keybert")


def test_embedding_keywords(spark):
    candidates = spark.createDataFrame(
        [(1, "x", [1.0, 0.0]), (1, "y", [1.0, 1.0]), (1, "z", [0.0, 0.0]), (2, "x", [0.0, 2.0])],
        "doc_id int, term string, embedding array<float>",
    )
    documents = spark.createDataFrame([(1, [1.0, 0.2]), (2, [0.0, 1.0])], "doc_id int, embedding array<float>")
    rows = kw.embedding_topn(candidates, documents, 2).orderBy("doc_id", "rn").collect()
    assert [(r.doc_id, r.term) for r in rows] == [(1, "x"), (1, "y"), (2, "x")]
    docs = spark.createDataFrame([(1, "t"), (3, "t")], "doc_id int, text string")
    method = methods.keybert(candidates, documents)
    got = {r.doc_id: r.keywords for r in methods.extract_keywords(docs, method, 1).collect()}
    assert got == {1: ["x"], 3: []}


def test_methods_are_checked(spark):
    docs = docs_of(spark, ["a"])
    for name in ("llm", "unknown"):
        with pytest.raises(ValueError):
            methods.extract_keywords(docs, name)
        with pytest.raises(ValueError):
            methods.summarise(docs, name)
    assert methods.summarise(docs_of(spark, ["a. b. c. d. e."]), "lead").first().summary == "a. b. c. d."


def test_custom_tokenizer(spark):
    @F.pandas_udf("array<string>")
    def halves(texts):
        return texts.map(lambda t: [t[: len(t) // 2], t[len(t) // 2 :]])

    row = methods.extract_keywords(docs_of(spark, ["abcabc"]), "tf", tokenizer=halves).first()
    assert row.keywords == ["abc"]


# Discovery and state

AS_OF = "2026-07-19 00:00:00"


def listing(spark, rows):
    return spark.createDataFrame(
        [(a, d, p, i) for i, (a, d, p) in enumerate(rows)], "article_id string, published_at string, page int, pos bigint"
    )


def article(n):
    return f"202607{n:08d}"


def found(df, **kwargs):
    return [r.article_id for r in disc.discover(df, AS_OF, **kwargs).orderBy("page", "pos").collect()]


def test_walk_stops_after_the_first_old_page(spark):
    df = listing(spark, [
        (article(1), "2026-07-18 10:00", 1), (" " + article(2) + " ", "", 1), ("bad", "2026-07-18 10:00", 1),
        (article(1), "2026-01-01 10:00", 2), (article(3), "2026-07-12 00:00", 2),
        (article(4), "2026-07-11 23:59", 3), (article(5), "2026-07-18 10:00", 3),
        (article(6), "2026-07-18 10:00", 4),
    ])
    assert found(df) == [article(i) for i in (1, 2, 3, 4, 5)]


def test_walk_stops_at_a_page_without_valid_items(spark):
    df = listing(spark, [(article(1), None, 1), ("bad", "x", 2), (article(3), "", 3)])
    assert found(df) == [article(1)]
    late = listing(spark, [(article(1), "", 2)])
    assert found(late) == []
    with pytest.raises(RuntimeError):
        disc.require_items(disc.discover(late, AS_OF))


def test_page_limit(spark):
    df = listing(spark, [(article(p), "2026-07-18 10:00", p) for p in range(1, 25)])
    assert len(found(df, max_pages=20)) == 20
    report = disc.discovery_report(df, AS_OF, max_pages=20).first()
    assert (report.last_page, report.cut_page, report.cap_hit) == (20, None, True)
    assert len(found(df)) == 24
    report = disc.discovery_report(df, AS_OF).first()
    assert (report.last_page, report.cut_page, report.cap_hit) == (24, None, False)


def test_state_operators(spark):
    new = spark.createDataFrame([("a", "2"), ("a", "3"), ("b", "2")], "article_id string, processed_at string")
    old = spark.createDataFrame([("a", "1")] * 3 + [("c", "1")], "article_id string, processed_at string")
    assert {tuple(r) for r in processed.merge_state(old, new).collect()} == {("a", "1"), ("b", "2"), ("c", "1")}
    assert [r.article_id for r in processed.unprocessed(new, old).collect()] == ["b"]
    assert [r.article_id for r in processed.unprocessed_few(new, old).collect()] == ["b"]
    assert [r.article_id for r in processed.state_without_post(old, new).collect()] == ["c"]
    assert [r.article_id for r in processed.state_with_post(old, new).collect()] == ["a"]
    assert [r.article_id for r in quality.missing_pages(new.distinct(), old).collect()] == ["b"]


# Skew


def test_salted_join_is_an_inner_join(spark):
    rows = spark.range(3000).select(F.col("id"), F.when(F.col("id") < 1500, 0).otherwise(F.col("id") % 50).alias("k"))
    lookup = spark.createDataFrame([(k, j) for k in range(0, 60, 2) for j in range(3)], "k bigint, j int")
    counts = rows.groupBy("k").agg(F.count("*").alias("n"))
    got = salted_join(rows, lookup, "k", hot_keys(counts, "k", "n", 5), "id").select("id", "k", "j")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(lookup, "k").select("id", "k", "j").collect()))


def test_global_row_number_with_one_timestamp_for_most_rows(spark):
    df = spark.range(2000).select("id", F.when(F.col("id") % 3 > 0, 7).otherwise(F.col("id")).alias("ts"))
    got = global_row_number(df, [F.desc("ts"), F.asc("id")], "rn", partitions=7).collect()
    expected = sorted(df.collect(), key=lambda r: (-r.ts, r.id))
    assert [r.id for r in sorted(got, key=lambda r: r.rn)] == [r.id for r in expected]
    assert sorted(r.rn for r in got) == list(range(1, 2001))


def test_broadcast_needs_a_size_check(spark):
    df = spark.range(10)
    hinted = broadcast_if_small(df, 10)._jdf.queryExecution().analyzed().toString()
    plain = broadcast_if_small(df, 9)._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in hinted and "broadcast" not in plain


def test_stopwords_leave_tokens_in_place_and_repeated_ids_count_terms_once(spark, tmp_path):
    plan = kw.without_stopwords(spark.range(9).selectExpr("string(id) term"), spark.createDataFrame([("1",)], "term string"))
    assert plan.count() == 8
    assert "BroadcastHashJoin" in plan._jdf.queryExecution().executedPlan().toString()
    rows = [(1, "the red red fox x"), (2, "red fox"), (2, "red hen hen"), (2, None), (None, "a fox"), (None, "fox cub"), (3, "the"), (4, ""), (5, None)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = queries.QUERIES["stopword_anti"](spark, str(tmp_path)).collect()
    assert {(r.doc_id, r.n_kept, r.n_terms) for r in got} == {(1, 3, 2), (2, 5, 3), (None, 3, 2)}
    assert len(got) == 3
    # A task holds a few numbers per document, not its terms.
    counted = queries._counted_terms(spark.createDataFrame(rows, "doc_id long, text string"))
    assert counted.count() == counted.select("row", "term").distinct().count() == 11


def related_by_pairs(tags, k):
    out = []
    for d in tags:
        scored = [(-len(tags[d] & tags[e]), e) for e in tags if e != d and tags[d] & tags[e]]
        out += [(d, i + 1, e, -o) for i, (o, e) in enumerate(sorted(scored)[:k])]
    return sorted(out)


@pytest.mark.parametrize("seed", range(3))
def test_related_equals_all_pairs_with_a_hot_tag(spark, seed):
    rng = random.Random(seed)
    tags = {i: set(rng.sample("abcdefghijklmnop", rng.randint(0, 5))) | ({"hot"} if rng.random() < 0.5 else set()) for i in range(120)}
    tags.update({200 + i: {"a", "b", "c", "hot"} for i in range(15)})
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id bigint, keywords array<string>")
    got = related.related_topk(df, 3).collect()
    assert sorted((r.doc_id, r.rn, r.related_id, r.overlap) for r in got) == related_by_pairs(tags, 3)


def found_related(df, k, **options):
    return sorted((r.doc_id, r.rn, r.related_id, r.overlap) for r in related.related_topk(df, k, **options).collect())


@pytest.mark.parametrize(("seed", "suffix"), [(0, 6), (1, 2), (2, 1)])
def test_related_equals_all_pairs_with_forty_shared_keywords(spark, seed, suffix, monkeypatch):
    monkeypatch.setattr(related, "ROUNDS", (5, 30, None))
    monkeypatch.setattr(related, "BLOCK_ENTRIES", 16)
    rng = random.Random(seed)
    words = [f"t{i:02d}" for i in range(60)]
    tags = {i: set(rng.sample(words, 40)) for i in range(60)}
    tags.update({100 + i: set(rng.sample(words[:8], rng.randint(0, 8))) | {"hot"} for i in range(60)})
    tags.update({200 + i: {f"r{i // 2}", "hot", *rng.sample(words, rng.choice([0, 3, 12]))} for i in range(40)})
    tags.update({300 + i: set(words[:15]) for i in range(8)})
    tags[400], tags[401] = set(), {"alone"}
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id bigint, keywords array<string>")
    assert found_related(df, 4, suffix=suffix) == related_by_pairs(tags, 4)


def test_related_reads_rare_lists_first_and_stops(spark, monkeypatch):
    """Pairs of rare keywords fill the best k, so hot lists give no pairs."""
    met = []
    meet = related._meet

    def counted(asked, held, id_col):
        met.append(asked.count())
        return meet(asked, held, id_col)

    monkeypatch.setattr(related, "_meet", counted)
    hot = [f"h{i}" for i in range(8)]
    tags = {i: {*(f"g{i // 5}.{j}" for j in range(8)), *hot} for i in range(400)}
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id bigint, keywords array<string>")
    got = found_related(df, 4)
    assert {(d, e) for d, _, e, o in got if o == 16} == {(d, e) for d in tags for e in tags if d // 5 == e // 5 and d != e}
    # Rare lists are asked by all 400 documents for their eight rare keywords, hot ones by nobody.
    assert met[:2] == [3200, 0] and sum(met[2:]) == 0


@pytest.mark.parametrize("dense", [1, 40, 10**9])
def test_related_long_lists_give_the_best_k_of_a_reader_not_all_pairs(spark, monkeypatch, dense):
    rows = []
    written = related.materialise

    def counted(df, name):
        out = written(df, name)
        if name == "met":
            rows.append(out.count())
        return out

    for name, value in (("materialise", counted), ("ROUNDS", (3, None)), ("BLOCK_ENTRIES", 64),
                        ("BLOCK_READERS", 100), ("READERS_AT_ONCE", 7), ("DENSE_PAIRS", dense)):
        monkeypatch.setattr(related, name, value)
    rng = random.Random(dense)
    words = [f"w{i}" for i in range(30)]
    tags = {f"d{i}": {"early", *rng.sample(words, rng.randint(4, 9))} for i in range(150)}
    tags.update({f"e{i}": set(rng.sample(words, 3)) for i in range(90)})
    tags["none"] = set()
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id string, keywords array<string>")
    assert found_related(df, 3, suffix=2) == related_by_pairs(tags, 3)
    # 31 lists of at most 150 entries have at most three blocks.
    held = sum(map(len, tags.values()))
    assert 0 < rows[-1] <= 3 * 3 * held < sum(len(tags[a] & tags[b]) for a in tags for b in tags if a != b)


@pytest.mark.parametrize(("share", "words_", "at_most"), [(16, 40, 20), (16, 400, 300), (0, 40, 20)])
def test_related_of_many_long_documents_files_only_short_ones(spark, monkeypatch, share, words_, at_most):
    """Documents of many keywords meet block by block, or by lists if there are few of them; both equal all pairs."""
    rows = {}
    written = related.materialise

    def noted(df, name):
        out = written(df, name)
        rows.setdefault(name, []).append(out.count())
        return out

    for name, value in (("materialise", noted), ("LONG_SHARE", share), ("FIRST_LISTS", 3), ("BLOCK_DOCUMENTS", 40)):
        monkeypatch.setattr(related, name, value)
    rng = random.Random(share)
    words = [f"w{i:03d}" for i in range(words_)]
    pick = lambda n: {words[int(rng.random() ** 2 * words_)] for _ in range(n)}
    tags = {f"d{i}": pick(rng.randint(6, at_most)) for i in range(130)}
    tags.update({f"s{i}": pick(rng.randint(0, 3)) for i in range(60)})
    tags.update({f"c{i}": tags["d1"] | {"w000"} for i in range(9)})
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id string, keywords array<string>")
    assert found_related(df, 3, suffix=4) == related_by_pairs(tags, 3)
    in_all = [w for t in tags.values() for w in t]
    held = {d: len([w for w in t if in_all.count(w) > 1]) for d, t in tags.items()}
    filed = sum(2 ** min(n, 4) - 1 for n in held.values() if n <= 4 or not share)
    assert rows["filed"] == [filed]
    # One more time the readers are written for each block.
    n_long, n_short = (sum(1 for n in held.values() if n and (n > 4) == kind) for kind in (True, False))
    assert not share or len(rows["readers"]) == 1 + -(-n_long // 40) + -(-n_short // 40)


def test_related_takes_an_id_once_from_a_block():
    lists = [[1, 2, 3], [1, 2, 3], [1, 2, 3], [1, 2, 9], [1, 4]]
    held = pa.table({"doc_id": [7, 7, 7, 8, 9], "all": lists, "early": [True, True, False, True, False]})
    asked = pa.table({"doc_id": [1, 2], "all": [[1, 2, 3], [1, 2]], "early": [True, False], "least": [1, 1]})
    got = related._best_in_block(2, "doc_id")(asked, held).to_pylist()
    assert sorted((r["doc_id"], r["related_id"], r["overlap"]) for r in got) == [(1, 7, 3), (1, 8, 2), (2, 7, 2), (2, 8, 2)]


def test_related_cuts_the_shuffles_of_subsets_by_their_rows(spark, monkeypatch):
    own, parts = spark.conf.get("spark.sql.shuffle.partitions"), {}
    written = related.materialise

    def noted(df, name):
        parts[name] = int(spark.conf.get("spark.sql.shuffle.partitions"))
        return written(df, name)

    monkeypatch.setattr(related, "materialise", noted)
    monkeypatch.setattr(session, "TASK_ROWS", 100)
    tags = {i: set(random.Random(i).sample("abcdefghij", 5)) for i in range(60)}
    df = spark.createDataFrame([(i, sorted(t)) for i, t in tags.items()], "doc_id bigint, keywords array<string>")
    assert found_related(df, 4) == related_by_pairs(tags, 4)
    # 60 documents have 31 subsets each.
    assert parts["filed"] == int(own) and parts["kept"] == parts["best"] == 19
    assert spark.conf.get("spark.sql.shuffle.partitions") == own


def test_related_with_nothing_shared(spark):
    schema = "doc_id bigint, keywords array<string>"
    for rows in ([], [(1, ["a"]), (2, ["b"]), (3, None), (4, [])], [(1, ["a", "a", None]), (2, [None])]):
        assert found_related(spark.createDataFrame(rows, schema), 4) == []


def test_related_refuses_too_many_tags(spark):
    with pytest.raises(ValueError):
        related.related_topk(spark.createDataFrame([(1, ["a"])], "doc_id int, keywords array<string>"), n_tags=13)
    crowded = spark.createDataFrame([(i, list("abcd")) for i in range(2)], "doc_id int, keywords array<string>")
    with pytest.raises(Exception, match="more than 3 shared keywords"):
        related.related_topk(crowded, n_tags=3).collect()


# Views


def test_collisions_last_write_and_suffix(spark):
    posts = spark.createDataFrame([("1", "p.md", 1), ("2", "p.md", 2), ("3", "q.md", 3)], "article_id string, path string, write_seq int")
    assert {(r.path, r.article_id) for r in views.last_write_wins(posts).collect()} == {("p.md", "2"), ("q.md", "3")}
    assert [tuple(r) for r in views.collisions(posts).collect()] == [("p.md", 2, "1", "2")]
    kept = views.suffix_collisions(posts, [F.asc("write_seq")]).collect()
    assert {(r.article_id, r.path) for r in kept} == {("1", "p.md"), ("2", "p--2.md"), ("3", "q.md")}


def test_hot_groups_are_limited_before_the_shuffle(spark):
    posts = spark.range(10).select(F.concat(F.lit("p"), F.col("id") % 2).alias("path"), F.col("id").alias("write_seq"))
    plan = views.last_write_wins(posts)._jdf.queryExecution().executedPlan().toString()
    below_exchange = plan[plan.index("Exchange"):]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange


def test_search_in_a_stored_index(spark, tmp_path):
    docs = docs_of(spark, ["apple pie apple", "apple tart", "cherry pie cake", ""])
    path = str(tmp_path / "index")
    srch.write_index(srch.build_index(docs), path)
    postings, size = srch.read_index(spark, path)
    stored = srch.search(postings, ["Apple", "pie"], 3, size=size)
    rows = stored.collect()
    assert rows == srch.search(srch.build_index(docs), ["pie", "apple"], 3).collect()
    assert [r.doc_id for r in rows][0] == 0 and {r.doc_id for r in rows} == {0, 1, 2}
    assert "In(term, [apple,pie])" in stored._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("portion", [1, 1 << 22])
def test_index_terms_of_batches_equal_those_of_each_document(spark, monkeypatch, portion):
    monkeypatch.setattr(kw, "PORTION_BYTES", portion)
    docs = docs_of(spark, ["b a b, A! x", None, "", "the . .", "aa bb aa ÄÖ äö zz", "aa " * 50]).coalesce(1)
    expected = kw.document_terms(docs).select("term", "doc_id", F.col("tf_count").alias("tf"), "n_tokens")
    index = srch.build_index(docs)
    assert index.dtypes == expected.dtypes and sorted(index.collect()) == sorted(expected.collect())
    # A batch is counted in one call, not by expressions that Spark interprets token by token.
    plan = index._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython ") == 1 and "Exchange" not in plan


def test_digest_entries_and_text(spark, tmp_path):
    items = spark.sql("SELECT id, TIMESTAMP_NTZ '2026-07-19 00:00:00' + make_dt_interval(0, CAST(id AS INT) * 5) AS ts FROM range(30)")
    entries = views.digest_entries(items, "ts", "id")
    rows = entries.orderBy(F.desc("ts")).collect()
    for day in {r.post_date for r in rows}:
        numbers = [r.entry_no for r in rows if r.post_date == day]
        assert numbers == list(range(1, len(numbers) + 1))
    views.write_digest(entries.withColumn("line", F.col("id").cast("string")), "line", str(tmp_path / "d"))
    assert spark.read.text(str(tmp_path / "d")).count() == 30


def test_subsets(spark):
    got = spark.sql("SELECT array('a', 'b', 'c') AS t").select(F.expr(related._subsets("t")).alias("s")).first().s
    assert sorted(map(tuple, got)) == sorted(c for n in (1, 2, 3) for c in combinations("abc", n))


def test_documents_are_processed_without_a_shuffle(spark):
    docs = docs_of(spark, ["a b. c d."])
    results = methods.extraction_results(docs, id_col="doc_id", text_col="text")
    for df in (kw.keywords_topn(docs), kw.document_terms(docs), results):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "Python" not in plan


def test_ranks_of_a_long_document(spark):
    rng = random.Random(11)
    long = random_text(rng, 3000)
    sql = textrank.sentence_ranks(text.sentences("text"))
    ranks = docs_of(spark, [long]).select(F.expr(sql).alias("r")).first().r
    assert len(ranks) == 3000 and sum(ranks) == pytest.approx(1.0, abs=1e-5)
