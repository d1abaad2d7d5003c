"""Sources, the daily run and the streams, end to end on small landed inputs."""

import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from digestloom.operators import quality
from digestloom.plans import daily_run
from digestloom.sources import listing as listing_source, pages as page_source, posts as post_source
from digestloom.sources import state as state_source
from digestloom.sources.posts import PostStyle
from digestloom.streaming import incremental

AS_OF = "2026-07-19 12:00:00"
STYLE = PostStyle(section_url="https://n.example/section?id1=04", section_name="N section")
OPTIONS = daily_run.Options(base_url="https://n.example", style=STYLE)

PAGE = (
    '<h2 id="article_title_h2">{title}</h2><div class="timewrap"><div class="time">'
    '<time>발행일 : {date}</time></div></div><div id="articleBody">{body}</div>'
)


def article_id(n):
    return f"20260719{n:06d}"


def landed(spark, rows):
    """Listing and pages from ``(n, title, date, body)``; a body of None has no page."""
    listing = spark.createDataFrame(
        [(article_id(n), d, 1 + i // 3, i) for i, (n, _, d, _) in enumerate(rows)],
        "article_id string, published_at string, page int, pos bigint",
    )
    pages = spark.createDataFrame(
        [(article_id(n), PAGE.format(title=t, date=d, body=b)) for n, t, d, b in rows if b is not None],
        "article_id string, html string",
    )
    return listing, pages


ROWS = [
    (1, "Same title", "2026-07-19 09:00", "<p>Alpha beta. Gamma alpha.</p>"),
    (2, "Same title", "2026-07-19 10:00", "<p>Second one.</p>"),
    (3, "No body", "2026-07-18 09:00", ""),
    (4, "No page", "2026-07-18 09:00", None),
    (5, "한글 제목", "언젠가", "<p>시장 시장 보안. 보안 시장.</p>"),
]


def counts(counters):
    return tuple(counters.select("candidates", "processed", "failed").first())


def test_two_runs(spark, tmp_path):
    posts_dir, state_dir = str(tmp_path / "posts"), str(tmp_path / "state")
    listing, pages = landed(spark, ROWS)

    dry = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, OPTIONS, dry_run=True)
    assert dry.first().asDict() == {
        "candidates": 4, "processed": 4, "failed": 0, "missing": 1, "last_page": 2, "cut_page": None, "cap_hit": False,
    }
    assert not os.path.exists(posts_dir) and not os.path.exists(state_dir)

    first = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, OPTIONS)
    assert counts(first) == (4, 4, 0)
    state = state_source.read_state(spark, state_dir)
    assert {r.article_id for r in state.collect()} == {article_id(n) for n in (1, 2, 3, 5)}
    assert {r.processed_at for r in state.collect()} == {"2026-07-19T12:00:00.000000+09:00"}

    stored = post_source.read_posts(spark, posts_dir)
    current = {r.path: r for r in post_source.current_posts(stored).collect()}
    assert set(current) == {
        "2026-07-19-same-title.md", "2026-07-18-no-body.md", "2026-07-19-hangeul-jemog.md",
    }
    assert stored.count() == 4
    assert current["2026-07-19-same-title.md"].article_id == article_id(2)
    assert current["2026-07-19-hangeul-jemog.md"].content == (
        "---\nlayout: single\ntitle: 한글 제목\ndate: 2026-07-19 12:00:00 +0900\n"
        "categories: [news, ai-sw]\ntags: [시장, 보안]\nsource_url: https://n.example/20260719000005\n"
        "auto_generated: true\n---\n\n## Keywords\n시장, 보안\n\n## Summary\n시장 시장 보안. 보안 시장.\n\n"
        "---\n*This post was automatically generated from [N section](https://n.example/section?id1=04). "
        "[Read original article →](https://n.example/20260719000005)*\n"
    )
    empty = current["2026-07-18-no-body.md"].content
    assert "tags: []\n" in empty and "## Keywords\n\n\n## Summary\n\n\n---" in empty

    second = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r2", AS_OF, OPTIONS)
    assert counts(second) == (0, 0, 0)
    assert state_source.read_state(spark, state_dir).count() == 4
    assert not os.path.exists(f"{state_dir}/run_id=r2")

    # The page arrives later: only that article is new.
    listing, pages = landed(spark, [*ROWS[:3], (4, "No page", "2026-07-18 09:00", "Now here."), ROWS[4]])
    third = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r3", AS_OF, OPTIONS)
    assert counts(third) == (1, 1, 0)
    assert post_source.read_posts(spark, posts_dir).count() == 5

    parsed = post_source.parse_posts(post_source.current_posts(post_source.read_posts(spark, posts_dir)))
    check = quality.post_invariants(parsed).first().asDict()
    assert check == {
        "n_posts": 4, "tags_differ": 0, "dates_differ": 0, "seconds_set": 0, "short_tags": 0,
        "untagged": 1, "overtagged": 0,
    }


def test_a_run_leaves_no_scratch(spark, tmp_path):
    base = spark.conf.get("spark.checkpoint.dir")
    before = set(os.listdir(base))
    listing, pages = landed(spark, ROWS)
    done = daily_run.run(spark, listing, pages, str(tmp_path / "posts"), str(tmp_path / "state"), "r1", AS_OF, OPTIONS)
    assert counts(done) == (4, 4, 0)
    assert set(os.listdir(base)) == before


def test_repeated_run_replaces_itself(spark, tmp_path):
    posts_dir, state_dir = str(tmp_path / "posts"), str(tmp_path / "state")
    listing, pages = landed(spark, ROWS)
    for _ in range(2):
        daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, OPTIONS)
    assert post_source.read_posts(spark, posts_dir).count() == 4
    assert state_source.read_state(spark, state_dir).count() == 4


def test_digest_as_a_post_of_the_day(spark, tmp_path):
    posts_dir, state_dir, digest_dir = (str(tmp_path / n) for n in ("posts", "state", "digest"))
    options = daily_run.Options(output_mode="daily_digest", digest_as_post=True, style=STYLE, base_url="https://n.example")
    listing, pages = landed(spark, ROWS[:3])
    daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, options, digest_dir=digest_dir)
    files = sorted(os.listdir(f"{digest_dir}/post_date=2026-07-18"))
    text = "".join(open(f"{digest_dir}/post_date=2026-07-18/{f}").read() for f in files if f.startswith("part-"))
    assert text == (
        "---\nlayout: single\ntitle: Daily digest 2026-07-18\ndate: 2026-07-18 00:00:00 +0900\ncategories: [news, ai-sw]\n"
        "tags: [daily-digest]\nauto_generated: true\n---\n\n1 articles\n\n## [No body](https://n.example/20260719000003)\n\n\n\n"
    )
    pieces = daily_run.daily_digest_posts(post_source.read_posts(spark, posts_dir), STYLE).collect()
    assert sorted((str(p.post_date), p.entry_no, p.path) for p in pieces) == [
        ("2026-07-18", 0, "2026-07-18-daily-digest.md"), ("2026-07-18", 1, "2026-07-18-daily-digest.md"),
        *((("2026-07-19"), n, "2026-07-19-daily-digest.md") for n in range(3)),
    ]


def test_digest_mode_rewrites_the_days_with_new_posts(spark, tmp_path):
    posts_dir, state_dir, digest_dir = (str(tmp_path / n) for n in ("posts", "state", "digest"))
    options = daily_run.Options(output_mode="daily_digest", style=STYLE)
    listing, pages = landed(spark, ROWS)
    with pytest.raises(ValueError):
        daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, options)

    def digest():
        return sorted((str(r.post_date), r.value) for r in spark.read.text(digest_dir).collect())

    daily_run.run(spark, listing, pages, posts_dir, state_dir, "r1", AS_OF, options, digest_dir=digest_dir)
    first = digest()
    assert [d for d, _ in first] == ["2026-07-18", "2026-07-19", "2026-07-19"]
    assert first[0][1] == "- [No body](https://news.example.com/20260719000003)"
    listing, pages = landed(spark, [*ROWS[:3], (4, "No page", "2026-07-18 09:00", "Now here."), ROWS[4]])
    daily_run.run(spark, listing, pages, posts_dir, state_dir, "r2", AS_OF, options, digest_dir=digest_dir)
    assert [d for d, _ in digest()] == ["2026-07-18", "2026-07-18", "2026-07-19", "2026-07-19"]


def test_exported_posts_read_back(spark, tmp_path):
    content = "---\nlayout: single\n---\n\n## Keywords\na\n"
    posts = spark.createDataFrame([("2026-07-19-a.md", content), ("2026-07-19-b.md", content)], "path string, content string")
    post_source.export_post_files(posts, str(tmp_path / "x"))
    back = post_source.read_post_files(spark, str(tmp_path / "x"))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, posts.collect()))


def test_methods_and_missing(spark):
    listing, pages = landed(spark, ROWS)
    state = state_source.empty_state(spark)
    options = daily_run.Options(keyword_method="tfidf", summary_method="lead", style=STYLE)
    outcome = daily_run.plan_run(listing, pages, state, AS_OF, options)
    assert outcome.posts.count() == 4
    assert [r.article_id for r in outcome.missing.collect()] == [article_id(4)]
    digest = daily_run.daily_digest(outcome.posts).orderBy("post_date", "entry_no").collect()
    assert [(str(r.post_date), r.entry_no) for r in digest] == [
        ("2026-07-18", 1), ("2026-07-19", 1), ("2026-07-19", 2), ("2026-07-19", 3),
    ]
    for bad in ({"output_mode": "weekly"}, {"lookback_days": 0}, {"keyword_count": 0}, {"summary_sentences": 0}):
        with pytest.raises(ValueError):
            daily_run.Options(**bad)


def test_html_is_parsed_after_a_join_without_shuffle(spark, tmp_path):
    listing, pages = landed(spark, ROWS)
    path = str(tmp_path / "pages")
    pages.write.parquet(path)
    new_ids = listing.select("article_id", "page", "pos")
    articles = daily_run.new_articles(spark.read.parquet(path), new_ids, OPTIONS)
    plan = articles._jdf.queryExecution().executedPlan().toString()
    assert plan.index("regexp_replace(html") < plan.index("BroadcastHashJoin")
    assert "hashpartitioning" not in plan


def test_an_empty_listing_is_an_error(spark):
    listing, pages = landed(spark, ROWS)
    with pytest.raises(RuntimeError, match="no articles"):
        daily_run.plan_run(
            listing.filter("page > 99"), pages, state_source.empty_state(spark), AS_OF, OPTIONS
        )


def test_unreadable_page_is_counted_and_retried(spark, tmp_path):
    listing, pages = landed(spark, ROWS[:1])
    broken = pages.withColumn("html", F.lit(None).cast("string"))
    state_dir = str(tmp_path / "state")
    out = daily_run.run(spark, listing, broken, str(tmp_path / "posts"), state_dir, "r1", AS_OF, OPTIONS)
    assert counts(out) == (1, 0, 1)
    assert not os.path.exists(state_dir)


def test_listing_files(spark, tmp_path):
    (tmp_path / "listing-2.xml").write_text(
        "<items><item><art_code> 20260719000001 </art_code></item>"
        "<item><art_code>20260719000002</art_code><publish_date>2026-07-19 09:00</publish_date></item></items>"
    )
    (tmp_path / "listing-10.xml.gz").write_bytes(gzip.compress(b"<items><item><art_code>20260719000003</art_code></item></items>"))
    rows = listing_source.read_listing(spark, str(tmp_path)).orderBy("page", "pos").collect()
    assert [(r.article_id.strip(), r.published_at, r.page) for r in rows] == [
        ("20260719000001", "", 2), ("20260719000002", "2026-07-19 09:00", 2), ("20260719000003", "", 10),
    ]
    (tmp_path / "page_1_morning.xml").write_text("<items><item><art_code>20260719000009</art_code></item></items>")
    with pytest.raises(Exception, match="no page number"):
        listing_source.read_listing(spark, str(tmp_path)).collect()


def test_listing_order_survives_landing(spark, tmp_path):
    """Many part files per page, read back in tasks of another cut."""
    rows = [(article_id(i), "", 1 + i // 700, i) for i in range(2000)]
    listing = spark.createDataFrame(rows, "article_id string, published_at string, page int, pos bigint")
    listing_source.write_listing(listing.repartition(7), str(tmp_path / "l"))
    back = listing_source.read_listing(spark, str(tmp_path / "l")).orderBy("page", "pos").collect()
    assert [r.article_id for r in back] == [r[0] for r in rows]


def test_all_pages_are_walked(spark):
    """More pages than any limit, and an item without a page number."""
    listing = spark.createDataFrame(
        [(article_id(i), "2026-07-19 09:00", i, i) for i in range(1, 26)], "article_id string, published_at string, page int, pos bigint"
    )
    pages = listing.select("article_id", F.lit("<p>x</p>").alias("html"))
    outcome = daily_run.plan_run(listing, pages, state_source.empty_state(spark), AS_OF, OPTIONS)
    assert counts(outcome.counters) == (25, 25, 0)
    limited = daily_run.Options(base_url="https://n.example", style=STYLE, max_pages=20)
    outcome = daily_run.plan_run(listing, pages, state_source.empty_state(spark), AS_OF, limited)
    row = outcome.counters.first()
    assert (row.candidates, row.last_page, row.cap_hit) == (20, 20, True)
    lost = listing.withColumn("page", F.when(F.col("page") != 7, F.col("page")))
    with pytest.raises(Exception, match="no page number"):
        daily_run.plan_run(lost, pages, state_source.empty_state(spark), AS_OF, OPTIONS)


def test_a_page_landed_twice_is_one_article(spark):
    listing, pages = landed(spark, ROWS)
    again = pages.withColumn("landed_at", F.lit(1)).unionByName(
        pages.filter(F.col("article_id") == article_id(1)).select(
            "article_id", F.replace("html", F.lit("Same"), F.lit("Newer")).alias("html"), F.lit(2).alias("landed_at")
        )
    )
    outcome = daily_run.plan_run(listing, again, state_source.empty_state(spark), AS_OF, OPTIONS)
    assert counts(outcome.counters) == (4, 4, 0)
    titles = {r.article_id: r.title for r in outcome.candidates.collect()}
    assert titles[article_id(1)] == "Newer title"


def test_a_backfill_sees_later_runs(spark, tmp_path):
    posts_dir, state_dir = str(tmp_path / "posts"), str(tmp_path / "state")
    listing, pages = landed(spark, ROWS)
    daily_run.run(spark, listing, pages, posts_dir, state_dir, "r5", AS_OF, OPTIONS)
    back = daily_run.run(spark, listing, pages, posts_dir, state_dir, "r2", AS_OF, OPTIONS)
    assert counts(back) == (0, 0, 0)
    state_source.compact_state(spark, state_dir, str(tmp_path / "compact"))
    compact = state_source.read_state(spark, str(tmp_path / "compact"))
    assert sorted(map(tuple, compact.collect())) == sorted(map(tuple, state_source.read_state(spark, state_dir).collect()))


def test_page_files(spark, tmp_path):
    (tmp_path / "20260719000001.html").write_text("<h2>a\nb</h2>")
    row = page_source.read_page_files(spark, str(tmp_path)).first()
    assert (row.article_id, row.html) == ("20260719000001", "<h2>a\nb</h2>")


def test_state_json(spark, tmp_path):
    assert state_source.read_state_json(spark, str(tmp_path / "none")).count() == 0
    folder = tmp_path / "state"
    folder.mkdir()
    stamp = "2026-08-20T10:01:43.174481+09:00"
    (folder / "good.json").write_text(json.dumps({"processed_ids": ["1", "2"], "last_run_at": stamp}, indent=2))
    (folder / "nolist.json").write_text(json.dumps({"processed_ids": "1"}))
    (folder / "noids.json").write_text("{}")
    (folder / "broken.json").write_text('{"processed_ids": ["9"')
    rows = state_source.read_state_json(spark, str(folder)).collect()
    assert sorted(map(tuple, rows)) == [("1", stamp), ("2", stamp)]
    bad = state_source.corrupt_state_json(spark, str(folder), AS_OF).collect()
    assert [os.path.basename(r.quarantine) for r in bad] == ["broken.json.corrupt.20260719120000"]
    assert bad[0].value.startswith('{"processed_ids"')
    for _ in range(2):
        assert state_source.quarantine_state_json(spark, str(folder), str(tmp_path / "q"), AS_OF) == 1


def test_large_state_document(spark, tmp_path):
    """A valid document of any size is read; the variant type would drop it beyond 16 MB."""
    ids = [f"{20260719000000 + i}" for i in range(1_200_000)]
    (tmp_path / "s.json").write_text(json.dumps({"processed_ids": ids, "last_run_at": "x"}))
    assert state_source.read_state_json(spark, str(tmp_path)).count() == len(ids)
    assert state_source.corrupt_state_json(spark, str(tmp_path), AS_OF).count() == 0


def test_state_json_round_trip(spark, tmp_path):
    ids = spark.range(500).select(F.col("id").cast("string").alias("article_id"))
    state_source.export_state_json(ids, str(tmp_path / "s"), AS_OF, documents=7)
    assert state_source.read_state_json(spark, str(tmp_path / "s")).select("article_id").distinct().count() == 500


def test_post_files(spark, tmp_path):
    (tmp_path / "2026-07-21-x.md").write_text(
        "---\nlayout: single\ntitle: 'a: b ''c'''\ndate: 2026-07-21 16:00:00 +0900\ncategories: [news]\n"
        "tags: [산업, '42']\nsource_url: https://n.example/20260721000088\nauto_generated: true\n---\n\n"
        "## Keywords\n산업, 42\n\n## Summary\nline one\nline two\n\n---\n*This post was automatically generated.*\n"
    )
    row = post_source.parse_posts(post_source.read_post_files(spark, str(tmp_path))).first()
    assert row.title == "a: b 'c'" and row.tags == ["산업", "42"] and row.article_id == "20260721000088"
    assert row.summary == "line one\nline two" and row.keyword_line == "산업, 42" and row.auto_generated


def _events(spark, path):
    """Three files, in which ids repeat within and across files; one time is unknown."""
    rows = [
        [("a", "2026-07-18 01:00:00"), ("a", "2026-07-18 02:00:00"), ("b", "2026-07-18 03:00:00")],
        [("a", "2026-07-19 01:00:00"), ("c", None), ("old", "2026-07-01 00:00:00")],
        [("b", "2026-07-19 01:00:00"), ("d", "2026-07-19 02:00:00")],
    ]
    schema = "article_id string, published_ts timestamp"
    for i, part in enumerate(rows):
        df = spark.createDataFrame(part, "article_id string, t string")
        df.select("article_id", F.col("t").cast("timestamp").alias("published_ts")).coalesce(1).write.parquet(f"{path}/{i}")
    return schema


def test_incremental_stream_is_exact_across_batches_and_restarts(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = _events(spark, source)

    def keep(batch):
        return batch.filter("published_ts IS NULL OR published_ts >= TIMESTAMP '2026-07-12 00:00:00'")

    for _ in range(2):
        stream = incremental.file_stream(spark, f"{source}/*", schema, files_per_batch=1)
        incremental.incremental_ingest(
            stream, str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"), AS_OF, keep
        ).awaitTermination()
        rows = spark.read.parquet(str(tmp_path / "out")).collect()
        assert sorted(r.article_id for r in rows) == ["a", "b", "c", "d"]
        assert state_source.read_state(spark, str(tmp_path / "state")).count() == 4


def test_a_new_checkpoint_loses_nothing(spark, tmp_path):
    """Another stream, or one whose checkpoint is lost, adds to filled folders."""
    for i, ids in enumerate((["1", "2", "3"], ["3", "4"])):
        source = str(tmp_path / f"in{i}")
        rows = spark.createDataFrame([(x,) for x in ids], "article_id string").withColumn("published_ts", F.lit(None).cast("timestamp"))
        rows.write.parquet(source)
        incremental.incremental_ingest(
            incremental.file_stream(spark, source, rows.schema), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / f"cp{i}"), AS_OF
        ).awaitTermination()
    assert sorted(r.article_id for r in spark.read.parquet(str(tmp_path / "out")).collect()) == ["1", "2", "3", "4"]
    assert state_source.read_state(spark, str(tmp_path / "state")).count() == 4


def test_keep_comes_before_the_first_row(spark, tmp_path):
    """An id whose first row is too old enters with its later row."""
    source = str(tmp_path / "in")
    rows = spark.createDataFrame([("a", "2026-07-01 00:00:00"), ("a", "2026-07-18 00:00:00")], "article_id string, t string")
    rows = rows.select("article_id", F.col("t").cast("timestamp").alias("published_ts"))
    rows.coalesce(1).write.parquet(source)
    incremental.incremental_ingest(
        incremental.file_stream(spark, source, rows.schema), str(tmp_path / "out"), str(tmp_path / "state"), str(tmp_path / "cp"), AS_OF,
        keep=lambda batch: batch.filter("published_ts >= TIMESTAMP '2026-07-12 00:00:00'"),
    ).awaitTermination()
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1


def test_undated_rows_come_out_beside_the_counts(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = _events(spark, source)
    stream = incremental.file_stream(spark, f"{source}/*", schema)
    incremental.append_to(incremental.undated(stream), str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    assert [r.article_id for r in spark.read.parquet(str(tmp_path / "out")).collect()] == ["c"]


def test_daily_stream_equals_batch(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = _events(spark, source)
    stream = incremental.file_stream(spark, f"{source}/*", schema, files_per_batch=3)
    counts = incremental.daily_counts(stream, delay="0 seconds")
    incremental.append_to(counts, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    got = {str(r.post_date): r.n_entries for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {"2026-07-01": 1, "2026-07-18": 3}


def test_bounded_dedup(spark, tmp_path):
    source = str(tmp_path / "in")
    schema = _events(spark, source)
    stream = incremental.file_stream(spark, f"{source}/*", schema)
    deduped = incremental.bounded_dedup(stream.filter("published_ts IS NOT NULL")).select("article_id")
    incremental.append_to(deduped, str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination()
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert sorted(r.article_id for r in rows) == ["a", "b", "d", "old"]
