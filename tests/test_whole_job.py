"""The daily job as a stream equals the batch run; pages may land later than their listing."""

import pytest
from pyspark.sql import functions as F

from digestloom.plans import daily_run
from digestloom.sources.store import Store
from digestloom.streaming import incremental, whole_job
from tests.test_runs import AS_OF, PAGE, STYLE, article_id

OPTIONS = daily_run.Options(base_url="https://n.example", style=STYLE, summary_method="lead")
LISTING = "article_id string, published_at string, page int, pos bigint, listed_at timestamp"
PAGES = "article_id string, html string, landed_at timestamp"


class Feed:
    """Folders that listing and pages land in, and the stream over them."""

    def __init__(self, spark, base):
        self.spark, self.base, self.n = spark, base, 0
        self.store = Store(spark, f"{base}/store")
        for name, schema in (("listing", LISTING), ("pages", PAGES)):
            spark.createDataFrame([], schema).write.parquet(f"{base}/{name}")

    def land(self, items=(), pages=()):
        rows = [(article_id(n), "2026-07-19 09:00", 1, n, at) for n, at in items]
        self.spark.createDataFrame(rows, "a string, b string, c int, d bigint, e string").select(
            F.col("a").alias("article_id"), F.col("b").alias("published_at"), F.col("c").alias("page"), F.col("d").alias("pos"), F.col("e").cast("timestamp").alias("listed_at")
        ).coalesce(1).write.mode("append").parquet(f"{self.base}/listing")
        rows = [(article_id(n), PAGE.format(title=t, date="2026-07-19 09:00", body=f"<p>{t} text.</p>"), at) for n, t, at in pages]
        self.spark.createDataFrame(rows, "a string, b string, c string").select(
            F.col("a").alias("article_id"), F.col("b").alias("html"), F.col("c").cast("timestamp").alias("landed_at")
        ).coalesce(1).write.mode("append").parquet(f"{self.base}/pages")

    def run(self, options=OPTIONS):
        listing = incremental.file_stream(self.spark, f"{self.base}/listing", LISTING)
        pages = incremental.file_stream(self.spark, f"{self.base}/pages", PAGES)
        whole_job.run_as_stream(listing, pages, self.store, f"{self.base}/missing", f"{self.base}/checkpoint", AS_OF, options).awaitTermination()

    def posts(self):
        return sorted((r.article_id, r.path, r.content) for r in self.store.posts().collect())

    def missing(self):
        return [r.article_id for r in self.spark.read.schema("article_id string").parquet(f"{self.base}/missing").collect()]


def test_items_wait_for_their_pages(spark, tmp_path):
    feed = Feed(spark, str(tmp_path))
    feed.land([(1, "2026-07-19 09:00:00"), (2, "2026-07-19 09:00:00"), (3, "2026-07-19 09:00:00")], [(1, "One", "2026-07-19 09:10:00")])
    feed.run()
    assert [p[0] for p in feed.posts()] == [article_id(1)]
    # Listed again, and a page that lands before its item.
    feed.land([(1, "2026-07-19 09:20:00")], [(4, "Four", "2026-07-19 09:30:00")])
    feed.run()
    assert [p[0] for p in feed.posts()] == [article_id(1)] and feed.missing() == []
    # Two batches after its listing the page is there, twice; the later version counts.
    feed.land([(4, "2026-07-19 10:00:00")], [(2, "Old", "2026-07-19 09:40:00"), (2, "Two", "2026-07-19 10:00:00")])
    feed.run()
    # Once more: it is not posted again.
    feed.land([], [(2, "Newer", "2026-07-19 10:10:00")])
    feed.run()
    posted = feed.posts()
    assert [p[0] for p in posted] == [article_id(n) for n in (1, 2, 4)] and "title: Two" in posted[1][2]
    # Time goes on: the third item has waited too long, and comes out once.
    for hour in (0, 2, 4):
        feed.land([(5 + hour, f"2026-07-23 0{hour}:00:00")], [(5 + hour, f"N{hour}", f"2026-07-23 0{hour}:10:00")])
        feed.run()
    assert feed.missing() == [article_id(3)]
    assert feed.store.state().count() == len(feed.posts()) == 6
    # The batch run over everything that landed gives the same posts.
    listing = spark.read.schema(LISTING).parquet(f"{tmp_path}/listing").filter("page = 1")
    pages = spark.read.schema(PAGES).parquet(f"{tmp_path}/pages").filter("NOT contains(html, 'Newer')")
    whole = Store(spark, str(tmp_path / "batch"))
    daily_run.run_in_store(listing, pages, whole, "r", AS_OF, OPTIONS)
    assert sorted((r.article_id, r.path, r.content) for r in whole.posts().collect()) == feed.posts()


def test_a_batch_that_dies_is_repeated_whole(spark, tmp_path, monkeypatch):
    feed = Feed(spark, str(tmp_path))
    feed.land([(1, "2026-07-19 09:00:00")], [(1, "One", "2026-07-19 09:10:00")])

    def dies(*_, **__):
        raise RuntimeError("gone")

    with monkeypatch.context() as m:
        m.setattr(Store, "commit", dies)
        with pytest.raises(Exception, match="gone"):
            feed.run()
    assert feed.posts() == []
    feed.run()
    assert [p[0] for p in feed.posts()] == [article_id(1)] and feed.store.state().count() == 1
