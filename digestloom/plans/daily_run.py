"""The daily job: listing, new ids, pages, articles, keywords, summaries, posts, state."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions import post
from digestloom.operators.discover import MAX_PAGES, discover, discovery_report, recent, require_items
from digestloom.operators.isolate import Guarded
from digestloom.operators.keywords import Tokenizer
from digestloom.operators.processed import unprocessed_few
from digestloom.operators.quality import missing_pages, run_counters
from digestloom.operators.segments import add_segment, read_segments, stored_frequencies
from digestloom.operators.skew import broadcast_if_small
from digestloom.operators.textrank import Splitter
from digestloom.operators.transliterate import unspelled_titles, with_spelling
from digestloom.operators.views import digest_entries, write_digest
from digestloom.plans.methods import OUTPUT_MODES, against_known, extract_keywords, method_name, prepare, prepared_tokenizer, summarise
from digestloom.session import materialise, scratch_released
from digestloom.sources.pages import PageLayout, parse_articles
from digestloom.sources.posts import PostStyle, current_posts, read_posts, render_posts, write_posts
from digestloom.sources.store import Store
from digestloom.sources.state import append_state, quarantine_state_json, read_state, read_state_json


@dataclass(frozen=True)
class Options:
    lookback_days: int = 7
    max_pages: int | None = MAX_PAGES
    keyword_method: str | Callable[..., DataFrame] = "tf"
    keyword_count: int = 7
    summary_method: str | Callable[..., DataFrame] = "textrank"
    summary_sentences: int = 4
    output_mode: str = "per_article"
    digest_as_post: bool = False  # a day's digest with front matter, keywords and summaries, not only lines
    base_url: str = "https://news.example.com"
    section: str = "AI/SW"
    page_layout: PageLayout = PageLayout()
    style: PostStyle = PostStyle(section_url="https://news.example.com/section")
    tokenizer: Tokenizer | Guarded | None = None
    splitter: Splitter | Guarded | None = None  # sentences and words for the summary
    parser: Guarded | None = None  # reads a page instead of ``page_layout``
    readings: DataFrame | None = None  # ``text, reading`` of letters and phrases, for paths
    corpus: DataFrame | None = None  # other texts (``raw_text``) that ``tfidf`` weighs terms by
    vectors: tuple[DataFrame, DataFrame] | None = None  # of terms and of articles, for ``keybert``

    def __post_init__(self) -> None:
        if self.output_mode not in OUTPUT_MODES:
            raise ValueError(f"unknown output mode {self.output_mode!r} (expected one of {OUTPUT_MODES})")
        for name in ("lookback_days", "keyword_count", "summary_sentences"):
            if getattr(self, name) < 1:
                raise ValueError(f"{name} must be at least 1")


@dataclass(frozen=True)
class Outcome:
    """Results of one run. The new articles are written down; the rest is computed on use."""

    candidates: DataFrame  # new articles, with ``error``: of a page, or of a guarded function
    posts: DataFrame  # rendered posts of the good ones
    missing: DataFrame  # listed ids without a landed page
    unspelled: DataFrame  # ids of good articles whose title has letters that the path drops, and how many
    report: DataFrame  # last page walked, page that cut the walk, whether the limit ended it
    counters: DataFrame  # one row: the counts of a run, missing pages and the report

    @property
    def failures(self) -> DataFrame:
        """``(article_id, error)`` of the articles that failed. They stay unprocessed."""
        return self.candidates.filter(F.col("error").isNotNull()).select("article_id", "error")


def one_page_per_id(pages: DataFrame, ids: DataFrame) -> DataFrame:
    """Pages of the given ids, the newest of each id: a repeated download lands a page again.

    The newest has the largest ``landed_at``, if there is such a column, then the larger text.
    Only ids that occur twice are gathered; usually there are none, and no HTML moves.
    """
    wanted = broadcast_if_small(ids.select("article_id"))
    columns = ["article_id", "html", *(["landed_at"] if "landed_at" in pages.columns else [])]
    own = pages.select(*columns).join(wanted, "article_id", "left_semi")
    again = materialise(
        own.groupBy("article_id").agg(F.count("*").alias("n")).filter("n > 1").select("article_id"), "landed-twice"
    )
    if again.isEmpty():
        return own.select("article_id", "html")
    again = broadcast_if_small(again)
    newest = F.max_by("html", F.struct(*[c for c in columns[::-1] if c != "article_id"]))
    twice = own.join(again, "article_id", "left_semi").groupBy("article_id").agg(newest.alias("html"))
    return own.join(again, "article_id", "left_anti").select("article_id", "html").unionByName(twice)


def new_articles(pages: DataFrame, new_ids: DataFrame, options: Options) -> DataFrame:
    """Parsed articles of the new ids.

    ``pages`` holds one row ``(article_id, html)`` per article. HTML is matched by a
    size-checked broadcast of the ids, so it is not shuffled, and parsed after the join.
    """
    return parse_articles(
        pages.select("article_id", "html").join(broadcast_if_small(new_ids), "article_id"),
        options.base_url, options.section, options.page_layout, options.parser,
    )


def process_new(new_ids: DataFrame, pages: DataFrame, as_of, options: Options = Options()) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Candidates, posts and unspelled titles (see ``Outcome``) of written-down new ids."""
    landed = one_page_per_id(pages, new_ids)
    articles = recent(new_articles(landed, new_ids, options), as_of, options.lookback_days)
    candidates = materialise(
        prepare(
            articles, "raw_text", tokenizer=options.tokenizer, splitter=options.splitter,
            keyword_method=options.keyword_method, summary_method=options.summary_method,
        ),
        "articles",
    )
    good = candidates.filter(F.col("error").isNull())
    extracted = summarise(
        extract_keywords(
            good, options.keyword_method, options.keyword_count, "article_id", "raw_text",
            options.tokenizer, options.corpus, options.vectors,
        ),
        options.summary_method, options.summary_sentences, "raw_text", options.splitter,
    )
    posts = render_posts(extracted, as_of, options.style, options.readings).withColumn(
        "method", F.lit(f"{method_name(options.keyword_method)}+{method_name(options.summary_method)}")
    )
    titles = good.select("article_id", "title")
    if options.readings is not None:
        titles = with_spelling(titles, "title", options.readings, "title")
    unspelled = unspelled_titles(titles)
    return candidates, posts, unspelled


def plan_run(listing: DataFrame, pages: DataFrame, state: DataFrame | Callable[[DataFrame], DataFrame], as_of,
             options: Options = Options()) -> Outcome:
    """Everything of a run but its commit.

    ``state`` may be a function that gets the discovered ids and reads only what concerns them.

    Known ids are dropped before any HTML is read, so the work follows the number of *new*
    articles. What several steps need is written once: the discovered ids, the new ids, and
    the parsed articles (a fraction of their HTML), from which keywords, summaries and
    counters are computed. Guarded functions of the options are called before the articles are
    written, each once: an article that one of them fails on is a failed one, and the others go on.
    """
    found = materialise(
        discover(listing, as_of, options.lookback_days, options.max_pages), "discovered"
    )
    require_items(found)
    state = state(found) if callable(state) else state
    new_ids = materialise(
        unprocessed_few(found.select("article_id", "page", "pos"), state), "new-ids"
    )
    candidates, posts, unspelled = process_new(new_ids, pages, as_of, options)
    missing = missing_pages(broadcast_if_small(new_ids.select("article_id")), pages)
    report = discovery_report(listing, as_of, options.lookback_days, options.max_pages)
    # Three tables of one row each.
    counters = run_counters(candidates).crossJoin(missing.agg(F.count("*").alias("missing"))).crossJoin(report)
    if options.readings is not None:
        counters = counters.withColumn("unspelled", unspelled.agg(F.coalesce(F.sum("unspelled"), F.lit(0))).scalar())
    return Outcome(candidates=candidates, posts=posts, missing=missing, unspelled=unspelled, report=report, counters=counters)


def run(spark: SparkSession, listing: DataFrame, pages: DataFrame, posts_dir: str, state_dir: str,
        run_id: str, as_of, options: Options = Options(), dry_run: bool = False,
        digest_dir: str | None = None, failures_dir: str | None = None,
        state_json: str | None = None, quarantine_dir: str | None = None,
        index_dir: str | None = None) -> DataFrame:
    """Run once and return the counters. ``run_id`` names the run (for example a timestamp).

    Output mode ``daily_digest`` also rewrites, below ``digest_dir``, the digests of the days
    that got new posts. ``failures_dir`` gets ``(article_id, error)`` of the articles that failed,
    by run. Ids in JSON state documents at ``state_json`` count as processed, too; broken documents
    are copied to ``quarantine_dir`` and counted (``quarantined``), and the run goes on.

    ``index_dir`` gets the run's articles as a segment of a full-text index, and keyword method
    ``tfidf`` then weighs terms by what all other runs have put there, without reading their texts.

    Posts are written before the state. A run that dies in between leaves its ids
    unprocessed and is repeated under the same ``run_id``, which replaces its own output.
    """
    if options.output_mode == "daily_digest" and digest_dir is None:
        raise ValueError("output mode daily_digest needs a digest_dir")
    if state_json is not None and quarantine_dir is None:
        raise ValueError("state_json needs a quarantine_dir for broken documents")
    with scratch_released(spark):
        folders = (posts_dir, state_dir, digest_dir, failures_dir, state_json, quarantine_dir, index_dir)
        counters = _commit(spark, listing, pages, folders, run_id, as_of, options, dry_run)
        # One row, which may outlive what the run wrote down for itself.
        return spark.createDataFrame(counters.collect(), counters.schema)


def run_in_store(listing: DataFrame, pages: DataFrame, store: Store, run_id: str, as_of, options: Options = Options()) -> DataFrame:
    """Run once into a ``Store``: posts and state count together or not at all. Returns the counters.

    A run that dies leaves nothing that a reader sees; its ids are unprocessed.
    """
    with scratch_released(store.spark):
        began = store.version()
        outcome = plan_run(listing, pages, lambda found: store.state(run_id, found, began), as_of, options)
        counters = store.spark.createDataFrame(outcome.counters.collect(), outcome.counters.schema)
        store.write_run(outcome.posts, run_id, as_of, began)
        return counters


def _commit(spark, listing, pages, folders, run_id, as_of, options, dry_run) -> DataFrame:
    posts_dir, state_dir, digest_dir, failures_dir, state_json, quarantine_dir, index_dir = folders
    if index_dir is not None and options.keyword_method == "tfidf" and options.corpus is None:
        others = read_segments(spark, index_dir, except_run=run_id)
        if others is not None:
            frequencies, n_docs = stored_frequencies(others)
            options = replace(options, keyword_method=against_known(materialise(frequencies, "known-terms"), n_docs))
    quarantined = 0
    if state_json is not None and not dry_run:
        quarantined = quarantine_state_json(spark, state_json, quarantine_dir, as_of)

    def state(found: DataFrame) -> DataFrame:
        own = read_state(spark, state_dir, except_run=run_id, ids=found)
        return own if state_json is None else own.unionByName(read_state_json(spark, state_json))

    outcome = plan_run(listing, pages, state, as_of, options)
    counters = outcome.counters
    if state_json is not None:
        counters = counters.withColumn("quarantined", F.lit(quarantined))
    if dry_run:
        return counters
    if failures_dir is not None:
        outcome.failures.write.mode("overwrite").parquet(f"{failures_dir}/run_id={run_id}")
    write_posts(outcome.posts, posts_dir, run_id)
    written = read_posts(spark, posts_dir).filter(F.col("run_id") == run_id)
    if not written.isEmpty():
        if options.output_mode == "daily_digest":
            # One row per day: bounded by the calendar.
            days = F.broadcast(written.select("post_date").distinct())
            posts = current_posts(read_posts(spark, posts_dir).join(days, "post_date", "left_semi"))
            if options.digest_as_post:
                write_digest(daily_digest_posts(posts, options.style), "value", digest_dir)
            else:
                write_digest(daily_digest(posts), "line", digest_dir)
        if index_dir is not None:
            good = outcome.candidates.filter(F.col("error").isNull())
            add_segment(good, index_dir, run_id, "article_id", "raw_text", prepared_tokenizer(good, options.tokenizer))
        append_state(written, state_dir, run_id, as_of)
    return counters


def daily_digest(posts: DataFrame) -> DataFrame:
    """Posts combined by day (output mode ``daily_digest``): one row per line of a day's digest."""
    narrow = posts.select("post_date", "article_id", "title", "url")
    return digest_entries(narrow, "post_date", "article_id").select(
        "post_date", "entry_no", "article_id",
        F.concat(F.lit("- ["), F.col("title"), F.lit("]("), F.col("url"), F.lit(")")).alias("line"),
    )


def daily_digest_posts(posts: DataFrame, style: PostStyle) -> DataFrame:
    """One combined post per day, by pieces: ``post_date, path, entry_no, value``.

    Piece 0 has the front matter and the number of articles, the others an article each, newest
    first. The pieces of a day are not gathered; in their order they are the lines of its file.
    """
    narrow = posts.select("post_date", "article_id", "title", "url", "keywords", "summary")
    entry = post.digest_entry("title", "url", "coalesce(keywords, CAST(array() AS ARRAY<STRING>))", "coalesce(summary, '')")
    entries = digest_entries(narrow, "post_date", "article_id").select("post_date", F.col("entry_no").cast("long").alias("entry_no"), F.expr(entry).alias("value"))
    day = F.date_format("post_date", "yyyy-MM-dd")
    head = F.concat(F.expr(post.digest_front_matter("_day", style.categories, style.layout)), F.lit("\n\n"), F.col("n").cast("string"), F.lit(" articles"))
    heads = narrow.groupBy("post_date").agg(F.count("*").alias("n")).withColumn("_day", day)
    pieces = heads.select("post_date", F.lit(0).cast("long").alias("entry_no"), head.alias("value")).unionByName(entries)
    return pieces.select("post_date", F.concat(day, F.lit("-daily-digest.md")).alias("path"), "entry_no", "value")
