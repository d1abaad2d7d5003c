"""From listing pages to the ids worth fetching."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.functions.dates import cutoff, published_ts, within_lookback
from digestloom.functions.text import strip
from digestloom.functions.urls import valid_id

# Landed pages cost no requests, so a run reads them all unless it is given a limit.
MAX_PAGES = None


def listed_items(listing: DataFrame, max_pages: int | None = MAX_PAGES) -> DataFrame:
    """Well-formed items of the pages a run may read; a missing date becomes empty.

    An item without a page number ends the run: it could not be placed in the walk.
    """
    page = F.coalesce("page", F.raise_error(F.lit("a listing item has no page number")).cast("int"))
    kept = page >= 1 if max_pages is None else page.between(1, max_pages)
    return (
        listing.filter(kept)
        .filter(valid_id("article_id"))
        .withColumn("article_id", F.expr(strip("article_id")))
        .withColumn("published_at", F.expr(strip("coalesce(published_at, '')")))
    )


def first_occurrences(items: DataFrame) -> DataFrame:
    """Each id once, where it is listed first; combined before the shuffle."""
    first = F.min(F.struct("page", "pos", "published_at"))
    return items.groupBy("article_id").agg(first.alias("at")).select("article_id", "at.*")


def _stops(items: DataFrame, firsts: DataFrame, as_of: datetime | str, lookback_days: int) -> tuple[DataFrame, DataFrame]:
    """One-row tables: the last page before the first gap, and the first page with an old item."""
    # The walk reaches the first page, from page 0 on, that has no successor.
    pages = items.select("page").distinct()
    reached = items.sparkSession.range(1).select(F.lit(0).alias("page")).unionByName(pages)
    before = pages.select((F.col("page") - 1).alias("page"))
    gap = reached.join(before, "page", "left_anti").agg(F.min("page").alias("last_page"))
    old = f"{published_ts('published_at')} < {cutoff(lookback_days, as_of)}"
    cut = firsts.filter(old).agg(F.min("page").alias("cut_page"))
    return gap, cut


def discover(
    listing: DataFrame,
    as_of: datetime | str,
    lookback_days: int = 7,
    max_pages: int | None = MAX_PAGES,
) -> DataFrame:
    """Ids found by walking the pages in order: ``(article_id, page, pos, published_at)``.

    The walk ends after the first page that shows an item older than the lookback, before
    the first page without items, and at the page limit, if there is one.
    """
    items = listed_items(listing, max_pages)
    firsts = first_occurrences(items)
    gap, cut = _stops(items, firsts, as_of, lookback_days)
    # ``least`` leaves out a null: without an old item the gap decides.
    return firsts.filter(F.col("page") <= F.least(gap.scalar(), cut.scalar()))


def discovery_report(
    listing: DataFrame,
    as_of: datetime | str,
    lookback_days: int = 7,
    max_pages: int | None = MAX_PAGES,
) -> DataFrame:
    """One row: pages walked, the page that ended the walk, and whether the limit ended it."""
    items = listed_items(listing, max_pages)
    firsts = first_occurrences(items)
    gap, cut = _stops(items, firsts, as_of, lookback_days)
    last_page = F.least("last_page", "cut_page")
    at_limit = F.lit(False) if max_pages is None else F.col("last_page") == max_pages
    return (
        gap.withColumn("cut_page", cut.scalar())
        .withColumn("cut_page", F.when(F.col("cut_page") <= F.col("last_page"), F.col("cut_page")))
        .select(
            last_page.alias("last_page"),
            "cut_page",
            (F.col("cut_page").isNull() & at_limit).alias("cap_hit"),
        )
    )


def recent(articles: DataFrame, as_of: datetime | str, lookback_days: int = 7) -> DataFrame:
    """Articles inside the lookback window; unparseable dates are kept."""
    return articles.filter(within_lookback("published_at", lookback_days, as_of))


def require_items(discovered: DataFrame) -> DataFrame:
    """An empty listing is an error (nothing *new* is not). Reads until the first row."""
    if discovered.isEmpty():
        raise RuntimeError("no articles discovered: the listing is empty or has changed")
    return discovered
