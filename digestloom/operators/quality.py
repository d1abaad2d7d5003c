"""Counters and invariants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def run_counters(candidates: DataFrame, error_col: str = "error") -> DataFrame:
    """Candidates, processed and failed of a run, in one row."""
    error = F.col(error_col)
    return candidates.agg(
        F.count("*").alias("candidates"),
        F.count_if(error.isNull()).alias("processed"),
        F.count_if(error.isNotNull()).alias("failed"),
    )


def missing_pages(ids: DataFrame, pages: DataFrame) -> DataFrame:
    """Ids whose page was not landed; they stay unprocessed and are tried again.

    Pages are reduced to the ids in question first: with few ids that is a broadcast, and the
    page table is read by one narrow column without a shuffle.
    """
    landed = pages.select("article_id").join(ids.select("article_id"), "article_id", "left_semi")
    return ids.join(landed.distinct(), "article_id", "left_anti")


def post_invariants(posts: DataFrame) -> DataFrame:
    """Violations per rule over parsed posts, in one pass."""
    day = F.substring("date", 1, 10)
    return posts.agg(
        F.count("*").alias("n_posts"),
        F.count_if(F.array_join("tags", ", ") != F.col("keyword_line")).alias("tags_differ"),
        F.count_if(F.substring("path", 1, 10) != day).alias("dates_differ"),
        F.count_if(F.substring("date", 18, 2) != "00").alias("seconds_set"),
        F.count_if(F.exists("tags", lambda t: F.length(t) < 2)).alias("short_tags"),
        F.count_if(F.size("tags") == 0).alias("untagged"),
        F.count_if(F.size("tags") > 7).alias("overtagged"),
    )
