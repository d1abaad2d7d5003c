"""The set of processed ids."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.operators.skew import broadcast_if_small


def unprocessed(articles: DataFrame, state: DataFrame) -> DataFrame:
    """Articles whose id is not in the state.

    The state grows without bound, so there is no broadcast hint: adaptive execution
    broadcasts it while it measures small and merges sorted partitions beyond that. Its ids
    are reduced to one row each before the join.
    """
    return articles.join(state.select("article_id").distinct(), "article_id", "left_anti")


def unprocessed_few(articles: DataFrame, state: DataFrame) -> DataFrame:
    """The same for written-down articles that are few next to the state.

    The state is reduced to their ids first, by a size-checked broadcast, so that a run over
    a few thousand new ids does not shuffle everything processed so far.
    """
    ids = broadcast_if_small(articles.select("article_id").distinct())
    return unprocessed(articles, state.join(ids, "article_id", "left_semi"))


def merge_state(old: DataFrame, new: DataFrame) -> DataFrame:
    """Idempotent add: each id once, with the time it was processed first."""
    both = old.select("article_id", "processed_at").unionByName(
        new.select("article_id", "processed_at")
    )
    return both.groupBy("article_id").agg(F.min("processed_at").alias("processed_at"))


def audit_state(state: DataFrame, posts: DataFrame) -> DataFrame:
    """Every known id once, with ``in_state`` and ``in_posts``: one shuffle for both differences."""
    tagged = state.select("article_id", F.lit(True).alias("s"), F.lit(False).alias("p")).unionByName(
        posts.select("article_id", F.lit(False).alias("s"), F.lit(True).alias("p"))
    )
    return tagged.groupBy("article_id").agg(
        F.max("s").alias("in_state"), F.max("p").alias("in_posts")
    )


def state_without_post(state: DataFrame, posts: DataFrame) -> DataFrame:
    """Processed ids that have no post."""
    return audit_state(state, posts).filter("in_state AND NOT in_posts").select("article_id")


def state_with_post(state: DataFrame, posts: DataFrame) -> DataFrame:
    """Processed ids that have a post."""
    return audit_state(state, posts).filter("in_state AND in_posts").select("article_id")
