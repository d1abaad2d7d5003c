"""Reader-facing views: tags, archive, trends, digests, pages and feed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.operators.skew import each, global_row_number, top_per_group


def tag_counts(tagged: DataFrame, tags_col: str = "tags") -> DataFrame:
    """Posts per tag (or per category)."""
    return (
        each(tagged, tags_col, "tag")
        .groupBy("tag")
        .agg(F.count("*").alias("n_posts"))
    )


def archive_counts(posts: DataFrame, date_col: str = "post_date") -> DataFrame:
    """Posts per month."""
    return posts.groupBy(F.trunc(date_col, "MONTH").alias("month")).agg(
        F.count("*").alias("n_posts")
    )


def keyword_trend(tagged: DataFrame, k: int = 5, date_col: str = "post_date", tags_col: str = "tags") -> DataFrame:
    """The ``k`` most used tags of each day."""
    counts = (
        each(tagged, tags_col, "tag", date_col)
        .groupBy(date_col, "tag")
        .agg(F.count("*").alias("n_posts"))
    )
    return top_per_group(counts, [date_col], [F.desc("n_posts"), F.asc("tag")], k)


def newest_first(ts: str, id_col: str) -> list[Column]:
    return [F.desc_nulls_last(ts), F.asc(id_col)]


def paginate(items: DataFrame, ts: str, id_col: str, per_page: int = 10) -> DataFrame:
    """``position`` (from 1) and ``page`` of every item, newest first, exact at any size."""
    numbered = global_row_number(items, newest_first(ts, id_col), "position")
    return numbered.withColumn("page", F.ceil(F.col("position") / per_page).cast("bigint"))


def latest(items: DataFrame, ts: str, id_col: str, n: int) -> DataFrame:
    """The ``n`` newest items (a feed, or a sample); each task keeps n rows."""
    return items.orderBy(*newest_first(ts, id_col)).limit(n)


def digest_headers(items: DataFrame, ts: str) -> DataFrame:
    """One row per day: number of entries, first and last time."""
    return items.groupBy(F.to_date(ts).alias("post_date")).agg(
        F.count("*").alias("n_entries"), F.min(ts).alias("first_ts"), F.max(ts).alias("last_ts")
    )


def digest_entries(items: DataFrame, ts: str, id_col: str) -> DataFrame:
    """The daily digest, one row per entry: ``post_date``, ``entry_no`` (newest first) and the item.

    A day is not gathered into one value: entries are numbered over the whole table, which
    splits a busy day over many tasks, and the entries of later days are subtracted.
    """
    numbered = global_row_number(items, newest_first(ts, id_col), "_position").withColumn(
        "post_date", F.to_date(ts)
    )
    # One row per day: bounded by the calendar.
    days = numbered.groupBy(F.col("post_date").alias("_day")).agg(
        (F.min("_position") - 1).alias("_before")
    )
    return (
        numbered.join(F.broadcast(days), F.col("post_date").eqNullSafe(F.col("_day")))
        .withColumn("entry_no", F.col("_position") - F.col("_before"))
        .drop("_position", "_before", "_day")
    )


def write_digest(entries: DataFrame, line: str, path: str) -> None:
    """Digest text below one folder per day; file order is entry order.

    Only the days of ``entries`` are replaced.
    """
    (
        entries.repartitionByRange("post_date", "entry_no")
        .sortWithinPartitions("post_date", "entry_no")
        .select("post_date", F.col(line).alias("value"))
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy("post_date")
        .text(path)
    )


def last_write_wins(posts: DataFrame, path_col: str = "path", order: list[Column] | None = None) -> DataFrame:
    """One post per path: the one written last."""
    order = order or [F.desc("write_seq")]
    return top_per_group(posts, [path_col], order, 1, "_rn").drop("_rn")


def collisions(posts: DataFrame, path_col: str = "path", id_col: str = "article_id") -> DataFrame:
    """Paths that several articles map to."""
    return (
        posts.groupBy(path_col)
        .agg(
            F.count("*").alias("n_articles"),
            F.min(id_col).alias("first_id"),
            F.max(id_col).alias("last_id"),
        )
        .filter("n_articles > 1")
    )


def suffix_collisions(posts: DataFrame, order: list[Column], id_col: str = "article_id") -> DataFrame:
    """Keep every post of a shared path: the first one keeps it, the others get ``--<id>``.

    Slugs never hold two dashes in a row, so a new path is always free. The owners are
    joined back by article id, which is unique, not by the path that may be hot.
    """
    owners = top_per_group(posts, ["path"], order, 1, "_rn").select(
        id_col, F.lit(True).alias("_owner")
    )
    suffixed = F.regexp_replace("path", r"\.md$", "")
    return (
        posts.join(owners, id_col, "left")
        .withColumn(
            "path",
            F.when(F.col("_owner"), F.col("path")).otherwise(
                F.concat(suffixed, F.lit("--"), F.col(id_col), F.lit(".md"))
            ),
        )
        .drop("_owner")
    )
