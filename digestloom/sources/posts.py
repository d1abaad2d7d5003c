"""Posts: rendering a table of articles, storing it, and reading posts back."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions import post
from digestloom.functions.arrays import keep, lit, transform
from digestloom.functions.dates import published_or
from digestloom.functions.urls import id_from_url
from digestloom.operators.transliterate import with_spelling
from digestloom.operators.views import last_write_wins


@dataclass(frozen=True)
class PostStyle:
    """What the posts of one site look like."""

    section_url: str
    section_name: str = "news section"
    categories: Sequence[str] = ("news", "ai-sw")
    layout: str = "single"


def render_posts(articles: DataFrame, as_of: datetime | str, style: PostStyle, readings: DataFrame | None = None) -> DataFrame:
    """Add ``path``, ``post_date`` and ``content`` to articles with keywords and summary.

    ``readings`` (``text, reading``) spells titles for the path before the built-in readings do.
    """
    head = post.front_matter("title", "_ts", "_tags", "url", style.categories, style.layout)
    tail = post.body("_tags", "_summary", "url", style.section_url, style.section_name)
    slug = post.slug_or_id("title" if readings is None else "_spelled", "article_id")
    if readings is not None:
        articles = with_spelling(articles, "title", readings, "_spelled")
    return (
        articles.withColumns(
            {
                "_ts": F.expr(published_or("published_at", as_of)),
                "_tags": F.expr("coalesce(keywords, CAST(array() AS ARRAY<STRING>))"),
                "_summary": F.expr("coalesce(summary, '')"),
            }
        )
        .withColumns(
            {
                "path": F.expr(post.post_path("_ts", slug)),
                "post_date": F.to_date("_ts"),
                "content": F.expr(f"concat({head}, '\\n', {tail})"),
            }
        )
        .drop("_ts", "_tags", "_summary", "_spelled")
    )


POST_SCHEMA = (
    "article_id STRING, page INT, pos BIGINT, url STRING, title STRING, published_at STRING, "
    "section STRING, keywords ARRAY<STRING>, summary STRING, method STRING, path STRING, "
    "content STRING, post_date DATE, run_id STRING"
)
_STORED = [c.split(" ")[0] for c in POST_SCHEMA.split(", ")][:-1]


def write_posts(posts: DataFrame, path: str, run_id: str) -> None:
    """Store the posts of one run, partitioned by day.

    A repeated run replaces its own folder. The rebalance hint splits busy days over several
    files and joins quiet ones.
    """
    (
        posts.withColumn("page", F.col("page").cast("int"))
        .withColumn("pos", F.col("pos").cast("bigint"))
        .select(*_STORED)
        .hint("rebalance", "post_date")
        .write.mode("overwrite")
        .partitionBy("post_date")
        .parquet(f"{path}/run_id={run_id}")
    )


def read_posts(spark: SparkSession, path: str) -> DataFrame:
    """All stored posts of all runs."""
    return spark.read.schema(POST_SCHEMA).parquet(path)


def current_posts(posts: DataFrame) -> DataFrame:
    """The visible post of each path: later runs, and later listing positions, overwrite."""
    return last_write_wins(posts, order=[F.desc("run_id"), F.desc("page"), F.desc("pos")])


def export_post_files(posts: DataFrame, path: str) -> None:
    """One text file per post, in a folder named after the post (for a site build).

    Many small files by nature: export the days that changed, not the whole table.
    """
    (
        posts.select("path", F.regexp_replace("content", r"\n\z", "").alias("value"))
        .write.mode("overwrite")
        .partitionBy("path")
        .text(path)
    )


def read_post_files(spark: SparkSession, path: str) -> DataFrame:
    """``(path, content)`` from a folder of Markdown files or from an export."""
    files = spark.read.text(path, wholetext=True, recursiveFileLookup=True)
    folder = F.regexp_extract("_metadata.file_path", r"/path=([^/]+\.md)/[^/]+$", 1)
    name = F.when(folder != "", folder).otherwise(F.col("_metadata.file_name"))
    return files.select(name.alias("path"), F.col("value").alias("content")).filter(
        F.col("path").endswith(".md")
    )


def _field(content: str, name: str) -> str:
    return f"regexp_extract({content}, {lit(f'(?m)^{name}: (.*)$')}, 1)"


def _list_field(content: str, name: str) -> str:
    inner = rf"regexp_extract({content}, {lit(rf'(?m)^{name}: \[(.*)\]$')}, 1)"
    items = keep(f"split({inner}, {lit(r',\s+')})", lambda t: f"{t} <> ''")
    return transform(items, post.unquote_yaml)


def parse_posts(posts: DataFrame) -> DataFrame:
    """Fields of ``(path, content)`` posts: front matter, keyword line, summary, article id."""
    head = "_head"
    fields = {
        "layout": post.unquote_yaml(_field(head, "layout")),
        "title": post.unquote_yaml(_field(head, "title")),
        "date": _field(head, "date"),
        "categories": _list_field(head, "categories"),
        "tags": _list_field(head, "tags"),
        "source_url": post.unquote_yaml(_field(head, "source_url")),
        "auto_generated": f"{_field(head, 'auto_generated')} = 'true'",
        "keyword_line": f"regexp_extract(content, {lit(r'(?m)^## Keywords\n(.*)$')}, 1)",
        "summary": "regexp_extract(content, "
        + lit(r"(?s)\n## Summary\n(.*)\n\n---\n\*This post") + ", 1)",
        "article_id": f"coalesce({id_from_url(_field(head, 'source_url'))}, '')",
    }
    head_text = f"regexp_extract(content, {lit(r'(?s)\A---\n(.*?)\n---\n')}, 1)"
    return posts.withColumn("_head", F.expr(head_text)).select(
        "path", *[F.expr(sql).alias(name) for name, sql in fields.items()]
    )
