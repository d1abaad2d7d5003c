"""Article pages, and their projection to article records."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.functions import html
from digestloom.functions.urls import article_url
from digestloom.operators.isolate import Guarded, attempt

# What a parser from outside returns for a page.
PARSED = "struct<title string, published_at string, raw_text string>"


@dataclass(frozen=True)
class PageLayout:
    """Where a site keeps title, date and body; each selector is ``#id``, ``.class`` or a tag."""

    title: str = "#article_title_h2"
    dates: tuple[str, ...] = (".timewrap", ".time")
    date: str = "time"
    date_marker: str = "발행일"
    body: str = "#articleBody"


def read_page_files(spark: SparkSession, path: str) -> DataFrame:
    """``(article_id, html)`` from one ``<id>.html`` file per article."""
    files = spark.read.text(path, wholetext=True)
    name = F.regexp_extract("_metadata.file_name", r"^(.*)\.html?$", 1)
    return files.select(name.alias("article_id"), F.col("value").alias("html"))


def parse_articles(pages: DataFrame, base_url: str, section: str = "AI/SW",
                   layout: PageLayout = PageLayout(), parser: Guarded | None = None) -> DataFrame:
    """Article records from ``(article_id, html)``; other columns are kept. No shuffle, no UDF.

    A page that is null cannot be read: its ``error`` is set. A guarded ``parser`` (html to
    ``PARSED``) replaces the layout; a page it fails on gets an ``error``.
    """
    unread = F.expr("CASE WHEN html IS NULL THEN 'page cannot be read' END")
    if parser is not None:
        parsed = attempt(pages.withColumn("error", unread), "_parsed", parser, "html", "parser")
        fields = {name: F.coalesce(F.col(f"_parsed.{name}"), F.lit("")) for name in ("title", "published_at", "raw_text")}
        url = F.expr(article_url("article_id", base_url))
        return parsed.withColumns(fields | {"url": url, "section": F.lit(section)}).drop("_parsed", "html")
    layout_dates = (layout.dates, layout.date, layout.date_marker)
    return (
        pages.withColumn("_page", F.expr(html.drop_hidden("html")))
        .withColumns(
            {
                "url": F.expr(article_url("article_id", base_url)),
                "title": F.expr(html.title("_page", layout.title)),
                "published_at": F.expr(html.published_at("_page", *layout_dates)),
                "raw_text": F.expr(html.body_text("_page", layout.body)),
                "section": F.lit(section),
                "error": unread,
            }
        )
        .drop("_page", "html")
    )
