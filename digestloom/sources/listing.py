"""Listing pages landed as XML."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

_ITEM = "art_code STRING, publish_date STRING, pos BIGINT"


def read_listing(spark: SparkSession, path: str) -> DataFrame:
    """``(article_id, published_at, page, pos)`` from XML files of ``<item>`` elements.

    The page number comes from a ``page=N`` folder or a ``...N.xml`` (or ``.xml.gz``) file
    name; a file without one ends the read. ``pos`` is the item's own ``pos`` where it was
    landed with one, else it rises in the order of file names and of items in a file.
    """
    raw = (
        spark.read.format("xml")
        .option("rowTag", "item")
        .option("recursiveFileLookup", True)
        .schema(_ITEM)
        .load(path)
    )
    file = F.col("_metadata.file_path")
    page = F.coalesce(
        F.regexp_extract(file, r"page=([0-9]+)/[^/]*$", 1).try_cast("int"),
        F.regexp_extract(file, r"([0-9]+)\.xml(?:\.gz)?$", 1).try_cast("int"),
        F.raise_error(F.concat(F.lit("no page number in the name of "), file)).cast("int"),
    )
    rows = raw.select(
        F.col("art_code").alias("article_id"),
        F.coalesce("publish_date", F.lit("")).alias("published_at"),
        page.alias("page"),
        "pos",
        file.alias("_file"),
        # Rises inside a file, whose items come in order within one task.
        F.monotonically_increasing_id().alias("_at"),
    )
    # Files by name; a hash would mix them. One row per file, so the window is narrow.
    files = rows.select("_file").distinct()
    if not rows.filter("pos IS NULL").limit(1).count():
        return rows.drop("_file", "_at")
    order = Window.orderBy("_file")
    numbered = files.withColumn("_file_no", F.row_number().over(order))
    starts = rows.groupBy("_file").agg(F.min("_at").alias("_from"))
    placed = rows.join(numbered.join(starts, "_file"), "_file")
    pos = F.shiftleft(F.col("_file_no").cast("bigint"), 40) + F.col("_at") - F.col("_from")
    return placed.select("article_id", "published_at", "page", F.coalesce("pos", pos).alias("pos"))


def write_listing(listing: DataFrame, path: str) -> None:
    """Land a listing as one folder per page."""
    (
        listing.select(
            "page", F.col("article_id").alias("art_code"), F.col("published_at").alias("publish_date"),
            "pos",
        )
        .repartitionByRange("page", "pos")
        .sortWithinPartitions("page", "pos")
        .write.format("xml")
        .option("rootTag", "items")
        .option("rowTag", "item")
        .option("nullValue", "")
        .mode("overwrite")
        .partitionBy("page")
        .save(path)
    )
