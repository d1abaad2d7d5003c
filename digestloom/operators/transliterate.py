"""Readings of letters and phrases from a given table, longest match first.

The table (``text, reading``, any number of characters each) becomes one value: an array by
code point in two steps (``pages[code >> 8][code & 255]``) that holds the phrases beginning with
that character, the longest first. So a lookup costs two array accesses and the phrases of one
character, however large the table is. The value travels as a scalar subquery; the table is
bounded by the writing systems it reads and refused beyond ``MAX_ENTRIES``.

A text is read from left to right: at each place the longest phrase that fits is replaced, else
the character stays. Texts are read in blocks, so the work is linear in their length.

Edge cases: a null or empty phrase is left out, a null reading is an empty one, of readings for
one phrase the smallest counts; a null text stays null.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.functions.slug import unspelled
from digestloom.session import materialise

MAX_ENTRIES = 500_000
BLOCK_CHARS = 256


def reading_table(entries: DataFrame) -> DataFrame:
    """One row: the phrases of ``text, reading`` by first character. Refuses too large a table."""
    phrases = (
        entries.select(F.col("text").cast("string").alias("text"), F.coalesce(F.col("reading").cast("string"), F.lit("")).alias("reading"))
        .filter("text <> ''").groupBy("text").agg(F.min("reading").alias("reading"))
    )
    if phrases.limit(MAX_ENTRIES + 1).count() > MAX_ENTRIES:
        raise ValueError(f"a table of readings has at most {MAX_ENTRIES} entries")
    phrase = F.struct((-F.length("text")).alias("order"), F.col("text").alias("text"), F.col("reading").alias("reading"))
    slots = phrases.groupBy(F.ascii("text").alias("code")).agg(F.sort_array(F.collect_list(phrase)).alias("phrases"))
    pages = slots.groupBy(F.shiftright("code", 8).alias("page")).agg(
        F.map_from_entries(F.collect_list(F.struct(F.col("code").bitwiseAND(255).alias("slot"), F.col("phrases")))).alias("slots")
    )
    by_slot = F.transform(F.sequence(F.lit(0), F.lit(255)), lambda i: F.try_element_at("slots", i))
    pages = pages.select("page", by_slot.alias("slots"))
    # One row of at most MAX_ENTRIES phrases.
    held = pages.agg(F.map_from_entries(F.collect_list(F.struct("page", "slots"))).alias("pages"), F.max("page").alias("last"))
    by_page = F.transform(F.sequence(F.lit(0), F.coalesce("last", F.lit(0))), lambda i: F.try_element_at("pages", i))
    return held.select(by_page.alias("pages"))


def with_spelling(rows: DataFrame, text: str, entries: DataFrame, name: str) -> DataFrame:
    """Add ``name``: the text with all phrases of ``entries`` replaced by their readings."""
    table = materialise(reading_table(entries), "readings")

    def spelled(bound: Column) -> Column:
        chars, pages = bound["chars"], bound["pages"]
        n = F.size(chars)

        def phrase_at(i: Column) -> Column:
            code = F.ascii(F.get(chars, i))
            listed = F.get(F.get(pages, F.shiftright(code, 8)), code.bitwiseAND(255))
            fits = F.filter(listed, lambda p: F.array_join(F.slice(chars, i + 1, -p["order"]), "") == p["text"])
            return F.get(fits, F.lit(0))

        def char_step(state: Column, i: Column) -> Column:
            def step(found: Column) -> Column:
                n_read = F.when(found.isNull(), 1).otherwise(-found["order"])
                piece = F.when(found.isNull(), F.get(chars, i)).otherwise(found["reading"])
                return F.struct((i + n_read).alias("next"), F.concat(state["out"], F.array(piece)).alias("out"))

            read = F.get(F.transform(F.array(phrase_at(i)), step), F.lit(0))
            return F.when(i < state["next"], state).otherwise(read)

        def block_step(state: Column, begin: Column) -> Column:
            end = F.least(begin + BLOCK_CHARS, n) - 1
            start = F.struct(state["next"].alias("next"), F.array().cast("array<string>").alias("out"))
            inner = F.aggregate(F.sequence(begin, end), start, char_step)
            return F.get(
                F.transform(F.array(inner), lambda x: F.struct(x["next"].alias("next"), F.concat(state["out"], F.array(F.array_join(x["out"], ""))).alias("out"))),
                F.lit(0),
            )

        begins = F.sequence(F.lit(0), n - 1, F.lit(BLOCK_CHARS))
        empty = F.struct(F.lit(0).alias("next"), F.array().cast("array<string>").alias("out"))
        return F.aggregate(begins, empty, block_step, lambda x: F.array_join(x["out"], ""))

    # One use of the subquery: Spark moves it into the expression, so no row holds the table.
    bound = F.array(F.struct(F.split(F.col(text), "").alias("chars"), F.col("_readings").alias("pages")))
    read = F.get(F.transform(bound, spelled), F.lit(0))
    spelling = F.when(F.length(F.col(text)) > 0, read).otherwise(F.col(text))
    return rows.withColumn("_readings", table.scalar()).withColumn(name, spelling).drop("_readings")


def unspelled_titles(articles: DataFrame, title: str = "title", id_col: str = "article_id") -> DataFrame:
    """``(id, unspelled)``: titles with letters that their slug drops, and how many."""
    return articles.select(id_col, F.expr(unspelled(title)).cast("long").alias("unspelled")).filter("unspelled > 0")
