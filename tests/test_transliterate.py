"""Titles in other scripts: built-in letters, given readings, and what stays unspelled."""

import random

import pytest
from pyspark.sql import functions as F

from digestloom.functions import slug
from digestloom.operators import transliterate
from digestloom.plans import daily_run
from digestloom.sources import posts as post_source
from tests.test_runs import AS_OF, ROWS, STYLE, article_id, landed


def titles(spark, values):
    return spark.createDataFrame(list(enumerate(values)), "n int, t string")


def column(df, expr):
    return [r[0] for r in sorted(df.select(F.expr(expr).alias("x"), "n").collect(), key=lambda r: r.n)]


SLUGS = {
    "서울 タワー": ("seoul-tawa", 1),  # the sign that lengthens a vowel has no reading
    "ひらがな と カタカナ": ("hiragana-to-katakana", 0),
    "ﾃｽﾄ ＡＩ２": ("tesuto-ai2", 0),
    "Привет, Мир! Объём": ("privet-mir-obiom", 0),
    "Йод і їжак": ("iod-i-yizhak", 0),
    "Αθήνα ἄνθρωπος ΨΥΧΗ": ("athena-anthropos-psukhe", 0),
    "漢字とAI": ("toai", 2),
    "עברית a": ("a", 5),
    "": ("", 0),
}


def test_scripts(spark):
    df = titles(spark, list(SLUGS))
    assert column(df, slug.slugify("t")) == [s for s, _ in SLUGS.values()]
    assert column(df, slug.unspelled("t")) == [n for _, n in SLUGS.values()]
    assert column(titles(spark, [None]), slug.slugify("t")) == [None]


def greedy(text, entries):
    out, i = "", 0
    while i < len(text):
        fits = [x for x in entries if text.startswith(x, i)]
        best = max(fits, key=len, default=None)
        out += entries[best] if best else text[i]
        i += len(best) if best else 1
    return out


def spelled(spark, texts, entries):
    table = spark.createDataFrame(entries, "text string, reading string")
    return column(transliterate.with_spelling(titles(spark, texts), "t", table, "t"), "t")


def test_longest_match_over_block_borders(spark):
    rnd = random.Random(3)
    entries = {"".join(rnd.choice("ab東京😀") for _ in range(rnd.randrange(1, 6))): f"<{i}>" for i in range(40)}
    texts = ["".join(rnd.choice("abc東京都😀 ") for _ in range(n)) for n in (0, 1, 5, 255, 256, 257, 700, 1500)]
    assert spelled(spark, texts, list(entries.items())) == [greedy(t, entries) for t in texts]


def test_edges_of_tables(spark):
    assert spelled(spark, ["ab", "", None], []) == ["ab", "", None]
    assert spelled(spark, ["ab", "x"], [("a", None), ("", "no"), (None, "no"), ("b", "2"), ("b", "1")]) == ["1", "x"]
    with pytest.raises(ValueError):
        many = spark.range(transliterate.MAX_ENTRIES + 1).selectExpr("string(id) AS text", "'r' AS reading")
        transliterate.reading_table(many)


def test_a_table_of_a_whole_script(spark):
    table = spark.range(0x4E00, 0xA000).selectExpr("decode(encode(char(0), 'utf-8'), 'utf-8') AS z", "id").select(
        F.udf(lambda i: chr(i))("id").alias("text"), F.concat(F.hex("id"), F.lit(" ")).alias("reading")
    )
    got = column(transliterate.with_spelling(titles(spark, ["一龥龦a", "中"]), "t", table, "t"), "t")
    assert got == ["4E00 9FA5 9FA6 a", "4E2D "]


def test_readings_in_a_run(spark, tmp_path):
    rows = [(1, "漢字 news", *ROWS[0][2:]), (2, "漢 עב", *ROWS[1][2:])]
    listing, pages = landed(spark, rows)
    readings = spark.createDataFrame([("漢字", "kanji "), ("漢", "han ")], "text string, reading string")
    options = daily_run.Options(base_url="https://n.example", style=STYLE, readings=readings)
    posts_dir = str(tmp_path / "posts")
    done = daily_run.run(spark, listing, pages, posts_dir, str(tmp_path / "state"), "r1", AS_OF, options)
    assert done.first().unspelled == 2
    paths = {r.article_id: (r.path, r.title) for r in post_source.read_posts(spark, posts_dir).collect()}
    assert paths == {article_id(1): ("2026-07-19-kanji-news.md", "漢字 news"), article_id(2): ("2026-07-19-han.md", "漢 עב")}
    plan = daily_run.plan_run(listing, pages, spark.createDataFrame([], "article_id string, processed_at string"), AS_OF, daily_run.Options(style=STYLE))
    assert {tuple(r) for r in plan.unspelled.collect()} == {(article_id(1), 2), (article_id(2), 3)}
