"""From raw documents to packed training sequences: five stages of the operators in ``llm``.

Each stage takes what its predecessor kept and returns the columns of ``documents``, but for
the last, which returns the places of token pieces in sequences.
"""

from __future__ import annotations

import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.llm import columns, decontaminate, jaccard_join, line_dedup, packing, toxicity
from digestloom.llm.queries import ship, table, tokenizer_path
from digestloom.operators.skew import broadcast_if_small
from digestloom.session import materialise, release, scratch_released, work_dir

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def settled(stage: Stage) -> Stage:
    """The stage with its rows written down and everything else that it wrote removed."""

    @functools.wraps(stage)
    def run(spark, docs, sf_dir):
        path = work_dir(spark, stage.__name__)
        with scratch_released(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        kept = spark.read.schema(rows.schema).parquet(path)
        kept.scratch_path = path
        return kept

    return run


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose restored text scores below the threshold."""
    ship(spark)
    return toxicity.drop_toxic(docs, table(spark, sf_dir, "labels")).select(*docs.columns)


@settled
def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that match an earlier line.

    A document of which nothing but blank is left goes; one that was blank before stays.
    """
    ship(spark)
    own, back = columns.set_aside(docs)
    kept = line_dedup.remove_repeated_lines(own)
    emptied = (F.col("_dl_removed") > 0) & (F.trim(F.translate("text", "\t\n\x0b\x0c\r", "     ")) == "")
    kept = kept.filter(~F.coalesce(emptied, F.lit(False)))
    if "n_chars" in docs.columns:
        kept = kept.withColumn("n_chars", F.when(F.col("_dl_removed") > 0, F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return kept.select(*own.columns).withColumnsRenamed(back)


@settled
def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near duplicates.

    Rows without an id stay; of rows that repeat an id and a text, one stays.
    """
    ship(spark)
    groups = jaccard_join.near_duplicates(docs)
    first = materialise(groups.filter("component_id is not null").select(F.col("component_id").alias("doc_id")).distinct(), "groups")
    kept = docs.join(broadcast_if_small(first), "doc_id", "left_semi").unionByName(docs.filter("doc_id is null"))
    again = materialise(docs.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id"), "repeated")
    if again.limit(1).count():
        once = kept.join(again, "doc_id", "left_semi").dropDuplicates(["doc_id", "text"])
        kept = kept.join(again, "doc_id", "left_anti").unionByName(once)
    return kept.select(*docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    ship(spark)
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark")).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 4096 tokens; one row per piece."""
    ship(spark)
    return packing.best_fit_packing(docs, tokenizer_path()).drop("n_bins", "bound", "pack_round")


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("best-fit packing", pack),
]

# A fitted classifier and a tokenizer cannot be written in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written down before the next one reads it."""
    docs = before = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stage(spark, before, sf_dir)
        docs = docs if hasattr(docs, "scratch_path") else materialise(docs, name.replace(" ", "-"))
        if hasattr(before, "scratch_path"):
            release(before)
        before = docs
    return STAGES[-1][1](spark, docs, sf_dir)
