"""Catalogue of this package's queries: name to callable ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.llm import (
    collision,
    decontaminate,
    filter_audit,
    hard_negatives,
    jaccard_join,
    line_dedup,
    mixing,
    packing,
    recompression,
    suffix_tree,
    toxicity,
    url_trust,
    warc,
)
from digestloom.operators.skew import broadcast_if_small
from digestloom.session import ship

QUERIES = {}


def query(function):
    @functools.wraps(function)
    def run(spark, sf_dir):
        ship(spark)
        return function(spark, sf_dir)

    QUERIES[function.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


URL_RULES = [("net/", "block"), ("example.net/en/", "allow"), ("example.com/de/", "block"), ("org/fr/", "allow")]


@query
def op1_url_filters(spark, sf_dir):
    return url_trust.judge(table(spark, sf_dir, "pages"), URL_RULES).drop("trust", "distrust")


@query
def op2_jaccard_join(spark, sf_dir):
    return jaccard_join.near_duplicates(table(spark, sf_dir, "documents"))


@query
def op3_toxicity(spark, sf_dir):
    return toxicity.scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op4_substring_dedup(spark, sf_dir):
    return recompression.remove_repeats(table(spark, sf_dir, "documents"), with_text=False)


@query
def op5_best_fit_packing(spark, sf_dir):
    documents = table(spark, sf_dir, "documents")
    return packing.best_fit_packing(documents, tokenizer_path()).drop("n_bins", "bound", "pack_round")


@query
def op6_lm_scoring(spark, sf_dir):
    return suffix_tree.scores(table(spark, sf_dir, "documents"))


@query
def op7_warc(spark, sf_dir):
    records = warc.round_trip(table(spark, sf_dir, "pages"))
    return records.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


@query
def op8_decontamination(spark, sf_dir):
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_line_dedup(spark, sf_dir):
    return line_dedup.digests(table(spark, sf_dir, "documents"))


@query
def op10_nearest_neighbours(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    return collision.nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))


@query
def op11_source_mixing(spark, sf_dir):
    """Documents labelled good come early four times as likely as those labelled bad."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    said = table(spark, sf_dir, "labels").filter("doc_id is not null and quality is not null")
    said = said.groupBy("doc_id").agg(F.max("quality").alias("quality"))
    documents = documents.join(broadcast_if_small(said), "doc_id", "left")
    quality = F.when(F.col("quality") == 1, 2.0).when(F.col("quality") == 0, 0.5).otherwise(1.0)
    return mixing.mix(documents, quality=quality).drop("copies")


@query
def op12_hard_negatives(spark, sf_dir):
    vectors = table(spark, sf_dir, "embeddings")
    relabelled = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = vectors.withColumn("label", relabelled)
    return hard_negatives.mine(vectors, vectors.filter(F.col("vec_id") % 100 == 0))


@query
def op13_filter_audit(spark, sf_dir):
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
