"""Full-text index over the corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.operators.keywords import counted_terms
from digestloom.session import materialise

# The usual BM25 parameters.
K1 = 1.2
B = 0.75


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Inverted index ``(term, id, tf, n_tokens)``; built per document, without a shuffle."""
    return counted_terms(docs, id_col, text_col).select(
        "term", id_col, F.col("tf_count").alias("tf"), "n_tokens"
    )


def corpus_size(index: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """One row ``(n_docs, avg_tokens)`` from an index."""
    per_doc = index.groupBy(id_col).agg(F.max("n_tokens").alias("n_tokens"))
    return per_doc.agg(
        F.count("*").alias("n_docs"), F.avg("n_tokens").cast("double").alias("avg_tokens")
    )


def write_index(index: DataFrame, path: str, id_col: str = "doc_id") -> None:
    """Store the index in term order with its corpus size, so that a lookup skips all files
    without its terms.

    The range is on term and id: the postings of a frequent term fill several files. Finding
    the ranges takes a second pass, so the postings are written down before it.
    """
    written = materialise(index, "postings")
    (
        written.repartitionByRange("term", id_col)
        .sortWithinPartitions("term", id_col)
        .write.mode("overwrite")
        .parquet(f"{path}/postings")
    )
    # Here a document's postings are still together: a task sends on one row for it.
    corpus_size(written, id_col).coalesce(1).write.mode("overwrite").parquet(f"{path}/size")


def read_index(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Postings and corpus size of a stored index."""
    return spark.read.parquet(f"{path}/postings"), spark.read.parquet(f"{path}/size")


def search(index: DataFrame, terms: Sequence[str], k: int = 10, id_col: str = "doc_id",
           size: DataFrame | None = None) -> DataFrame:
    """Best ``k`` documents for the terms by BM25: ``(id, n_matched, score)``.

    Only postings of the query terms are read; the final order keeps k rows per task.
    """
    query = sorted({t.lower() for t in terms})
    hits = index.filter(F.col("term").isin(query))
    size = corpus_size(index, id_col) if size is None else size
    # One row per query term: bounded by the query.
    freq = F.broadcast(hits.groupBy("term").agg(F.count("*").alias("df")))
    corpus = size.select(F.struct("n_docs", "avg_tokens")).scalar()
    n_docs, avg_tokens = corpus["n_docs"], corpus["avg_tokens"]
    idf = F.ln(1 + (n_docs - F.col("df") + 0.5) / (F.col("df") + 0.5))
    length = 1 - B + B * F.col("n_tokens") / avg_tokens
    gain = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * length)
    scored = (
        hits.join(freq, "term")
        .groupBy(id_col)
        .agg(F.count("*").alias("n_matched"), F.round(F.sum(gain), 6).alias("score"))
    )
    return scored.orderBy(F.desc("score"), F.asc(id_col)).limit(k)
