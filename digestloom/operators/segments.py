"""A full-text index kept as immutable segments, one per run.

A segment has its documents in the order of their length, cut into cells of ``CELL_DOCS``. A row
holds the postings of one term in one cell, and next to them the largest frequency and the
smallest length among them: the score of no document of the cell can exceed what these give,
whatever the corpus has become since. Adding a run writes one segment and reads no other; a
repeated run replaces its own. Document frequencies are kept by run as well, so that new
documents can be weighed against everything published without reading it again.

A search reads the bounds of its terms first, scores the few cells that promise most, and then
only those whose bounds reach the k-th best score found there. A document belongs to one
segment: runs take each id once. ``merge_segments`` writes many segments as one, in a new
folder; if an id is in several, its last run counts.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from digestloom.operators.keywords import Tokenizer, counted_terms
from digestloom.operators.search import B, K1
from digestloom.operators.skew import broadcast_if_small, global_row_number
from digestloom.session import materialise, path_exists

CELL_DOCS = 256
# Cells that are scored to find out how good a document has to be.
FIRST_CELLS = 8
# Scores are compared before they are rounded.
SLACK = 1e-6


def add_segment(docs: DataFrame, path: str, run_id: str, id_col: str = "doc_id", text_col: str = "text",
                tokenizer: Tokenizer | None = None) -> None:
    """Index the documents of one run below ``path``."""
    terms = materialise(counted_terms(docs, id_col, text_col, tokenizer).withColumnRenamed(id_col, "id"), "terms")
    _write(terms, docs.count(), path, run_id)


def _write(terms: DataFrame, n_docs: int, path: str, run_id: str) -> None:
    """A segment from ``term, id, tf_count, n_tokens``."""
    lengths = terms.groupBy("id").agg(F.max("n_tokens").alias("n_tokens"))
    numbered = global_row_number(lengths, [F.asc("n_tokens"), F.asc("id")], "at")
    cells = materialise(numbered.select("id", F.floor((F.col("at") - 1) / CELL_DOCS).cast("int").alias("cell")), "cells")
    # The range holds all rows of a term in a cell, so they are grouped where they are written. Its
    # bounds take a second pass over the terms, but no second shuffle.
    placed = terms.join(broadcast_if_small(cells), "id").select("term", "cell", "id", "tf_count", "n_tokens").repartitionByRange("term", "cell")
    posting = F.struct("id", F.col("tf_count").alias("tf"), "n_tokens")
    # At most CELL_DOCS postings in a group, however frequent the term.
    rows = placed.groupBy("term", "cell").agg(
        F.count("*").alias("n"), F.max("tf_count").alias("most"), F.min("n_tokens").alias("shortest"), F.collect_list(posting).alias("postings")
    )
    blocks = f"{path}/blocks/run_id={run_id}"
    rows.sortWithinPartitions("term", "cell").write.mode("overwrite").parquet(blocks)
    frequencies = terms.sparkSession.read.schema("term string, n bigint").parquet(blocks).groupBy("term").agg(F.sum("n").alias("df"))
    frequencies.write.mode("overwrite").parquet(f"{path}/frequencies/run_id={run_id}")
    size = lengths.agg(F.lit(n_docs).cast("long").alias("n_docs"), F.count("*").alias("n_with_terms"), F.coalesce(F.sum("n_tokens"), F.lit(0)).alias("n_tokens"))
    # The size is written last: a segment without one is not there.
    size.coalesce(1).write.mode("overwrite").parquet(f"{path}/size/run_id={run_id}")


@dataclass(frozen=True)
class Segments:
    blocks: DataFrame  # run_id, term, cell, n, most, shortest, postings
    frequencies: DataFrame  # run_id, term, df
    size: DataFrame  # run_id, n_docs, n_with_terms, n_tokens


def read_segments(spark: SparkSession, path: str, except_run: str | None = None) -> Segments | None:
    """The segments of all finished runs but ``except_run``; None if there are none."""
    if not path_exists(spark, f"{path}/size"):
        return None

    def table(name: str) -> DataFrame:
        found = spark.read.parquet(f"{path}/{name}").withColumn("run_id", F.col("run_id").cast("string"))
        return found if except_run is None else found.filter(F.col("run_id") != except_run)

    size = table("size")
    finished = F.broadcast(size.select("run_id"))  # one row per run
    return Segments(table("blocks").join(finished, "run_id", "left_semi"), table("frequencies").join(finished, "run_id", "left_semi"), size)


def stored_frequencies(segments: Segments) -> tuple[DataFrame, int]:
    """Documents per term over all segments, and the number of documents."""
    n_docs = segments.size.agg(F.sum("n_docs")).first()[0] or 0
    return segments.frequencies.groupBy("term").agg(F.sum("df").alias("df")), n_docs


def _gain(idf: Column, tf: Column, n_tokens: Column, avg_tokens: Column) -> Column:
    return idf * tf * (K1 + 1) / (tf + K1 * (1 - B + B * n_tokens / avg_tokens))


def search_segments(segments: Segments, terms: Sequence[str], k: int = 10, id_col: str = "doc_id",
                    first_cells: int = FIRST_CELLS) -> tuple[DataFrame, dict[str, int]]:
    """Best ``k`` documents by BM25, ``(id, n_matched, score)``, and how many postings were scored of all."""
    query = sorted({t.lower() for t in terms})
    size = segments.size.agg(F.sum("n_with_terms").alias("n"), (F.sum("n_tokens") / F.sum("n_with_terms")).cast("double").alias("avg"))
    corpus = size.select(F.struct(F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("avg", F.lit(1.0)).alias("avg"))).scalar()
    hits = segments.blocks.filter(F.col("term").isin(query))
    # The postings are not among the columns that are read for the bounds.
    heads = materialise(hits.select("run_id", "cell", "term", "n", "most", "shortest"), "heads")
    freq = heads.groupBy("term").agg(F.sum("n").alias("df"))  # one row per query term
    idf = materialise(freq.select("term", F.ln(1 + (corpus["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5)).alias("idf"), corpus["avg"].alias("avg")), "idf")
    bound = _gain(F.col("idf"), F.col("most"), F.col("shortest"), F.col("avg"))
    cells = materialise(
        heads.join(F.broadcast(idf), "term").groupBy("run_id", "cell").agg(F.sum(bound).alias("bound"), F.sum("n").alias("n")), "bounds"
    )

    def scored(some: DataFrame) -> DataFrame:
        wanted = hits.join(broadcast_if_small(some.select("run_id", "cell")), ["run_id", "cell"], "left_semi")
        rows = wanted.select("term", F.explode("postings").alias("p")).join(F.broadcast(idf), "term")
        gain = _gain(F.col("idf"), F.col("p.tf"), F.col("p.n_tokens"), F.col("avg"))
        return rows.groupBy(F.col("p.id").alias(id_col)).agg(F.count("*").alias("n_matched"), F.sum(gain).alias("score"))

    promising = materialise(cells.orderBy(F.desc("bound"), "run_id", "cell").limit(first_cells), "promising")
    # A cell has all postings of its documents, so their scores are whole.
    kth = scored(promising).orderBy(F.desc("score")).limit(k).agg(F.count("*").alias("n"), F.min("score").alias("least")).first()
    least = kth["least"] - SLACK if kth["n"] >= k else 0.0
    reached = materialise(cells.filter(F.col("bound") >= least), "reached")
    read = reached.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    listed = cells.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    found = scored(reached).withColumn("score", F.round("score", 6)).orderBy(F.desc("score"), F.asc(id_col)).limit(k)
    return found, {"postings": listed, "scored": read}


def merge_segments(spark: SparkSession, path: str, into: str, run_id: str = "merged") -> None:
    """Write all segments as one below the new folder ``into``; readers change over to it."""
    segments = read_segments(spark, path)
    if segments is None:
        return
    rows = segments.blocks.select("run_id", "term", F.explode("postings").alias("p")).select("run_id", "term", "p.id", F.col("p.tf").alias("tf_count"), "p.n_tokens")
    last = rows.groupBy("id").agg(F.max("run_id").alias("run_id"))
    kept = materialise(rows.join(last, ["id", "run_id"], "left_semi").drop("run_id"), "merged")
    with_terms = kept.select("id").distinct().count()
    empty = segments.size.agg(F.sum(F.col("n_docs") - F.col("n_with_terms"))).first()[0] or 0
    _write(kept, with_terms + empty, into, run_id)
