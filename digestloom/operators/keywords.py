"""Keyword extraction: per document, against the corpus, and by embeddings."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from digestloom.functions.arrays import fold, let, struct, total, transform, zip_with
from digestloom.functions.text import content_tokens, keep_tokens, term_counts
from digestloom.operators.isolate import Guarded, attempt
from digestloom.operators.skew import MAX_BROADCAST_ROWS, broadcast_if_small, hot_keys, salted_join, top_per_group
from digestloom.session import materialise, ship

Tokenizer = Callable[[Column], Column]

# Bytes of tokens that are counted at a time; a longer document is counted alone.
PORTION_BYTES = 1 << 22

# Fixed value: weight of each repetition in the single-document score.
REPEAT_WEIGHT = 0.15

SCORE_DECIMALS = 9


def tf_score(count: str, n_tokens: str) -> str:
    """Term frequency, raised for terms that recur."""
    return f"{count} / {n_tokens} * (1D + ({count} - 1) * {REPEAT_WEIGHT!r}D)"


def top_terms(tokens: str, k: int) -> str:
    """Best ``k`` terms of one document: ``array<struct<term,tf_count,score>>``, best first.

    The score grows strictly with the count, so the order is count, then first occurrence,
    on integers.
    """
    if k < 1:
        raise ValueError("the number of keywords must be at least 1")

    def ranked(counts: str) -> str:
        keyed = transform(
            counts, lambda c: struct(n=f"-{c}.tf_count", pos=f"{c}.first_pos", term=f"{c}.term")
        )
        order = f"slice(sort_array({keyed}), 1, {int(k)})"
        n_tokens = fold(counts, "0L", lambda acc, c: f"{acc} + {c}.tf_count")
        return let(
            n_tokens,
            lambda n: transform(
                order,
                lambda o: struct(term=f"{o}.term", tf_count=f"-{o}.n", score=tf_score(f"(-{o}.n)", n)),
            ),
        )

    return let(term_counts(tokens), ranked)


def keyword_list(tokens: str, k: int = 7) -> str:
    """Top keywords of a token list, best first; no tokens give an empty list."""
    return transform(top_terms(tokens, k), lambda t: f"{t}.term")


def with_tokens(docs: DataFrame, text_col: str, tokenizer: Tokenizer | None) -> tuple[DataFrame, str]:
    """The documents, and the SQL expression of their content tokens.

    ``tokenizer`` maps the text column to an array column; a pandas UDF that calls a
    morphological analyser fits. A guarded one adds ``error``; texts it fails on have no tokens.
    """
    if tokenizer is None:
        return docs, content_tokens(text_col)
    if isinstance(tokenizer, Guarded):
        return attempt(docs, "_tokens", tokenizer, text_col, "tokenizer"), keep_tokens("coalesce(_tokens, CAST(array() AS ARRAY<STRING>))")
    return docs.withColumn("_tokens", tokenizer(F.col(text_col))), keep_tokens("_tokens")


def keywords_topn(
    docs: DataFrame, k: int = 7, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """``(id, rn, term, tf_count, score)`` for the ``k`` best terms of every document. No shuffle."""
    docs, tokens = with_tokens(docs, text_col, tokenizer)
    return docs.select(id_col, F.posexplode(F.expr(top_terms(tokens, k))).alias("at", "kw")).select(
        id_col, (F.col("at") + 1).alias("rn"), "kw.term", "kw.tf_count", "kw.score"
    )


def document_terms(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """``(id, term, tf_count, first_pos, n_tokens)`` for every term of every document. No shuffle."""
    docs, tokens = with_tokens(docs, text_col, tokenizer)
    rows = let(
        tokens,
        lambda ts: transform(
            term_counts(ts),
            lambda c: struct(
                term=f"{c}.term", tf_count=f"{c}.tf_count", first_pos=f"{c}.first_pos",
                n_tokens=f"bigint(size({ts}))",
            ),
        ),
    )
    return docs.select(id_col, F.explode(F.expr(rows)).alias("t")).select(id_col, "t.*")


def counted_terms(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    tokenizer: Tokenizer | None = None,
) -> DataFrame:
    """``(id, term, tf_count, n_tokens)`` as in ``document_terms``, counted for the documents of an Arrow batch at once."""
    ship(docs.sparkSession)
    docs, tokens = with_tokens(docs, text_col, tokenizer)
    counted = F.arrow_udf(_counted, "array<struct<term string, tf_count bigint, n_tokens bigint>>")
    return docs.select(id_col, F.explode(counted(F.expr(tokens))).alias("t")).select(id_col, "t.*")


def _counted(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for batch in batches:
        rows = max(1, len(batch) * PORTION_BYTES // max(1, batch.nbytes))
        for at in range(0, len(batch), rows) or [0]:
            lists = batch[at : at + rows]
            coded = lists.flatten().dictionary_encode()
            doc = pc.list_parent_indices(lists).to_numpy().astype(np.int64)
            size = np.bincount(doc, minlength=len(lists))
            one = max(1, len(coded.dictionary))
            pairs, times = np.unique(doc * one + coded.indices.to_numpy(zero_copy_only=False), return_counts=True)
            doc, term = pairs // one, pairs % one
            terms = coded.dictionary.take(pa.array(term))
            counts = pa.StructArray.from_arrays([terms, pa.array(times), pa.array(size[doc])], names=["term", "tf_count", "n_tokens"])
            ends = np.searchsorted(doc, np.arange(len(lists) + 1)).astype(np.int32)
            yield pa.ListArray.from_arrays(pa.array(ends), counts)


def document_frequency(terms: DataFrame) -> DataFrame:
    """Documents per term; counted in each task before the shuffle."""
    return terms.groupBy("term").agg(F.count("*").alias("df"))


def without_stopwords(tokens: DataFrame, stopwords: DataFrame) -> DataFrame:
    """Anti-join of exploded tokens with a stopword table of any size: broadcast while a count shows it small."""
    return tokens.join(broadcast_if_small(stopwords.select("term").distinct()), "term", "left_anti")


def tfidf_terms(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                tokenizer: Tokenizer | None = None) -> DataFrame:
    """Every term with its document frequency and ``weight``, not yet normalised.

    The weight is the count times ``ln((1+n)/(1+df)) + 1``. The terms are needed for the
    frequencies and again for the weights, so they are written once instead of tokenising
    the corpus for each use. So are the frequencies: while a count shows them few they are
    broadcast, and the terms stay where they are; beyond that both are joined by term, with the
    hot terms salted.
    """
    terms = materialise(document_terms(docs, id_col, text_col, tokenizer), "terms")
    freq = materialise(document_frequency(terms), "frequencies")
    idf = F.ln((docs.count() + 1) / (F.col("df") + 1)) + 1
    weighted = freq.withColumn("idf", idf)
    if freq.count() <= MAX_BROADCAST_ROWS:
        joined = terms.join(F.broadcast(weighted), "term")
    else:
        hot = materialise(hot_keys(freq, "term", "df"), "hot-terms")
        joined = salted_join(terms, weighted, "term", hot, id_col)
    return joined.withColumn("weight", F.col("tf_count") * F.col("idf")).drop("idf")


def tfidf_topn(docs: DataFrame, k: int = 7, id_col: str = "doc_id", text_col: str = "text",
               tokenizer: Tokenizer | None = None) -> DataFrame:
    """Best ``k`` terms of every document against the whole corpus, scores L2-normalised.

    One shuffle brings the weights of a document together; its size is bounded by the
    document. Equal scores go by term. A corpus of one document has nothing to compare with:
    it gets the single-document scores and order.
    """
    weights = tfidf_terms(docs, id_col, text_col, tokenizer)
    whole = Window.partitionBy(id_col)
    alone = F.lit(docs.count() == 1)
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(whole))
    scored = weights.withColumn(
        "score",
        F.when(alone, F.expr(tf_score("tf_count", "n_tokens"))).otherwise(
            F.col("weight") / norm
        ),
    )
    order = [
        F.desc(F.round("score", SCORE_DECIMALS)),
        F.asc(F.when(alone, F.col("first_pos"))),
        F.asc("term"),
    ]
    return top_per_group(scored, [id_col], order, k).select(
        id_col, "rn", "term", "tf_count", "df", "score"
    )


def tfidf_against(docs: DataFrame, corpus: DataFrame, k: int = 7, id_col: str = "doc_id", text_col: str = "text",
                  tokenizer: Tokenizer | None = None) -> DataFrame:
    """Best ``k`` terms of every document against itself and ``corpus`` (a ``text_col`` column).

    Each document is its own corpus of one plus the given texts, so a document's keywords do
    not depend on which others are scored with it. Ties go by term.
    """
    others = document_terms(corpus.withColumn("_n", F.monotonically_increasing_id()), "_n", text_col, tokenizer)
    freq = materialise(document_frequency(others), "frequencies")
    return tfidf_with(docs, freq, corpus.count(), k, id_col, text_col, tokenizer)


def tfidf_with(docs: DataFrame, frequencies: DataFrame, n_docs: int, k: int = 7, id_col: str = "doc_id", text_col: str = "text",
               tokenizer: Tokenizer | None = None) -> DataFrame:
    """The same with known ``frequencies`` (``term, df``) of a corpus of ``n_docs`` documents."""
    n = n_docs + 1
    known = F.broadcast(frequencies) if frequencies.count() <= MAX_BROADCAST_ROWS else frequencies
    df = F.coalesce("df", F.lit(0)) + 1
    terms = document_terms(docs, id_col, text_col, tokenizer).join(known, "term", "left")
    weighted = terms.withColumn("weight", F.col("tf_count") * (F.ln((1 + n) / (1 + df)) + 1)).withColumn("df", df)
    norm = F.sqrt(F.sum(F.col("weight") * F.col("weight")).over(Window.partitionBy(id_col)))
    scored = weighted.withColumn("score", F.col("weight") / norm)
    order = [F.desc(F.round("score", SCORE_DECIMALS)), F.asc("term")]
    return top_per_group(scored, [id_col], order, k).select(id_col, "rn", "term", "tf_count", "df", "score")


def as_lists(keyword_rows: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Keyword rows to one ordered list per document (at most k entries each)."""
    ordered = F.sort_array(F.collect_list(F.struct("rn", "term")))
    return keyword_rows.groupBy(id_col).agg(
        F.transform(ordered, lambda t: t["term"]).alias("keywords")
    )


def cosine(a: str, b: str) -> str:
    """Cosine of two equally long numeric arrays; null when one has no length."""
    return f"try_divide({_dot(a, b)}, sqrt({_dot(a, a)}) * sqrt({_dot(b, b)}))"


def _dot(a: str, b: str) -> str:
    return total(zip_with(a, b, lambda x, y: f"double({x}) * double({y})"))


def embedding_topn(
    candidates: DataFrame, documents: DataFrame, k: int = 7, key: str = "doc_id",
    term: str = "term", vector: str = "embedding", decimals: int = 6,
) -> DataFrame:
    """Rank candidate terms by cosine to the vector of their document.

    ``candidates``: ``(key, term, vector)``; ``documents``: ``(key, vector)``, one row per key.
    """
    counts = candidates.groupBy(key).agg(F.count("*").alias("n"))
    joined = salted_join(
        candidates.select(key, term, F.col(vector).alias("_c")),
        documents.select(key, F.col(vector).alias("_d")),
        key,
        hot_keys(counts, key, "n"),
        term,
    )
    scored = joined.withColumn("score", F.expr(cosine("_c", "_d"))).drop("_c", "_d")
    order = [F.desc_nulls_last(F.round("score", decimals)), F.asc(term)]
    return top_per_group(scored, [key], order, k).select(key, "rn", term, "score")


def mean_vectors(vectors: DataFrame, key: str, vector: str = "embedding") -> DataFrame:
    """Mean vector per key: summed per dimension in each task before the shuffle."""
    sums = (
        vectors.select(key, F.posexplode(vector).alias("dim", "v"))
        .groupBy(key, "dim")
        .agg(F.avg(F.col("v").cast("double")).alias("v"))
    )
    # One entry per dimension, so the list is bounded by the vector length.
    ordered = F.sort_array(F.collect_list(F.struct("dim", "v")))
    return sums.groupBy(key).agg(F.transform(ordered, lambda x: x["v"]).alias(vector))
