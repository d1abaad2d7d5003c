"""Pluggable keyword and summary methods: name to a function over documents.

Every keyword method takes ``(docs, k, id_col, text_col, tokenizer)`` and adds ``keywords``;
every summary method takes ``(docs, k, text_col)`` and adds ``summary``. Functions of that form
can be given instead of a name.

A guarded function (``operators.isolate``) of the text can be given, too: it is called in batches,
and a document it fails on gets an ``error`` instead of ending the job. So can a guarded
tokenizer, and a splitter that cuts texts into sentences and words for the summary.

``tfidf`` scores a document by itself, or against a corpus if one is given; ``tfidf_batch``
scores the documents against each other; ``keybert`` ranks precomputed vectors, which have to
be given.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.functions.text import sentences
from digestloom.operators.keywords import (
    Tokenizer, as_lists, embedding_topn, keyword_list, tfidf_against, tfidf_topn, tfidf_with, with_tokens,
)
from digestloom.operators.isolate import Guarded, attempt
from digestloom.operators.textrank import (
    Splitter, given_words, lead, lead_summary, textrank_summary, with_summary,
)


def _tf(docs: DataFrame, k: int, id_col: str, text_col: str,
    tokenizer: Tokenizer | None) -> DataFrame:
    docs, tokens = with_tokens(docs, text_col, tokenizer)
    return docs.withColumn("keywords", F.expr(keyword_list(tokens, k))).drop("_tokens")


def _with_lists(docs: DataFrame, rows: DataFrame, id_col: str) -> DataFrame:
    none = F.array().cast("array<string>")
    return docs.join(as_lists(rows, id_col), id_col, "left").withColumn("keywords", F.coalesce("keywords", none))


def _batch(docs: DataFrame, k: int, id_col: str, text_col: str,
    tokenizer: Tokenizer | None) -> DataFrame:
    return _with_lists(docs, tfidf_topn(docs, k, id_col, text_col, tokenizer), id_col)


def against(corpus: DataFrame) -> Callable[..., DataFrame]:
    """A keyword method that weighs terms by their frequency in ``corpus``."""

    def tfidf(docs, k, id_col, text_col, tokenizer):
        return _with_lists(docs, tfidf_against(docs, corpus, k, id_col, text_col, tokenizer), id_col)

    return tfidf


def against_known(frequencies: DataFrame, n_docs: int) -> Callable[..., DataFrame]:
    """A keyword method that weighs terms by known frequencies, such as those stored with an index."""

    def tfidf(docs, k, id_col, text_col, tokenizer):
        return _with_lists(docs, tfidf_with(docs, frequencies, n_docs, k, id_col, text_col, tokenizer), id_col)

    return tfidf


KEYWORD_METHODS: dict[str, Callable[..., DataFrame]] = {"tf": _tf, "tfidf": _tf, "tfidf_batch": _batch}
SUMMARY_METHODS: dict[str, Callable[..., DataFrame]] = {
    "textrank": lambda docs, k, text_col: with_summary(docs, sentences(text_col), k),
    "lead": lambda docs, k, text_col: docs.withColumn("summary", F.expr(lead_summary(text_col, k))),
}
OUTPUT_MODES = ("per_article", "daily_digest")


def _pick(methods: dict, name: str, kind: str) -> Callable[..., DataFrame]:
    if name == "llm":
        raise ValueError(f"{kind} method 'llm' calls an external service and is not supported")
    if name not in methods:
        names = sorted([*methods, "keybert"] if methods is KEYWORD_METHODS else methods)
        raise ValueError(f"unknown {kind} method {name!r} (expected one of {names})")
    return methods[name]


def keybert(candidates: DataFrame, doc_vectors: DataFrame, id_col: str = "doc_id") -> Callable[..., DataFrame]:
    """A keyword method that ranks precomputed term vectors against document vectors."""

    def keybert(docs, k, id_col_, text_col, tokenizer):
        return _with_lists(docs, embedding_topn(candidates, doc_vectors, k, id_col), id_col)

    return keybert


def method_name(method: str | Callable[..., DataFrame]) -> str:
    """How a method is named in results."""
    return method if isinstance(method, str) else getattr(method, "__name__", type(method).__name__)


# Columns that ``prepare`` adds: results of guarded functions.
TOKENS, SPLIT = "_prepared_tokens", "_prepared_split"


def prepare(docs: DataFrame, text_col: str, *, tokenizer: Tokenizer | Guarded | None = None, splitter: Splitter | Guarded | None = None,
            keyword_method: str | Callable[..., DataFrame] = "", summary_method: str | Callable[..., DataFrame] = "",
            error_col: str = "error") -> DataFrame:
    """Call the guarded ones of the given functions, once per document; failures go to ``error``.

    ``extract_keywords`` and ``summarise`` find the results. What is not guarded is left to them.
    """
    for name, function, step in ((TOKENS, tokenizer, "tokenizer"), (SPLIT, splitter, "splitter"),
                                 ("keywords", keyword_method, "keyword method"), ("summary", summary_method, "summary method")):
        if isinstance(function, Guarded):
            docs = attempt(docs, name, function, text_col, step, error_col)
    return docs


def extract_keywords(docs: DataFrame, method: str | Callable[..., DataFrame] = "tf", k: int = 7,
                     id_col: str = "doc_id", text_col: str = "text",
                     tokenizer: Tokenizer | Guarded | None = None, corpus: DataFrame | None = None,
                     vectors: tuple[DataFrame, DataFrame] | None = None) -> DataFrame:
    """Add ``keywords``. ``corpus`` is for ``tfidf``; ``vectors`` (of terms, of documents) for ``keybert``."""
    if k < 1:
        raise ValueError("the number of keywords must be at least 1")
    if isinstance(method, Guarded):
        docs = docs if "keywords" in docs.columns else prepare(docs, text_col, keyword_method=method)
        return docs.withColumn("keywords", F.slice(F.coalesce("keywords", F.array().cast("array<string>")), 1, k))
    if isinstance(tokenizer, Guarded):
        docs = docs if TOKENS in docs.columns else prepare(docs, text_col, tokenizer=tokenizer)
        if corpus is not None:
            # Texts that cannot be cut into tokens say nothing about terms.
            corpus = prepare(corpus.select(text_col), text_col, tokenizer=tokenizer).filter("error IS NULL")
        tokenizer = _prepared_tokens
    if method == "tfidf" and corpus is not None:
        method = against(corpus)
    elif method == "keybert":
        if vectors is None:
            raise ValueError("keyword method 'keybert' needs the vectors of terms and documents")
        method = keybert(*vectors, id_col)
    run = method if callable(method) else _pick(KEYWORD_METHODS, method, "keyword")
    return run(docs, k, id_col, text_col, tokenizer).drop(TOKENS)


def _prepared_tokens(_):
    return F.coalesce(TOKENS, F.array().cast("array<string>"))


def prepared_tokenizer(docs: DataFrame, tokenizer: Tokenizer | Guarded | None) -> Tokenizer | Guarded | None:
    """The tokenizer, or the tokens that ``prepare`` has put into the documents."""
    return _prepared_tokens if TOKENS in docs.columns else tokenizer


def summarise(docs: DataFrame, method: str | Callable[..., DataFrame] = "textrank", k: int = 4,
              text_col: str = "text", splitter: Splitter | Guarded | None = None) -> DataFrame:
    """Add ``summary``. ``splitter`` cuts texts for the methods ``textrank`` and ``lead``."""
    if isinstance(method, Guarded):
        docs = docs if "summary" in docs.columns else prepare(docs, text_col, summary_method=method)
        return docs.withColumn("summary", F.coalesce("summary", F.lit("")))
    run = method if callable(method) else _pick(SUMMARY_METHODS, method, "summary")
    if splitter is None or callable(method):
        return run(docs, k, text_col)
    if k < 1:
        raise ValueError("a summary needs at least one sentence")
    if isinstance(splitter, Guarded):
        docs = docs if SPLIT in docs.columns else prepare(docs, text_col, splitter=splitter)
        parts, word_lists = f"coalesce({SPLIT}.sentences, CAST(array() AS ARRAY<STRING>))", given_words(f"{SPLIT}.words")
    else:
        parts, word_lists = splitter.to_sentences(text_col), splitter.word_lists
    done = docs.withColumn("summary", F.expr(lead(parts, k))) if method == "lead" else with_summary(docs, parts, k, word_lists)
    return done.drop(SPLIT)


def extraction_results(docs: DataFrame, keyword_method: str | Callable[..., DataFrame] = "tf",
                       summary_method: str | Callable[..., DataFrame] = "textrank",
                       keyword_count: int = 7, summary_sentences: int = 4,
                       id_col: str = "article_id", text_col: str = "raw_text") -> DataFrame:
    """``(article_id, keywords, summary, method)`` per document. Built-in methods are plain expressions here."""
    done = extract_keywords(docs, keyword_method, keyword_count, id_col, text_col)
    if summary_method == "textrank":
        done = done.withColumn("summary", F.expr(textrank_summary(text_col, summary_sentences)))
    else:
        done = summarise(done, summary_method, summary_sentences, text_col)
    return done.select(
        F.col(id_col).alias("article_id"), "keywords", "summary",
        F.lit(f"{method_name(keyword_method)}+{method_name(summary_method)}").alias("method"),
    )
