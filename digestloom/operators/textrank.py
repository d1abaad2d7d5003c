"""TextRank over the sentences of one document, without a sentence-pair graph.

The similarity of two sentences is the number of equal word pairs over the sum of the
logarithms of their lengths. That denominator depends on the two lengths only, so the
matrix product a power iteration needs can be taken per word and per sentence length:

    (W u)_i = sum over words w of i of  sum over lengths m of  y[w, m] / (ln len_i + ln m)
    y[w, m] = sum of u_j over the occurrences of w in sentences of length m

Work per step is linear in the words plus the pairs of *distinct lengths* under one word,
instead of quadratic in the sentences. All of it stays inside the document's row: no
shuffle, no edge table, no growing lineage, and a lost task is simply recomputed.

There are two forms of it. ``sentence_degrees``, ``sentence_ranks`` and ``summary_of`` are SQL expressions,
which Spark interprets element by element. ``degrees``, ``ranks`` and ``with_summary`` do the same sums in
the same order on the words of an Arrow batch at once, many documents a step; jobs use these.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from digestloom.functions.arrays import (
    blank_to_null, fold, keep, let, runs, struct, total, transform, zip_with,
)
from digestloom.functions.text import sentences, strip, words
from digestloom.operators.isolate import Guarded, guarded_rows
from digestloom.session import ship

# Fixed values of the published summariser.
DAMPING = 0.85
EPSILON = 1e-4
ROW_SUM_GUARD = 1e-7


def steps_to_settle(damping: float, epsilon: float) -> int:
    """Steps after which no change above ``epsilon`` is left.

    A step shrinks the change by the damping factor, and the first change is at most 2.
    """
    if not (0 <= damping < 1 and 0 < epsilon):
        raise ValueError("damping must lie in [0, 1) and epsilon above 0, or give max_steps")
    return 2 + (math.ceil(math.log(epsilon / 2) / math.log(damping)) if damping and epsilon < 2 else 0)


# Ranks are compared at this many decimals, so that equal sentences tie exactly.
TIE_DECIMALS = 12


# Bytes of words whose graphs are held at a time; a longer document is held alone.
PORTION_BYTES = 1 << 21


# SQL expression of the words of each sentence (array of arrays), from that of the sentences.
WordLists = Callable[[str], str]


@dataclass(frozen=True)
class Splitter:
    """How a text is cut: builders of SQL expressions for its sentences and a sentence's words."""

    to_sentences: Callable[[str], str] = sentences
    to_words: Callable[[str], str] = words

    def word_lists(self, parts: str) -> str:
        return transform(parts, self.to_words)


def python_splitter(splitter) -> Guarded:
    """A splitter that is a Python object with ``to_sentences(text)`` and ``to_words(sentence)``.

    Both run in one pass over a text, in Arrow batches; a text it fails on gets an error.
    """

    def split(text):
        parts = [str(s) for s in splitter.to_sentences(text)]
        return {"sentences": parts, "words": [[str(w) for w in splitter.to_words(s)] for s in parts]}

    return guarded_rows(split, "struct<sentences array<string>, words array<array<string>>>", type(splitter).__name__)


def given_words(column: str) -> WordLists:
    """Word lists that are there already, one per sentence; a sentence without one has no words."""
    none = "CAST(array() AS ARRAY<STRING>)"
    return lambda parts: transform(parts, lambda s, i: keep(f"coalesce(get({column}, {i}), {none})", lambda w: f"{w} IS NOT NULL"))


def _graph(parts: str, word_lists: WordLists | None = None) -> str:
    """``struct<words, sents>`` of one document. Words are compared in lower case.

    ``words``: per word that occurs more than once, its length classes
    ``array<struct<members, weights>>``: the sentence index of every occurrence, and the
    inverse similarity denominator towards each class of the word.
    ``sents``: per sentence, the indexes of its classes (in the flattened order of
    ``words``) and the weight it gets from words that occur nowhere else.
    """
    return let(_lowered(parts, word_lists), _graph_of_words)


def _lowered(parts: str, word_lists: WordLists | None = None) -> str:
    """The words of each sentence as they are compared."""
    if word_lists is None:
        return transform(parts, lambda s: words(f"lower({s})"))
    return transform(word_lists(parts), lambda ws: transform(ws, lambda w: f"lower({w})"))


def _slice(values: str, run: str, skip: int = 0) -> str:
    return f"slice({values}, {run}.lo + {1 + skip}, {run}.hi - {run}.lo - {skip})"


def _graph_of_words(parts: str) -> str:
    def placed(ws: str, i: str) -> str:
        return transform(ws, lambda w: struct(word=w, len=f"size({ws})", at=i))

    occurrences = f"sort_array(flatten({transform(parts, placed)}))"

    def by_length(one: str) -> str:
        return transform(
            runs(one, lambda a, b: f"{a}.len = {b}.len"),
            lambda r: struct(
                log_len=f"ln(get({one}, {r}.lo).len)",
                members=transform(_slice(one, r), lambda o: f"{o}.at"),
            ),
        )

    def weigh(classes: str) -> str:
        def inverse(c: str, o: str) -> str:
            norm = f"{c}.log_len + {o}.log_len"
            return f"CASE WHEN {norm} > 0 THEN 1D / ({norm}) ELSE 1D END"

        return transform(
            classes,
            lambda c: struct(
                members=f"{c}.members", weights=transform(classes, lambda o: inverse(c, o))
            ),
        )

    def by_word(occ: str) -> str:
        # One slice per word, then one per length inside it.
        repeated = keep(
            runs(occ, lambda a, b: f"{a}.word = {b}.word"), lambda r: f"{r}.hi - {r}.lo > 1"
        )
        return transform(
            transform(transform(repeated, lambda r: _slice(occ, r)), by_length), weigh
        )

    def by_sentence(shared: str) -> str:
        uses = transform(
            f"flatten({shared})",
            lambda c, k: transform(f"{c}.members", lambda at: struct(at=at, cls=k)),
        )
        # A marker per sentence keeps sentences without any shared word in place.
        markers = transform(parts, lambda s, i: struct(at=i, cls="-1"))
        return let(
            f"sort_array(concat(flatten({uses}), {markers}))",
            lambda us: transform(
                runs(us, lambda a, b: f"{a}.at = {b}.at"),
                lambda r: transform(_slice(us, r, skip=1), lambda u: f"{u}.cls"),
            ),
        )

    def solo(ws: str, classes: str) -> str:
        norm = f"CASE WHEN size({ws}) > 1 THEN ln(size({ws})) * 2 ELSE 1D END"
        return f"(size({ws}) - size({classes})) / ({norm})"

    return let(
        let(occurrences, by_word),
        lambda shared: struct(
            words=shared,
            sents=zip_with(
                parts, by_sentence(shared), lambda ws, cs: struct(classes=cs, solo=solo(ws, cs))
            ),
        ),
    )


def _spread(graph: str, u: str) -> str:
    """The product of the similarity matrix (diagonal included) with ``u``."""

    def per_class(classes: str) -> str:
        summed = transform(classes, lambda c: total(f"{c}.members", lambda at: f"get({u}, {at})"))
        return let(
            summed,
            lambda ys: transform(
                classes, lambda c: total(zip_with(ys, f"{c}.weights", lambda y, w: f"{y} * {w}"))
            ),
        )

    return let(
        f"flatten({transform(f'{graph}.words', per_class)})",
        lambda z: zip_with(
            f"{graph}.sents",
            u,
            lambda s, ui: f"{s}.solo * {ui} + {total(f'{s}.classes', lambda k: f'get({z}, {k})')}",
        ),
    )


def _degrees(graph: str, parts: str) -> str:
    return let(transform(parts, lambda s: "1D"), lambda ones: _spread(graph, ones))


def sentence_degrees(parts: str, word_lists: WordLists | None = None) -> str:
    """Summed similarity of each sentence to all sentences of the document, itself included."""
    return let(parts, lambda ps: let(_graph(ps, word_lists), lambda g: _degrees(g, ps)))


def sentence_ranks(
    parts: str,
    damping: float = DAMPING,
    epsilon: float = EPSILON,
    max_steps: int | None = None,
    word_lists: WordLists | None = None,
) -> str:
    """TextRank score of each sentence: ``array<double>`` aligned with ``parts``.

    The graph is that of ``word_lists``, by default of the words between whitespace.

    Steps end when the vector moves by at most ``epsilon`` (Euclidean), which they do before
    the default bound; ``epsilon=0`` with ``max_steps`` gives a fixed number of steps.
    """
    max_steps = steps_to_settle(damping, epsilon) if max_steps is None else max_steps
    stay, move = f"{1.0 - damping!r}D", f"{damping!r}D"

    def iterate(ps: str, graph: str, degrees: str) -> str:
        def step(x: str) -> str:
            share = zip_with(x, degrees, lambda r, d: f"{r} / ({d} + {ROW_SUM_GUARD!r}D)")
            return let(
                share,
                lambda u: transform(
                    _spread(graph, u), lambda s: f"{stay} / size({ps}) + {s} * {move}"
                ),
            )

        def moved(x: str, nx: str) -> str:
            change = total(zip_with(nx, x, lambda a, b: f"{a} - {b}"), lambda d: f"{d} * {d}")
            return struct(x=nx, going=f"sqrt({change}) > {epsilon!r}D")

        def advance(acc: str, _: str) -> str:
            stepped = let(step(f"{acc}.x"), lambda nx: moved(f"{acc}.x", nx))
            return f"CASE WHEN {acc}.going THEN {stepped} ELSE {acc} END"

        start = struct(x=transform(ps, lambda s: f"1D / size({ps})"), going="true")
        return fold(f"sequence(1, {int(max_steps)})", start, advance, lambda acc: f"{acc}.x")

    def ranked(ps: str) -> str:
        scores = let(_graph(ps, word_lists), lambda g: let(_degrees(g, ps), lambda d: iterate(ps, g, d)))
        return f"CASE WHEN size({ps}) > 0 THEN {scores} ELSE CAST(array() AS ARRAY<DOUBLE>) END"

    return let(parts, ranked)


class _Graphs:
    """The graphs of the documents of a batch as flat arrays; sums are taken in the order of the SQL form."""

    def __init__(self, texts: pa.ListArray):
        sents = texts.flatten()
        self.n_docs, self.n_sents = len(texts), len(sents)
        self.doc = pc.list_parent_indices(texts).to_numpy().astype(np.int64)
        self.size = np.bincount(self.doc, minlength=self.n_docs)
        at = pc.list_parent_indices(sents).to_numpy().astype(np.int64)
        length = np.bincount(at, minlength=self.n_sents)
        coded = sents.flatten().dictionary_encode()
        place = np.empty(len(coded.dictionary), np.int64)
        place[pc.sort_indices(coded.dictionary).to_numpy()] = np.arange(len(place))
        word = place[coded.indices.to_numpy(zero_copy_only=False)]
        order = np.lexsort((at, length[at], word, self.doc[at]))
        at, word = at[order], word[order]
        new = _changes(self.doc[at], word)
        times = np.diff(np.append(np.flatnonzero(new), len(at)))
        repeated = np.repeat(times > 1, times)
        once = np.bincount(at[~repeated], minlength=self.n_sents)
        log = np.log(np.maximum(length, 1))
        self.solo = once / np.where(length > 1, log * 2, 1.0)
        self.at, word = at[repeated], word[repeated]
        doc = self.doc[self.at]
        start = _changes(doc, word, length[self.at])
        # Classes: occurrences of a word in sentences of one length; each is weighed with all of its word.
        self.cls = np.cumsum(start) - 1
        self.cls_doc, cls_log = doc[start], log[self.at[start]]
        firsts = np.flatnonzero(_changes(self.cls_doc, word[start]))
        n = np.diff(np.append(firsts, len(cls_log)))
        per = np.repeat(n, n)
        self.left = np.repeat(np.arange(len(per)), per)
        self.right = np.arange(len(self.left)) - np.repeat(np.cumsum(per) - per, per) + np.repeat(np.repeat(firsts, n), per)
        norm = cls_log[self.left] + cls_log[self.right]
        self.weight = 1.0 / np.where(norm > 0, norm, 1.0)
        # A sentence adds up its classes in their order.
        self.by_sentence = np.lexsort((self.cls, self.at))

    def spread(self, u: np.ndarray) -> np.ndarray:
        """The product of the similarity matrices (diagonals included) with ``u``."""
        y = np.bincount(self.cls, u[self.at], len(self.cls_doc))
        z = np.bincount(self.left, y[self.right] * self.weight, len(self.cls_doc))
        order = self.by_sentence
        return self.solo * u + np.bincount(self.at[order], z[self.cls[order]], self.n_sents)

    def only(self, docs: np.ndarray) -> tuple[_Graphs, np.ndarray]:
        """The graphs of some documents (a mask), and where their sentences were."""
        kept = object.__new__(_Graphs)
        sents, classes = docs[self.doc], docs[self.cls_doc]
        members, pairs = sents[self.at], classes[self.left]
        new_doc, new_sent, new_cls = (np.cumsum(m) - 1 for m in (docs, sents, classes))
        kept.n_docs, kept.n_sents = int(docs.sum()), int(sents.sum())
        kept.doc, kept.size, kept.solo = new_doc[self.doc[sents]], self.size[docs], self.solo[sents]
        kept.at, kept.cls = new_sent[self.at[members]], new_cls[self.cls[members]]
        kept.cls_doc = new_doc[self.cls_doc[classes]]
        kept.left, kept.right, kept.weight = new_cls[self.left[pairs]], new_cls[self.right[pairs]], self.weight[pairs]
        kept.by_sentence = np.lexsort((kept.cls, kept.at))
        return kept, np.flatnonzero(sents)

    def settled(self, damping: float, epsilon: float, max_steps: int) -> np.ndarray:
        """The rank of every sentence."""
        out = np.zeros(self.n_sents)
        graphs, place = self, np.arange(self.n_sents)
        degrees = self.spread(np.ones(self.n_sents))
        x = 1.0 / self.size[self.doc]
        going = self.size > 0
        for _ in range(max_steps):
            if not going.any():
                break
            if 2 * going.sum() <= len(going):
                out[place] = x
                graphs, at = graphs.only(going)
                place, x, degrees, going = place[at], x[at], degrees[at], going[going]
            spread = graphs.spread(x / (degrees + ROW_SUM_GUARD))
            moved = (1.0 - damping) / graphs.size[graphs.doc] + spread * damping
            change = np.bincount(graphs.doc, (moved - x) ** 2, graphs.n_docs)
            x = np.where(going[graphs.doc], moved, x)
            going = going & (np.sqrt(change) > epsilon)
        out[place] = x
        return out


def _changes(*keys: np.ndarray) -> np.ndarray:
    """Whether a row is the first or differs from the one before."""
    new = np.ones(len(keys[0]), bool)
    new[1:] = np.logical_or.reduce([key[1:] != key[:-1] for key in keys])
    return new


def _by_batch(score: Callable[[_Graphs], np.ndarray]) -> Callable[[Column], Column]:
    """A function of word lists (arrays of arrays) whose result is an array of doubles, one per sentence."""

    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            rows = max(1, len(batch) * PORTION_BYTES // max(1, batch.nbytes))
            for at in range(0, len(batch), rows) or [0]:
                some = batch[at : at + rows]
                graphs = _Graphs(some)
                ends = np.concatenate([[0], np.cumsum(graphs.size)]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(score(graphs)))
                yield pc.if_else(some.is_valid(), lists, pa.scalar(None, lists.type)) if some.null_count else lists

    return F.arrow_udf(scored, "array<double>")


def degrees(parts: str, word_lists: WordLists | None = None) -> Column:
    """``sentence_degrees`` as a column."""
    return _by_batch(lambda graphs: graphs.spread(np.ones(graphs.n_sents)))(F.expr(_lowered(parts, word_lists)))


def ranks(parts: str, word_lists: WordLists | None = None, damping: float = DAMPING, epsilon: float = EPSILON,
          max_steps: int | None = None) -> Column:
    """``sentence_ranks`` as a column."""
    steps = steps_to_settle(damping, epsilon) if max_steps is None else int(max_steps)
    return _by_batch(lambda graphs: graphs.settled(damping, epsilon, steps))(F.expr(_lowered(parts, word_lists)))


def with_summary(docs: DataFrame, parts: str, k: int = 4, word_lists: WordLists | None = None) -> DataFrame:
    """The documents with the column ``summary``: ``summary_of`` the sentences ``parts``."""
    if k < 1:
        raise ValueError("a summary needs at least one sentence")
    ship(docs.sparkSession)
    cut = docs.withColumn("_parts", F.expr(parts))
    # Few sentences are not ranked.
    ranked = cut.withColumn("_ranks", ranks(f"CASE WHEN size(_parts) > {int(k)} THEN _parts END", word_lists))
    return ranked.withColumn("summary", F.expr(_chosen("_parts", "_ranks", k))).drop("_parts", "_ranks")


def lead(parts: str, k: int) -> str:
    """First ``k`` sentences joined with one space."""
    return f"array_join(slice({parts}, 1, {int(k)}), ' ')"


def _top_in_order(parts: str, ranks: str, k: int) -> str:
    by_rank = transform(ranks, lambda r, i: struct(r=f"-round({r}, {TIE_DECIMALS})", at=i))
    best = f"slice(sort_array({by_rank}), 1, {int(k)})"
    order = f"sort_array({transform(best, lambda b: f'{b}.at')})"
    return f"array_join({transform(order, lambda at: f'get({parts}, {at})')}, ' ')"


def summary_of(parts: str, k: int = 4, word_lists: WordLists | None = None) -> str:
    """Extractive summary of an array of sentences.

    Up to ``k`` sentences are returned as they are; otherwise the ``k`` best ranked ones in
    document order, with the first ``k`` as the fallback.
    """
    if k < 1:
        raise ValueError("a summary needs at least one sentence")

    return let(parts, lambda ps: _chosen(ps, sentence_ranks(ps, word_lists=word_lists), k))


def _chosen(ps: str, ranks: str, k: int) -> str:
    ranked = blank_to_null(strip(_top_in_order(ps, ranks, k)))
    return (
        f"CASE WHEN size({ps}) <= {int(k)} THEN array_join({ps}, ' ') "
        f"ELSE coalesce({ranked}, {lead(ps, k)}) END"
    )


def textrank_summary(text: str, k: int = 4, split_newlines: bool = False) -> str:
    return summary_of(sentences(text, split_newlines), k)


def split_summary(text: str, k: int, splitter: Splitter) -> str:
    """Summary of a text that is cut by ``splitter``."""
    return summary_of(splitter.to_sentences(text), k, splitter.word_lists)


def lead_summary(text: str, k: int = 4, split_newlines: bool = False) -> str:
    if k < 1:
        raise ValueError("a summary needs at least one sentence")
    return lead(sentences(text, split_newlines), k)


def explode_sentences(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", split_newlines: bool = False
) -> DataFrame:
    """One row per sentence: ``(id, sent_idx, sentence)``, ``sent_idx`` from 0."""
    return docs.select(
        id_col,
        F.posexplode(F.expr(sentences(text_col, split_newlines))).alias("sent_idx", "sentence"),
    )
