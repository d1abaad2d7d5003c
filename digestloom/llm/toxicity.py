"""Toxicity scores of restored text.

A character model over all documents restores disguised words (``deobfuscate``); labelled
documents tell which restored words mark toxic text; a document's score joins the evidence of
the marking words it holds as independent causes.

Marking words are learnt from at most ``max_labelled`` labelled rows of the training fold,
chosen by a hash of the id, each different text once. A word is a candidate if hardly any but
toxic texts hold it. Of the N words that k unrelated texts hold, N * share ** k are candidates
by chance; how that compares with the candidates found is the doubt in each of them, and lowers
the reliability it gets. Texts that marks explain are then set aside and the rest is looked at
again: there toxic texts are rarer, so fewer of them are enough, which is how a language with
few toxic texts gets marks. Where nothing certain is left, weak marks are taken with what they
are worth; several of them in a text add up.

Texts count as related when the smallest hash of their five-word shingles agrees, as it does in
most near copies; so a word of copies of one toxic text marks nothing.

Edge cases: null and empty texts hold no words and get the score of texts without marks; a
null id counts as the empty text in the fold hash and has no label; labels other than 0 and 1
are not used; of repeated labels the larger share wins; without labels no word marks; repeated
documents are each scored; other columns never enter a score.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import columns, deobfuscate, jaccard_join, words
from digestloom.session import materialise

FOLDS, HELD_OUT = 3, 1
MAX_LABELLED = 50_000
LEAST_SHARE = 0.9
# Unrelated texts among those of a word, at least.
UNRELATED_SHARE = 0.35
# Doubt up to which a mark explains a text, and up to which it is a weak mark.
SURE, WEAK = 0.02, 0.3
# Words in more unrelated texts than this are one class.
CLASSES = 64
THRESHOLD = 0.7
# Restored tokens that a worker keeps.
CACHED_TOKENS = 50_000


class Reader:
    """Names of the restored words of texts."""

    def __init__(self, model: deobfuscate.Model):
        self.model = model
        self.cache: dict[str, list[int]] = {}

    def _restored(self, token: str, spaced: bool) -> list[int]:
        key = token if not spaced else " " + token
        found = self.cache.get(key)
        if found is None:
            if len(self.cache) > CACHED_TOKENS:
                self.cache.clear()
            texts = deobfuscate.restore(token, self.model, spaced)
            found = deobfuscate.Tokens(pa.array(texts, pa.string())).name.tolist() if texts else []
            self.cache[key] = found
        return found

    def read(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Text number and name of every word: plain as it is, odd ones restored as well."""
        tokens = deobfuscate.Tokens(texts)
        text_of = np.repeat(np.arange(len(texts)), np.diff(tokens.first))
        owner, names = [], []
        for i in np.flatnonzero(tokens.odd).tolist():
            for name in self._restored(tokens.text(i), False):
                owner.append(text_of[i])
                names.append(name)
        for a, b in tokens.spaced_runs():
            run = "".join(tokens.text(i) for i in range(a, b))
            for name in self._restored(run, True):
                owner.append(text_of[a])
                names.append(name)
        some = tokens.some
        return (
            np.concatenate((text_of[some], np.array(owner, dtype=np.int64))),
            np.concatenate((tokens.name[some], np.array(names, dtype=np.uint64))),
        )


def _observed(handle):
    """Different words of each labelled text."""

    def run(batches):
        reader = Reader(handle.value)
        for batch in words.gathered(batches, "text", words.CHUNK_BYTES):
            owner, names = reader.read(batch.column("text"))
            order = np.argsort(owner, kind="stable")
            cut = np.searchsorted(owner[order], np.arange(batch.num_rows + 1))
            lists = [np.unique(names[order[a:b]]).view(np.int64) for a, b in zip(cut, cut[1:])]
            kin = [int(x.min().view(np.int64)) if len(x) else 0 for x in jaccard_join.shingle_sets(batch.column("text"), 5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("same"), batch.column("toxic"), pa.array(kin, pa.int64()), pa.array(lists, pa.list_(pa.int64()))],
                names=["same", "toxic", "kin", "marks"],
            )

    return run


def _scored(handle, base: float, text: str):
    """Batches of one task with the scores of their texts."""

    def run(batches):
        model, marks, chance = handle.value
        reader = Reader(model)
        for batch in words.gathered(batches, text, words.CHUNK_BYTES):
            owner, names = reader.read(batch.column(text))
            at = np.searchsorted(marks, names)
            hit = marks[np.minimum(at, len(marks) - 1)] == names if len(marks) else np.zeros(len(names), dtype=bool)
            doc, mark = words.unique_pairs(owner[hit], at[hit])
            calm = np.bincount(doc, weights=np.log1p(-chance[mark]), minlength=batch.num_rows)
            yield batch, 1 - (1 - base) * np.exp(calm)

    return run


def _scores(handle, base: float):
    def run(batches):
        for batch, score in _scored(handle, base, "text")(batches):
            rest = [n for n in batch.schema.names if n != "text"]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in rest), pa.array(score, pa.float64())], names=[*rest, "score"])

    return run


def held_out(id_col: str):
    return F.crc32(F.coalesce(F.col(id_col).cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


class Classifier:
    """A fitted model: character counts, marking words and their reliability."""

    def __init__(self, model, marks, chance, base):
        self.model, self.marks, self.chance, self.base = model, marks, chance, base

    def score(self, documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
        """``documents`` ids with ``score``."""
        rows = documents.select(F.col(id_col), F.col(text_col).cast("string").alias("text"))
        handle = documents.sparkSession.sparkContext.broadcast((self.model, self.marks, self.chance))
        kind = rows.schema[0].dataType.simpleString()
        return rows.mapInArrow(_scores(handle, self.base), f"`{id_col}` {kind}, score double")


def fit(
    documents: DataFrame,
    labels: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "toxic",
    max_labelled: int = MAX_LABELLED,
) -> Classifier:
    """Learn from the labelled documents outside the held-out fold."""
    spark = documents.sparkSession
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    grams = deobfuscate.character_counts(rows).toArrow()
    model = deobfuscate.Model(grams.column("gram").to_numpy(), grams.column("n").to_numpy())
    known = (
        labels.select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("toxic"))
        .filter(F.col("id").isNotNull() & F.col("toxic").isin(0, 1) & ~held_out("id"))
        .groupBy("id").agg((F.avg("toxic") >= 0.5).cast("int").alias("toxic"))
        .orderBy(F.xxhash64("id"), "id").limit(max_labelled)
    )
    known = materialise(known, "labels")
    # At most max_labelled narrow rows are broadcast.
    train = rows.join(F.broadcast(known), "id").select(F.xxhash64("text").alias("same"), F.col("toxic"), "text")
    handle = spark.sparkContext.broadcast(model)
    seen = train.mapInArrow(_observed(handle), "same long, toxic int, kin long, marks array<long>")
    seen = seen.groupBy("same").agg(F.max("toxic").alias("toxic"), F.first("kin").alias("kin"), F.first("marks").alias("marks"))
    seen = materialise(seen, "observed")
    size = seen.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
    each = materialise(seen.select("same", "kin", "toxic", F.explode("marks").alias("mark")), "words")
    names, chance, explained = _marks(each, size["n"] or 0, size["t"] or 0)
    order = np.argsort(names)
    base = ((size["t"] or 0) - explained + 0.5) / (max((size["n"] or 0) - explained, 0) + 2.0)
    return Classifier(model, names[order], chance[order], min(base, 0.5))


def _doubts(found, share: float) -> dict[int, float]:
    """By the number of unrelated texts of a word: candidates by chance among those found."""
    doubt, least = {}, 1.0
    for k, n, hits in found:
        least = min(least, n * share**k / max(hits, 1))
        doubt[k] = least
    return doubt


def _marks(each: DataFrame, n_texts: int, n_toxic: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Names of marking words, their reliability, and how many toxic texts the sure ones explain.

    Rounds end when no sure mark is found; every other round explains a further toxic text.
    """
    names, chance, explained, open_ = [], [], 0, n_toxic
    while open_:
        share = min(max(open_ / n_texts, 1e-6), 0.5)
        family = each.groupBy("mark", "kin").agg(F.min("toxic").alias("t"), F.count("*").alias("n"))
        counted = family.groupBy("mark").agg(F.count("*").alias("k"), F.sum("t").alias("t"), F.sum("n").alias("n")).filter("k > 1")
        candidate = (F.col("t") >= LEAST_SHARE * F.col("k")) & (F.col("k") >= UNRELATED_SHARE * F.col("n"))
        counted = counted.withColumn("hit", candidate).withColumn("class", F.least("k", F.lit(CLASSES)))
        counted = materialise(counted, "counted")
        found = counted.groupBy("class").agg(F.count("*"), F.count_if("hit")).orderBy("class").collect()
        doubt = _doubts(found, share)
        sure = [k for k, x in doubt.items() if x <= SURE]
        taken = sure or [k for k, x in doubt.items() if x <= WEAK]
        marks = counted.filter(F.col("hit") & F.col("class").isin(taken)).select("mark", "class", "k", "t")
        table = marks.toArrow()
        if not table.num_rows:
            # The surest classes may hold no word: what is left is weak.
            weak = [k for k, x in doubt.items() if x <= WEAK]
            table, sure = counted.filter(F.col("hit") & F.col("class").isin(weak)).select("mark", "class", "k", "t").toArrow(), []
        k, t = table.column("k").to_numpy(), table.column("t").to_numpy()
        sound = np.array([1 - doubt[c] for c in table.column("class").to_pylist()])
        names.append(table.column("mark").to_numpy().view(np.uint64))
        chance.append(sound * (t + 0.5) / (k + 1.0))
        if not sure:
            break
        known = materialise(each.join(marks.select("mark"), "mark", "left_semi").groupBy("same").agg(F.max("toxic").alias("toxic")), "explained")
        gone = known.agg(F.count("*").alias("n"), F.sum("toxic").alias("t")).first()
        explained, open_, n_texts = explained + gone["t"], open_ - gone["t"], n_texts - gone["n"]
        each = materialise(each.join(known, "same", "left_anti"), "words")
    if not names:
        return np.empty(0, dtype=np.uint64), np.empty(0), 0
    return np.concatenate(names), np.concatenate(chance), explained


def scores(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """``doc_id, held_out, score, predicted`` for every document."""
    fitted = fit(documents, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    return fitted.score(documents, id_col, text_col).select(
        id_col, held_out(id_col).alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted")
    )


def drop_toxic(documents: DataFrame, labels: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", label_col: str = "toxic") -> DataFrame:
    """Documents below the threshold, all columns as they are."""
    fitted = fit(documents, labels, id_col=id_col, text_col=text_col, label_col=label_col)
    documents, back = columns.set_aside(documents)
    rows = documents.withColumn("_dl_text", F.col(columns.renamed(text_col, back)).cast("string"))
    handle = documents.sparkSession.sparkContext.broadcast((fitted.model, fitted.marks, fitted.chance))

    def keep(batches):
        for batch, score in _scored(handle, fitted.base, "_dl_text")(batches):
            yield batch.filter(pa.array(score < THRESHOLD))

    return rows.mapInArrow(keep, rows.schema).drop("_dl_text").withColumnsRenamed(back)
