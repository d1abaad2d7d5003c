"""Language-model scores from a probabilistic suffix tree over words.

The tree holds contexts of one to three words. A context is a candidate if it occurs at least
``CONTEXT_LEAST`` times in the training texts, whatever their size, and its next words are those
that follow it at least ``NEXT_LEAST`` times. A candidate stays if its next-word distribution
diverges from that of its longest proper suffix by more than a description-length penalty;
suffixes of what stays stay. Next-word distributions are smoothed by absolute discounting into
those of the suffix, down to the add-one unigram distribution of all training words, so every
distribution sums to one (with one share for words never seen). A word is scored in the longest
context that stays.

Contexts and entries are named by 64-bit hashes (clashes as in ``words``). A longer context is
counted only where a fixed bitmap of the shorter table lets it pass; the bitmap drops nothing
that reaches the least counts. Counts cover the whole training corpus: they are summed in tasks
and then per range of keys, stay tables, and are tested by joins and groups. The most frequent
part of the model and of the words (fixed numbers) is broadcast for scoring. The rest of the
model is sent to the shards of documents that ask for it, each value once per shard; the rest
of the words is joined, one row per rare word of a document.

Edge cases: a null or empty text is the end token alone; documents of few words use the
contexts they have; a null id counts as the empty text in the fold hash; without training
documents every word is unknown and N and V are 0; repeated documents are each scored and each
counted; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import counts, jaccard_join, shards, words
from digestloom.session import materialise, release

FOLDS, HELD_OUT = 7, 2
# Least number of occurrences of a context, and of a next word in it.
CONTEXT_LEAST = 20
NEXT_LEAST = 4
# Words whose counts are broadcast, 12 MB, and values of the model that are, 8 MB.
MAX_FREQUENT = 1 << 20
MAX_HOT = 1 << 19
DISCOUNT = 0.75
# Nats that a context has to gain for each of its next words.
PENALTY = 2.0
# Text of a shard that asks for the rest of the model.
SHARD_BYTES = 8 << 20
# Different entries that a task holds before it sends them.
HELD_ENTRIES = 1 << 20
# Entries that wait for being counted, and ranges that are sent at once: what bounds the scratch memory.
PENDING_ENTRIES, SENT_PARTS = 1 << 18, 16

# The name of the end token, which is no word, and of the begin.
END, BEGIN, _ROOT, _NEXT, _SHARE = words.spread(5, seed=31)


def held_out(column):
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % FOLDS == HELD_OUT


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Names of the tokens of all texts, each with its end, and the first token of each text."""
    found = words.split(texts, words.SPACE_SEPARATED, True)
    n = len(found.first) - 1
    first = found.first + np.arange(n + 1)
    name = np.full(len(found.name) + n, END, dtype=np.uint64)
    name[np.arange(len(found.name)) + found.text_of()] = found.name
    return name, first


def _index(keys: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place of each key in a sorted table, and whether it is there."""
    if not len(table):
        return np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=bool)
    # In order, neighbours are found in memory that was just read.
    order = np.argsort(keys)
    keys = keys[order]
    near = np.minimum(np.searchsorted(table, keys), len(table) - 1)
    at, there = np.empty(len(keys), dtype=np.int64), np.empty(len(keys), dtype=bool)
    at[order], there[order] = near, table[near] == keys
    return at, there


def _first_context(word: np.ndarray) -> np.ndarray:
    """Names of contexts of one word."""
    return words.mix(word ^ _ROOT)


def _entry(context: np.ndarray, symbol: np.ndarray) -> np.ndarray:
    """Name of a next word in a context, which is that of the context one word longer."""
    return words.mix(words.mix(context + _NEXT) + symbol)


def _levels(name: np.ndarray, first: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For contexts of one to three words: context and entry of each token, and whether the text has it."""
    place = np.arange(len(name)) - np.repeat(first[:-1], np.diff(first))
    before = np.where(place > 0, np.roll(name, 1), BEGIN)
    context = _first_context(before)
    out = []
    for length in range(1, 4):
        entry = _entry(context, name)
        out.append((context, entry, place >= length - 1))
        context = np.roll(entry, 1)
    return out


def _unigrams(batch):
    for part in words.chunks(batch, "text"):
        yield tokens(part.column("text"))[0]


class _Entries:
    """Counts of (context, next word) given so far."""

    def __init__(self):
        self.key, self.context, self.symbol = (np.empty(0, dtype=np.uint64) for _ in range(3))
        self.n = np.empty(0, dtype=np.int64)
        self.new, self.pending = [], 0

    def add(self, key, context, symbol):
        self.new.append((key, context, symbol))
        self.pending += len(key)

    def merge(self):
        # Column by column, so that only one is held twice.
        new, self.new, pending, self.pending = [list(x) for x in zip(*self.new)] or [[], [], []], [], self.pending, 0
        key = np.concatenate((self.key, *new[0]))
        new[0].clear()
        order = np.argsort(key)
        key = key[order]
        fresh = np.ones(len(key), dtype=bool)
        fresh[1:] = key[1:] != key[:-1]
        self.key = key[fresh]
        at = order[fresh]
        self.context = np.concatenate((self.context, *new[1]))[at]
        new[1].clear()
        self.symbol = np.concatenate((self.symbol, *new[2]))[at]
        new[2].clear()
        n = np.concatenate((self.n, np.ones(pending, dtype=np.int64)))[order]
        self.n = np.add.reduceat(n, np.flatnonzero(fresh)) if len(n) else n


def _count_entries(training: DataFrame, length: int, long_enough, behind, parts: int) -> DataFrame:
    """``key, ctx, sym, n, one`` of the next words of contexts of ``length`` words.

    ``long_enough`` marks the contexts to look at, ``behind`` the entries of their suffixes;
    ``one`` names the context of the next word alone.
    """
    shift = np.uint64(64 - parts.bit_length() + 1)

    def tally(batches):
        found = _Entries()

        def sent():
            part = (words.mix(found.key) >> shift).astype(np.int32)
            order = np.argsort(part, kind="stable")
            cut = np.searchsorted(part[order], np.arange(parts + 1))
            # A few ranges at a time, as the payloads are copies.
            for begin in range(0, parts, SENT_PARTS):
                full = [i for i in range(begin, min(begin + SENT_PARTS, parts)) if cut[i + 1] > cut[i]]
                rows = [order[cut[i] : cut[i + 1]] for i in full]
                payload = [b"".join(x[r].tobytes() for x in (found.context, found.symbol, found.n)) for r in rows]
                yield pa.RecordBatch.from_arrays([pa.array(full, pa.int32()), pa.array(payload, pa.binary())], names=["part", "payload"])

        for batch in batches:
            for chunk in words.chunks(batch, "text"):
                name, first = tokens(chunk.column("text"))
                levels = _levels(name, first)
                context, entry, usable = levels[length - 1]
                kept = np.flatnonzero(usable)
                kept = kept[_is_marked(long_enough.value, context[kept])]
                if behind is not None:
                    kept = kept[_is_marked(behind.value, levels[length - 2][1][kept])]
                found.add(entry[kept], context[kept], name[kept])
                if found.pending > PENDING_ENTRIES:
                    found.merge()
                    if len(found.key) > HELD_ENTRIES:
                        yield from sent()
                        found = _Entries()
        found.merge()
        yield from sent()
        found = None
        words.give_back()

    def total(table: pa.Table) -> pa.Table:
        whole = [np.frombuffer(p, dtype=np.uint64).reshape(3, -1) for p in table.column("payload").to_pylist()]
        context, symbol, n = np.concatenate(whole, axis=1)
        key, at, inverse = np.unique(_entry(context, symbol), return_index=True, return_inverse=True)
        n = np.bincount(inverse, weights=n.astype(np.int64)).astype(np.int64)
        kept = n >= NEXT_LEAST
        at = at[kept]
        columns = (key[kept], context[at], symbol[at], n[kept], _first_context(symbol[at]))
        return pa.table({c: x.view(np.int64) for c, x in zip(("key", "ctx", "sym", "n", "one"), columns)})

    sent = training.mapInArrow(tally, "part int, payload binary")
    return sent.groupBy("part").applyInArrow(total, "key long, ctx long, sym long, n long, one long")


def _is_marked(bits: bytes, keys: np.ndarray) -> np.ndarray:
    cells = np.frombuffer(bits, dtype=np.uint8)
    cell = jaccard_join._cell(keys)
    return (cells[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0


def _word_contexts(batches):
    for batch in batches:
        key = _first_context(batch.column("key").to_numpy().view(np.uint64)).view(np.int64)
        yield pa.RecordBatch.from_arrays([pa.array(key), batch.column("n")], names=["key", "n"])


def _test(entries: DataFrame, length: int) -> tuple[DataFrame, DataFrame]:
    """Entries with their smoothed probability, and the contexts: does each diverge from its suffix?

    ``entries`` hold ``key, ctx, sym, n, total`` (of the context), ``q`` (of the next word in the
    suffix), ``tail`` and ``back``: the suffixes of ``key`` and of ``ctx`` as contexts.
    """
    entries = materialise(entries.withColumn("p", (F.col("n") - DISCOUNT) / F.col("total")), f"next{length}")
    contexts = entries.groupBy("ctx").agg(
        F.first("total").alias("total"), F.first("back").alias("back"), F.count("*").alias("kinds"),
        F.greatest(1 - F.sum("p"), F.lit(1e-9)).alias("share"), F.greatest(1 - F.sum("q"), F.lit(1e-12)).alias("outside"),
    )
    contexts = materialise(contexts, f"shares{length}")
    smooth = F.col("p") + F.col("share") * F.col("q")
    smoothed = entries.join(contexts.select("ctx", "share"), "ctx").withColumn("smooth", smooth)
    smoothed = smoothed.select("key", "ctx", "sym", "n", "tail", "p", "smooth", (F.col("smooth") * F.log(F.col("smooth") / F.col("q"))).alias("gain"))
    smoothed = materialise(smoothed, f"entries{length}")
    release(entries)
    gain = smoothed.groupBy("ctx").agg(F.sum("gain").alias("gain"))
    gained = F.col("total") * (F.col("gain") + F.col("share") * F.col("outside") * F.log("share"))
    tested = contexts.join(gain, "ctx").select("ctx", "total", "back", "share", (gained > PENALTY * F.col("kinds")).alias("stays"))
    tested = materialise(tested, f"contexts{length}")
    release(contexts)
    return smoothed, tested


class Tree:
    """The part of the model that is broadcast for scoring.

    ``key`` and ``value`` map the name of an entry to its discounted probability, and the name of
    a context (xor a constant) to the weight of its suffix.
    """

    def __init__(self, hot, hot_counts, total, kinds, key, value):
        self.hot, self.hot_counts = hot, hot_counts
        self.total, self.kinds = total, kinds
        self.key, self.value = key, value

    def find(self, keys: np.ndarray, rest=None) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, 0 if there is none, and whether there is."""
        out, found = np.zeros(len(keys)), np.zeros(len(keys), dtype=bool)
        likely = np.flatnonzero(_is_marked(rest[2], keys)) if rest else np.arange(len(keys))
        for key, value in ((self.key, self.value), *([rest[:2]] if rest else [])):
            at, there = _index(keys[likely], key)
            out[likely[there]] = value[at[there]]
            found[likely[there]] = True
        return out, found

    def asked(self, texts: pa.Array, bits: bytes) -> np.ndarray:
        """Sorted keys of the texts that the broadcast part lacks. The bitmap marks all keys of the model."""
        name, first = tokens(texts)
        keys = []
        for context, entry, usable in _levels(name, first):
            share = context ^ _SHARE
            live = np.flatnonzero(usable)
            live = live[_is_marked(bits, share[live])]
            # Entries of a context that did not stay are never looked up.
            keys += [share[live], entry[live][_is_marked(bits, entry[live])]]
        keys = words.distinct(np.concatenate(keys))
        return keys[~_index(keys, self.key)[1]]

    def asked_of_shard(self, texts: pa.RecordBatch, bits: bytes) -> np.ndarray:
        """``asked`` of all texts of a shard, in slices."""
        keys = [self.asked(part.column("text"), bits) for part in words.chunks(texts, "text")]
        return words.distinct(np.concatenate([np.empty(0, dtype=np.uint64), *keys]))

    def logs(self, texts: pa.Array, rest=None):
        """First token of each text, and per token: known count or -1, log10 of base and model.

        ``rest`` are keys and values beyond the broadcast ones, and a bitmap that marks all keys of the model. For a word outside the broadcast
        counts both logs leave out its own unigram term.
        """
        name, first = tokens(texts)
        at, hot = _index(name, self.hot)
        count = np.where(hot, self.hot_counts[at] if len(self.hot) else 0, -1)
        weight = float(self.total + self.kinds + 1)
        base = np.where(hot, (count + 1.0) / weight, 1.0)
        p = base.copy()
        for context, entry, usable in _levels(name, first):
            live = np.flatnonzero(usable)
            share, stays = self.find(context[live] ^ _SHARE, rest)
            live, share = live[stays], share[stays]
            if not len(live):
                break
            p[live] = self.find(entry[live], rest)[0] + share * p[live]
        return first, name, count, np.log10(base), np.log10(p)


def _score(tree, batch, rest=None):
    """Scores of a batch, in slices."""
    for part in words.chunks(batch, "text"):
        first, name, count, base, model = tree.logs(part.column("text"), rest)
        cold = count < 0
        at = np.concatenate(([0], np.cumsum(cold)))[first]
        total = lambda x: np.add.reduceat(x, first[:-1]) if len(x) else np.zeros(0)
        yield pa.RecordBatch.from_arrays(
            [
                part.column("id"),
                pa.array(np.diff(first), pa.int64()),
                pa.array(np.diff(first) - np.diff(at), pa.int64()),
                pa.array(total(base), pa.float64()),
                pa.array(total(model), pa.float64()),
                pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(name[cold].view(np.int64), pa.int64())),
            ],
            names=["id", "n_tokens", "n_hot", "base", "model", "rare"],
        )


def _scored(handle):
    def run(batches):
        for batch in batches:
            yield from _score(handle.value, batch)

    return run


def _scored_shards(handle, bits, parts):
    def run(batches):
        for batch in batches:
            for body, told in zip(batch.column("body"), batch.column("told").to_pylist()):
                texts = shards.unpack(body.as_py())
                # The answers name no keys: they follow the order of those asked for.
                keys = handle.value.asked_of_shard(texts, bits.value)
                answers = {a["part"]: a["payload"] for a in told or ()}
                there, value = [np.empty(0, dtype=bool)], [np.empty(0)]
                for part, asked in shards.ranges(keys, parts):
                    answer = np.frombuffer(answers[part], dtype=np.uint8)
                    cut = -(-len(asked) // 8)
                    there.append(np.unpackbits(answer[:cut], count=len(asked)).astype(bool))
                    value.append(np.frombuffer(answer[cut:].tobytes(), dtype=np.float64))
                yield from _score(handle.value, texts, (keys[np.concatenate(there)], np.concatenate(value), bits.value))
            words.give_back()

    return run


def _asked(handle, bits, parts):
    def run(batches):
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body")):
                keys = handle.value.asked_of_shard(shards.unpack(body.as_py()), bits.value)
                yield shards.messages(shards.send(shard, keys, parts))
            words.give_back()

    return run


def _told(asked: pa.Table, rest: pa.Table) -> pa.Table:
    """For each message of one range of keys: a bit per key, is it there? Then the values of those."""
    key = rest.column("key").to_numpy().view(np.uint64)
    order = np.argsort(key)
    key, value = key[order], rest.column("value").to_numpy()[order]
    out = []
    for payload in asked.column("payload").to_pylist():
        at, there = _index(np.frombuffer(payload, dtype=np.uint64), key)
        out.append(np.packbits(there).tobytes() + value[at[there]].tobytes())
    return pa.table({"shard": asked.column("shard"), "part": asked.column("part"), "payload": pa.array(out, pa.binary())})


def _scored_with_rest(rows: DataFrame, handle, rest: DataFrame, kind: str) -> DataFrame:
    """Scores of ``rows`` under the broadcast part and the ``rest`` of the model (``key, value``)."""
    held = shards.gather(rows, "text", SHARD_BYTES)
    size = held.agg(F.sum("n_bytes")).first()[0] or 0
    # A text asks for a key per ten bytes or fewer.
    parts = shards.parts_for(size // 8)
    marked = jaccard_join.with_marks(jaccard_join.marked(rest.select(F.col("key").alias("node"))), handle.value.key)
    bits = rows.sparkSession.sparkContext.broadcast(marked)
    asked = held.select("shard", "body").mapInArrow(_asked(handle, bits, parts), shards.MESSAGE)
    ranged = rest.withColumn("part", F.shiftrightunsigned("key", 65 - parts.bit_length()).cast("int"))
    told = asked.groupBy("part").cogroup(ranged.groupBy("part")).applyInArrow(_told, "shard long, part int, payload binary")
    # At most one payload per range, and all of them the values of one shard.
    told = told.groupBy("shard").agg(F.collect_list(F.struct("part", "payload")).alias("told"))
    return held.select("shard", "body").join(told.hint("shuffle_hash"), "shard", "left").mapInArrow(_scored_shards(handle, bits, parts), kind)


def _grow(training: DataFrame, table: DataFrame, total: int, kinds: int, docs: int, size: int) -> DataFrame:
    """The model: ``key, value, n`` of the contexts that stay and of their next words."""
    spark = training.sparkSession
    sc = spark.sparkContext
    parts = counts.parts_for(size // 8)
    known = table.filter((F.col("n") >= CONTEXT_LEAST) & (F.col("key") != F.lit(int(END.view(np.int64)))))
    begin = spark.createDataFrame([(int(_first_context(np.array([BEGIN])).view(np.int64)[0]), docs)], "key long, n long")
    held = materialise(known.select("key", "n").mapInArrow(_word_contexts, "key long, n long").unionByName(begin), "contexts0")
    # One task marks: the driver, which has the least memory, gets one bitmap and not several.
    mark = lambda rows: sc.broadcast(jaccard_join.marked(rows.select(F.col("key").alias("node")).coalesce(1)))
    root = table.select(F.col("key").alias("sym"), ((F.col("n") + 1) / F.lit(float(total + kinds + 1))).alias("q"))
    smoothed, tested, behind = [], [], None
    for length in range(1, 4):
        # The entries of the level before are the contexts of this one.
        before = held if length == 1 else smoothed[-1].filter(F.col("n") >= CONTEXT_LEAST)
        bits = mark(before)
        counted = materialise(_count_entries(training, length, bits, behind, parts), f"counted{length}")
        if length == 1:
            contexts = before.select(F.col("key").alias("ctx"), F.col("n").alias("total"), F.lit(None).cast("long").alias("back"))
            entries = counted.join(contexts, "ctx").join(root, "sym").withColumn("tail", F.col("one"))
        else:
            contexts = before.select(F.col("key").alias("ctx"), F.col("n").alias("total"), F.col("tail").alias("back"))
            below = smoothed[-1].select(F.col("ctx").alias("back"), "sym", F.col("smooth").alias("q"), F.col("key").alias("tail"))
            entries = counted.join(contexts, "ctx").join(below, ["back", "sym"])
        rows, contexts = _test(entries.drop("one"), length)
        release(counted)
        bits.destroy()
        if behind is not None:
            behind.destroy()
        behind = mark(rows) if length < 3 else None
        smoothed.append(rows)
        tested.append(contexts)
    model, needed, used = None, None, []
    for rows, contexts in zip(reversed(smoothed), reversed(tested)):
        stays = F.col("stays")
        if needed is not None:
            suffixes = needed.select(F.col("back").alias("ctx")).distinct().withColumn("held", F.lit(True))
            contexts, stays = contexts.join(suffixes, "ctx", "left"), stays | F.coalesce("held", F.lit(False))
        needed = materialise(contexts.filter(stays).select("ctx", "back", "share", "total"), "needed")
        shares = needed.select(
            F.col("ctx").bitwiseXOR(F.lit(int(_SHARE.view(np.int64)))).alias("key"), F.col("share").alias("value"), F.col("total").alias("n")
        )
        both = shares.unionByName(rows.join(needed.select("ctx"), "ctx", "left_semi").select("key", F.col("p").alias("value"), "n"))
        model = both if model is None else model.unionByName(both)
        used.append(needed)
    model = materialise(model, "model")
    for done in (held, *smoothed, *tested, *used):
        release(done)
    return model


def fit(training: DataFrame) -> tuple[Tree, DataFrame]:
    """The tree of the texts of ``training`` (column ``text``), and all word counts."""
    return _fit(training)[:2]


def _fit(training: DataFrame) -> tuple[Tree, DataFrame, DataFrame | None]:
    """``fit``, and the part of the model that is not broadcast, if there is one."""
    size = counts.text_bytes(training)
    table = materialise(counts.count_keys(training, _unigrams, counts.parts_for(size // 20)), "words")
    sums = table.agg(F.sum("n").alias("n"), F.count("*").alias("v")).first()
    total, kinds = sums["n"] or 0, sums["v"]
    docs = table.filter(F.col("key") == F.lit(int(END.view(np.int64)))).first()
    model = _grow(training, table, total, kinds, docs["n"] if docs else 0, size)
    name, number = _sorted(table.orderBy(F.desc("n"), "key").limit(MAX_FREQUENT), "n")
    key, value, n = _sorted(model.orderBy(F.desc("n"), "key").limit(MAX_HOT), "value", "n")
    tree = Tree(name, number, total, kinds, key, value)
    if len(key) < MAX_HOT:
        return tree, table, None
    least = int(n.min())
    last = int(key[n == least].view(np.int64).max())
    rest = model.filter((F.col("n") < least) | (F.col("n") == least) & (F.col("key") > last))
    return tree, table, materialise(rest.select("key", "value"), "rest")


def _sorted(rows: DataFrame, *columns: str) -> list[np.ndarray]:
    """Keys of a bounded number of rows in order, with columns."""
    found = rows.select("key", *columns).toArrow()
    keys = found.column("key").to_numpy().view(np.uint64)
    order = np.argsort(keys)
    return [keys[order], *(found.column(c).to_numpy()[order] for c in columns)]


def scores(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Unigram base and tree scores (log10) of every document; see the module."""
    rows = documents.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    tree, table, rest = _fit(rows.filter(~held_out(F.col("id"))).select("text"))
    handle = documents.sparkSession.sparkContext.broadcast(tree)
    kind = f"id {rows.schema['id'].dataType.simpleString()}, n_tokens long, n_hot long, base double, model double, rare array<long>"
    scored = rows.mapInArrow(_scored(handle), kind) if rest is None else _scored_with_rest(rows, handle, rest, kind)
    scored = materialise(scored.withColumn("row", F.monotonically_increasing_id()), "scored")
    rare = scored.select("row", F.explode("rare").alias("key"))
    weight = F.lit(float(tree.total + tree.kinds + 1))
    met = rare.join(table, "key", "left").groupBy("row").agg(
        F.sum(F.log10((F.coalesce("n", F.lit(0)) + 1) / weight)).alias("rare_log"), F.count("n").alias("rare_known")
    )
    log = F.coalesce("rare_log", F.lit(0.0))
    return scored.join(met, "row", "left").select(
        F.col("id").alias(id_col),
        held_out(F.col("id")).alias("held_out"),
        "n_tokens",
        (F.col("n_hot") + F.coalesce("rare_known", F.lit(0))).alias("n_known"),
        F.lit(tree.total).cast("long").alias("train_tokens"),
        (F.col("base") + log).alias("base_score"),
        (F.col("model") + log).alias("score"),
    )
