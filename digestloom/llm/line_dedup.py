"""Line dedup by an exact set-similarity join.

A line is the set of its different words. Two lines match when the Jaccard similarity of their
sets reaches the threshold. A line is removed when any earlier line matches it; earlier means
by document id, then by place. Whether the earlier line itself stays does not matter, so the
result does not depend on the order in which pairs are found.

The words of a line are ordered by rarity over all documents (the counts of the most frequent
words are broadcast, a fixed number; the others come first, by name). Matching sets share a
word in the first ``n - ceil(t n) + 1`` of both, so only these are posted, and words that occur
once are not. Pairs of a list pass length and positional filters and a parity filter of 64
cells before they leave the list, and then the sets themselves are compared.

Equal sets are one node with one first occurrence. Lists are paired whole where no
entry has many possible matches. In other lists every node is compared with its neighbours
first; only nodes for which that found no earlier match are compared with the whole list, so a
family of near copies costs a line of comparisons.

A line of few words can only match an equal one (at 0.8 a line of three words; one of four may
match a line of five): such lines are nodes, but post no words.

Edge cases: null and empty texts have one empty line; blank lines are never compared and always
stay, and so do lines of fewer than ``least_words`` different words (none by default); lines end at line feeds;
repeated documents are copies, the first in reading order stays; documents without an id come
last; a document may lose all its lines; other columns are kept as they are.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import columns, counts, jaccard_join, shards, words
from digestloom.session import free_shuffles, materialise, release

PERCENT = 80
LEAST_WORDS = 1
MAX_FREQUENT = 1 << 20
SHARD_BYTES = 2 << 20
# Entries of long lists looked at in one call, and pairs of them looked at at once.
GROUP_ENTRIES = 20_000
BLOCK_PAIRS = 1 << 20
# Lists up to this length are paired whole.
PAIRED_LIST = 32
# Lists up to this length are paired whole unless an entry has more possible matches than FEW.
WHOLE_LIST, FEW = 512, 8

_CELL = words.spread(2, seed=41)


# Bits of the order of a word inside its line; a line number below 2^20 takes the others.
_ORDER_BITS = np.uint64(44)
_FREQUENT = np.uint64(1 << 43)


class Places:
    """Where the lines of some texts begin and end."""

    def __init__(self, texts: pa.Array):
        raw, offsets = words.utf8(texts)
        feeds = np.flatnonzero(raw == 10)
        n = len(offsets) - 1
        # A text has one line more than it has line feeds.
        per_text = np.searchsorted(feeds, offsets[1:]) - np.searchsorted(feeds, offsets[:-1]) + 1
        self.first = np.concatenate(([0], np.cumsum(per_text)))
        text_of = np.repeat(np.arange(n), per_text)
        number = np.arange(len(text_of)) - self.first[text_of]
        before = np.searchsorted(feeds, offsets[:-1])
        self.start, self.end = offsets[text_of].copy(), offsets[text_of + 1].copy()
        inner = number > 0
        self.start[inner] = feeds[before[text_of[inner]] + number[inner] - 1] + 1
        last = number == per_text[text_of] - 1
        self.end[~last] = feeds[before[text_of[~last]] + number[~last]]
        self.text_of, self.number, self.raw = text_of, number, raw

    def blank(self) -> np.ndarray:
        """Lines without a word."""
        place = np.flatnonzero(words.SPACE_SEPARATED[self.raw])
        return np.searchsorted(place, self.start) == np.searchsorted(place, self.end)

    def alone(self, picked: np.ndarray) -> pa.Array:
        """The given lines as texts of their own."""
        raw = self.raw.tobytes()
        return pa.array([raw[a:b] for a, b in zip(self.start[picked].tolist(), self.end[picked].tolist())], pa.binary()).cast(pa.string())


class Lines(Places):
    """Lines of some texts as sets of words, in the order of 44-bit codes of their names."""

    def __init__(self, texts: pa.Array, order_of=None):
        super().__init__(texts)
        found = words.split(texts, words.SPACE_SEPARATED, True)
        # Words are in the order of lines, so the last line that starts before a word holds it.
        line = np.searchsorted(self.start, found.start, side="right") - 1
        # Words of one line whose codes agree are taken as equal: some hundred words, 43 bits.
        code = order_of(found.name) if order_of else found.name >> np.uint64(21)
        if len(self.start) < 1 << 20:
            order = np.argsort((line.astype(np.uint64) << _ORDER_BITS) | code)
        else:
            order = np.lexsort((code, line))
        line, code = line[order], code[order]
        fresh = np.concatenate(([True], (line[1:] != line[:-1]) | (code[1:] != code[:-1]))) if len(code) else np.empty(0, dtype=bool)
        self.name, self.line = found.name[order[fresh]], line[fresh]
        self.size = np.bincount(self.line, minlength=len(self.start))
        self.at = np.cumsum(self.size) - self.size
        some = self.size > 0
        sums = np.zeros(len(self.start), dtype=np.uint64)
        if len(self.name):
            sums[some] = np.add.reduceat(words.mix(self.name ^ _CELL[0]), self.at[some])
        self.node = words.mix(sums + self.size.astype(np.uint64))

    def cells(self, picked: np.ndarray) -> np.ndarray:
        """64 parity cells for each of the given lines, none of them blank."""
        bit = np.uint64(1) << (words.mix(self.name ^ _CELL[1]) & np.uint64(63))
        return np.bitwise_xor.reduceat(np.append(bit, np.uint64(0)), self.at)[picked]

    def firsts(self, ids: np.ndarray, picked: np.ndarray) -> np.ndarray:
        """Of the given lines, the first of each node, by document id and place."""
        order = picked[np.lexsort((self.number[picked], self.text_of[picked], ids[self.text_of[picked]], self.node[picked]))]
        fresh = np.concatenate(([True], self.node[order][1:] != self.node[order][:-1])) if len(order) else np.empty(0, dtype=bool)
        return order[fresh]


def _ids(column: pa.Array) -> np.ndarray:
    """Document ids for ordering; documents without one come last."""
    return column.cast(pa.int64()).fill_null(np.iinfo(np.int64).max).to_numpy(zero_copy_only=False)


def _rank(names: np.ndarray, rank: np.ndarray):
    """Codes by rarity: words outside ``names`` by name, then the others by their rank."""

    def order_of(name):
        code = name >> np.uint64(21)
        if len(names):
            at = np.minimum(np.searchsorted(names, name), len(names) - 1)
            code = np.where(names[at] == name, _FREQUENT | rank[at], code)
        return code

    return order_of


_ENTRY = [("key", "u8"), ("node", "i8"), ("cells", "u8"), ("age", "f4"), ("n", "u4"), ("at", "u4")]


_NODE = "node long, n long, doc long, shard long, place long, cells long"


def _nodes(text, id_col, least):
    """First occurrence of each node of a shard."""

    def run(batches):
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body")):
                rows = shards.unpack(body.as_py())
                ids = _ids(rows.column(id_col))
                lines = Lines(rows.column(text))
                first = lines.firsts(ids, np.flatnonzero(lines.size >= least))
                text_of = lines.text_of[first]
                found = [lines.node[first], lines.size[first], ids[text_of], np.full(len(first), shard), (text_of << 32) | lines.number[first], lines.cells(first)]
                yield pa.RecordBatch.from_arrays([pa.array(c.astype(np.int64)) for c in found], names=["node", "n", "doc", "shard", "place", "cells"])
            words.give_back()

    return run


def _post(text, id_col, percent, least, handle, parts):
    """Postings of the rare words of each node of a shard: one message per shard and range of words."""

    def run(batches):
        names, n, once = handle.value
        several = np.frombuffer(once, dtype=np.uint8)
        for batch in batches:
            for body in batch.column("body"):
                rows = shards.unpack(body.as_py())
                ids = _ids(rows.column(id_col))
                lines = Lines(rows.column(text), _rank(names, n))
                first = lines.firsts(ids, np.flatnonzero(lines.size >= least))
                size = lines.size[first]
                head = size - -(-percent * size // 100) + 1
                # The nearest set that is not equal has one word more.
                head[100 * size < percent * (size + 1)] = 0
                place = words.ragged(lines.at[first], head)
                owner = np.repeat(np.arange(len(first)), head)
                at = np.arange(len(place)) - np.repeat(np.cumsum(head) - head, head)
                key = lines.name[place]
                cell = jaccard_join._cell(key.view(np.int64))
                met = (several[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0
                key, owner, at = key[met], owner[met], at[met]
                node = lines.node[first].view(np.int64)
                cells = lines.cells(first)
                entry = np.empty(len(key), dtype=_ENTRY)
                entry["cells"] = cells[owner]
                # Words are spread over ranges by another hash than the nodes.
                entry["key"], entry["node"], entry["n"], entry["at"] = key, node[owner], size[owner], at
                entry["age"] = ids[lines.text_of[first]][owner].astype(np.float32)
                part = jaccard_join._by_part(words.mix(key), parts)
                order = np.argsort(part, kind="stable")
                entry, cut = entry[order], np.searchsorted(part[order], np.arange(parts + 1))
                sent = [(i, entry[a:b].tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([i for i, _ in sent], pa.int32()), pa.array([p for _, p in sent], pa.binary())], names=["part", "payload"]
                )
            words.give_back()

    return run


def _may_match(n1, at1, cells1, n2, at2, cells2, percent):
    """Length and positional filters, and the parity cells: a bound on the words not shared."""
    need = -(-percent * (n1 + n2) // (100 + percent))
    sizes = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    differ = np.bitwise_count(cells1 ^ cells2).astype(np.int64)
    return sizes & (np.minimum(n1 - at1, n2 - at2) >= need) & (differ <= n1 + n2 - 2 * need)


def _lists(percent):
    """Pairs of short lists, near pairs of long ones, and the entries of the latter."""

    def run(table: pa.Table) -> pa.Table:
        entry = np.concatenate([np.frombuffer(p, dtype=_ENTRY) for p in table.column("payload").to_pylist()])
        # The node of a key comes once from each shard; keep the oldest.
        entry = entry[np.lexsort((entry["age"], entry["node"], entry["key"]))]
        fresh = np.concatenate(([True], (entry["key"][1:] != entry["key"][:-1]) | (entry["node"][1:] != entry["node"][:-1])))
        entry = entry[fresh]
        entry = entry[np.lexsort((entry["node"], entry["age"], entry["key"]))]
        key, node, cells = entry["key"], entry["node"], entry["cells"]
        n, at = entry["n"].astype(np.int64), entry["at"].astype(np.int64)
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        head = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
        number = np.cumsum(begins) - 1
        length = np.bincount(number)[number]
        short = length <= PAIRED_LIST
        a, b = [], []

        def offer(i, j):
            ok = _may_match(n[i], at[i], cells[i], n[j], at[j], cells[j], percent)
            a.append(i[ok])
            b.append(j[ok])
            return ok

        later = np.flatnonzero(~begins)
        offer(head[later], later)
        offer(later - 1, later)
        later = later[short[later]]
        for step in range(2, PAIRED_LIST):
            later = later[later - step >= head[later]]
            offer(later - step, later)
        # Longer lists are paired until one entry has too many possible matches: a family of near copies.
        crowded, hits = np.zeros(int(number[-1]) + 1, dtype=bool), np.zeros(len(key), dtype=np.int64)
        middle = np.flatnonzero(~short & (length <= WHOLE_LIST))
        for step in range(2, WHOLE_LIST):
            middle = middle[(middle - step >= head[middle]) & ~crowded[number[middle]]]
            if not len(middle):
                break
            j = middle[offer(middle - step, middle)]
            hits[j] += 1
            crowded[number[j][hits[j] > FEW]] = True
        short |= (length <= WHOLE_LIST) & ~crowded[number]
        # In lists that stay open also neighbours by size.
        by_size = np.lexsort((node, n, number))
        i, j = by_size[:-1], by_size[1:]
        near = (number[i] == number[j]) & ~short[i]
        offer(i[near], j[near])
        pairs = jaccard_join.different_pairs(node[np.concatenate(a)], node[np.concatenate(b)])
        long_ = ~short
        m, k = pairs.shape[1], int(long_.sum())
        none = pa.nulls(m, pa.int64())
        rest = [pa.concat_arrays([none, pa.array(c)]) for c in (key[long_].view(np.int64), n[long_], at[long_])]
        return pa.table({
            "a": pa.array(np.concatenate((pairs[0], node[long_]))),
            "b": pa.concat_arrays([pa.array(pairs[1]), pa.nulls(k, pa.int64())]),
            "key": rest[0], "n": rest[1], "at": rest[2],
        })

    return run


def _open_against_list(percent):
    """Pairs of the nodes without an earlier match with all earlier ones of their list.

    A group holds the lists of some keys; pairs are looked at in blocks, and only those that
    may match come out.
    """

    def run(table: pa.Table) -> pa.Table:
        key, node, n, at, doc, shard, place = (table.column(c).to_numpy() for c in ("key", "a", "n", "at", "doc", "shard", "place"))
        order = np.lexsort((place, shard, doc, key))
        key, node, n, at = key[order], node[order], n[order], at[order]
        cells = table.column("cells").to_numpy()[order].view(np.uint64)
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        start = np.maximum.accumulate(np.where(begins, np.arange(len(key)), 0))
        later = np.flatnonzero(table.column("open").to_numpy(zero_copy_only=False)[order])
        later = later[later > start[later]]
        upto = np.cumsum(later - start[later])
        pairs = [np.empty((2, 0), dtype=np.int64)]
        done = 0
        while done < len(later):
            to = int(np.searchsorted(upto, (upto[done - 1] if done else 0) + BLOCK_PAIRS, side="right"))
            block = later[done : max(to, done + 1)]
            done += len(block)
            a, b = words.ragged(start[block], block - start[block]), np.repeat(block, block - start[block])
            ok = _may_match(n[a], at[a], cells[a], n[b], at[b], cells[b], percent)
            pairs.append(jaccard_join.different_pairs(node[a[ok]], node[b[ok]]))
        pairs = jaccard_join.different_pairs(*np.concatenate(pairs, axis=1))
        return pa.table({"a": pairs[0], "b": pairs[1]})

    return run


def _spot(shard, place):
    """A number for a place, to be marked in a bitmap; few places share one."""
    return (shard << 17) ^ place


def _wanted_sets(text, least, wanted):
    """Nodes and words of the lines whose places are marked; no others are split."""

    def run(batches):
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in batches:
            for shard, body in zip(batch.column("shard").to_pylist(), batch.column("body")):
                places = Places(shards.unpack(body.as_py()).column(text))
                cell = jaccard_join._cell(_spot(np.int64(shard), (places.text_of << 32) | places.number))
                lines = Lines(places.alone(np.flatnonzero((bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1)))
                picked = np.flatnonzero(lines.size >= least)
                _, once = np.unique(lines.node[picked], return_index=True)
                picked = picked[once]
                sets = [lines.name[a : a + k].tobytes() for a, k in zip(lines.at[picked].tolist(), lines.size[picked].tolist())]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lines.node[picked].view(np.int64)), pa.array(sets, pa.binary())], names=["node", "tokens"]
                )
            words.give_back()

    return run


def _rewrite(text, least, n_lines, n_removed):
    """Texts without the removed lines: those to compare whose places are not given."""

    def run(batches):
        for batch in batches:
            for body, place in zip(batch.column("body"), batch.column("kept")):
                rows = shards.unpack(body.as_py())
                lines = Places(rows.column(text)) if least <= 1 else Lines(rows.column(text))
                stays = lines.blank() if least <= 1 else lines.size < least
                place = place.values.to_numpy(zero_copy_only=False) if place.is_valid else np.empty(0, dtype=np.int64)
                stays[lines.first[place >> 32] + (place & 0xFFFFFFFF)] = True
                raw = lines.raw.tobytes()
                start, end = lines.start.tolist(), lines.end.tolist()
                kept, removed = [], []
                valid = rows.column(text).is_valid().to_pylist()
                for i in range(rows.num_rows):
                    a, b = int(lines.first[i]), int(lines.first[i + 1])
                    picked = (np.flatnonzero(stays[a:b]) + a).tolist()
                    removed.append(b - a - len(picked))
                    kept.append(b"\n".join([raw[start[j] : end[j]] for j in picked]) if valid[i] else None)
                at = rows.schema.get_field_index(text)
                out = rows.set_column(at, text, pa.array(kept, pa.binary()).cast(pa.string()))
                yield pa.RecordBatch.from_arrays(
                    [*out.columns, pa.array(np.diff(lines.first), pa.int64()), pa.array(removed, pa.int64())],
                    names=[*out.schema.names, n_lines, n_removed],
                )
            words.give_back()

    return run


def remove_repeated_lines(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS
) -> DataFrame:
    """``documents`` with the kept lines as text, and ``_dl_lines`` and ``_dl_removed``.

    Where the documents have such columns, the counts get underscores behind their names.
    """
    sc = documents.sparkSession.sparkContext
    documents = documents.withColumn(text_col, F.col(text_col).cast("string"))
    held = shards.gather(documents, text_col, SHARD_BYTES)
    plain = documents.select(F.col(text_col).alias("text"))
    size = held.agg(F.sum("n_bytes")).first()[0] or 0

    def each_word(batch):
        for part in words.chunks(batch, "text"):
            yield words.split(part.column("text"), words.SPACE_SEPARATED, True).name

    table = materialise(counts.count_keys(plain, each_word, counts.parts_for(size // 20), 2), "words")
    hot = table.orderBy(F.desc("n"), "key").limit(MAX_FREQUENT).toArrow()
    keys, n = hot.column("key").to_numpy().view(np.uint64), hot.column("n").to_numpy()
    order = np.argsort(keys)
    several = jaccard_join.marked(table.select(F.col("key").alias("node")))
    rank = np.empty(len(keys), dtype=np.uint64)
    rank[np.lexsort((keys, n))] = np.arange(len(keys), dtype=np.uint64)
    release(table)
    handle = sc.broadcast((keys[order], rank[order], several))
    parts = counts.parts_for(size // 40)
    bodies = held.select("shard", "body")
    # First occurrence of each node: few rows from each shard, and none of a hot node.
    age = F.struct("doc", "shard", "place")
    nodes = materialise(
        bodies.mapInArrow(_nodes(text_col, id_col, least_words), _NODE)
        .groupBy("node").agg(F.min(age).alias("age"), F.first("cells").alias("cells"), F.first("n").alias("n")),
        "nodes",
    )
    free_shuffles(documents.sparkSession)
    posted = bodies.mapInArrow(_post(text_col, id_col, percent, least_words, handle, parts), "part int, payload binary")
    found = materialise(posted.groupBy("part").applyInArrow(_lists(percent), "a long, b long, key long, n long, at long"), "pairs")
    free_shuffles(documents.sparkSession)
    handle.destroy()
    del hot, keys, n, rank, order, several

    def matches(pairs):
        """Nodes that have an earlier match among the pairs."""
        one = nodes.select(F.col("node").alias("a"), F.col("age").alias("age1"))
        two = nodes.select(F.col("node").alias("b"), F.col("age").alias("age2"))
        likely = pairs.distinct().join(one, "a").join(two, "b")
        likely = materialise(likely.select("a", "b", F.when(F.col("age1") > F.col("age2"), F.col("a")).otherwise(F.col("b")).alias("later")), "likely")
        wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        wanted = materialise(wanted.join(nodes.select("node", "age"), "node"), "wanted")
        bits = sc.broadcast(jaccard_join.marked(wanted.select(F.shiftleft("age.shard", 17).bitwiseXOR(F.col("age.place")).alias("node"))))
        sets = bodies.mapInArrow(_wanted_sets(text_col, least_words, bits), "node long, tokens binary").join(wanted, "node", "left_semi")
        sets = materialise(sets.groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")
        one, two = (sets.select(F.col("node").alias(x), F.col("tokens").alias(s)) for x, s in (("a", "s1"), ("b", "s2")))
        equal = likely.join(one, "a").join(two, "b").mapInArrow(jaccard_join.compare(percent, ["later"]), "later long")
        matched = materialise(equal.select(F.col("later").alias("node")).distinct(), "matched")
        for done in (likely, wanted, sets):
            release(done)
        bits.destroy()
        return matched

    matched = matches(found.filter("key is null").select("a", "b"))
    entries = found.filter("key is not null").select("key", "a", "n", "at")
    entries = (
        entries.join(nodes.select(F.col("node").alias("a"), "age.*", "cells"), "a")
        .join(matched.select(F.col("node").alias("a"), F.lit(False).alias("open")), "a", "left")
        .withColumn("open", F.coalesce("open", F.lit(True)))
    )
    # Only lists with an open node behind their first one have anything to compare.
    some = entries.groupBy("key").agg(F.count_if("open").alias("m"), F.min_by("open", F.struct("doc", "shard", "place")).cast("int").alias("f"))
    entries = entries.join(some.filter("m > f").select("key"), "key", "left_semi")
    entries = materialise(entries, "entries")
    groups = max(1, entries.count() // GROUP_ENTRIES)
    bucket = F.pmod(F.xxhash64("key"), F.lit(groups)).alias("bucket")
    more = materialise(entries.groupBy(bucket).applyInArrow(_open_against_list(percent), "a long, b long"), "open")
    release(entries)
    if more.limit(1).count():
        matched = matched.unionByName(matches(more)).distinct()
    kept = nodes.join(matched, "node", "left_anti").select("age.shard", "age.place")
    # At most the lines of a shard in one list.
    kept = kept.groupBy("shard").agg(F.collect_list("place").alias("kept"))
    n_lines, n_removed = (columns.free(c, documents.columns) for c in ("_dl_lines", "_dl_removed"))
    schema = documents.schema.add(n_lines, "long").add(n_removed, "long")
    return bodies.join(kept.hint("shuffle_hash"), "shard", "left").mapInArrow(_rewrite(text_col, least_words, n_lines, n_removed), schema)


def digests(documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: lines, lines removed and the SHA-256 of the kept text."""
    rows = documents.select(F.col(id_col), F.col(text_col))
    kept = remove_repeated_lines(rows, id_col=id_col, text_col=text_col)
    kept = kept.withColumnsRenamed({"_dl_lines": "n_lines", "_dl_removed": "n_removed"})
    # By Spark: a second Python step behind the first would hold as many workers again.
    digest = F.sha2(F.coalesce(text_col, F.lit("")).cast("binary"), 256)
    return kept.select(id_col, "n_lines", "n_removed", digest.alias("kept_sha256"))

