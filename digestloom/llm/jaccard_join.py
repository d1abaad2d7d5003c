"""Near-duplicate documents by a size-aware heavy-light set-similarity join.

A document's set holds its different word shingles. Two documents link when their Jaccard
similarity reaches the threshold. Equal sets are one node, named by a hash of the set, so
copies are never compared with each other.

Order: shingles are ordered by hash, with the frequent ones (counted over all documents) last,
so that passages which many documents share stay out of the prefixes. A set of n shingles and
any partner share at least ``ceil(t n)``, hence they meet in the first ``n - ceil(t n) + 1``
shingles of both, and in two of the first ``n - ceil(t n) + 2``.

Small sets, below a boundary size, enumerate all two-element subsets of the longer prefix and
meet in equal subsets. Sets from the boundary on scan inverted lists of single shingles, with
size and positional filters. The boundary is the size up to which enumerating costs less than
scanning, by the list lengths counted in the first pass.

Inside a list neighbours by size are compared first, then of long lists the pairs whose parity
bitmaps differ least. Pairs of nodes that these links connect need no comparing; all other pairs
of a list are compared too, so no link between different components is lost, while what is
compared in a group of near copies grows with its size, not with its square.
Candidates pass a parity bitmap (an exact bound on the overlap) and then the sets themselves.

Shingles and sets are compared by 64-bit hashes: among n of them some two clash with a chance
of about n^2 / 2^65.

Edge cases: null, empty and blank texts have an empty set and link with nothing; fewer words
than a shingle are one shingle as a whole; repeated ids are separate documents of the same
name; a null id never names a component unless all ids in it are null; other columns are kept
out of the result.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from digestloom.llm import words
from digestloom.llm.components import components, spanning
from digestloom.session import free_shuffles, materialise, release

SHINGLE = 5
PERCENT = 80
# A shingle in more prefixes than this is frequent; the most frequent ones are ordered last.
FREQUENT = 16
MAX_FREQUENT = 1 << 20
# Lists up to this length are paired where they are found; longer ones know components first.
PAIRED_LIST = 24
# Pairs of an entry of a long list that are tried before all others.
BEST_FIRST = 4
# Cost of a candidate pair against that of one list entry.
PAIR_COST = 4.0
CHUNK_BYTES = 4 << 20
# Bits of the filter of wanted nodes (a fixed 8 MB).
WANTED_BITS = 1 << 26
PART_ENTRIES = 1 << 20

_SHORT = np.uint64(0x5851F42D4C957F2D)
_SUBSET = words.spread(2, seed=21) | np.uint64(1)


def shingle_sets(texts: pa.Array, k: int) -> list[np.ndarray]:
    """Sorted different shingle names of each text."""
    found = words.split(texts, words.SPACE_SEPARATED, True)
    runs = words.shingles(found.name, k)
    first = found.first.tolist()
    out = []
    for a, b in zip(first, first[1:]):
        if b - a >= k:
            out.append(words.distinct(runs[a : b - k + 1]))
        elif b > a:
            whole = words.window_sums(found.name[a:b], np.array([0]), np.array([b - a]))
            out.append(words.mix(whole ^ _SHORT))
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def set_name(tokens: np.ndarray) -> int:
    """Signed 64-bit name of a set."""
    total = words.mix(np.array([words.mix(tokens ^ _SHORT).sum(dtype=np.uint64) + np.uint64(len(tokens))], dtype=np.uint64))
    return int(total.view(np.int64)[0])


def _ceil(percent: int, n):
    return -(-percent * n // 100)


def prefix_length(n: int, percent: int) -> int:
    return n - _ceil(percent, n) + 1


def bitmap(tokens: np.ndarray) -> bytes:
    """Parity of the shingles per cell; at least two cells a shingle, a power of two in all."""
    cells = max(64, 1 << (2 * len(tokens) - 1).bit_length())
    counts = np.bincount((tokens >> np.uint64(17)).astype(np.int64) & (cells - 1), minlength=cells)
    return np.packbits((counts & 1).astype(bool)).tobytes()


def differing_cells(a: bytes, b: bytes) -> int:
    """A lower bound on the size of the symmetric difference."""
    x, y = np.frombuffer(a, dtype=np.uint8), np.frombuffer(b, dtype=np.uint8)
    if len(x) < len(y):
        x, y = y, x
    while len(x) > len(y):
        # Cells are numbered modulo a power of two: halves fold onto each other.
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return int(np.bitwise_count(x ^ y).sum())


def _parts(entries: int) -> int:
    return 1 << max(6, math.ceil(math.log2(max(entries, 1) / PART_ENTRIES)))


def _by_part(names: np.ndarray, parts: int) -> np.ndarray:
    return (names >> np.uint64(64 - parts.bit_length() + 1)).astype(np.int64)


def _sets_once(batch, k):
    """Name and shingles of each different set of a batch."""
    out = {}
    for tokens in shingle_sets(batch.column("text"), k):
        if len(tokens):
            out.setdefault(set_name(tokens), tokens)
    return out


def _count_prefixes(k, percent, parts):
    def run(batches):
        for batch in words.gathered(batches, "text", CHUNK_BYTES):
            heads = [t[: prefix_length(len(t), percent)] for t in _sets_once(batch, k).values()]
            names, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *heads]), return_counts=True)
            cut = np.searchsorted(_by_part(names, parts), np.arange(parts + 1))
            sent = [(i, names[a:b].tobytes() + counts[a:b].astype(np.uint32).tobytes()) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            yield pa.RecordBatch.from_arrays(
                [pa.array([i for i, _ in sent], pa.int32()), pa.array([p for _, p in sent], pa.binary())], names=["part", "payload"]
            )

    return run


def _sum_prefixes(table: pa.Table) -> pa.Table:
    """Frequent shingles of a range, and sums over the others for the cost of lists."""
    names, counts = [], []
    for payload in table.column("payload").to_pylist():
        n = len(payload) // 12
        names.append(np.frombuffer(payload, dtype=np.uint64, count=n))
        counts.append(np.frombuffer(payload, dtype=np.uint32, offset=8 * n))
    names, inverse = np.unique(np.concatenate(names), return_inverse=True)
    total = np.bincount(inverse, weights=np.concatenate(counts)).astype(np.int64)
    frequent = total > FREQUENT
    rest = total[~frequent]
    token = np.append(names[frequent].view(np.int64), 0)
    return pa.table({
        "token": pa.array(token),
        "n": pa.array(np.append(total[frequent], int(rest.sum()))),
        "extra": pa.array([*[None] * int(frequent.sum()), int((rest * (rest - 1)).sum())], pa.int64()),
    })


def boundary(entries: int, extra: int, percent: int) -> int:
    """First size for which scanning lists costs less than enumerating two-element subsets."""
    scan = 1 + PAIR_COST * extra / max(entries, 1)
    size = 1
    while True:
        p = prefix_length(size, percent)
        if p * (p + 1) / 2 > p * scan:
            return size
        size += 1


def _post(k, percent, frequent, bound, parts):
    def keys(tokens):
        n = len(tokens)
        p = prefix_length(n, percent)
        at = np.searchsorted(frequent.value, tokens)
        hot = frequent.value[np.minimum(at, len(frequent.value) - 1)] == tokens if len(frequent.value) else np.zeros(n, dtype=bool)
        head = tokens[~hot][: p + 1]
        if len(head) < p + 1:
            head = np.concatenate((head, tokens[hot][: p + 1 - len(head)]))
        names, places = [], []
        if 100 * n >= percent * bound:
            names.append(head[:p])
            places.append(np.arange(p))
        if n < bound:
            i, j = np.triu_indices(len(head), 1)
            names.append(words.mix(head[i] * _SUBSET[0] + head[j] * _SUBSET[1]))
            places.append(np.full(len(i), -1))
        return np.concatenate(names), np.concatenate(places)

    def run(batches):
        for batch in words.gathered(batches, "text", CHUNK_BYTES):
            sets = shingle_sets(batch.column("text"), k)
            nodes = [set_name(t) if len(t) else None for t in sets]
            once = {node: t for node, t in zip(nodes, sets) if node is not None}
            found = [keys(t) for t in once.values()]
            owner = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
            entry = np.empty(len(owner), dtype=[("key", "u8"), ("node", "i8"), ("n", "u4"), ("at", "i4")])
            if len(owner):
                entry["key"] = np.concatenate([x[0] for x in found])
                entry["at"] = np.concatenate([x[1] for x in found])
                entry["node"] = np.array(list(once))[owner]
                entry["n"] = np.array([len(t) for t in once.values()])[owner]
            part = _by_part(entry["key"], parts)
            order = np.argsort(part, kind="stable")
            entry, cut = entry[order], np.searchsorted(part[order], np.arange(parts + 1))
            sent = [(i, _squeeze(entry[a:b])) for i, (a, b) in enumerate(zip(cut, cut[1:])) if b > a]
            seen = set()
            maps = [bitmap(t) if len(t) and not (n in seen or seen.add(n)) else None for n, t in zip(nodes, sets)]
            d, m = batch.num_rows, len(sent)
            ids = batch.column("doc_id")
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([None] * d + [i for i, _ in sent], pa.int32()),
                    pa.array([None] * d + [p for _, p in sent], pa.binary()),
                    pa.concat_arrays([ids, pa.nulls(m, ids.type)]),
                    pa.array([len(t) for t in sets] + [None] * m, pa.int64()),
                    pa.array(nodes + [None] * m, pa.int64()),
                    pa.array(maps + [None] * m, pa.binary()),
                ],
                names=["part", "payload", "doc_id", "n_shingles", "node", "cells"],
            )

    return run


def _squeeze(entry: np.ndarray) -> bytes:
    """List entries column by column; nodes and sizes once each."""
    nodes, first, inverse = np.unique(entry["node"], return_index=True, return_inverse=True)
    return b"".join([
        np.array([len(entry), len(nodes)], dtype=np.int64).tobytes(), nodes.tobytes(), entry["n"][first].tobytes(),
        entry["key"].tobytes(), inverse.astype(np.uint32).tobytes(), np.minimum(entry["at"], 32767).astype(np.int16).tobytes(),
    ])


def _unsqueeze(data: bytes):
    m, n = np.frombuffer(data, dtype=np.int64, count=2).tolist()
    at = 16
    out = []
    for kind, count in (("i8", n), ("u4", n), ("u8", m), ("u4", m), ("i2", m)):
        out.append(np.frombuffer(data, dtype=kind, count=count, offset=at))
        at += out[-1].nbytes
    nodes, sizes, key, inverse, place = out
    return key, nodes[inverse], sizes[inverse].astype(np.int64), place.astype(np.int64)


def may_link(n1, at1, n2, at2, percent, bound):
    """Size and positional filters; ``at`` is -1 for subset keys, which have no position."""
    need = -(-percent * (n1 + n2) // (100 + percent))
    rest = np.minimum(n1 - np.maximum(at1, 0), n2 - np.maximum(at2, 0))
    sizes = 100 * np.minimum(n1, n2) >= percent * np.maximum(n1, n2)
    return sizes & (rest >= need) & ((at1 < 0) | (np.maximum(n1, n2) >= bound))


def different_pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Different unordered pairs in two rows, the smaller of each first."""
    a, b = np.minimum(a, b), np.maximum(a, b)
    order = np.lexsort((b, a))
    a, b = a[order], b[order]
    fresh = np.ones(len(a), dtype=bool)
    fresh[1:] = (a[1:] != a[:-1]) | (b[1:] != b[:-1])
    return np.stack([a[fresh], b[fresh]])


def _lists(percent, bound):
    """Pairs of the lists of one range; entries of long lists come out as they are."""

    def run(table: pa.Table) -> pa.Table:
        key, node, n, place = (np.concatenate(x) for x in zip(*map(_unsqueeze, table.column("payload").to_pylist())))
        order = np.lexsort((node, n, key))
        key, node, n, place = key[order], node[order], n[order], place[order]
        fresh = np.concatenate(([True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])))
        key, node, n, place = key[fresh], node[fresh], n[fresh], place[fresh]
        begins = np.concatenate(([True], key[1:] != key[:-1]))
        number = np.cumsum(begins) - 1
        length = np.bincount(number)[number]
        several = length > 1
        key, node, n, place, length, number = (x[several] for x in (key, node, n, place, length, number))

        def pairs(step, among):
            a = np.flatnonzero((number[step:] == number[:-step]) & among[step:]) if len(number) > step else np.empty(0, dtype=np.int64)
            b = a + step
            a = a[may_link(n[a], place[a], n[b], place[b], percent, bound)]
            return different_pairs(node[a], node[a + step])

        everything = np.ones(len(key), dtype=bool)
        short = length <= PAIRED_LIST
        near = pairs(1, everything)
        far = [pairs(step, short) for step in range(2, PAIRED_LIST)]
        far = different_pairs(*np.concatenate([np.empty((2, 0), dtype=np.int64), *far], axis=1))
        long_ = ~short
        kinds = np.repeat([0, 1, 2], [near.shape[1], far.shape[1], int(long_.sum())])
        none = pa.nulls(near.shape[1] + far.shape[1], pa.int64())
        return pa.table({
            "kind": pa.array(kinds.astype(np.int32)),
            "a": pa.array(np.concatenate((near[0], far[0], node[long_]))),
            "b": pa.concat_arrays([pa.array(near[1]), pa.array(far[1]), pa.nulls(int(long_.sum()), pa.int64())]),
            "key": pa.concat_arrays([none, pa.array(key[long_].view(np.int64))]),
            "n": pa.concat_arrays([none, pa.array(n[long_])]),
            "place": pa.concat_arrays([none, pa.array(place[long_])]),
        })

    return run


def _folded(cells: list[bytes]) -> dict[int, np.ndarray]:
    """Bitmaps folded to each width that occurs; rows of a narrower bitmap are left empty."""
    widths = np.array([len(c) for c in cells])
    out = {}
    for width in np.unique(widths).tolist():
        rows = np.zeros((len(cells), width // 8), dtype=np.uint64)
        for i in np.flatnonzero(widths >= width).tolist():
            parts = np.frombuffer(cells[i], dtype=np.uint64).reshape(-1, width // 8)
            rows[i] = np.bitwise_xor.reduce(parts, axis=0)
        out[width] = rows
    return out


def _bitsets(lists: pa.ListArray) -> np.ndarray:
    """Each list of keys as a row of bits over all keys that occur."""
    counts = pc.list_value_length(lists).to_numpy(zero_copy_only=False)
    keys, number = np.unique(lists.flatten().to_numpy(zero_copy_only=False), return_inverse=True)
    bits = np.zeros((len(lists), len(keys) // 64 + 1), dtype=np.uint64)
    row = np.repeat(np.arange(len(lists)), counts)
    np.bitwise_or.at(bits, (row, number >> 6), np.uint64(1) << (number & 63).astype(np.uint64))
    return bits


def _crossing(percent, bound, best):
    """Pairs of one long list that lie in different components and pass the bitmaps.

    Entries are compared one after the other with all that follow by size. A pair comes out of
    the first list that it shares, and only if its bitmaps allow a link. With ``best`` only so
    many pairs of an entry come out, those whose bitmaps differ least.
    """

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("n", "ascending"), ("a", "ascending")])
        node, n, place, comp = (table.column(c).to_numpy() for c in ("a", "n", "place", "component"))
        first, second = [np.empty(0, dtype=np.int64)], [np.empty(0, dtype=np.int64)]
        if len(np.unique(comp)) > 1:
            cells = table.column("cells").to_pylist()
            folded = _folded(cells)
            earlier = _bitsets(table.column("earlier").combine_chunks())
            # Sizes ascend, so the partners of an entry are the entries up to a size, and their
            # bitmaps are as wide or wider.
            last = np.searchsorted(n, 100 * n // percent, side="right")
            for i in range(len(n)):
                j = np.arange(i + 1, last[i])
                j = j[comp[j] != comp[i]]
                j = j[may_link(n[i], place[i], n[j], place[j], percent, bound)]
                j = j[~(earlier[j] & earlier[i]).any(axis=1)]
                rows = folded[len(cells[i])]
                differ = np.bitwise_count(rows[j] ^ rows[i]).sum(axis=1, dtype=np.int64)
                may = differ <= n[i] + n[j] - 2 * -(-percent * (n[i] + n[j]) // (100 + percent))
                j, differ = j[may], differ[may]
                if best and len(j) > best:
                    j = j[np.argsort(differ, kind="stable")[:best]]
                first.append(np.minimum(node[i], node[j]))
                second.append(np.maximum(node[i], node[j]))
        return pa.table({"a": np.concatenate(first), "b": np.concatenate(second)})

    return run


def _pass_bitmaps(percent):
    def run(batches):
        for batch in batches:
            n1, n2 = batch.column("n1").to_numpy(), batch.column("n2").to_numpy()
            most = n1 + n2 - 2 * -(-percent * (n1 + n2) // (100 + percent))
            cells = zip(batch.column("cells1").to_pylist(), batch.column("cells2").to_pylist())
            kept = [differing_cells(x, y) <= m for (x, y), m in zip(cells, most.tolist())]
            yield batch.filter(pa.array(kept, pa.bool_())).select(["a", "b"])

    return run


def compare(percent, columns):
    """Pairs whose sets (sorted names ``s1, s2``) reach the threshold; the given columns of them."""

    def run(batches):
        for batch in batches:
            out = []
            for x, y in zip(batch.column("s1").to_pylist(), batch.column("s2").to_pylist()):
                x, y = np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)
                both = len(np.intersect1d(x, y, assume_unique=True))
                out.append(100 * both >= percent * (len(x) + len(y) - both))
            yield batch.filter(pa.array(out, pa.bool_())).select(columns)

    return run


def _cell(node: np.ndarray) -> np.ndarray:
    return (words.mix(node.view(np.uint64)) & np.uint64(WANTED_BITS - 1)).astype(np.int64)


def with_marks(bits: bytes, nodes: np.ndarray) -> bytes:
    """The bits with the nodes marked as well."""
    cells = np.frombuffer(bits, dtype=np.uint8).copy()
    _mark(cells, nodes)
    return cells.tobytes()


def _mark(cells: np.ndarray, nodes: np.ndarray) -> None:
    cell = _cell(nodes)
    np.bitwise_or.at(cells, cell >> 3, (128 >> (cell & 7)).astype(np.uint8))


def _mark_wanted(batches):
    """Cells of wanted nodes, one packed and compressed bitmap per task."""
    cells = np.zeros(WANTED_BITS // 8, dtype=np.uint8)
    for batch in batches:
        _mark(cells, batch.column("node").to_numpy())
    yield pa.RecordBatch.from_arrays([pa.array([pa.compress(cells, codec="zstd", asbytes=True)], pa.binary())], names=["bits"])


def marked(nodes: DataFrame) -> bytes:
    """A fixed 8 MB of bits in which every node (column ``node``) is marked; others may be."""
    # Eight megabytes at most from each of a few tasks, whatever the number of nodes.
    rows = nodes.coalesce(4).mapInArrow(_mark_wanted, "bits binary").collect()
    cells = np.zeros(WANTED_BITS // 8, dtype=np.uint8)
    while rows:
        cells |= np.frombuffer(pa.decompress(rows.pop()["bits"], len(cells), codec="zstd", asbytes=True), dtype=np.uint8)
    return cells.tobytes()


def _wanted_sets(k, wanted):
    def run(batches):
        bits = np.frombuffer(wanted.value, dtype=np.uint8)
        for batch in words.gathered(batches, "text", CHUNK_BYTES):
            once = _sets_once(batch, k)
            nodes = np.array(list(once), dtype=np.int64)
            cell = _cell(nodes)
            picked = nodes[(bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 > 0].tolist()
            yield pa.RecordBatch.from_arrays(
                [pa.array(picked, pa.int64()), pa.array([once[n].tobytes() for n in picked], pa.binary())], names=["node", "tokens"]
            )
            del once

    return run


class _Join:
    """The passes of one join over ``rows`` (``doc_id, text``)."""

    def __init__(self, rows: DataFrame, k: int, percent: int):
        self.rows, self.k, self.percent = rows, k, percent
        self.spark = rows.sparkSession

    def prepare(self) -> None:
        k, percent, sc = self.k, self.percent, self.spark.sparkContext
        size = self.rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
        # A word takes some six bytes, and a fifth of the shingles are in prefixes.
        parts = _parts(size // 30)
        counted = (
            self.rows.mapInArrow(_count_prefixes(k, percent, parts), "part int, payload binary")
            .groupBy("part").applyInArrow(_sum_prefixes, "token long, n long, extra long")
        )
        counted = materialise(counted, "prefixes")
        # One row per range.
        sums = counted.filter("extra is not null").agg(F.sum("n"), F.sum("extra")).first()
        top = counted.filter("extra is null").orderBy(F.desc("n"), "token").limit(MAX_FREQUENT).select("token")
        frequent = np.sort(top.toArrow().column("token").to_numpy().view(np.uint64))
        # What is done with goes at once, for the driver holds the plans and tasks of every step.
        release(counted)
        self.bound = boundary(sums[0] or 0, sums[1] or 0, percent)
        kind = self.rows.schema["doc_id"].dataType.simpleString()
        posted = materialise(
            self.rows.mapInArrow(
                _post(k, percent, sc.broadcast(frequent), self.bound, parts),
                f"part int, payload binary, doc_id {kind}, n_shingles long, node long, cells binary",
            ),
            "posted",
        )
        self.documents = posted.filter("part is null").select("doc_id", "n_shingles", "node")
        self.nodes = materialise(
            posted.filter("part is null and node is not null").groupBy("node")
            .agg(F.max("n_shingles").alias("n"), F.max("cells").alias("cells")), "nodes"
        )
        self.found = materialise(
            posted.filter("part is not null").select("part", "payload").groupBy("part")
            .applyInArrow(_lists(percent, self.bound), "kind int, a long, b long, key long, n long, place long"),
            "pairs",
        )

    def verified(self, pairs: DataFrame, spanned: bool) -> DataFrame:
        """Pairs that link. With ``spanned`` only as many as connect the same nodes are tried."""
        one = self.nodes.select(F.col("node").alias("a"), F.col("n").alias("n1"), F.col("cells").alias("cells1"))
        two = self.nodes.select(F.col("node").alias("b"), F.col("n").alias("n2"), F.col("cells").alias("cells2"))
        likely = materialise(pairs.distinct().join(one, "a").join(two, "b").mapInArrow(_pass_bitmaps(self.percent), "a long, b long"), "likely")
        n = likely.count()
        if not n:
            return likely
        if spanned:
            every, likely = likely, materialise(spanning(likely, n), "spanning")
            release(every)
        wanted = likely.select(F.col("a").alias("node")).unionByName(likely.select(F.col("b").alias("node"))).distinct()
        wanted = materialise(wanted, "wanted")
        bits = self.spark.sparkContext.broadcast(marked(wanted))
        sets = self.rows.mapInArrow(_wanted_sets(self.k, bits), "node long, tokens binary")
        sets = materialise(sets.join(wanted, "node", "left_semi").groupBy("node").agg(F.first("tokens").alias("tokens")), "sets")
        one = sets.select(F.col("node").alias("a"), F.col("tokens").alias("s1"))
        two = sets.select(F.col("node").alias("b"), F.col("tokens").alias("s2"))
        links = materialise(likely.join(one, "a").join(two, "b").mapInArrow(compare(self.percent, ["a", "b"]), "a long, b long"), "links")
        bits.destroy()
        for done in (likely, wanted, sets):
            release(done)
        return links

    def components(self) -> DataFrame:
        """``node, component`` of all nodes that link with another."""
        links = self.verified(self.found.filter("kind = 0").select("a", "b"), spanned=True)
        known = materialise(components(links), "components")
        # First the likeliest pairs of long lists, which connect most of what belongs together;
        # then all pairs that still lie in different components.
        for best in (BEST_FIRST, 0):
            pairs = self._pairs_of_long_lists(known, best)
            if not best:
                pairs = pairs.unionByName(self._pairs_of_short_lists(known))
            rest = self.verified(pairs, spanned=bool(best))
            del pairs
            if rest.limit(1).count():
                links = links.unionByName(rest)
                known = materialise(components(links), "components")
            free_shuffles(self.spark)
        return known

    def _pairs_of_short_lists(self, known: DataFrame) -> DataFrame:
        names = known.select(F.col("node").alias("a"), F.col("component").alias("c"))
        pairs = self.found.filter("kind < 2").select("a", "b").distinct().join(names, "a", "left")
        names = known.select(F.col("node").alias("b"), F.col("component").alias("d"))
        return pairs.join(names, "b", "left").filter(F.coalesce("c", "a") != F.coalesce("d", "b")).select("a", "b")

    def _pairs_of_long_lists(self, known: DataFrame, best: int) -> DataFrame:
        entries = self.found.filter("kind = 2").select("key", "a", "n", "place").join(known.withColumnRenamed("node", "a"), "a", "left")
        entries = entries.withColumn("component", F.coalesce("component", "a"))
        # Lists inside one component, as those of a group of near copies, need no look.
        mixed = entries.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).filter("x <> y").select("key")
        entries = materialise(entries.join(mixed, "key", "left_semi"), "entries")
        # The long lists of a node, of which there are no more than shingles in its prefix. They meet the
        # bitmaps as one row of the node: Spark sizes arrays too low, and would broadcast entries that
        # each hold all lists of their node. The hint keeps the lists of the nodes out of the driver too.
        own = entries.groupBy("a").agg(
            F.first("n").alias("n"), F.first("component").alias("component"),
            F.sort_array(F.collect_list(F.struct("place", "key"))).alias("lists"),
        )
        cells = self.nodes.select(F.col("node").alias("a"), "cells")
        each = own.join(cells.hint("merge"), "a").select(
            "a", "n", "component", "cells", F.transform("lists", lambda x: x["key"]).alias("keys"), F.posexplode("lists").alias("nth", "x")
        )
        return (
            each.select("x.key", "a", "n", "x.place", "component", "cells", F.slice("keys", F.lit(1), F.col("nth")).alias("earlier"))
            .groupBy("key").applyInArrow(_crossing(self.percent, self.bound, best), "a long, b long")
        )


def near_duplicates(
    documents: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE, percent: int = PERCENT
) -> DataFrame:
    """One row per document: size of its set, and the smallest id its links lead to."""
    rows = documents.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    join = _Join(rows, shingle, percent)
    join.prepare()
    known = join.components()
    # A document without a set, or without links, is alone; node names are unique per set.
    named = join.documents.join(known, "node", "left").withColumn("component", F.coalesce("component", "node"))
    least = named.filter("component is not null").groupBy("component").agg(F.min("doc_id").alias("component_id"))
    return named.join(least, "component", "left").select(
        F.col("doc_id").alias(id_col), "n_shingles",
        F.when(F.col("component").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )
