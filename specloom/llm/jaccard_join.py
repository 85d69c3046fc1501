"""N-gram Jaccard join with a count-vector R-tree.

A document is its set of `width`-word shingles; equal sets are one node. Shingles hash into
`GROUPS` groups and a set's group counts are a point. Two sets cannot share more than the
sum of their coordinates' minima, so a tree of point boxes prunes whole branches by the
minima of box maxima against the overlap that the similarity asks for. Surviving pairs are
verified on the sets.

Before its set is sent, a pair is compared on parts: the hashes below a limit, all of a small
set and a quarter of a large one, two bytes of each. If even the whole rest in common would
not be enough, the pair goes. Tasks of blocks do this at once, so they send on few pairs that
are not links.

Trees are built per block. A block is a shingle that several sets hold among their first
n - ceil(s*n) + 1 in one global order, where similar sets must meet; shingles of very many
sets come last in that order, so common passages make no blocks. First every set is
compared with the set that is the smallest of most of its blocks, which joins large groups of
near copies with one pair a set, and then with the other smallest ones that are still apart.
That first set is its home: sets of one home, which meet in many blocks, are compared once, in
a block of their own, and not in the others. Blocks whose other sets are then of several components get
trees, which find all remaining pairs across components; a block larger than `CHUNK` is cut into
chunks, and only its sets outside the first one's component go to all of them. Tasks of blocks do not
send these pairs on but a forest that ties their sets. The sets that forests tie are a group: they
meet as whole sets in one task, or in one for each two chunks of a large group, which sends on
the links that join components. So no such link is lost and no group is paired out.

Sets and nodes are 64-bit hashes; two different sets of N get one hash with chance N*N/2**65.

Defined results: null or empty texts have no shingles and link with nothing; rows of one
doc_id are one document that holds the links of each; rows without id stand alone; other
columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import drop_stored, ship_package, store

from . import packed as P
from . import words as W
from .components import components, forest
from .prefilter import likely

GROUPS = 128
#: Coordinates of the tree's boxes: each adds up some groups; points are compared on all groups.
FOLDED = 32
CHUNK = 4096
FANOUT = 16
#: At most so many shingles are put last for being common; the bar follows from the input.
COMMON = 500_000
#: How a set's members are cut from texts.
Runs = Callable[[W.Bytes, int], tuple[np.ndarray, np.ndarray]]
_TOKEN = np.dtype([("key", np.uint64), ("count", np.int64)])
_MEMBER = np.dtype([("key", np.uint64), ("node", np.int64), ("size", np.int32)])
_POINT = np.dtype([("key", np.uint64), ("node", np.int64), ("comp", np.int64), ("home", np.int64), ("size", np.int32), ("asks", np.int8), ("counts", np.uint16, GROUPS)])
#: A count that may stand for a larger one.
FULL = 0xFFFF
#: Members of the sets that a chunk of a group holds.
MEMBERS = 1_000_000
#: Pairs of points that a tree is asked for at a time; all of them may pass its bounds.
ASKED = 1 << 20
#: Points, and bytes of their sets' parts, that a map task holds before it sends them on.
BLOCK = 50_000
PART_BYTES = 1 << 24


def word_runs(texts: W.Bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's runs of lowered words, and where each text's begin."""
    low = texts.lowered()
    found = W.find_words(low, W.BLANK_SEPARATED)
    return W.shingles(low.hashes(found.start, found.end), found.first, width)


def sets(texts: W.Bytes, width: int, runs: Runs = word_runs) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Each text's distinct shingle hashes, where each text's begin, its size and its node."""
    values, begin = W.distinct_per_text(*runs(texts, width))
    size = np.diff(begin)
    total = np.r_[np.uint64(0), np.cumsum(W.mix(values ^ np.uint64(0xA5A5A5A5A5A5A5A5)), dtype=np.uint64)]
    node = W.mix(total[begin[1:]] - total[begin[:-1]] + size.astype(np.uint64))
    return values, begin, size, W.signed(node)


def prefix_length(size: np.ndarray, percent: float) -> np.ndarray:
    return np.where(size > 0, size - np.ceil(percent * size / 100 - 1e-9).astype(np.int64) + 1, 0)


def _prefix(values: np.ndarray, begin: np.ndarray, size: np.ndarray, percent: float, common: np.ndarray, level: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first shingles of each set in the global order (40 bits of each), and whose they are."""
    text = np.repeat(np.arange(len(size)), size)
    values = values >> np.uint64(24)  # a chance meeting in a block costs a comparison, no more
    if len(common) and len(values):
        at = np.searchsorted(common, values)
        at[at == len(common)] = 0
        late = np.where(common[at] == values, level[at], 0)
        order = np.lexsort((values, late, text))
        values = values[order]
    rank = np.arange(len(values)) - begin[text]
    keep = rank < prefix_length(size, percent)[text]
    return values[keep], text[keep]


def part_limit(size: np.ndarray) -> np.ndarray:
    """The first 16 bits of hashes below this make a set's part: all of a small set, a quarter of a large one."""
    return np.uint64(1 << 16) >> np.searchsorted([96, 192], size).astype(np.uint64)


def parts_of(values: np.ndarray, begin: np.ndarray, size: np.ndarray) -> list[bytes]:
    """The first 16 bits of each set's first hashes, up to its limit; they rise within a set."""
    high = values >> np.uint64(48)
    text = np.repeat(np.arange(len(size)), size)
    upto = begin[:-1] + np.bincount(text[high < part_limit(size)[text]], minlength=len(size))
    held = high.astype(np.uint16).tobytes()
    return [held[2 * a : 2 * b] for a, b in zip(begin[:-1].tolist(), upto.tolist(), strict=True)]


class Parts:
    """Parts of many sets, joined."""

    def __init__(self, held: list[bytes]):
        self.n = np.array([len(p) // 2 for p in held], np.int64)
        self.begin = np.cumsum(self.n) - self.n
        self.flat = np.frombuffer(b"".join(held), np.uint16)

    def can_be_near(self, x: np.ndarray, y: np.ndarray, sizes: np.ndarray, percent: float) -> np.ndarray:
        """Which pairs of sets (by place) can be similar: what lies outside their common part may all be shared.

        So few bits may be equal by chance, which lets a pair pass, no more.
        """
        out = np.zeros(len(x), bool)
        limit = part_limit(sizes)
        weight = np.cumsum(self.n[x] + self.n[y])
        start = 0
        while start < len(x):
            end = max(start + 1, int(np.searchsorted(weight, (weight[start - 1] if start else 0) + 500_000, "right")))
            a, b = x[start:end], y[start:end]
            least = np.minimum(limit[a], limit[b])
            joined, rest = [], []
            for side in (a, b):
                n = self.n[side]
                who = np.repeat(np.arange(len(side)), n)
                value = self.flat[self.begin[side][who] + np.arange(len(who)) - (np.cumsum(n) - n)[who]]
                used = value < least[who]
                joined.append(who[used].astype(np.uint64) << np.uint64(16) | value[used].astype(np.uint64))
                rest.append(sizes[side] - np.bincount(who[used], minlength=len(side)))
            both = np.sort(np.concatenate(joined))
            shared = np.bincount((both[1:][both[1:] == both[:-1]] >> np.uint64(16)).astype(np.int64), minlength=len(a))
            out[start:end] = _enough(shared + np.minimum(*rest), sizes[a] + sizes[b], percent)
            start = end
        return out


def pack_counts(counts: np.ndarray) -> list[bytes]:
    """Each set's group counts in two bytes a group, or four where one needs them."""
    wide = counts.max(1, initial=0) > 0xFFFF
    held = np.minimum(counts, 0xFFFF).astype(np.uint16).tobytes()
    return [counts[i].astype(np.uint32).tobytes() if w else held[2 * GROUPS * i : 2 * GROUPS * (i + 1)] for i, w in enumerate(wide.tolist())]


def unpack_counts(held: list[bytes]) -> np.ndarray:
    if all(len(x) == 2 * GROUPS for x in held):
        return np.frombuffer(b"".join(held), np.uint16).reshape(-1, GROUPS)
    return np.stack([np.frombuffer(x, np.uint16 if len(x) == 2 * GROUPS else np.uint32).astype(np.uint32) for x in held])


def _nodes(batches: Iterator[pa.RecordBatch], width: int, runs: Runs) -> Iterator[pa.RecordBatch]:
    """Each row's set size, node, group counts and part."""
    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            values, begin, size, node = sets(texts, width, runs)
            text = np.repeat(np.arange(texts.count), size)
            group = (W.mix(values) >> np.uint64(32)).astype(np.int64) % GROUPS
            cut = pack_counts(np.bincount(text * GROUPS + group, minlength=texts.count * GROUPS).reshape(-1, GROUPS))
            yield pa.RecordBatch.from_arrays(
                [rows.column("doc_id"), pa.array(size.astype(np.int64)), pa.array(node), pa.array(cut, pa.binary()), pa.array(parts_of(values, begin, size), pa.binary())],
                ["doc_id", "size", "node", "counts", "part"])


def _prefix_counts(batches: Iterator[pa.RecordBatch], width: int, percent: float, count: int, runs: Runs) -> Iterator[pa.RecordBatch]:
    packer, none = P.Packer(_TOKEN, count), np.zeros(0, np.uint64)
    for batch in batches:
        held = []
        for _, texts in W.slices(batch, "text"):
            held.append(_prefix(*sets(texts, width, runs)[:3], percent, none, none)[0])
        values, times = np.unique(np.concatenate(held or [none]), return_counts=True)
        yield from packer.add(values, times)
    yield from packer.flush()


def _common(table: pa.Table, least: int) -> pa.Table:
    held = P.unpack(table, _TOKEN)
    values, at = np.unique(held["key"], return_inverse=True)
    times = np.bincount(at, held["count"], len(values)).astype(np.int64)
    keep = times > least
    return pa.table({"key": W.signed(values[keep]), "n": times[keep]})


def _members(batches: Iterator[pa.RecordBatch], width: int, percent: float, count: int, held, runs: Runs) -> Iterator[pa.RecordBatch]:
    packer = P.Packer(_MEMBER, count, distinct=True)
    for batch in batches:
        for _, texts in W.slices(batch, "text"):
            values, begin, size, node = sets(texts, width, runs)
            token, text = _prefix(values, begin, size, percent, *held.value)
            yield from packer.add(token, node[text], size[text])
    yield from packer.flush()


def _stars(table: pa.Table, percent: float) -> pa.Table:
    """Members of blocks with several sets of fitting sizes, each with its block's smallest node.

    A shingle's sets are cut where the next larger one is too large for the one before.
    """
    held = P.ordered(P.unpack(table, _MEMBER), "key", "size", "node")
    key, size = held["key"], held["size"].astype(np.int64)
    new = np.ones(len(held), bool)
    new[1:] = (key[1:] != key[:-1]) | (100 * size[:-1] < percent * size[1:])
    first = np.flatnonzero(new)
    n = np.diff(np.r_[first, len(held)])
    pivot = np.minimum.reduceat(held["node"], first) if len(first) else held["node"]
    block = W.mix(key[first] ^ W.mix(size[first].astype(np.uint64)))
    keep = np.repeat(n > 1, n)
    spread = lambda x: np.repeat(x, n)[keep]
    return pa.table({"token": W.signed(spread(block)), "pivot": spread(pivot), "node": held["node"][keep], "n": spread(n).astype(np.int32)})


#: Shingles below this hash, a fifth of all, are compared before whole sets are sent.
PART = np.uint64((1 << 64) // 5)


def _payload(batches: Iterator[pa.RecordBatch], width: int, runs: Runs) -> Iterator[pa.RecordBatch]:
    """Each text's shingles in two parts, by hash."""
    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            values, begin, size, node = sets(texts, width, runs)
            text = np.repeat(np.arange(texts.count), size)
            cut = begin[:-1] + np.bincount(text[values < PART], minlength=texts.count)
            held = values.tobytes()
            ends = [(8 * a, 8 * m, 8 * b) for a, m, b in zip(begin[:-1].tolist(), cut.tolist(), begin[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([
                rows.column("doc_id"), pa.array(node), pa.array(size.astype(np.int32)), pa.array([held[a:m] for a, m, _ in ends], pa.binary()), pa.array([held[m:b] for _, m, b in ends], pa.binary())],
                ["doc_id", "node", "size", "part", "rest"])


def _enough(overlap: np.ndarray, sizes: np.ndarray, percent: float) -> np.ndarray:
    """overlap / (sizes - overlap) >= percent / 100, in whole numbers."""
    return (100 + percent) * overlap >= percent * sizes


def _filter(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    """Pairs that the summed coordinate minima and their parts let pass."""
    for batch in batches:
        points = [unpack_counts(batch.column(c).to_pylist()) for c in ("pa", "pb")]
        sizes = [batch.column(c).to_numpy().astype(np.int64) for c in ("na", "nb")]
        good = _enough(np.minimum(*points).sum(1, dtype=np.int64), sizes[0] + sizes[1], percent)
        at = np.flatnonzero(good)
        parts = Parts([*batch.column("qa").take(pa.array(at)).to_pylist(), *batch.column("qb").take(pa.array(at)).to_pylist()])
        good[at] = parts.can_be_near(np.arange(len(at)), np.arange(len(at)) + len(at), np.r_[sizes[0][at], sizes[1][at]], percent)
        keep = pa.array(good)
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _common_count(x: list[bytes], y: list[bytes]) -> np.ndarray:
    """How many values each pair of distinct-value arrays shares."""
    out = np.zeros(len(x), np.int64)
    for i, (p, q) in enumerate(zip(x, y, strict=True)):
        joined = np.sort(np.frombuffer(p + q, np.uint64))
        out[i] = np.count_nonzero(joined[1:] == joined[:-1])
    return out


def _partly(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    """Pairs that can still be similar after a part of their sets: the rest shares at most the smaller rest."""
    for batch in batches:
        x, y = batch.column("xp").to_pylist(), batch.column("yp").to_pylist()
        na, nb = batch.column("na").to_numpy().astype(np.int64), batch.column("nb").to_numpy().astype(np.int64)
        size = lambda parts: np.array([len(p) // 8 for p in parts], np.int64)
        keep = pa.array(_enough(_common_count(x, y) + np.minimum(na - size(x), nb - size(y)), na + nb, percent))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def _verify(batches: Iterator[pa.RecordBatch], percent: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [[p + q for p, q in zip(batch.column(f"{c}p").to_pylist(), batch.column(f"{c}r").to_pylist(), strict=True)] for c in "xy"]
        sizes = np.array([(len(p) + len(q)) // 8 for p, q in zip(*both, strict=True)], np.int64)
        keep = pa.array(_enough(_common_count(*both), sizes, percent))
        yield pa.RecordBatch.from_arrays([batch.column("a").filter(keep), batch.column("b").filter(keep)], ["a", "b"])


def fold(counts: np.ndarray) -> np.ndarray:
    """Group counts added up to the tree's coordinates."""
    return counts.reshape(len(counts), FOLDED, -1).sum(2, dtype=np.int32)


def slices(asks: np.ndarray, points: np.ndarray) -> Iterator[slice]:
    """Runs of `asks` that make at most `ASKED` pairs with the points, or are one."""
    step = max(1, ASKED // len(points))
    return (slice(at, at + step) for at in range(0, len(asks), step))


class RTree:
    """Points packed by size and position into boxes, level by level."""

    def __init__(self, points: np.ndarray):
        self.points = points[np.lexsort((*points["counts"].T[:3], points["size"]))]
        counts, size, comp = fold(self.points["counts"]), self.points["size"].astype(np.int64), self.points["comp"]
        # two full counts at one place bound nothing: such pairs pass
        full = (self.points["counts"] == FULL).any(1)
        self.levels = [(counts, size, size, comp, comp, full)]
        while len(self.levels[-1][0]) > 1:
            high, small, large, low_c, high_c, full = self.levels[-1]
            cut = np.arange(0, len(high), FANOUT)
            self.levels.append((np.maximum.reduceat(high, cut), np.minimum.reduceat(small, cut), np.maximum.reduceat(large, cut),
                                np.minimum.reduceat(low_c, cut), np.maximum.reduceat(high_c, cut), np.logical_or.reduceat(full, cut)))

    def pairs(self, asks: np.ndarray, percent: float) -> tuple[np.ndarray, np.ndarray]:
        """(point of `asks`, point of the tree) in different components whose bound is enough."""
        query = np.arange(len(asks))
        box = np.zeros(len(asks), np.int64)
        counts, size, comp = fold(asks["counts"]), asks["size"].astype(np.int64), asks["comp"]
        own_full = (asks["counts"] == FULL).any(1)
        for depth in range(len(self.levels) - 1, -1, -1):
            high, small, large, low_c, high_c, full = self.levels[depth]
            kept = []
            for s in range(0, len(query), 16384):
                q, b = query[s : s + 16384], box[s : s + 16384]
                good = ~((low_c[b] == comp[q]) & (high_c[b] == comp[q]))
                good &= (100 * large[b] >= percent * size[q]) & (100 * size[q] >= percent * small[b])
                q, b = q[good], b[good]
                good = _enough(np.minimum(high[b], counts[q]).sum(1), small[b] + size[q], percent) | (full[b] & own_full[q])
                q, b = q[good], b[good]
                if not depth:  # single points: all groups
                    fine = np.minimum(self.points["counts"][b], asks["counts"][q]).sum(1, dtype=np.int64)
                    good = _enough(fine, small[b] + size[q], percent) | (full[b] & own_full[q])
                    q, b = q[good], b[good]
                kept.append((q, b))
            query, box = (np.concatenate([k[i] for k in kept]) if kept else query[:0] for i in (0, 1))
            if depth:
                below = len(self.levels[depth - 1][0])
                query = np.repeat(query, FANOUT)
                box = (box[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                query, box = query[box < below], box[box < below]
        return query, box


def _points(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Packed points of each bucket, and the parts of the sets among them."""
    held, parts, kept = [], {}, 0

    def flush() -> Iterator[pa.RecordBatch]:
        rows = np.concatenate(held)
        bucket = (W.mix(rows["key"]) % np.uint64(count)).astype(np.int32)
        order = np.lexsort((rows["key"], bucket))
        rows, bucket = rows[order], bucket[order]
        first, size = P.runs(bucket)
        packed, sent = [], []
        for at, n in zip(first.tolist(), size.tolist(), strict=True):
            nodes = np.unique(rows["node"][at : at + n])
            own = [parts[v] for v in nodes.tolist()]
            packed.append(P.squeeze(rows[at : at + n]))
            flat = np.frombuffer(b"".join(own), np.uint16)
            step = np.diff(flat, prepend=np.uint16(0))  # small within a set, so a byte each
            sent.append(np.array([len(nodes), len(flat)]).tobytes() + nodes.tobytes() + np.array([len(p) for p in own], np.int32).tobytes() + (P.squeeze(step) if len(step) else b""))
        yield pa.RecordBatch.from_arrays(
            [pa.array(bucket[first]), pa.array(size.astype(np.int32)), pa.array(packed, pa.binary()), pa.array(sent, pa.binary())], ["bucket", "n", "packed", "parts"])

    for batch in batches:
        column = lambda c: batch.column(c).to_numpy(zero_copy_only=False)
        rows = np.empty(batch.num_rows, _POINT)
        rows["key"] = W.mix(column("token").view(np.uint64) + column("chunk").astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
        for c in ("node", "comp", "home", "size", "asks"):
            rows[c] = column(c)
        rows["counts"] = np.minimum(unpack_counts(batch.column("counts").to_pylist()), FULL)
        parts.update(zip(column("node").tolist(), batch.column("part").to_pylist(), strict=True))
        held.append(rows)
        kept += batch.column("part").nbytes
        if sum(map(len, held)) >= BLOCK or kept >= PART_BYTES:
            yield from flush()
            held, parts, kept = [], {}, 0
    if held:
        yield from flush()


def _sent_parts(table: pa.Table) -> tuple[np.ndarray, Parts]:
    """The nodes of a bucket in order, and their parts."""
    known: dict[int, bytes] = {}
    for blob in table["parts"].to_pylist():
        n, total = np.frombuffer(blob, np.int64, 2).tolist()
        nodes, size = np.frombuffer(blob, np.int64, n, 16).tolist(), np.frombuffer(blob, np.int32, n, 16 + 8 * n)
        flat = np.cumsum(P.expand(blob[16 + 12 * n :], total, np.dtype(np.uint16)), dtype=np.uint16).tobytes() if total else b""
        ends = np.cumsum(size, dtype=np.int64)
        known.update((v, flat[e - s : e]) for v, s, e in zip(nodes, size.tolist(), ends.tolist(), strict=True))
    order = sorted(known)
    return np.array(order, np.int64), Parts([known[v] for v in order])


def _search(table: pa.Table, percent: float) -> pa.Table:
    """A forest of the pairs of a bucket's blocks that their trees and then their parts let pass."""
    held = P.unpack(table, _POINT)
    nodes, parts = _sent_parts(table)
    sizes = np.zeros(len(nodes), np.int64)
    sizes[np.searchsorted(nodes, held["node"])] = held["size"]
    held = held[np.lexsort((held["node"], held["key"]))]  # so a whole block begins with its pivot
    first, size = P.runs(held["key"])
    done, waiting = set(), []
    root = np.arange(len(nodes))  # the first set that each is tied to

    def sieve() -> None:
        nonlocal root
        pairs = np.unique(np.concatenate(waiting))
        x, y = pairs // len(nodes), pairs % len(nodes)
        apart = root[x] != root[y]
        x, y = x[apart], y[apart]
        near = parts.can_be_near(x, y, sizes, percent)
        top = np.arange(len(nodes))
        low, high = forest(root[x[near]], root[y[near]])
        top[low] = high
        root = top[root]
        waiting.clear()

    for a, n in zip(first.tolist(), size.tolist(), strict=True):
        block = held[a : a + n]
        if (block["comp"] == block["comp"][0]).all():
            continue
        same = hashlib.blake2b(block["node"].tobytes() + block["home"].tobytes(), digest_size=16).digest()
        if same in done:  # near copies share many blocks
            continue
        done.add(same)
        asking = np.where(block["asks"] < 0, block["comp"] != block["comp"][0], block["asks"] == 1)
        asks, stays = block[asking], block[~asking]
        asks = asks[np.unique(asks["node"], return_index=True)[1]]
        for points in (stays, asks):
            if len(points) and len(asks):
                tree = RTree(points)
                place = np.searchsorted(nodes, tree.points["node"])
                for some in slices(asks, points):
                    own = asks[some]
                    q, p = tree.pairs(own, percent)
                    elsewhere = own["home"][q] != tree.points["home"][p]  # sets of one home meet there, once
                    x, y = np.searchsorted(nodes, own["node"])[q[elsewhere]], place[p[elsewhere]]
                    apart = root[x] != root[y]
                    x, y = x[apart], y[apart]
                    waiting.append(np.minimum(x, y) * len(nodes) + np.maximum(x, y))
                    if sum(map(len, waiting)) > 200_000:
                        sieve()
    if waiting:
        sieve()
    tied = np.flatnonzero(root != np.arange(len(nodes)))
    return pa.table({"a": nodes[root[tied]], "b": nodes[tied]})


def _meet(table: pa.Table, percent: float) -> pa.Table:
    """Links that join the components of each group in the table, as edges between these."""
    group, node, side = (table[c].to_numpy() for c in ("g", "node", "side"))
    order = np.lexsort((node, side, group))
    order = order[np.r_[True, (group[order][1:] != group[order][:-1]) | (node[order][1:] != node[order][:-1])]]  # a node's rows are alike
    first, size = P.runs(group[order])
    out = [np.zeros((0, 2), np.int64)]
    for a, n in zip(first.tolist(), size.tolist(), strict=True):
        rows = order[a : a + n]
        held = table.select(["comp", "part", "rest"]).take(pa.array(rows))
        comp, sets = held["comp"].to_numpy(), []
        for at in range(0, n, 256):  # few sets at a time are held twice
            some = held.slice(at, 256)
            sets += [np.frombuffer(p + q, np.uint64) for p, q in zip(some["part"].to_pylist(), some["rest"].to_pylist(), strict=True)]
        del held
        out.append(_joins(sets, comp, side[rows], percent))
    edges = np.concatenate(out)
    return pa.table({"a": edges[:, 0], "b": edges[:, 1]})


def _numbered(flat: np.ndarray) -> tuple[np.ndarray, int]:
    """Each value's number in the order of the distinct ones, and how many these are."""
    order = np.argsort(flat)
    held = flat[order]
    number = np.cumsum(np.r_[False, held[1:] != held[:-1]], dtype=np.int32)
    del held
    out = np.empty(len(flat), np.int64)  # an index, which any other kind would be turned into again and again
    out[order] = number
    return out, int(number[-1]) + 1 if len(number) else 0


def _joins(sets: list[np.ndarray], comp: np.ndarray, side: np.ndarray, percent: float) -> np.ndarray:
    """Edges between the components that links of the sets join; if there are two sides, links across them."""
    size = np.array([len(v) for v in sets], np.int64)
    begin = np.cumsum(size) - size
    points = np.zeros(len(sets), _POINT)
    points["size"], points["comp"], points["node"] = size, comp, np.arange(len(sets))
    for i, own in enumerate(sets):
        points["counts"][i] = np.minimum(np.bincount((W.mix(own) >> np.uint64(32)).astype(np.int64) % GROUPS, minlength=GROUPS), FULL)
    flat, values = _numbered(np.concatenate(sets))
    across = bool(side.any())
    tree, asks = RTree(points[side == 0]), points[side == 1] if across else points
    named, label = np.unique(comp, return_inverse=True)
    mark, edges = np.zeros(values, bool), []
    for some in slices(asks, tree.points):
        q, p = tree.pairs(asks[some], percent)
        q, p = asks["node"][some][q], tree.points["node"][p]
        if not across:
            q, p = q[q < p], p[q < p]
        order = np.argsort(q, kind="stable")
        q, p = q[order], p[order]
        for start, n in zip(*map(np.ndarray.tolist, P.runs(q)), strict=True):
            one, others = q[start], p[start : start + n]
            others = others[label[others] != label[one]]
            if not len(others):
                continue
            own = flat[begin[one] : begin[one] + size[one]]
            mark[own] = True
            ends = np.cumsum(size[others])
            member = np.arange(ends[-1]) + np.repeat(begin[others] - ends + size[others], size[others])
            shared = np.add.reduceat(mark[flat[member]], ends - size[others], dtype=np.int64)
            mark[own] = False
            met = np.unique(label[others[_enough(shared, size[others] + size[one], percent)]])
            edges += [(named[label[one]], named[m]) for m in met]
            label[np.isin(label, met)] = label[one]
    return np.array(edges, np.int64).reshape(-1, 2)


def groups(documents: DataFrame, percent: float = 80, width: int = 5, runs: Runs = word_runs) -> DataFrame:
    """(doc_id, n_shingles, component_id) for each row."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = P.buckets(spark, docs)
    nodes = store(docs.mapInArrow(lambda it: _nodes(it, width, runs), "doc_id long, size long, node long, counts binary, part binary"), "nodes")
    used = docs.where("doc_id IS NOT NULL AND text IS NOT NULL")
    # shingles in the first parts of very many sets come last in the order
    total = nodes.select(F.sum(F.floor(F.col("size") * (100 - percent) / 100) + 1)).first()[0] or 0
    least = max(64, total // COMMON)  # so at most COMMON shingles are above it
    often = P.per_bucket(used.mapInArrow(lambda it: _prefix_counts(it, width, percent, count, runs), P.SHAPE), lambda t: _common(t, least), "key long, n long").toArrow()
    key, n = often["key"].to_numpy().view(np.uint64), often["n"].to_numpy()
    order = np.argsort(key)
    held = spark.sparkContext.broadcast((key[order], np.log2(np.maximum(n[order], 1)).astype(np.int8) + 1))  # at most COMMON entries
    # blocks, and the first star of pairs
    members = used.mapInArrow(lambda it: _members(it, width, percent, count, held, runs), P.SHAPE)
    blocks = store(P.per_bucket(members, lambda t: _stars(t, percent), "token long, pivot long, node long, n int"), "blocks")
    leader = nodes.where("doc_id IS NOT NULL AND size > 0").groupBy("node").agg(F.min("doc_id").alias("doc_id"))
    leader = leader.join(blocks.select("node").distinct(), "node", "left_semi")
    points = store(nodes.join(leader, ["node", "doc_id"]).dropDuplicates(["node"]), "points")

    def whole_sets(ids: DataFrame) -> DataFrame:
        """Sets of these documents and of some others; they are cut before any join by id, which would send all texts."""
        return likely(used, "doc_id", ids).mapInArrow(lambda it: _payload(it, width, runs), "doc_id long, node long, size int, part binary, rest binary")

    def links(pairs: DataFrame) -> DataFrame:
        """The pairs that the bound lets pass and the sets confirm."""
        held = points.select("node", F.col("size").cast("int"), "counts", "part")
        both = pairs.join(held.toDF("a", "na", "pa", "qa"), "a").join(held.toDF("b", "nb", "pb", "qb"), "b")
        passed = store(both.mapInArrow(lambda it: _filter(it, percent), "a long, b long"), "passed")
        involved = passed.select(F.col("a").alias("node")).union(passed.select(F.col("b").alias("node"))).distinct()
        ids = store(points.join(involved, "node", "left_semi").select("doc_id"), "set-ids")
        shingled = store(whole_sets(ids).join(ids.distinct(), "doc_id", "left_semi").drop("doc_id"), "sets")
        some = shingled.select("node", "size", "part")
        both = passed.join(some.toDF("a", "na", "xp"), "a").join(some.toDF("b", "nb", "yp"), "b")
        near = store(both.mapInArrow(lambda it: _partly(it, percent), "a long, b long"), "near")
        whole = shingled.select("node", "part", "rest")
        both = near.join(whole.toDF("a", "xp", "xr"), "a").join(whole.toDF("b", "yp", "yr"), "b")
        out = store(both.mapInArrow(lambda it: _verify(it, percent), "a long, b long"), "links")
        drop_stored(passed, ids, shingled, near)
        return out

    # a set's home is the smallest set that most of its blocks name: it meets that first, then others that are still apart
    stars = store(blocks.groupBy(F.col("pivot").alias("a"), F.col("node").alias("b")).agg(F.count("*").alias("times")), "stars")
    homes = store(stars.groupBy(F.col("b").alias("node")).agg(F.max_by("a", F.struct("times", F.negative("a"))).alias("home")), "homes")
    one = homes.where("home <> node").select(F.col("home").alias("a"), F.col("node").alias("b"))
    first = links(one)
    known = store(components(first), "joined")
    apart = stars.join(known.toDF("a", "ca"), "a", "left").join(known.toDF("b", "cb"), "b", "left").where("a <> b AND coalesce(ca, a) <> coalesce(cb, b)")
    first = store(first.union(links(apart.select("a", "b").join(one, ["a", "b"], "left_anti"))), "star-links")
    joined = components(first)
    # blocks whose sets, which have all met the pivot, are of several components
    placed = points.select("node", F.col("size").cast("int"), "counts", "part").join(joined.toDF("node", "c"), "node", "left").withColumn("comp", F.coalesce("c", "node")).drop("c")
    placed = store(placed.join(homes, "node"), "placed-points")
    # the sets of one home are a block as well; there no two count as of one home
    members = homes.groupBy("home").agg(F.count("*").cast("int").alias("n")).where("n > 1").join(homes, "home")
    own = members.select(F.xxhash64("home").alias("token"), F.col("home").alias("pivot"), "node", "n", F.lit(True).alias("own"))
    blocks = blocks.withColumn("own", F.lit(False)).union(own)
    blocks = store(blocks.join(placed.select("node", "comp", "home"), "node"), "labelled-blocks")
    open_ = blocks.where("node <> pivot").groupBy("token", "own").agg(*(f(c).alias(f"{f.__name__}_{c}") for f in (F.min, F.max) for c in ("comp", "home")))
    open_ = open_.where("min_comp <> max_comp AND (own OR min_home <> max_home)")
    blocks = blocks.join(open_, ["token", "own"], "left_semi").drop("comp", "home")
    home = F.when(F.col("own"), F.col("node")).otherwise(F.col("home")).alias("home")
    whole = blocks.where(F.col("n") <= CHUNK).select("token", "node", "own").join(placed, "node").select("token", "node", "comp", home, "size", "counts", "part", F.lit(-1).cast("tinyint").alias("asks"), F.lit(0).alias("chunk"))
    large = blocks.where(F.col("n") > CHUNK).join(placed, "node").join(placed.select(F.col("node").alias("pivot"), F.col("comp").alias("main")), "pivot")
    large = large.withColumn("asks", (F.col("comp") != F.col("main")).cast("tinyint")).withColumn("chunks", F.ceil(F.col("n") / CHUNK).cast("int"))
    large = large.withColumn("chunk", F.explode(F.when(F.col("asks") == 1, F.sequence(F.lit(0), F.col("chunks") - 1)).otherwise(F.array(F.pmod(F.hash("node"), F.col("chunks"))))))
    pointed = whole.union(large.withColumn("home", home).select(whole.columns)).mapInArrow(lambda it: _points(it, count), f"{P.SHAPE}, parts binary")
    rest = P.per_bucket(pointed, lambda t: _search(t, percent), "a long, b long")
    tied = store(components(rest).toDF("node", "g").join(placed.select("node", "size", "comp"), "node"), "tied")
    # each group's sets meet in one task, those of a large one in a task for each two chunks
    chunks = tied.groupBy("g").agg(F.ceil(F.greatest(F.count("*") / CHUNK, F.sum("size") / MEMBERS)).cast("int").alias("chunks"))
    cells = tied.join(chunks, "g").select("g", "node", "comp", "chunks", F.pmod(F.hash("node"), F.col("chunks")).alias("own"))
    cells = cells.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1))).withColumn("side", F.col("own") > F.col("other"))
    small = F.pmod(F.xxhash64("g"), F.lit(count))
    cells = cells.select("g", "node", "comp", "side", F.when(F.col("chunks") == 1, small).otherwise(F.xxhash64("g", F.least("own", "other"), F.greatest("own", "other"))).alias("cell"))
    met = cells.join(whole_sets(points.join(tied, "node", "left_semi").select("doc_id")).drop("doc_id", "size"), "node").groupBy("cell").applyInArrow(lambda t: _meet(t, percent), "a long, b long")
    final = components(first.union(met))
    known = nodes.join(final.toDF("node", "c"), "node", "left").select("doc_id", "size", F.when(F.col("size") > 0, F.coalesce("c", "node")).alias("c"))
    known = store(known, "placed")
    # rows of one id tie their sets together as well
    twice = known.where("doc_id IS NOT NULL AND c IS NOT NULL").groupBy("doc_id").agg(F.min("c").alias("a"), F.max("c").alias("b")).where("a <> b")
    if not twice.isEmpty():
        own = known.where("c IS NOT NULL").join(twice.select("doc_id", "a"), "doc_id").select("a", F.col("c").alias("b"))
        known = known.join(components(own).toDF("c", "tied"), "c", "left").select("doc_id", "size", F.coalesce("tied", "c").alias("c"))
    lowest = known.where("c IS NOT NULL").groupBy("c").agg(F.min("doc_id").alias("component_id"))
    return known.join(lowest, "c", "left").select("doc_id", F.col("size").alias("n_shingles"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
