"""Fuzzy line dedup by MinHash.

Lines are compared trimmed and lowered. A line's set holds its runs of `width` characters
(a shorter line is one run). One-permutation MinHash fills `bands * rows` bins, empty bins
borrow from the next filled one, and equal bands make lines candidates. Groups of the same
lines, which near copies have in several bands, are one. Each group's texts meet in one task. There
every line is first compared with the group's smallest line and its next one, and then with all lines
of the group that are still apart from it, by exact Jaccard similarity; the task sends on a forest of
the links, at most one row a line. A group of more than `SMALL` lines is dealt to chunks, each with the
group's smallest line; its lines that then still are of several components go through the exact join
of `jaccard_join` (blocks by rare runs), which finds all links among them. A distributed union-find
joins the forests. Of each component the first line in (doc_id, line) order stays. A pair at similarity 0.8 meets
in a band with probability 0.98, at 0.9 with 0.9999, and one that meets is never left out.

Defined results: blank lines are never removed; a null text has no lines; rows of one
doc_id are one document, so repeats of its rows keep the same lines; documents without id
are returned as they are; extra columns pass through. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import ship_package, store

from . import packed as P
from . import words as W
from .components import components, forest
from .jaccard_join import _joins, groups
from .prefilter import likely

#: Lines of a band's group that one task compares with one another.
SMALL = 4096
#: Lines of a group up to which its pairs are listed; larger ones are searched by trees.
LISTED = 32
_PAIR = np.dtype([("key", np.uint64), ("line", np.int64)])


def raw_lines(documents: DataFrame) -> DataFrame:
    """(doc_id, no, raw) of every line."""
    return documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode(F.split("text", "\n")).alias("no", "raw"))


def lines(raw: DataFrame) -> DataFrame:
    """(doc_id, no, line, h) of the lines that are not blank, with the hash of their compared form."""
    trimmed = F.btrim("raw", F.lit(" \t\r\x0b\x0c"))
    return raw.where(trimmed != "").select("doc_id", "no", F.lower(trimmed).alias("line")).withColumn("h", F.xxhash64("line"))


def shingle_sets(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `width` characters of each text, repeats included, and where each text's begin."""
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.r_[0, np.cumsum([len(t) for t in texts])].astype(np.int64)
    size = np.diff(first)
    total = np.zeros(len(points), np.uint32)
    total += points
    padded = np.r_[points, np.zeros(width, np.uint32)]
    for k in range(1, width):
        total *= np.uint32(0x01000193)
        total += padded[k : k + len(points)]
    count = np.maximum(size - width + 1, np.minimum(size, 1))
    begin = np.r_[0, np.cumsum(count)]
    text = np.repeat(np.arange(len(texts)), count)
    value = total[first[text] + np.arange(begin[-1]) - begin[text]]
    short = size < width  # a whole line: hash only its own characters
    for t in np.flatnonzero(short & (size > 0)).tolist():
        own = 0x811C9DC5
        for p in points[first[t] : first[t + 1]].tolist():
            own = (own * 0x01000193 + p) & 0xFFFFFFFF
        value[begin[t]] = own
    value ^= value >> np.uint32(16)
    value *= np.uint32(0x85EBCA6B)
    value ^= value >> np.uint32(13)
    value *= np.uint32(0xC2B2AE35)
    value ^= value >> np.uint32(16)
    return value, begin


def signatures(value: np.ndarray, begin: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of each text, empty bins filled from the next filled one."""
    n = len(begin) - 1
    text = np.repeat(np.arange(n), np.diff(begin))
    least = np.full(n * bins, 0xFFFFFFFF, np.uint32)
    bin_ = ((value.astype(np.uint64) * np.uint64(bins)) >> np.uint64(32)).astype(np.int64)
    np.minimum.at(least, text * bins + bin_, value)
    table = least.reshape(n, bins)
    empty = table == 0xFFFFFFFF
    if empty.any():
        twice = np.concatenate([~empty, ~empty], 1)
        at = np.where(twice, np.arange(2 * bins), 2 * bins * 4)
        source = np.minimum.accumulate(at[:, ::-1], 1)[:, ::-1][:, :bins]
        source = np.where(source >= 2 * bins, np.arange(bins), source)
        moved = (source - np.arange(bins)).astype(np.uint32)
        table = np.take_along_axis(table, source % bins, 1) + moved * np.uint32(0x9E3779B1)
    return table


def _bands(batches: Iterator[pa.RecordBatch], count: int, width: int, bands: int, rows: int) -> Iterator[pa.RecordBatch]:
    packer = P.Packer(_PAIR, count, distinct=True)
    for batch in batches:
        h = batch.column("h").to_numpy(zero_copy_only=False)
        _, one = np.unique(h, return_index=True)
        texts = batch.column("line").take(pa.array(one)).to_pylist()
        at = 0
        while at < len(one):
            upto, size = at, 0
            while upto < len(one) and size < W.SLICE // 2:
                size += len(texts[upto])
                upto += 1
            table = signatures(*shingle_sets(texts[at:upto], width), bands * rows).astype(np.uint64)
            for b in range(bands):
                key = np.full(upto - at, b + 1, np.uint64)
                for r in range(rows):
                    key = W.mix(key ^ table[:, b * rows + r])
                yield from packer.add(key, h[one[at:upto]])
            at = upto
    yield from packer.flush()


def _groups(table: pa.Table, small: int) -> pa.Table:
    """Lines of a band's group of several: `g`, which the same lines share, each line `h`, and `large`.

    A group of more than `small` lines is dealt to chunks `g` that share its smallest line; `large` names the group.
    """
    held = P.ordered(P.unpack(table, _PAIR), "key", "line")
    first, size = P.runs(held["key"])
    line = held["line"]
    total = np.r_[np.uint64(0), np.cumsum(W.mix(line.view(np.uint64)), dtype=np.uint64)]
    name = W.mix(total[first + size] - total[first] + size.astype(np.uint64))
    chunks = -(-size // small)
    g = np.repeat(name, size)
    far = np.flatnonzero(np.repeat(chunks > 1, size))
    dealt = W.mix(line[far].view(np.uint64) ^ np.uint64(0x5851F42D4C957F2D)) % np.repeat(chunks, size)[far].astype(np.uint64)
    g[far] = W.mix(g[far] + dealt + np.uint64(1))
    keep = np.repeat((size > 1) & (chunks == 1), size)
    keep[far] = True
    keep[first[chunks > 1]] = False  # the smallest lines of groups that are dealt to chunks go to each chunk
    wide = np.flatnonzero(chunks > 1)
    at = np.repeat(first[wide], chunks[wide])
    nth = np.arange(len(at)) - np.repeat(np.cumsum(chunks[wide]) - chunks[wide], chunks[wide])
    pivots = W.mix(np.repeat(name[wide], chunks[wide]) + nth.astype(np.uint64) + np.uint64(1))
    large = np.repeat(name, size)
    return pa.table({
        "g": W.signed(np.r_[g[keep], pivots]), "h": np.r_[line[keep], line[at]],
        "large": pa.array(W.signed(np.r_[large[keep], np.repeat(name[wide], chunks[wide])]), mask=np.r_[~np.repeat(chunks > 1, size)[keep], np.zeros(len(at), bool)])})


def character_runs(texts: W.Bytes, width: int) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of each text's runs of `width` characters (a shorter one is one run), and where each text's begin."""
    points = np.frombuffer(texts.data.tobytes().decode("utf-8", "surrogatepass").encode("utf-32-le", "surrogatepass"), np.uint32)
    return W.shingles(W.mix(points.astype(np.uint64)), W.code_points(texts)[texts.offsets], width)


#: Pairs, and character runs of pairs, that are compared at a time.
PAIRS, RUNS = 2000, 4_000_000
#: Fills lines shorter than a run; no valid text holds it.
FILLER = "\udfff"


def _wide_runs(texts: list[str], width: int) -> tuple[np.ndarray, np.ndarray]:
    """52-bit hashes of all runs of `width` characters of each text, repeats included, and where each text's begin."""
    texts = [t.ljust(width, FILLER) for t in texts]
    points = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64) + np.uint64(1)
    total, padded = points.copy(), np.r_[points, np.zeros(width, np.uint64)]
    for k in range(1, width):
        total *= np.uint64(0x9E3779B97F4A7C15)
        total += padded[k : k + len(points)]
    size = np.array([len(t) for t in texts], np.int64)
    begin = np.r_[0, np.cumsum(size - width + 1)]
    at = np.arange(begin[-1]) + np.repeat(np.cumsum(size) - size - begin[:-1], size - width + 1)
    return W.mix(total[at]) >> np.uint64(12), begin


class Lines:
    """Lines as sets of their runs of characters; runs are told apart by 52 bits of their hash."""

    def __init__(self, texts: list[str], width: int):
        value, begin = _wide_runs(texts, width)
        self.value, self.begin = W.distinct_per_text(value, begin)
        self.size = np.diff(self.begin)

    def near(self, x: np.ndarray, y: np.ndarray, similarity: float) -> np.ndarray:
        """Which pairs of lines (by place) are similar enough."""
        weight = np.cumsum(self.size[x] + self.size[y])
        out, start = np.zeros(len(x), bool), 0
        while start < len(x):
            upto = int(np.searchsorted(weight, (weight[start - 1] if start else 0) + RUNS, "right"))
            end = min(max(upto, start + 1), start + PAIRS)
            keys = []  # of each run: its pair and its hash
            for own in (x[start:end], y[start:end]):
                n = self.size[own]
                pair = np.repeat(np.arange(len(own), dtype=np.uint64), n)
                at = np.arange(len(pair)) + np.repeat(self.begin[own] - (np.cumsum(n) - n), n)
                keys.append(pair << np.uint64(52) | self.value[at])
            key = np.sort(np.concatenate(keys))
            both = np.bincount((key[1:][key[1:] == key[:-1]] >> np.uint64(52)).astype(np.int64), minlength=end - start)
            out[start:end] = both >= similarity * (self.size[x[start:end]] + self.size[y[start:end]] - both)
            start = end
        return out


def jaccard_at_least(a: list[str], b: list[str], width: int, similarity: float) -> np.ndarray:
    """Whether two texts' sets of character runs are similar enough."""
    texts = list(dict.fromkeys([*a, *b]))
    number = {t: i for i, t in enumerate(texts)}
    return Lines(texts, width).near(*(np.array([number[t] for t in side], np.int64) for side in (a, b)), similarity)


def _tie(table: pa.Table, width: int, similarity: float) -> pa.Table:
    """A forest of the links among the lines of each group of the table."""
    g, h = table["g"].to_numpy(), table["h"].to_numpy()
    name, place = np.unique(h, return_index=True)
    lines = Lines(table["line"].take(pa.array(place)).to_pylist(), width)
    order = np.lexsort((h, g))
    order = order[np.r_[True, (g[order][1:] != g[order][:-1]) | (h[order][1:] != h[order][:-1])]]
    first, size = P.runs(g[order])
    line = np.searchsorted(name, h[order])
    root = np.arange(len(name))  # the smallest line that each is tied to

    def join(a: np.ndarray, b: np.ndarray) -> None:
        nonlocal root
        top = np.arange(len(name))
        low, high = forest(root[a], root[b])
        top[low] = high
        root = top[root]

    def compare(a: np.ndarray, b: np.ndarray) -> None:
        pairs = np.unique(np.minimum(a, b) * len(name) + np.maximum(a, b))
        a, b = pairs // len(name), pairs % len(name)
        small, big = np.minimum(lines.size[a], lines.size[b]), np.maximum(lines.size[a], lines.size[b])
        fits = (root[a] != root[b]) & (small >= similarity * big)
        a, b = a[fits], b[fits]
        good = lines.near(a, b, similarity)
        join(a[good], b[good])

    later = np.ones(len(line), bool)
    later[first] = False
    at = np.flatnonzero(later)
    compare(line[at], np.repeat(line[first], size)[at])
    compare(line[at], line[at - 1])

    def several() -> np.ndarray:
        """Groups whose lines are of several components."""
        if not len(line):
            return first
        return np.flatnonzero((size > 2) & (np.minimum.reduceat(root[line], first) != np.maximum.reduceat(root[line], first)))

    left = several()
    few = left[size[left] <= LISTED]
    for n in np.unique(size[few]).tolist():  # all pairs of groups of one size at a time
        x, y = np.triu_indices(n, 1)
        some = first[few[size[few] == n]]
        for at in range(0, len(some), 1 + 200_000 // len(x)):
            begin = some[at : at + 1 + 200_000 // len(x), None]
            compare(line[(begin + x).ravel()], line[(begin + y).ravel()])
    percent = round(100 * similarity, 9)
    for i in several().tolist():
        if size[i] <= LISTED:
            continue
        own = line[first[i] : first[i] + size[i]]
        named, at, n = np.unique(root[own], return_inverse=True, return_counts=True)
        outside = at != n.argmax()  # those of the largest component have no links among them to find
        sets = [lines.value[lines.begin[k] : lines.begin[k + 1]] for k in own.tolist()]
        for rows, side in ((np.arange(len(own)), outside), (np.flatnonzero(outside), np.zeros(outside.sum(), bool))):
            edges = _joins([sets[k] for k in rows.tolist()], named[at[rows]], side, percent)
            join(edges[:, 0], edges[:, 1])
    tied = np.flatnonzero(root != np.arange(len(name)))
    return pa.table({"a": name[root[tied]], "b": name[tied]})


def line_components(raw: DataFrame, seen: DataFrame, similarity: float = 0.8, width: int = 8, bands: int = 10, rows: int = 5) -> DataFrame:
    """(id, component_id) over hashes of lines that are linked with others.

    `seen` names the first (doc_id, no) of each hash: only there a candidate's text is read.
    """
    count, small = P.buckets(raw.sparkSession), SMALL
    packed = lines(raw).select("h", "line").mapInArrow(lambda it: _bands(it, count, width, bands, rows), P.SHAPE)
    met = P.per_bucket(packed, lambda t: _groups(t, small), "g long, h long, large long")
    met = store(met.repartition("h").dropDuplicates(["h", "g"]).join(seen.select("h", "place"), "h"), "line-groups")

    def texts(of: DataFrame) -> DataFrame:
        """Rows with a hash and a place, and the line there; only lines at these places are brought to their compared form."""
        wanted = of.withColumn("no", F.pmod("place", F.lit(1 << 32)).cast("int")).select(F.xxhash64(((F.col("place") - F.col("no")) / F.lit(1 << 32)).cast("long"), "no").alias("at"))
        there = lines(likely(raw.withColumn("at", F.xxhash64("doc_id", "no")), "at", wanted))
        return of.join(there.select("h", "line", _place().alias("place")), ["h", "place"])

    dealt = texts(met).select(F.pmod("g", F.lit(count)).alias("cell"), "g", "h", "line")
    first = store(dealt.groupBy("cell").applyInArrow(lambda t: _tie(t, width, similarity), "a long, b long"), "line-links")
    joined = store(components(first), "line-joined")
    large = met.where("large IS NOT NULL").select("large", "h", "place")
    if large.isEmpty():
        return joined
    # groups that were dealt to chunks: all links among the lines of those that still hold several components
    held = large.join(joined.toDF("h", "c"), "h", "left").withColumn("c", F.coalesce("c", "h"))
    several = held.groupBy("large").agg(F.min("c").alias("low"), F.max("c").alias("high")).where("low <> high")
    rest = store(large.join(several, "large", "left_semi").select("h", "place").distinct(), "line-rest")
    if rest.isEmpty():
        return joined
    left = store(texts(rest).select(F.col("h").alias("doc_id"), F.col("line").alias("text")), "line-rest-texts")
    tied = groups(left, round(100 * similarity, 9), width, character_runs).where("doc_id <> component_id")
    return components(joined.toDF("a", "b").union(tied.select(F.col("component_id").alias("a"), F.col("doc_id").alias("b"))))


def _place() -> Column:
    """One number in the order of (doc_id, no)."""
    return F.col("doc_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("no")


def dropped_lines(documents: DataFrame, similarity: float = 0.8, width: int = 8) -> DataFrame:
    """(doc_id, no) of each line that a line of its component comes before."""
    ship_package(documents.sparkSession)
    raw = raw_lines(documents)
    where = store(lines(raw).select("doc_id", "no", "h"), "line-places")
    seen = store(where.groupBy("h").agg(F.min(_place()).alias("place"), F.count("*").alias("n")), "line-seen")
    merged = store(line_components(raw, seen, similarity, width).withColumnRenamed("id", "h"), "line-components")
    keepers = seen.join(merged, "h", "left").withColumn("c", F.coalesce("component_id", "h"))
    lowest = keepers.where("component_id IS NOT NULL").groupBy("c").agg(F.min("place").alias("lowest"))
    keepers = keepers.where("n > 1 OR component_id IS NOT NULL").join(lowest, "c", "left").select("h", F.coalesce("lowest", "place").alias("keeper"))
    return where.join(store(keepers, "line-keepers"), "h").where(_place() != F.col("keeper")).select("doc_id", "no").distinct()


def dedup_lines(documents: DataFrame, similarity: float = 0.8, width: int = 8) -> DataFrame:
    """Documents with the numbers of the lines that go: `dropped` (null: none go)."""
    gone = dropped_lines(documents, similarity, width).groupBy("doc_id").agg(F.sort_array(F.collect_list("no")).alias("dropped"))
    return documents.drop("dropped").join(gone, "doc_id", "left")


def without_lines(rows: DataFrame) -> DataFrame:
    """Rows of `dedup_lines` with the dropped lines cut from their text."""
    names, shape = rows.columns, rows.schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part, texts = batch.slice(at, 500), []
                for text, gone in zip(part.column("text").to_pylist(), part.column("dropped").to_pylist(), strict=True):
                    if text is not None and gone:
                        gone = set(gone)
                        text = "\n".join(x for k, x in enumerate(text.split("\n")) if k not in gone)
                    texts.append(text)
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()) if c == "text" else part.column(c) for c in names], names)
            W.tidy()

    return rows.mapInArrow(run, shape)


def n_lines() -> Column:
    return F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).cast("long")
