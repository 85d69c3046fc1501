"""Language-model scoring with an Elias-Fano n-gram trie.

Counts of all one-, two- and three-word runs of the training texts decide the model. Runs that
make up at least `rarest` of all training tokens are kept in the trie, a bar that is the same at
every size and bounds each level by 1 / rarest entries. A longer run is counted for the trie only
if its shorter parts are kept, which loses none that could pass the bar.

All other runs (`Rest`) are counted exactly by a join: texts are dealt to blocks, each block sends
its distinct runs that the trie lacks, with the word or pair they follow, to buckets by what they
follow (by the whole run where that is very frequent). A bucket adds up the blocks' counts and
answers each block in the order it asked, so no run is left to back-off for being rare. Followers
that the trie lacks are counted into the back-off weights of what the trie holds.

A level of the trie holds, for each run of the level above, its last words as ascending
numbers. The numbers are made one monotone sequence by adding each parent's base and stored
in Elias-Fano form, as are the pointers to where a parent's children begin. A three-word
run's last word is written as its place among the children of the run's last two words'
first one (its context), so its numbers are small. Log probabilities (absolute discounting)
and back-off weights are quantised to 256 values a level. The levels are arrays of bytes that
a worker maps from one file; queries look for the successor in the parent's range.

Defined results: a null or empty text has one token, the end; rows that repeat score alike
and count as often; rows without id are scored and learned from; columns other than doc_id
and text are left out; without training texts counts are 0. An empty table gives no rows.
"""

from __future__ import annotations

import mmap
import tempfile
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.session import drop_stored, ship_package, store

from . import packed as P
from . import words as W

END = W.hash_bytes(b"\x00end of text")
#: No word is like this: it separates texts in runs of word numbers.
ABSENT = -1
DISCOUNT = 0.6
#: Words or pairs that make up this share of all tokens have their followers dealt over all buckets.
HOT = 1e-4
#: Bytes of text of a block.
BLOCK = 6_000_000
#: Marks hashes, where numbers stand for what the trie holds.
HASH = np.uint64(1 << 63)
#: Marks pairs of words that the trie holds, where it lacks the pair (1 and 2: words and pairs that it holds, 0: nothing).
PAIR = 3


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 10 == 0, F.lit(False))


class EliasFano:
    """A monotone sequence of n numbers below a universe in about 2 + log2(u / n) bits each."""

    def __init__(self, values: np.ndarray, universe: int):
        n = max(len(values), 1)
        self.n, self.low_bits = len(values), max(0, int(universe // n).bit_length() - 1)
        values = values.astype(np.uint64)
        low = values & np.uint64((1 << self.low_bits) - 1)
        bits = (low[:, None] >> np.arange(self.low_bits, dtype=np.uint64)[None, :]).astype(np.uint8) & 1
        self.low = np.r_[np.packbits(bits.ravel(), bitorder="little"), np.zeros(9, np.uint8)]
        high = (values >> np.uint64(self.low_bits)).astype(np.int64) + np.arange(len(values))
        size = int(high[-1]) + 2 if len(values) else 1
        marks = np.zeros(-(-size // 8) * 8, np.uint8)
        marks[high] = 1
        self.high = np.packbits(marks, bitorder="little")
        self._index()

    def _index(self) -> None:
        """Ones before each byte of the upper bits, to find the i-th one."""
        self.before = np.r_[0, np.cumsum(_ONES[self.high])].astype(np.int64)
        # how many numbers have smaller upper bits: the ones before the zero that ends those
        zero = np.flatnonzero(np.unpackbits(self.high, bitorder="little") == 0)
        self.below = np.r_[0, zero - np.arange(len(zero))].astype(np.int32)
        # the eight bytes from each byte on
        self.eight = np.ndarray(max(len(self.low) - 8, 1), "<u8", self.low.tobytes(), strides=(1,))

    def parts(self) -> list[np.ndarray]:
        return [self.low, self.high]

    @classmethod
    def of(cls, n: int, low_bits: int, low: np.ndarray, high: np.ndarray) -> EliasFano:
        new = cls.__new__(cls)
        new.n, new.low_bits, new.low, new.high = n, low_bits, low, high
        new._index()
        return new

    def __getitem__(self, i: np.ndarray) -> np.ndarray:
        """The numbers at places i."""
        byte = np.searchsorted(self.before, i, "right") - 1
        upper = byte * 8 + _PLACE[self.high[byte], i - self.before[byte]] - i
        return (upper << self.low_bits) | self._low(i)

    def _low(self, i: np.ndarray) -> np.ndarray:
        """The lower bits of the numbers at places i."""
        at = i * self.low_bits
        return ((self.eight[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << self.low_bits) - 1)).astype(np.int64)

    def find(self, value: np.ndarray) -> np.ndarray:
        """Successor search: the place of each value, or -1."""
        hit = np.full(len(value), -1, np.int64)
        if not self.n or not len(value):
            return hit
        high, wanted = value >> self.low_bits, value & ((1 << self.low_bits) - 1)
        known = high < len(self.below) - 1
        high = np.where(known, high, 0)
        low, stop = self.below[high].astype(np.int64), self.below[high + 1].astype(np.int64)
        stop[~known] = low[~known]
        end = stop.copy()
        live = np.flatnonzero(low < end)
        while len(live):  # among numbers of equal upper bits only the lower ones are read
            middle = (low[live] + end[live]) >> 1
            less = self._low(middle) < wanted[live]
            low[live[less]] = middle[less] + 1
            end[live[~less]] = middle[~less]
            live = live[low[live] < end[live]]
        found = np.flatnonzero(low < stop)
        good = found[self._low(low[found]) == wanted[found]]
        hit[good] = low[good]
        return hit


_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little")
_ONES = _BITS.sum(1).astype(np.int64)
_PLACE = np.argsort(-_BITS.astype(np.int8), axis=1, kind="stable").astype(np.int64)


def quantise(values: np.ndarray, levels: int = 256) -> tuple[np.ndarray, np.ndarray]:
    """Codes and the values they stand for: means of equally filled bins."""
    if not len(values):
        return np.zeros(0, np.uint8), np.zeros(levels)
    order = np.argsort(values, kind="stable")
    code = np.empty(len(values), np.int64)
    code[order] = np.arange(len(values)) * levels // len(values)
    size = np.bincount(code, minlength=levels)
    means = np.bincount(code, values, levels) / np.maximum(size, 1)
    return code.astype(np.uint8), means


class Trie:
    """Levels of words, pairs and triples; `words` are the kept words' hashes in order."""

    def __init__(self, words: np.ndarray, base: np.ndarray, count: np.ndarray, pairs: np.ndarray, pair_n: np.ndarray, triples: np.ndarray, triple_n: np.ndarray, followers: tuple[np.ndarray, np.ndarray] | None = None):
        """`pairs` and `triples` hold word numbers in order of rows; `base`: the words' unigram log10 probabilities;
        `followers`: how many kinds of words that the trie lacks follow each word and each pair."""
        v = len(words)
        self.words, self.slots = words, None
        first = np.searchsorted(pairs[:, 0], np.arange(v + 1))
        total = np.maximum(count, 1)

        def elsewhere(above, n, whole, kinds):
            """The share of the runs that the trie lacks."""
            return np.where(kinds > 0, (whole - np.bincount(above, n, len(whole)) - DISCOUNT * kinds) / whole, 0.0)

        share = (pair_n - DISCOUNT) / total[pairs[:, 0]]
        lacking = elsewhere(pairs[:, 0], pair_n, total, followers[0]) if followers is not None else 0.0
        left = 1 - np.bincount(pairs[:, 0], share, v) - lacking
        covered = np.bincount(pairs[:, 0], 10.0 ** base[pairs[:, 1]], v)
        p2 = share + left[pairs[:, 0]] * 10.0 ** base[pairs[:, 1]]
        weight1 = np.maximum(1 - lacking - np.bincount(pairs[:, 0], p2, v), 1e-6) / np.maximum(1 - covered, 1e-6)
        pair_key = pairs[:, 0].astype(np.int64) * v + pairs[:, 1]
        above = np.searchsorted(pair_key, triples[:, 0].astype(np.int64) * v + triples[:, 1])
        context = np.searchsorted(pair_key, triples[:, 1].astype(np.int64) * v + triples[:, 2])
        total = np.maximum(pair_n, 1)
        share = (triple_n - DISCOUNT) / total[above]
        lacking = elsewhere(above, triple_n, total, followers[1]) if followers is not None else 0.0
        left = 1 - np.bincount(above, share, len(pairs)) - lacking
        p3 = share + left[above] * p2[context]
        weight2 = np.maximum(1 - lacking - np.bincount(above, p3, len(pairs)), 1e-6) / np.maximum(1 - np.bincount(above, p2[context], len(pairs)), 1e-6)
        second = np.searchsorted(above, np.arange(len(pairs) + 1))
        # a triple's last word as its place among the children of its middle word
        relative = context - first[triples[:, 1]]
        widest = int(np.diff(first).max(initial=0)) + 1
        self.meta = {"v": v, "widest": widest}
        self.levels = {
            "pairs": EliasFano(pair_key, v * v + 1), "pair_at": EliasFano(first, len(pairs) + 1),
            "triples": EliasFano(above * widest + relative, len(pairs) * widest + 1), "triple_at": EliasFano(second, len(triples) + 1),
        }
        log = lambda x: np.log10(np.maximum(x, 1e-30))
        self.codes, self.tables = {}, {}
        for name, values in (("p1", base), ("w1", log(weight1)), ("p2", log(p2)), ("w2", log(weight2)), ("p3", log(p3))):
            self.codes[name], self.tables[name] = quantise(values)
        self.n1, self.n2 = count.astype(np.float64), pair_n.astype(np.float64)
        self.rank = np.empty(v, np.int32)  # by frequency: frequent words have small numbers, which pack well
        self.rank[np.argsort(-self.n1, kind="stable")] = np.arange(v)

    def dump(self) -> tuple[bytes, dict]:
        """All arrays in one run of bytes, and where each lies."""
        arrays = {"words": self.words, "n1": self.n1, "n2": self.n2, "rank": self.rank, **{f"c.{k}": c for k, c in self.codes.items()}, **{f"t.{k}": t for k, t in self.tables.items()}}
        for name, level in self.levels.items():
            arrays |= {f"l.{name}": level.low, f"h.{name}": level.high}
        at, where, out = 0, {}, []
        for name, values in arrays.items():
            data = np.ascontiguousarray(values).tobytes()
            where[name] = (at, len(values), values.dtype.str)
            out.append(data + b"\0" * (-len(data) % 8))
            at += len(out[-1])
        shape = {name: (level.n, level.low_bits) for name, level in self.levels.items()}
        return b"".join(out), {"arrays": where, "levels": shape, **self.meta}

    @classmethod
    def load(cls, data: bytes, meta: dict) -> Trie:
        """Map the levels from an unnamed file of this worker."""
        file = tempfile.TemporaryFile()  # has no name: nothing is left when the worker ends
        file.write(data or b"\0")
        file.flush()
        mapped = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        new = cls.__new__(cls)
        get = lambda name: np.frombuffer(mapped, meta["arrays"][name][2], meta["arrays"][name][1], meta["arrays"][name][0])
        new.words, new.n1, new.n2, new.rank, new.meta = get("words"), get("n1"), get("n2"), get("rank"), meta
        new.slots = None
        new.levels = {n: EliasFano.of(*shape, get(f"l.{n}"), get(f"h.{n}")) for n, shape in meta["levels"].items()}
        names = ("p1", "w1", "p2", "w2", "p3")
        new.codes, new.tables = {n: get(f"c.{n}") for n in names}, {n: get(f"t.{n}") for n in names}
        return new

    def value(self, name: str, at: np.ndarray) -> np.ndarray:
        return self.tables[name][self.codes[name][at]]

    def numbers(self, hashes: np.ndarray) -> np.ndarray:
        """Word numbers; words that are not kept have -1."""
        if self.slots is None:
            self.slots = Slots(self.words)
        return self.slots.find(hashes)

    def places(self, before: np.ndarray, last: np.ndarray, word: np.ndarray, follows: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Places of the pairs (last, word), the pairs (before, last) and the triples, or -1.

        With `follows` the tokens are those of texts in order: a token's context is the pair that ends before it.
        """
        v, widest = self.meta["v"], self.meta["widest"]
        pair, context, triple = (np.full(len(word), -1, np.int64) for _ in range(3))
        at = np.flatnonzero((last >= 0) & (word >= 0))
        pair[at] = self.levels["pairs"].find(last[at] * v + word[at])
        at = np.flatnonzero((before >= 0) & (last >= 0))
        context[at] = pair[at - 1] if follows else self.levels["pairs"].find(before[at] * v + last[at])
        at = np.flatnonzero((context >= 0) & (pair >= 0))
        relative = pair[at] - self.levels["pair_at"][last[at]]  # the word's place among the children of `last`
        triple[at] = self.levels["triples"].find(context[at] * widest + relative)
        return pair, context, triple

    def log10(self, before: np.ndarray, last: np.ndarray, word: np.ndarray, places: tuple | None = None, rest: Rest | None = None) -> np.ndarray:
        """log10 P(word | before last) of kept words, and of all others with the counts of `rest`."""
        pair, context, triple = places or self.places(before, last, word)
        rest = rest or Rest.none(len(word))
        out = 10.0 ** np.where(word >= 0, self.value("p1", np.maximum(word, 0)) if self.meta["v"] else 0.0, rest.base)
        for n, above, run, weight, prob, level in ((self.n1, last, pair, "w1", "p2", 0), (self.n2, context, triple, "w2", "p3", 1)):
            count, whole, kinds = rest.counts[level]
            # what follows a word or pair that is not kept
            share, left = np.maximum(count - DISCOUNT, 0) / np.maximum(whole, 1), np.where(whole > 0, DISCOUNT * kinds / np.maximum(whole, 1), 1.0)
            kept = np.flatnonzero(above >= 0)
            share[kept] = np.maximum(count[kept] - DISCOUNT, 0) / n[above[kept]]
            left[kept] = 10.0 ** self.value(weight, above[kept])
            out = share + left * out
            hit = np.flatnonzero(run >= 0)
            out[hit] = 10.0 ** self.value(prob, run[hit])
        return np.log10(out)


@dataclass
class Rest:
    """What the trie lacks, for each token: the log10 probability of a word that is not kept, and for
    the runs of two and of three words that end here their count and the count and kinds of all that
    follow the same word or pair (0 where the trie has these)."""

    base: np.ndarray
    counts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def none(cls, n: int) -> Rest:
        return cls(np.zeros(n), [(np.zeros(n), np.zeros(n), np.zeros(n))] * 2)


def _numbers(words: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    if not len(words):
        return np.full(len(hashes), -1, np.int64)
    at = np.searchsorted(words, hashes)
    at[at == len(words)] = 0
    return np.where(words[at] == hashes, at, -1)


class Slots:
    """Places of hashes among sorted hashes, found by their upper bits."""

    def __init__(self, words: np.ndarray):
        bits = len(words).bit_length() + 1
        self.words, self.shift = words, np.uint64(64 - bits)
        self.first = np.searchsorted(words >> self.shift, np.arange((1 << bits) + 1, dtype=np.uint64)).astype(np.int32)

    def find(self, hashes: np.ndarray) -> np.ndarray:
        slot = (hashes >> self.shift).astype(np.int64)
        at, end = self.first[slot], self.first[slot + 1]
        out = np.full(len(hashes), -1, np.int64)
        live = np.flatnonzero(at < end)
        at, end, left = at[live], end[live], hashes[live]
        while len(live):
            hit = self.words[at] == left
            out[live[hit]] = at[hit]
            at = at + 1
            more = ~hit & (at < end)
            live, at, end, left = live[more], at[more], end[more], left[more]
        return out


def _order(key: np.ndarray, above: np.ndarray, word: np.ndarray, bits: int = 0) -> np.ndarray:
    """An order by `key` that has equal runs side by side and hangs on (key, above, word) alone.

    Beyond its last `bits` the key stands for `above`; where it does not tell runs apart, they do.
    """
    order = np.argsort(key)
    key, a, w = key[order], above[order], word[order]
    group = key >> np.uint64(bits)
    mixed = np.flatnonzero(((group[1:] == group[:-1]) & (a[1:] != a[:-1])) | ((key[1:] == key[:-1]) & (w[1:] != w[:-1])))
    if len(mixed):
        low = np.unique(np.searchsorted(group, group[mixed]))
        size = np.searchsorted(group, group[low], "right") - low
        slots = np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())
        order[slots] = order[slots][np.lexsort((w[slots], a[slots], group[slots]))]
    return order


def _tokens(texts: W.Bytes) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each text's words and its end, and where each text's begin."""
    low = texts.lowered()
    found = W.find_words(low, W.BLANK_SEPARATED)
    first = found.first + np.arange(texts.count + 1)
    out = np.full(int(first[-1]), END, np.uint64)
    out[np.arange(len(found.start)) + found.text_of()] = low.hashes(found.start, found.end)
    return out, first


_RUN = np.dtype([("key", np.int64), ("n", np.int64)])


def _count(batches: Iterator[pa.RecordBatch], order: int, held, buckets: int, block: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """Packed (key, n) of the runs of `order` words whose shorter parts are kept."""
    words, pairs = held.value if held is not None else (None, None)
    packer, keys, total = P.Packer(_RUN, buckets, block=1), [], 0
    slots = Slots(words) if order > 1 else None
    for batch in batches:
        for _, texts in W.slices(batch, "text"):
            token, first = _tokens(texts)
            key = W.signed(token)
            if order > 1:
                number = slots.find(token)
                inside = np.ones(len(token), bool)
                inside[first[:-1]] = False
                inside &= (number >= 0) & (np.r_[ABSENT, number[:-1]] >= 0)
                key = np.r_[0, number[:-1]] * len(words) + number
                if order == 3:
                    pair = np.where(inside, _numbers(pairs, np.where(inside, key, 0)), -1)
                    inside = inside & (pair >= 0) & (np.r_[ABSENT, pair[:-1]] >= 0)
                    key = np.r_[0, pair[:-1]] * len(words) + number
                key = key[inside]
            keys.append(key)
            total += len(key)
            if total >= block:
                yield from packer.add(*np.unique(np.concatenate(keys), return_counts=True))
                keys, total = [], 0
    if total:
        yield from packer.add(*np.unique(np.concatenate(keys), return_counts=True))


def _counts(texts: DataFrame, order: int, held, least: float) -> DataFrame:
    """(key, n) of all runs of a level that occur at least so often."""
    buckets = P.buckets(texts.sparkSession)

    def total(table: pa.Table) -> pa.Table:
        rows = P.unpack(table, _RUN)
        key, at = np.unique(rows["key"], return_inverse=True)
        n = np.bincount(at, rows["n"], len(key)).astype(np.int64)
        return pa.table({"key": key[n >= least], "n": n[n >= least]})

    return P.per_bucket(texts.mapInArrow(lambda it: _count(it, order, held, buckets), P.SHAPE), total, "key long, n long")


def _level(texts: DataFrame, order: int, held, least: float) -> tuple[np.ndarray, np.ndarray]:
    """Kept runs of a level and their counts: at most N / least of them."""
    table = _counts(texts, order, held, least).toArrow()
    key, n = table["key"].to_numpy(), table["n"].to_numpy()
    by = np.argsort(key)
    return key[by], n[by]


_ASK = np.dtype([("above", np.uint64), ("word", np.uint64), ("n", np.uint32)])
_ANSWER = np.dtype([("n", np.uint32), ("whole", np.uint32), ("kinds", np.uint32)])
_FOLLOWERS = np.dtype([("above", np.uint64), ("kinds", np.uint32)])


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of about `BLOCK` bytes of text each, packed."""
    held, size = [], 0

    def packed() -> pa.RecordBatch:
        sink = pa.BufferOutputStream()
        with pa.ipc.new_stream(sink, held[0].schema, options=pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))) as out:
            out.write_table(pa.Table.from_batches(held))
        return pa.record_batch({"texts": pa.array([sink.getvalue().to_pybytes()], pa.binary())})

    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            held.append(rows)
            size += len(texts.data)
            if size >= BLOCK:
                yield packed()
                held, size = [], 0
    if held:
        yield packed()


def _open(texts: bytes) -> pa.Table:
    return pa.ipc.open_stream(texts).read_all()


def _lacking(token: np.ndarray, first: np.ndarray, base: int, trie: Trie, buckets: int, hot: float) -> tuple[np.ndarray, ...]:
    """Of texts' tokens the numbers of the word and the two before it and their places in the trie; then of
    each run that the trie lacks its level, token (from `base` on), what it follows, its word and sort key."""
    first = first[:-1]
    number = trie.numbers(token)
    last, before = np.r_[ABSENT, number[:-1]], np.r_[ABSENT, ABSENT, number[:-2]][: len(number)]
    later, third = np.ones(len(token), bool), np.ones(len(token), bool)  # second or later, third or later token of a text
    two = first[np.diff(np.r_[first, len(token)]) > 1] + 1
    later[first] = third[first] = third[two] = False
    last[first] = before[first] = before[two] = ABSENT
    pair, context, triple = trie.places(before, last, number, follows=True)
    known = np.flatnonzero(number >= 0)
    word = token >> np.uint64(17) | HASH >> np.uint64(16)  # tells apart what follows the same word or pair
    word[known] = trie.rank[number[known]]
    one, two, three = np.flatnonzero(number < 0), np.flatnonzero(later & (pair < 0)), np.flatnonzero(third & (triple < 0))
    above2 = np.uint64(1 << 60) | last[two].astype(np.uint64)
    rare = np.flatnonzero(last[two] < 0)
    above2[rare] = W.mix(token[two[rare] - 1]) | HASH
    above3 = np.uint64(2 << 60) | context[three].astype(np.uint64)
    apart = np.flatnonzero((context[three] < 0) & (before[three] >= 0) & (last[three] >= 0))
    above3[apart] = np.uint64(PAIR << 60) | word[three[apart] - 2] << np.uint64(30) | word[three[apart] - 1]
    rare = np.flatnonzero((before[three] < 0) | (last[three] < 0))
    above3[rare] = W.mix(token[three[rare] - 2] * np.uint64(3) + W.mix(token[three[rare] - 1])) | HASH
    above = np.concatenate([np.zeros(len(one), np.uint64), above2, above3])
    word = np.concatenate([token[one], word[two], word[three]])
    run = (above ^ word * np.uint64(0xC2B2AE3D27D4EB4F)) * np.uint64(0x9E3779B97F4A7C15)
    bucket = above * np.uint64(0xD6E8FEB86659FD93)
    # runs that follow nothing or something very frequent are dealt one by one
    spread = np.flatnonzero(np.concatenate([np.ones(len(one), bool), _frequent(trie.n1, last[two], hot), _frequent(trie.n2, context[three], hot)]))
    bucket[spread] = run[spread]
    bucket = (bucket >> np.uint64(32)) % np.uint64(buckets)
    # in a bucket near the order of what they follow and of words, which packs well
    major, minor = above.copy(), run >> np.uint64(40)
    major[: len(one)], minor[: len(one)] = word[: len(one)] >> np.uint64(40), word[: len(one)] >> np.uint64(16)
    far = np.flatnonzero(above >= np.uint64(PAIR << 60))
    major[far] >>= np.where(above[far] >= HASH, np.uint64(40), np.uint64(30))
    near = np.flatnonzero((above > 0) & (above < np.uint64(PAIR << 60)))
    minor[near] = np.where(word[near] < np.uint64(1 << 24), word[near], word[near] >> np.uint64(24))
    low24 = np.uint64((1 << 24) - 1)
    key = bucket << np.uint64(48) | (major & low24) << np.uint64(24) | minor & low24
    level = np.repeat(np.arange(3, dtype=np.int8), [len(one), len(two), len(three)])
    return number, last, before, pair, context, triple, level, base + np.concatenate([one, two, three]), above, word, key


class Block:
    """The tokens of a block of texts, their places in the trie, and the runs that the trie lacks."""

    def __init__(self, table: pa.Table, trie: Trie, buckets: int, hot: float):
        parts, base, rows = [], 0, 0
        for batch in table.to_batches():  # of some half megabyte each, so that their arrays stay in the processor's cache
            token, first = _tokens(W.as_bytes(batch.column("text")))
            parts.append((np.diff(first), np.repeat(np.arange(rows, rows + len(first) - 1), np.diff(first)), *_lacking(token, first, base, trie, buckets, hot)))
            base, rows = base + len(token), rows + len(first) - 1
        whole = [np.concatenate(part) for part in zip(*parts, strict=True)]
        self.size, self.text, self.number, self.last, self.before, *places = whole[:8]
        self.places, self.level, (self.where, above, word, key) = tuple(places), whole[8], whole[9:]
        self.order = order = _order(key, above, word)
        above, word = above[order], word[order]
        new = np.ones(len(order), bool)
        new[1:] = (above[1:] != above[:-1]) | (word[1:] != word[:-1])
        self.begin = np.flatnonzero(new)
        self.of = np.cumsum(new) - 1
        self.above, self.word, self.bucket = above[new], word[new], (key[order][new] >> np.uint64(48)).astype(np.int64)

    def asked(self, training: np.ndarray, block: int) -> pa.RecordBatch:
        """Rows of each bucket's runs with their counts in training texts."""
        rows = np.empty(len(self.begin), _ASK)
        rows["above"], rows["word"] = self.above, self.word
        if len(rows):
            rows["n"] = np.add.reduceat(training[self.text[self.where[self.order]]].astype(np.int64), self.begin)
        first, size = P.runs(self.bucket)
        packed = [P.squeeze(rows[a : a + n]) for a, n in zip(first.tolist(), size.tolist(), strict=True)]
        return pa.record_batch({"bucket": pa.array(self.bucket[first], pa.int32()), "block": pa.array([block] * len(first), pa.int64()), "n": pa.array(size, pa.int32()), "packed": pa.array(packed, pa.binary())})

    def rest(self, answers: pa.Table, whole: float) -> tuple[Rest, np.ndarray]:
        """What the buckets answered, for each token, and which words that are not kept are known."""
        parts = sorted(zip(answers["bucket"].to_pylist(), answers["n"].to_pylist(), answers["packed"].to_pylist(), strict=True), key=lambda x: x[0])
        rows = np.concatenate([np.zeros(0, _ANSWER), *(P.expand(data, n, _ANSWER) for _, n, data in parts)])
        if len(rows) != len(self.begin):
            raise ValueError("a block's answers do not fit its runs")
        level, where = self.level[self.order], self.where[self.order]
        found = [np.ascontiguousarray(rows[name]) for name in _ANSWER.names]  # a field at a time: records are slow to deal out
        base, known, counts = np.zeros(len(self.number)), np.zeros(len(self.number), bool), []
        for wanted in range(3):
            own = np.flatnonzero(level == wanted)
            at, run = where[own], self.of[own]
            if wanted == 0:
                base[at], known[at] = np.log10((found[0] + 0.1) / whole)[run], (found[0] > 0)[run]
                continue
            fields = [np.zeros(len(self.number)) for _ in range(3)]
            for field, values in zip(fields, found, strict=True):
                values = values[run]
                some = np.flatnonzero(values)
                field[at[some]] = values[some]
            counts.append(tuple(fields))
        return Rest(base, counts), known


def _frequent(n: np.ndarray, at: np.ndarray, hot: float) -> np.ndarray:
    return (at >= 0) & (n[np.maximum(at, 0)] >= hot) if len(n) else np.zeros(len(at), bool)


def _answers(table: pa.Table) -> pa.Table:
    """To each row of a bucket its runs' counts, in its order; and a row without block of the followers of what the trie holds."""
    sizes = table["n"].to_numpy()
    rows = P.unpack(table, _ASK)
    above, word, times = (np.ascontiguousarray(rows[name]) for name in _ASK.names)
    del rows
    order = _order(W.mix(above) >> np.uint64(24) << np.uint64(24) | W.mix(word) >> np.uint64(40), above, word, 24)
    above, word = above[order], word[order]
    new = np.ones(len(order), bool)
    new[1:] = (above[1:] != above[:-1]) | (word[1:] != word[:-1])
    begin = np.flatnonzero(new)
    n = np.add.reduceat(times[order].astype(np.int64), begin)
    first, size = P.runs(above[begin])
    whole, kinds = np.add.reduceat(n, first), np.add.reduceat((n > 0).astype(np.int64), first)
    held = above[begin][first] < np.uint64(PAIR << 60)  # the trie has the counts of these
    run = np.empty(len(order), np.int64)
    run[order] = np.cumsum(new) - 1
    each = np.empty(len(order), _ANSWER)
    for name, values in zip(_ANSWER.names, (n, np.repeat(np.where(held, 0, whole), size), np.repeat(np.where(held, 0, kinds), size)), strict=True):
        each[name] = values.astype(np.uint32)[run]
    ends = np.cumsum(sizes).tolist()
    packed = [P.squeeze(each[b - k : b]) for b, k in zip(ends, sizes.tolist(), strict=True)]
    more = np.empty(int((held & (kinds > 0)).sum()), _FOLLOWERS)
    more["above"], more["kinds"] = above[begin][first][held & (kinds > 0)], kinds[held & (kinds > 0)]
    extra = [P.squeeze(more)] if len(more) else []
    bucket = table["bucket"][0].as_py()
    return pa.table({
        "bucket": pa.array([bucket] * (len(sizes) + len(extra)), pa.int32()), "block": pa.array([*table["block"].to_pylist(), *[None] * len(extra)], pa.int64()),
        "n": pa.array([*sizes.tolist(), *[len(more)] * len(extra)], pa.int32()), "packed": pa.array([*packed, *extra], pa.binary())})


@contextmanager
def _shuffles_go(spark: SparkSession) -> Iterator[None]:
    """Here each job's result is stored or small, so its shuffle files go when it ends."""
    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(name, None)
    spark.conf.set(name, "true")
    try:
        yield
    finally:
        spark.conf.unset(name) if before is None else spark.conf.set(name, before)


def score(documents: DataFrame, rarest: float = 2.5e-7) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) for each row."""
    spark = documents.sparkSession
    ship_package(spark)
    with _shuffles_go(spark):
        return _score(spark, documents, rarest)


def _score(spark: SparkSession, documents: DataFrame, rarest: float) -> DataFrame:
    docs = documents.select("doc_id", "text", held_out(F.col("doc_id")).alias("held_out"))
    training = docs.where("NOT held_out").select("text")
    counts = store(_counts(training, 1, None, 1), "word-counts")
    all_, kinds = counts.agg(F.sum("n"), F.count("*")).first()
    all_ = int(all_ or 0)
    least = max(1.0, rarest * all_)
    table = counts.where(F.col("n") >= least).toArrow()  # at most 1 / rarest rows, as all counts add up to all_
    words, n1 = table["key"].to_numpy().view(np.uint64), table["n"].to_numpy()
    by = np.argsort(words)
    words, n1 = words[by], n1[by]
    drop_stored(counts)
    whole = all_ + 0.1 * (kinds + 1)
    base = np.log10((n1 + 0.1) / whole)
    v = max(len(words), 1)
    held = spark.sparkContext.broadcast((words, None))
    key2, n2 = _level(training, 2, held, least)
    held = spark.sparkContext.broadcast((words, key2))
    key3, n3 = _level(training, 3, held, least)
    pairs = np.stack([key2 // v, key2 % v], 1)
    above = key3 // v
    triples = np.concatenate([pairs[above], (key3 % v)[:, None]], 1) if len(key3) else np.zeros((0, 3), np.int64)
    levels = (words, base, n1, pairs, n2, triples, n3)

    # runs that the trie lacks: each block asks, each bucket answers
    buckets, hot = 2 * P.buckets(spark), HOT * all_
    blocks = store(docs.mapInArrow(_blocks, "texts binary").withColumn("block", F.monotonically_increasing_id()), "lm-blocks")
    places = spark.sparkContext.broadcast(Trie(*levels).dump())  # levels of at most 1 / rarest entries

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = Trie.load(*places.value)
        for batch in batches:
            for number, texts in zip(batch.column("block").to_pylist(), batch.column("texts"), strict=True):
                table = _open(texts.as_py())
                yield Block(table, trie, buckets, hot).asked(~table["held_out"].to_numpy(), number)
                W.tidy()

    asked = blocks.mapInArrow(ask, "bucket int, block long, n int, packed binary")
    answers = store(P.per_bucket(asked, _answers, "bucket int, block long, n int, packed binary"), "lm-answers")
    followers = np.zeros(len(words)), np.zeros(len(pairs))
    for _, _, n, packed in answers.where("block IS NULL").toLocalIterator():  # of words and pairs in the trie only
        rows = P.expand(bytes(packed), n, _FOLLOWERS)
        for level, lacking in enumerate(followers, 1):
            own = rows[rows["above"] >> np.uint64(60) == level]
            np.add.at(lacking, (own["above"] & np.uint64((1 << 60) - 1)).astype(np.int64), own["kinds"])
    model = spark.sparkContext.broadcast((*Trie(*levels, followers).dump(), base))

    tries: list[Trie] = []

    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        data, meta, base = model.value
        if not tries:  # once a task
            tries.append(Trie.load(data, meta))
        trie, table = tries[0], _open(rows["texts"][0].as_py())
        block = Block(table, trie, buckets, hot)
        rest, known = block.rest(answers, whole)
        common = block.number >= 0
        add = lambda x: np.bincount(block.text, x, len(block.size))
        basic = np.where(common, base[np.maximum(block.number, 0)] if len(base) else 0.0, rest.base)
        out = pa.table([
            table["doc_id"], table["held_out"], pa.array(block.size, pa.int64()), pa.array(add(common | known).astype(np.int64)),
            pa.array(add(basic)), pa.array(add(trie.log10(block.before, block.last, block.number, block.places, rest)))],
            ["doc_id", "held_out", "n_tokens", "n_known", "base_score", "score"])
        del block, rest
        W.tidy()
        return out

    kind = dict(docs.dtypes)["doc_id"]
    answers = answers.where("block IS NOT NULL")
    scored = blocks.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        run, f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, base_score double, score double")
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(all_).cast("long").alias("train_tokens"), "base_score", "score")
