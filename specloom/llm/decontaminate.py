"""Benchmark decontamination with an FM-index per training shard.

Each slice of documents is a shard. Its words become symbols, its suffix array gives the
Burrows-Wheeler transform, and a wavelet matrix over that answers ranks. All benchmark
windows are searched backward at once; occurrences are located by walking back to sampled
suffix positions, and overlapping hits merge into spans. Shards need nothing from each
other, so there is no shuffle and a lost task is simply run again.

The benchmark is the stated query set. It is read in blocks of at most `block_bytes` of
text, one pass over a shard for each block, so nothing held in a task grows with it.

A window is `width` consecutive words of an item; an item of fewer words, but not none, is
one window. Words are lowered in A-Z, runs of ASCII letters, digits and non-ASCII bytes.

Defined results: null or empty texts have no words and no hits; items with a null id or
text are left out; items that repeat count once an id; repeated documents are judged each
for itself; columns named like a result are replaced. Empty tables give no hits or no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from specloom.session import ship_package

from . import words as W

SHARD = 2 << 20
SAMPLE_EVERY = 16


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order. Symbols 0 end texts: they differ from each other by position."""
    n = len(symbols)
    ends = np.flatnonzero(symbols == 0)
    first = symbols.astype(np.int64) + len(ends)
    first[ends] = np.arange(len(ends))
    bits = int(first.max()).bit_length()
    span = max(1, min(8, 62 // bits))
    key, padded = np.zeros(n, np.int64), np.r_[first, np.zeros(span, np.int64)]
    for j in range(span):
        key = (key << bits) | padded[j : j + n]
    order = np.argsort(key, kind="stable")
    new = np.r_[True, key[order][1:] != key[order][:-1]]
    rank = np.empty(n, np.int64)  # where a suffix's group of equals begins
    rank[order] = np.maximum.accumulate(np.where(new, np.arange(n), 0))
    while not new.all():
        # sort the suffixes that are still equal to a neighbour by what follows
        open_ = np.flatnonzero(~new | ~np.r_[new[1:], True])
        at = order[open_]
        pair = rank[at] * (n + 1) + np.where(at + span < n, rank[np.minimum(at + span, n - 1)], 0)
        by = np.argsort(pair, kind="stable")
        at, pair = at[by], pair[by]
        order[open_] = at
        fresh = np.r_[True, pair[1:] != pair[:-1]]
        new[open_] |= fresh
        rank[at] = open_[np.maximum.accumulate(np.where(fresh, np.arange(len(at)), 0))]
        span *= 2
    return order


class FMIndex:
    """Backward search and location over symbols that end each text with 0."""

    def __init__(self, symbols: np.ndarray, starts: np.ndarray):
        order = suffix_array(symbols)
        n = len(symbols)
        self.n, self.bwt = n, symbols[order - 1]
        self.below = np.r_[0, np.cumsum(np.bincount(symbols))]
        self.levels, held = [], self.bwt
        for bit in range(max(1, int(symbols.max()).bit_length()) - 1, -1, -1):
            ones = (held >> bit) & 1 == 1
            before = np.zeros(n + 1, np.int32)
            np.cumsum(ones, out=before[1:])
            self.levels.append((bit, before, n - int(before[-1])))
            held = np.concatenate([held[~ones], held[ones]])
        kept = np.zeros(n, bool)
        kept[::SAMPLE_EVERY] = True
        kept[starts] = True  # a walk back ends at the beginning of its text
        self.sampled = kept[order]
        self.sample_rank = np.cumsum(self.sampled) - 1
        self.sample = order[self.sampled]

    def rank(self, symbol: np.ndarray, upto: np.ndarray) -> np.ndarray:
        """How often a symbol occurs in the transform's rows before `upto`."""
        low, high = np.zeros_like(upto), upto
        for bit, before, zeros in self.levels:
            one = (symbol >> bit) & 1 == 1
            low = np.where(one, zeros + before[low], low - before[low])
            high = np.where(one, zeros + before[high], high - before[high])
        return high - low

    def search(self, patterns: np.ndarray, length: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges of all patterns (right-aligned rows of symbols). Symbols that the shard lacks match nothing."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), self.n, np.int64)
        width = patterns.shape[1]
        live = np.flatnonzero((length > 0) & (patterns[:, width - 1] > 0))
        for j in range(width - 1, -1, -1):
            live = live[length[live] >= width - j]
            if not len(live):
                break
            symbol = patterns[live, j]
            lost = (symbol <= 0) | (symbol >= len(self.below) - 1)
            high[live[lost]] = low[live[lost]]
            live, symbol = live[~lost], symbol[~lost]
            low[live] = self.below[symbol] + self.rank(symbol, low[live])
            high[live] = self.below[symbol] + self.rank(symbol, high[live])
            live = live[low[live] < high[live]]
        return low, np.where(length > 0, high, low)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows."""
        rows, steps = rows.copy(), np.zeros(len(rows), np.int64)
        live = np.flatnonzero(~self.sampled[rows])
        while len(live):
            symbol = self.bwt[rows[live]]
            rows[live] = self.below[symbol] + self.rank(symbol, rows[live])
            steps[live] += 1
            live = live[~self.sampled[rows[live]]]
        return self.sample[self.sample_rank[rows]] + steps


class Windows:
    """The windows of a block of benchmark items, and which items have each."""

    def __init__(self, ids: list[str], texts: list[str], width: int):
        low = W.as_bytes(pa.array(texts, pa.string())).lowered()
        found = W.find_words(low, W.LETTERS_DIGITS)
        self.width = width
        self.vocabulary, symbol = np.unique(low.hashes(found.start, found.end), return_inverse=True)
        per = found.per_text
        runs = np.where(per >= width, per - width + 1, np.minimum(per, 1))
        item = np.repeat(np.arange(len(ids)), runs)
        at = found.first[item] + np.arange(len(item)) - np.repeat(np.cumsum(runs) - runs, runs)
        length = np.minimum(per[item], width)
        columns = np.arange(width)[None, :] - (width - length[:, None])
        rows = np.where(columns >= 0, np.r_[symbol, -1][np.where(columns >= 0, at[:, None] + columns, len(symbol))], -1)
        self.rows, own = np.unique(rows.reshape(-1, width), axis=0, return_inverse=True)
        self.length = (self.rows >= 0).sum(1)
        pairs = np.unique(np.stack([own.ravel(), item], 1), axis=0) if len(item) else np.zeros((0, 2), np.int64)
        self.item_of, self.first = pairs[:, 1], np.searchsorted(pairs[:, 0], np.arange(len(self.rows) + 1))
        self.ids = ids


def _match(windows: Windows, texts: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Words of each text; hit marks of all words; where each text's words begin; (text, item) pairs."""
    low = texts.lowered()
    found = W.find_words(low, W.LETTERS_DIGITS)
    per = found.per_text
    hit = np.zeros(int(found.first[-1]) + 1, np.int64)
    none = np.zeros(0, np.int64)
    if not len(found.start) or not len(windows.rows):
        return per, hit[:-1] > 0, found.first, none, none
    hashes = low.hashes(found.start, found.end)
    known = np.searchsorted(windows.vocabulary, hashes)
    known[known == len(windows.vocabulary)] = 0
    symbol = np.where(windows.vocabulary[known] == hashes, known + 2, 1)  # 1: not in the benchmark; 0: end of a text
    text = found.text_of()
    symbols = np.zeros(len(symbol) + texts.count, np.int32)
    symbols[np.arange(len(symbol)) + text] = symbol
    starts = found.first[:-1] + np.arange(texts.count)
    index = FMIndex(symbols, starts)
    low_row, high_row = index.search(np.where(windows.rows >= 0, windows.rows + 2, -1), windows.length)
    times = high_row - low_row
    window = np.repeat(np.arange(len(times)), times)
    row = low_row[window] + np.arange(len(window)) - np.repeat(np.cumsum(times) - times, times)
    place = index.locate(row)
    owner = np.searchsorted(starts, place, "right") - 1
    word = place - owner
    hit += np.bincount(word, minlength=len(hit)) - np.bincount(word + windows.length[window], minlength=len(hit))
    many = windows.first[window + 1] - windows.first[window]
    item = windows.item_of[np.repeat(windows.first[window], many) + np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)]
    pairs = np.unique(np.repeat(owner, many) * len(windows.ids) + item)
    return per, np.cumsum(hit)[:-1] > 0, found.first, pairs // len(windows.ids), pairs % len(windows.ids)


def _blocks(benchmark: DataFrame, limit: int) -> Iterator[tuple[list[str], list[str]]]:
    """The benchmark's items in blocks of about `limit` bytes; the driver holds one block."""
    rows = benchmark.select(F.col("item_id").cast("string"), "text").dropna().distinct()
    held, total = ([], []), 0
    for row in rows.toLocalIterator():
        held[0].append(row[0])
        held[1].append(row[1])
        total += len(row[1])
        if total >= limit:
            yield held
            held, total = ([], []), 0
    if held[0] or total == 0:
        yield held


def decontaminate(documents: DataFrame, benchmark: DataFrame, width: int = 13, block_bytes: int = 4 << 20) -> DataFrame:
    """Documents with n_words, n_hit, items (ids of items found) and spans (hit word ranges, begin and end in turn)."""
    spark = documents.sparkSession
    ship_package(spark)
    base = documents.drop("n_words", "n_hit", "items", "spans")
    names = base.columns
    shape = StructType([*base.schema.fields]).add("n_words", LongType()).add("n_hit", LongType()).add("items", ArrayType(StringType())).add("spans", ArrayType(IntegerType()))
    out = base
    for number, block in enumerate(_blocks(benchmark, block_bytes)):
        held = spark.sparkContext.broadcast(Windows(*block, width))  # one block: bounded by block_bytes

        def run(batches: Iterator[pa.RecordBatch], held=held, later=number > 0) -> Iterator[pa.RecordBatch]:
            windows = held.value
            for batch in batches:
                for rows, texts in W.slices(batch, "text", SHARD):
                    per, hit, first, text, item = _match(windows, texts)
                    owner = np.repeat(np.arange(texts.count), per)
                    items = [[] for _ in range(texts.count)]
                    for t, i in zip(text.tolist(), item.tolist(), strict=True):
                        items[t].append(windows.ids[i])
                    if later:
                        for t, (ids, spans) in enumerate(zip(rows.column("items").to_pylist(), rows.column("spans").to_pylist(), strict=True)):
                            items[t] += ids
                            for b, e in zip(spans[::2], spans[1::2], strict=True):
                                hit[first[t] + b : first[t] + e] = True
                    edge = np.flatnonzero(np.r_[True, (hit[1:] != hit[:-1]) | (owner[1:] != owner[:-1])]) if len(hit) else np.zeros(0, np.int64)
                    until = np.r_[edge[1:], len(hit)]
                    edge, until = edge[hit[edge]], until[hit[edge]]
                    whose = owner[edge]
                    spans = np.stack([edge - first[whose], until - first[whose]], 1).ravel()
                    begin = 2 * np.searchsorted(whose, np.arange(texts.count + 1))
                    n_hit = np.bincount(owner[hit], minlength=texts.count)
                    yield pa.RecordBatch.from_arrays(
                        [*(rows.column(c) for c in names), pa.array(per.astype(np.int64)), pa.array(n_hit.astype(np.int64)),
                         pa.array([sorted(set(x)) for x in items], pa.list_(pa.string())), W.ragged(spans.astype(np.int32), begin, pa.int32())],
                        [*names, "n_words", "n_hit", "items", "spans"])

        out = out.mapInArrow(run, shape)
    return out


def contaminated() -> Column:
    """The rule: some hit, and hits on at least a twentieth of the words."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))
