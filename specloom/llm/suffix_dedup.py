"""Suffix-array dedup: bytes covered by a string of `span` bytes that an earlier document holds.

1. Each window of `span` bytes belongs to its minimizer; windows next to each other with one
   minimizer form a stretch. Minimizers found in one document only end here.
2. Stretches of the others meet by minimizer, so equal windows meet whatever surrounds them.
   Equal stretches are kept once with their smallest document.
3. Stretches of one minimizer that differ are sorted by a difference-cover suffix array:
   sampled triples (positions 1 and 2 modulo 3) get names by sorting, the names' triples are
   sorted again until they cover the window, the remaining suffixes follow from their first
   byte and the next sampled rank, and both orders are merged. Equal prefixes are neighbours
   there; each group of them takes its smallest document. Minimizers are sorted some at a time.
   One with very many stretches is sorted in parts; of equal windows of a part one goes on, and
   those of all parts meet by a hash of their bytes, some at a time.
4. Windows with a smaller document than their own give byte ranges, which are united per
   document. Exact copies of whole texts take part once: a copy goes as a whole.

The suffix arrays are built per bucket of minimizers. One over the whole corpus would shuffle
some sixty bytes for every byte of text.

Defined results: null texts are empty, texts under `span` bytes lose nothing; repeats within
a document are no matches. Of rows that share a doc_id but not the text, the text with the
smallest SHA-256 is compared, the others lose nothing; rows without id lose nothing. Other
columns are left out. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import ship_package, store

from . import anchors as A
from . import packed as P
from . import words as W

GRAM = 24
_SEEN = np.dtype([("key", np.uint64), ("doc", np.int64)])
_SHARED = np.dtype([("doc", np.int64), ("key", np.uint64)])
_STRETCH = np.dtype([("key", np.uint64), ("doc", np.int64), ("at", np.int32), ("windows", np.uint8)])
_RANGE = np.dtype([("doc", np.int64), ("begin", np.int64), ("end", np.int64)])
#: Stands in place of a minimizer for a document whose text an earlier one has.
COPY = np.uint64(0xFFFFFFFFFFFFFFFF)
#: Bytes of stretches that are sorted at a time, which takes some hundred bytes of memory for each.
PART = 1 << 20
#: Windows of several parts that meet at a time.
MEET = 200_000
_TEXTS = "bucket int, n int, docs binary, sizes binary, packed binary"
_STRINGS = "bucket int, n int, packed binary, strings binary"


def _minimizers(texts: W.Bytes, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Stretches of all texts: (minimizer, text, first window's byte, number of windows)."""
    size = np.diff(texts.offsets)
    runs = np.maximum(size - GRAM + 1, 0)
    first = np.r_[0, np.cumsum(runs)]
    start = np.repeat(texts.offsets[:-1] - first[:-1], runs) + np.arange(first[-1])
    hashes = texts.hashes(start, start + GRAM)
    chosen = A.window_minima(hashes, first, span - GRAM + 1)
    windows = np.maximum(size - span + 1, 0)
    text = np.repeat(np.arange(texts.count), windows)
    new = np.flatnonzero(np.r_[True, chosen[1:] != chosen[:-1]]) if len(chosen) else np.zeros(0, np.int64)
    begin = np.r_[0, np.cumsum(windows)]
    return hashes[chosen[new]] >> np.uint64(24), text[new], new - begin[text[new]], np.diff(np.r_[new, len(chosen)])


def _gathered(data: np.ndarray, begin: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Byte runs one after the other; their places are written out for a slice at a time."""
    ends = np.cumsum(length)
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint8)
    at = done = 0
    while at < len(length):
        upto = max(at + 1, int(np.searchsorted(ends, done + W.SLICE, "right")))
        n, end = length[at:upto], int(ends[upto - 1])
        out[done:end] = data[np.repeat(begin[at:upto] - (ends[at:upto] - n - done), n) + np.arange(end - done)]
        at, done = upto, end
    return out


def _seen(batches: Iterator[pa.RecordBatch], span: int, count: int) -> Iterator[pa.RecordBatch]:
    packer = P.Packer(_SEEN, count, distinct=True)
    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            key, text, _, _ = _minimizers(texts, span)
            yield from packer.add(key, rows.column("doc_id").to_numpy()[text])
    yield from packer.flush()


def _empty(shape: str) -> pa.Table:
    kinds = {"int": pa.int32(), "binary": pa.binary()}
    return pa.table({c.split()[0]: pa.array([], kinds[c.split()[1]]) for c in shape.split(", ")})


def _shared(table: pa.Table, count: int) -> pa.Table:
    """Minimizers of several documents, packed by document."""
    held = P.ordered(P.unpack(table, _SEEN), "key", "doc")
    _, size = P.runs(held["key"])
    held = held[np.repeat(size > 1, size)]
    packer = P.Packer(_SHARED, count)
    out = [*packer.add(held["doc"], held["key"]), *packer.flush()]
    return pa.Table.from_batches(out) if out else _empty(P.SHAPE)


def _marks(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    packer = P.Packer(_SHARED, count)
    for batch in batches:
        yield from packer.add(batch.column("doc_id").to_numpy(), np.full(batch.num_rows, COPY, np.uint64))
    yield from packer.flush()


def _texts(batches: Iterator[pa.RecordBatch], count: int) -> Iterator[pa.RecordBatch]:
    """Texts packed by document, as those of `_SHARED`."""
    codec = pa.Codec("zstd", compression_level=3)
    for batch in (b.slice(at, 4000) for b in batches for at in range(0, b.num_rows, 4000)):
        doc = batch.column("doc_id").to_numpy()
        texts = W.as_bytes(batch.column("text"))
        bucket = (W.mix(doc.astype(np.uint64)) % np.uint64(count)).astype(np.int32)
        order = np.argsort(bucket, kind="stable")
        first, n = P.runs(bucket[order])
        size = np.diff(texts.offsets)
        data = texts.data.tobytes()
        out = {"docs": [], "sizes": [], "packed": []}
        for a, k in zip(first.tolist(), n.tolist(), strict=True):
            rows = order[a : a + k]
            out["docs"].append(doc[rows].tobytes())
            out["sizes"].append(size[rows].tobytes())
            out["packed"].append(codec.compress(b"".join([data[texts.offsets[i] : texts.offsets[i + 1]] for i in rows.tolist()]), asbytes=True))
        yield pa.RecordBatch.from_arrays([pa.array(bucket[order][first]), pa.array(n.astype(np.int32)), *(pa.array(v, pa.binary()) for v in out.values())], ["bucket", "n", *out])


def _unpack_texts(table: pa.Table) -> tuple[np.ndarray, W.Bytes, np.ndarray]:
    """Documents of a bucket, their texts, and whether a row stands for its document."""
    codec = pa.Codec("zstd")
    docs = [np.frombuffer(x, np.int64) for x in table["docs"].to_pylist()]
    sizes = [np.frombuffer(x, np.int64) for x in table["sizes"].to_pylist()]
    data = [codec.decompress(x, int(s.sum()), asbytes=True) if s.sum() else b"" for x, s in zip(table["packed"].to_pylist(), sizes, strict=True)]
    doc = np.concatenate([np.zeros(0, np.int64), *docs])
    texts = W.Bytes(np.frombuffer(b"".join(data), np.uint8), np.r_[0, np.cumsum(np.concatenate([np.zeros(0, np.int64), *sizes]))])
    stands = np.ones(len(doc), bool)
    ids, inverse, n = np.unique(doc, return_inverse=True, return_counts=True)
    digests: dict[int, list] = {}
    for i in np.flatnonzero(n[inverse] > 1).tolist():
        own = texts.data[texts.offsets[i] : texts.offsets[i + 1]].tobytes()
        digests.setdefault(int(doc[i]), []).append((hashlib.sha256(own).hexdigest(), i))
    for rows in digests.values():
        least = min(rows)[0]
        for digest, i in rows:
            stands[i] = digest == least
    return doc, texts, stands


def _stretches(texts_table: pa.Table, shared_table: pa.Table, span: int, count: int) -> pa.Table:
    """The stretches of shared minimizers, packed by minimizer."""
    doc, texts, stands = _unpack_texts(texts_table)
    shared = P.unpack(shared_table, _SHARED)
    copies = np.unique(shared["doc"][shared["key"] == COPY])
    wanted = np.sort(W.mix(shared["doc"].astype(np.uint64)) + shared["key"])
    go = np.flatnonzero(stands & ~np.isin(doc, copies))
    codec = pa.Codec("zstd", compression_level=1)
    records, strings = [], []
    at = 0
    while at < len(go) and len(wanted):
        upto, size = at, 0
        while upto < len(go) and (upto == at or size < W.SLICE):
            size += int(texts.offsets[go[upto] + 1] - texts.offsets[go[upto]])
            upto += 1
        rows = go[at:upto]
        cut = [texts.data[texts.offsets[i] : texts.offsets[i + 1]] for i in rows.tolist()]
        part = W.Bytes(np.concatenate(cut), np.r_[0, np.cumsum([len(c) for c in cut])].astype(np.int64))
        at = upto
        key, text, first, windows = _minimizers(part, span)
        full = W.mix(doc[rows][text].astype(np.uint64)) + key
        place = np.searchsorted(wanted, full)
        place[place == len(wanted)] = 0
        keep = np.flatnonzero(wanted[place] == full)
        key, text, first, windows = key[keep], text[keep], first[keep], windows[keep]
        record = np.empty(len(keep), _STRETCH)
        for name, value in zip(_STRETCH.names, (key, doc[rows][text], first, windows), strict=True):
            record[name] = value
        strings.append(_gathered(part.data, part.offsets[text] + first, windows + span - 1))
        records.append(record)
    record = np.concatenate([np.zeros(0, _STRETCH), *records])
    if not len(record):
        return _empty(_STRINGS)
    data = np.concatenate(strings)
    strings.clear()
    length = record["windows"].astype(np.int64) + span - 1
    begin = np.cumsum(length) - length
    bucket = (W.mix(record["key"]) % np.uint64(count)).astype(np.int32)
    order = np.lexsort((record["key"], bucket))
    record, bucket, begin, length = record[order], bucket[order], begin[order], length[order]
    first, n = P.runs(bucket)
    return pa.table({
        "bucket": bucket[first], "n": n.astype(np.int32),
        "packed": pa.array([P.squeeze(record[a : a + k]) for a, k in zip(first.tolist(), n.tolist(), strict=True)], pa.binary()),
        "strings": pa.array([codec.compress(_gathered(data, begin[a : a + k], length[a : a + k]).tobytes(), asbytes=True) for a, k in zip(first.tolist(), n.tolist(), strict=True)], pa.binary())})


def prefix_order(data: np.ndarray, span: int) -> np.ndarray:
    """All positions ordered by their first `span` bytes or more, by a difference cover modulo 3."""
    n = len(data)
    padded = np.r_[data, np.zeros(span + 80, np.uint8)]
    letters = np.zeros(n + span + 32, np.uint64)  # eight bytes from each position
    for k in range(8):
        letters = (letters << np.uint64(8)) | padded[k : k + len(letters)]
    at = np.arange(n)
    sampled = at[at % 3 > 0]
    rank = np.zeros(n + 3 * span + 99, np.int64)
    columns = [letters[np.minimum(sampled + 8 * k, len(letters) - 1)] for k in range(3)]
    covers = 24
    while True:
        # sort the sampled triples and name them in order
        order = np.lexsort(columns[::-1])
        new = np.zeros(len(order), bool)
        new[:1] = True
        for c in columns:
            new[1:] |= c[order[1:]] != c[order[:-1]]
        rank[sampled[order]] = np.cumsum(new)
        if covers >= span or new.all():
            break
        columns = [rank[sampled + covers * k] for k in range(3)]  # recurse on names: their triples cover three times as much
        covers *= 3
    sampled = sampled[order]
    rest = at[at % 3 == 0]
    # one byte and the next sampled rank order the remaining suffixes
    byte = lambda i: padded[i].astype(np.int64)
    rest = rest[np.argsort((byte(rest) << 40) | rank[rest + 1], kind="stable")]
    one, two = sampled[sampled % 3 == 1], sampled[sampled % 3 == 2]
    before = np.searchsorted((byte(one) << 40) | rank[one + 1], (byte(rest) << 40) | rank[rest + 1])
    wide = lambda i: (byte(i) << 48) | (byte(i + 1) << 40) | rank[i + 2]
    before = before + np.searchsorted(wide(two), wide(rest))
    merged = np.empty(n, np.int64)
    place = np.maximum.accumulate(before) + np.arange(len(rest)) if len(rest) else before
    taken = np.zeros(n, bool)
    taken[place] = True
    merged[place] = rest
    merged[~taken] = sampled
    return merged


def window_kinds(data: np.ndarray, starts: np.ndarray, span: int) -> np.ndarray:
    """A number for each window start, the same for equal bytes; numbers follow the order of the windows."""
    kinds = np.empty(len(starts), np.int64)
    if len(starts):
        which = np.full(len(data), -1)
        which[starts] = np.arange(len(starts))
        order = which[prefix_order(data, span)]
        order = order[order >= 0]
        held = np.lib.stride_tricks.sliding_window_view(data, span)[starts[order]]
        kinds[order] = np.cumsum(np.r_[True, (held[1:] != held[:-1]).any(1)]) - 1
    return kinds


def least_per_window(data: np.ndarray, starts: np.ndarray, doc: np.ndarray, span: int) -> np.ndarray:
    """For each window start its smallest `doc` among windows with equal bytes."""
    kinds = window_kinds(data, starts, span)
    least = np.full(int(kinds.max(initial=-1)) + 1, np.iinfo(np.int64).max)
    np.minimum.at(least, kinds, doc)
    return least[kinds]


def _distinct(record: np.ndarray, data: np.ndarray, begin: np.ndarray, length: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
    """Where each kind of equal stretches is found, and which kind each stretch is."""
    widest = 2 * span - GRAM
    rows = np.zeros((len(record), widest + 1), np.uint8)
    owner = np.repeat(np.arange(len(record)), length)
    rows[owner, np.arange(len(owner)) - np.repeat(np.cumsum(length) - length, length)] = _gathered(data, begin, length)
    rows[:, widest] = record["windows"]
    _, chosen, which = np.unique(rows.view(f"V{widest + 1}").ravel(), return_index=True, return_inverse=True)
    return chosen, which.ravel()


def _starts(begin: np.ndarray, windows: np.ndarray) -> np.ndarray:
    """The windows of stretches one after the other: where each begins."""
    return np.repeat(begin - (np.cumsum(windows) - windows), windows) + np.arange(int(windows.sum()))


def _gone(record: np.ndarray, owner: np.ndarray, step: np.ndarray, gone: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte ranges of runs of windows that go; each window is given by its stretch and its place there."""
    edge = np.r_[True, (gone[1:] != gone[:-1]) | (owner[1:] != owner[:-1])] if len(gone) else np.zeros(0, bool)
    a = np.flatnonzero(edge)
    b = np.r_[a[1:], len(gone)] - 1 if len(a) else a
    a, b = a[gone[a]], b[gone[a]]
    r = owner[a]
    return record["doc"][r], record["at"][r] + step[a], record["at"][r] + step[b] + span


def _some(record: np.ndarray, data: np.ndarray, begin: np.ndarray, length: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Byte ranges to remove from all stretches of some minimizers."""
    # equal stretches once, with their smallest document
    chosen, which = _distinct(record, data, begin, length, span)
    least = np.full(len(chosen), np.iinfo(np.int64).max)
    np.minimum.at(least, which, record["doc"])
    # a minimizer with one stretch decides all its windows at once
    _, inverse, n = np.unique(record["key"][chosen], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(n[inverse] > 1)
    size = length[chosen[mixed]]
    windows = record["windows"].astype(np.int64)
    many = windows[chosen[mixed]]
    from_ = np.cumsum(many) - many
    starts = _starts(np.cumsum(size) - size, many)
    lowest = least_per_window(_gathered(data, begin[chosen[mixed]], size), starts, np.repeat(least[mixed], many), span)
    simple = np.ones(len(chosen), bool)
    simple[mixed] = False
    whole = np.flatnonzero(simple[which] & (least[which] < record["doc"]))
    yield record["doc"][whole], record["at"][whole].astype(np.int64), record["at"][whole] + length[whole]
    slot = np.full(len(chosen), -1)
    slot[mixed] = np.arange(len(mixed))
    open_ = np.flatnonzero(~simple[which])
    owner = np.repeat(open_, windows[open_])
    step = _starts(np.zeros(len(open_), np.int64), windows[open_])
    yield _gone(record, owner, step, lowest[from_[slot[which[owner]]] + step] < record["doc"][owner], span)


def _many(record: np.ndarray, data: np.ndarray, begin: np.ndarray, length: np.ndarray, span: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """The same for one minimizer with more stretches than are sorted at a time."""
    doc, windows = record["doc"], record["windows"].astype(np.int64)
    number = np.int32 if len(data) < 1 << 31 else np.int64
    cut = _parts(length)
    held, starts, owners, total = [], [], [], 0
    for s, t in cut:
        chosen, which = _distinct(record[s:t], data, begin[s:t], length[s:t], span)
        by_doc = np.argsort(doc[s:t], kind="stable")
        first = by_doc[np.unique(which[by_doc], return_index=True)[1]]  # of equal stretches the one of the smallest document
        size, many = length[s:t][first], windows[s:t][first]
        kinds = window_kinds(_gathered(data, begin[s:t][first], size), _starts(np.cumsum(size) - size, many), span)
        owner = np.repeat(s + first, many)
        order = np.lexsort((doc[owner], kinds))
        one = order[np.unique(kinds[order], return_index=True)[1]]  # of equal windows the one of the smallest document
        starts.append(_starts(begin[s:t][first], many)[one].astype(number))
        owners.append(owner[one].astype(number))
        held.append((which.astype(np.int32), (np.cumsum(many) - many).astype(np.int32), (kinds + total).astype(number)))
        total += len(one)
    start, owner = np.concatenate(starts), np.concatenate(owners)
    starts.clear(), owners.clear()
    view = np.lib.stride_tricks.sliding_window_view(data, span)
    cells = -(-total // MEET)
    cell = np.empty(total, np.int32)
    for at in range(0, total, MEET):
        cell[at : at + MEET] = _row_hashes(view[start[at : at + MEET]]) % np.uint64(cells)
    for c in range(cells):
        at = np.flatnonzero(cell == c)
        at = at[np.argsort(doc[owner[at]], kind="stable")]
        _, first, same = np.unique(view[start[at]].view(f"V{span}").ravel(), return_index=True, return_inverse=True)
        owner[at] = owner[at][first][same.ravel()]
    for (s, t), (which, from_, kinds) in zip(cut, held, strict=True):
        of = np.repeat(np.arange(t - s), windows[s:t])
        step = _starts(np.zeros(t - s, np.int64), windows[s:t])
        yield _gone(record[s:t], of, step, doc[owner[kinds[from_[which[of]] + step]]] < doc[s:t][of], span)


def _row_hashes(rows: np.ndarray) -> np.ndarray:
    """A hash of each row of bytes."""
    wide = np.zeros((len(rows), -(-rows.shape[1] // 8) * 8), np.uint8)
    wide[:, : rows.shape[1]] = rows
    out = np.zeros(len(rows), np.uint64)
    for column in wide.view(np.uint64).T:
        out = W.mix(out ^ column) + np.uint64(1)
    return out


def _parts(weight: np.ndarray) -> list[tuple[int, int]]:
    """Runs of places whose weights add up to at most `PART`, or that are one place."""
    ends, out, at = np.cumsum(weight), [], 0
    while at < len(weight):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + PART, "right")))
        out.append((at, upto))
        at = upto
    return out


def _ranges(table: pa.Table, span: int, count: int) -> pa.Table:
    """Byte ranges to remove from a bucket's stretches, packed by document."""
    codec = pa.Codec("zstd")
    parts = [P.expand(d, n, _STRETCH) for d, n in zip(table["packed"].to_pylist(), table["n"].to_pylist(), strict=True)]
    record = np.concatenate(parts)
    sizes = [int((p["windows"].astype(np.int64) + span - 1).sum()) for p in parts]
    data = np.empty(sum(sizes), np.uint8)
    at = 0
    for x, n in zip(table["strings"], sizes, strict=True):
        data[at : at + n] = np.frombuffer(codec.decompress(x.as_buffer(), n), np.uint8)
        at += n
    length = record["windows"].astype(np.int64) + span - 1
    begin = np.cumsum(length) - length
    order = np.argsort(record["key"], kind="stable")
    record, begin, length = record[order], begin[order], length[order]
    first, n = P.runs(record["key"])
    packer, found = P.Packer(_RANGE, count), []
    weight = np.add.reduceat(length, first) if len(first) else first
    for s, t in _parts(weight):
        a, b = int(first[s]), int(first[t - 1] + n[t - 1])
        settle = _many if weight[s:t].sum() > PART else _some
        for fields in settle(record[a:b], data, begin[a:b], length[a:b], span):
            found += packer.add(*fields)
    found += packer.flush()
    return pa.Table.from_batches(found) if found else _empty(P.SHAPE)


def _cut(texts_table: pa.Table, ranges_table: pa.Table, marks_table: pa.Table, span: int) -> pa.Table:
    doc, texts, stands = _unpack_texts(texts_table)
    ranges = P.unpack(ranges_table, _RANGE)
    ranges = ranges[np.argsort(ranges["doc"], kind="stable")]
    marks = P.unpack(marks_table, _SHARED)
    copies = np.isin(doc, marks["doc"])
    n = np.diff(texts.offsets)
    first, last = np.searchsorted(ranges["doc"], doc, "left"), np.searchsorted(ranges["doc"], doc, "right")
    removed, spans, digest = np.zeros(len(doc), np.int64), np.zeros(len(doc), np.int64), []
    for i in range(len(doc)):
        own = texts.data[texts.offsets[i] : texts.offsets[i + 1]]
        if stands[i] and copies[i] and n[i] >= span:
            removed[i], spans[i], own = n[i], 1, own[:0]
        elif stands[i] and last[i] > first[i]:
            rows = ranges[first[i] : last[i]]
            marked = np.cumsum(np.bincount(rows["begin"], minlength=n[i] + 1) - np.bincount(rows["end"], minlength=n[i] + 1))[:-1] > 0
            removed[i] = np.count_nonzero(marked)
            spans[i] = np.count_nonzero(marked[1:] & ~marked[:-1]) + int(marked[0])
            own = own[~marked]
        digest.append(hashlib.sha256(own.tobytes()).hexdigest())
    return pa.table({"doc_id": doc, "n_bytes": n, "n_removed": removed, "n_spans": spans, "kept_sha256": pa.array(digest, pa.string())})


def dedup(documents: DataFrame, span: int = 50) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) for each row."""
    spark = documents.sparkSession
    ship_package(spark)
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    count = P.buckets(spark, docs)
    known = docs.where("doc_id IS NOT NULL")
    own = known.select("doc_id", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("sha")).groupBy("doc_id").agg(F.min("sha").alias("sha"))
    own = store(own, "digests")
    copies = own.join(own.groupBy("sha").agg(F.min("doc_id").alias("first")), "sha").where("doc_id > first").select("doc_id")
    marks = store(copies.mapInArrow(lambda it: _marks(it, count), P.SHAPE), "copies")
    seen = known.where("text IS NOT NULL").mapInArrow(lambda it: _seen(it, span, count), P.SHAPE)
    shared = P.per_bucket(seen, lambda t: _shared(t, count), P.SHAPE).union(marks)
    texts = known.mapInArrow(lambda it: _texts(it, count), _TEXTS)
    pieces = texts.groupBy("bucket").cogroup(shared.groupBy("bucket")).applyInArrow(lambda a, b: _stretches(a, b, span, count), _STRINGS)
    ranges = P.per_bucket(pieces, lambda t: _ranges(t, span, count), P.SHAPE)
    # ranges and marks of a bucket in one table, told apart by a column
    notes = store(ranges.withColumn("mark", F.lit(False)), "ranges").union(marks.withColumn("mark", F.lit(True)))

    def cut(a: pa.Table, b: pa.Table) -> pa.Table:
        return _cut(a, b.filter(pc.invert(b["mark"])), b.filter(b["mark"]), span)

    shape = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    done = texts.groupBy("bucket").cogroup(notes.groupBy("bucket")).applyInArrow(cut, shape)
    untouched = docs.where("doc_id IS NULL").select(
        "doc_id", F.coalesce(F.octet_length("text"), F.lit(0)).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"),
        F.lit(0).cast("long").alias("n_spans"), F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))
    return done.union(untouched)
