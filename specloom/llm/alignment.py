"""Alignment of two tokenizers' tokens over the same bytes, by diagonal run skipping.

Each document is encoded by a byte-level BPE (A, with a blank before the text) and by a
SentencePiece model (B, which puts that blank itself). A token is its byte range; offsets
where tokens of both end cut the tokens into groups. The two arrays of ends are compared at
the current shift between their indices, in probes that double as long as all ends agree, so
a one-to-one stretch is jumped in few steps. The first disagreement is resolved locally: the
array that is behind steps on until both end together, which closes an irregular group and
gives the next shift. All stretches of a slice of documents do this in step as numpy arrays:
besides each document's beginning, sampled ends of A that a binary search finds in B begin a
stretch, so a long document is many of them.

Where a blank follows a character that is no white space, both tokenizers cut (A by its
pattern, B since no piece holds a blank after something else; both are looked up, and texts
stay whole where one does not hold). The units between such places are encoded once, by the
libraries, and a Python worker remembers `REMEMBERED` of them; ids of a text are put together
from its units.

Links are the pairs of tokens that end together. How often an (a, b) pair of ids is linked
in the corpus is counted from distinct pairs per block; documents get the counts of their
pairs by `keyed_sums`.

Defined results: texts that are null, empty, or whose joined token bytes differ from blank
and text (a literal "▁", bytes that the model changes) have no tokens, zeros and empty lists.
Every input row gives one row, repeated ids and texts too, and its links count each time;
texts of any length are aligned whole; other columns are left out; an empty table gives no
rows.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
import json
import os
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, LongType, StringType, StructType

from specloom.session import ship_package, store

from . import words as W
from .keyed_sums import add_up
from .pieces import BLANK, PIECES
from .token_counts import ragged_bytes, with_blank

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
#: Every so many ends of A one is sought in B, to begin a stretch there.
STRIDE = 64
#: Text bytes that are encoded at a time.
SLICE = 1 << 18
#: Units that a Python worker remembers before it starts its table anew.
REMEMBERED = 400_000
#: Bytes that may end a white space character, in ASCII or beyond.
_SPACE_ENDS = np.zeros(256, bool)
_SPACE_ENDS[[*range(0x09, 0x0E), *range(0x1C, 0x21), *range(0x80, 0x8B), 0x9F, 0xA0, 0xA8, 0xA9, 0xAF]] = True


_NOT_BLANK = bytes(b if b == 0x20 else 0 for b in range(256))


def byte_alphabet() -> dict[str, int]:
    """The character of each byte in byte-level vocabularies: printable ones stand for themselves, others follow from 256."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + k): b for k, b in enumerate(hidden)}


class Side:
    """A tokenizer's ids of texts, and the bytes of each id."""

    def __init__(self, bytes_of: list[bytes]):
        self.sizes = np.array([len(b) for b in bytes_of], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(bytes_of), np.uint8)

    def bytes_for(self, ids: np.ndarray, size: np.ndarray) -> np.ndarray:
        begin = np.r_[0, np.cumsum(size)]
        return self.joined[np.repeat(self.starts[ids] - begin[:-1], size) + np.arange(begin[-1])]


class ByteLevel(Side):
    """A tokenizers file with byte-level pieces."""

    def __init__(self, content: str):
        import tokenizers

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks share the cores
        self.library = tokenizers.Tokenizer.from_str(content)
        self.library.encode_special_tokens = True
        alphabet = byte_alphabet()
        held = [b""] * self.library.get_vocab_size()
        for piece, i in self.library.get_vocab().items():
            held[i] = bytes(alphabet[c] for c in piece) if all(c in alphabet for c in piece) else piece.encode()
        super().__init__(held)
        made = json.loads(content)
        first = made.get("pre_tokenizer") or {}
        self.cuts_at_blanks = first.get("type") == "ByteLevel" and first.get("use_regex", True) and not first.get("add_prefix_space") and not made.get("normalizer")

    def encode(self, blanked: list[str]) -> list[list[int]]:
        """Ids of texts that already have their blank."""
        return [e.ids for e in self.library.encode_batch_fast(blanked, add_special_tokens=False)]


class Pieces(Side):
    """A SentencePiece file that puts a blank before each text."""

    def __init__(self, content: bytes):
        import sentencepiece

        self.library = sentencepiece.SentencePieceProcessor(model_proto=content)
        held = []
        for i in range(self.library.get_piece_size()):
            piece = self.library.id_to_piece(i)
            held.append(bytes([int(piece[3:5], 16)]) if self.library.is_byte(i) else piece.replace(BLANK, " ").encode())
        super().__init__(held)
        self.cuts_at_blanks = not any(b"\x00 " in b.translate(_NOT_BLANK) for b in held)

    def encode(self, blanked: list[str]) -> list[list[int]]:
        """Ids of texts that already have their blank, which the library puts itself."""
        return self.library.encode([t[1:] for t in blanked], num_threads=1)


class Memory:
    """Ids of texts on both sides, put together from remembered units."""

    def __init__(self, a: ByteLevel, b: Pieces):
        self.sides = (a, b)
        self.cuts = a.cuts_at_blanks and b.cuts_at_blanks
        self.forget()

    def forget(self) -> None:
        self.key, self.place = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        self.flat = [np.zeros(0, np.int64), np.zeros(0, np.int64)]
        self.begin = [np.zeros(1, np.int64), np.zeros(1, np.int64)]

    def units(self, texts: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Beginnings and ends of units, and where each text's begin; a blank that ends a text is no unit."""
        data, n = texts.data, len(texts.data)
        begins = np.zeros(n + 1, bool)
        if self.cuts and n:
            begins[1:-1] = (data[1:] == 0x20) & ~_SPACE_ENDS[data[:-1]]
            begins[texts.offsets[1:][np.diff(texts.offsets) > 0] - 1] = False
        begins[texts.offsets] = True
        start = np.flatnonzero(begins[:n])
        return start, np.r_[start[1:], n][: len(start)], np.searchsorted(start, texts.offsets)

    def _find(self, key: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.key, key)
        at[at == len(self.key)] = 0
        return np.where(self.key[at] == key, self.place[at], -1) if len(self.key) else np.full(len(key), -1)

    def ids(self, texts: W.Bytes) -> list[tuple[np.ndarray, np.ndarray]]:
        """For each side the ids of all texts joined, and where each text's begin."""
        start, end, first = self.units(texts)
        key, one, at = np.unique(texts.hashes(start, end), return_index=True, return_inverse=True)
        if len(self.key) > REMEMBERED:
            self.forget()
        fresh = np.flatnonzero(self._find(key) < 0)
        if len(fresh):
            parts = [p.decode("utf-8", "replace") for p in ragged_bytes(texts.data, start[one[fresh]], end[one[fresh]]).to_pylist()]
            known = len(self.begin[0]) - 1
            for k, side in enumerate(self.sides):
                flat, begin = _flat(side.encode(parts))
                self.begin[k] = np.r_[self.begin[k], begin[1:] + self.begin[k][-1]]
                self.flat[k] = np.r_[self.flat[k], flat]
            keys, places = np.r_[self.key, key[fresh]], np.r_[self.place, known + np.arange(len(fresh))]
            order = np.argsort(keys)
            self.key, self.place = keys[order], places[order]
        unit = self._find(key)[at]
        out = []
        for flat, begin in zip(self.flat, self.begin, strict=True):
            size = begin[unit + 1] - begin[unit]
            where, _, _ = _steps(begin[unit], size)
            out.append((flat[where], np.r_[0, np.cumsum(size)][first]))
        return out


@functools.lru_cache(maxsize=1)
def _memory(a: str, b: bytes) -> Memory:
    return Memory(ByteLevel(a), Pieces(b))


def _steps(start: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """start, start + 1, ... of each stretch joined; whose they are; where each stretch's begin."""
    begin = np.cumsum(n) - n
    who = np.repeat(np.arange(len(n)), n)
    return start[who] + np.arange(len(who)) - begin[who], who, begin


def common_ends(a: np.ndarray, b: np.ndarray, first_a: np.ndarray, first_b: np.ndarray, stride: int = STRIDE) -> tuple[np.ndarray, np.ndarray]:
    """Which ends of A and which of B lie at the same offset.

    `a` and `b` rise strictly and end alike; `first_a`, `first_b` are the indices where
    documents begin, whose last ends agree.
    """
    in_a, in_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
    if not len(a):
        return in_a, in_b
    sampled = np.arange(stride - 1, len(a) - 1, stride)
    place = np.searchsorted(b, a[sampled])
    same = b[place] == a[sampled]
    i, at = np.unique(np.r_[first_a, sampled[same] + 1], return_index=True)
    j = np.r_[first_b, place[same] + 1][at]
    stop = np.r_[i[1:], len(a)]
    wide = np.ones(len(i), np.int64)
    padded = np.r_[b, np.full(2 * stride, -1, b.dtype)]
    while len(i):
        n = np.minimum(np.minimum(wide, stop - i), stride)
        at, who, begin = _steps(i, n)
        shift = j - i
        equal = a[at] == padded[at + shift[who]]
        offset = at - i[who]
        run = np.minimum.reduceat(np.where(equal, stride, offset), begin)
        run = np.minimum(run, n)
        jumped = at[offset < run[who]]
        in_a[jumped] = True
        in_b[(at + shift[who])[offset < run[who]]] = True
        i, j = i + run, j + run
        wide = np.where(run == n, wide * 2, 1)
        odd = np.flatnonzero(run < n)
        p, q = i[odd], j[odd]
        rest = np.arange(len(odd))
        while len(rest):
            x, y = a[p[rest]], b[q[rest]]
            p[rest] += x < y
            q[rest] += y < x
            rest = rest[x != y]
        in_a[p], in_b[q] = True, True
        i[odd], j[odd] = p + 1, q + 1
        live = i < stop
        i, j, stop, wide = i[live], j[live], stop[live], wide[live]
    return in_a, in_b


def _flat(ids: list[list[int]]) -> tuple[np.ndarray, np.ndarray]:
    first = np.r_[0, np.cumsum([len(x) for x in ids])].astype(np.int64)
    return np.fromiter(itertools.chain.from_iterable(ids), np.int64, int(first[-1])), first


def _without(ids: np.ndarray, first: np.ndarray, keep: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    n = np.diff(first)
    return ids[np.repeat(keep, n)], np.r_[0, np.cumsum(np.where(keep, n, 0))]


def _same(side: Side, ids: np.ndarray, first: np.ndarray, texts: W.Bytes) -> np.ndarray:
    """Which texts the joined bytes of their tokens give back."""
    size = side.sizes[ids]
    data = side.bytes_for(ids, size)
    begin = np.r_[0, np.cumsum(size)][first]
    same = np.diff(begin) == np.diff(texts.offsets)
    if same.all():
        differ = np.r_[0, np.cumsum(data != texts.data)]
        return differ[begin[1:]] == differ[begin[:-1]]
    for k in np.flatnonzero(same).tolist():
        same[k] = np.array_equal(data[begin[k] : begin[k + 1]], texts.data[texts.offsets[k] : texts.offsets[k + 1]])
    return same


class Aligned:
    """The tokens of a slice of texts, and where both sides end together."""

    def __init__(self, column: pa.Array, memory: Memory):
        a_side, b_side = memory.sides
        blanked = with_blank(W.as_bytes(column))
        (a, fa), (b, fb) = memory.ids(blanked)
        good = _same(a_side, a, fa, blanked) & _same(b_side, b, fb, blanked)
        (self.a, self.first_a), (self.b, self.first_b) = _without(a, fa, good), _without(b, fb, good)
        n = np.diff(self.first_a)
        begins = n > 0
        self.in_a, self.in_b = common_ends(
            np.cumsum(a_side.sizes[self.a]), np.cumsum(b_side.sizes[self.b]), self.first_a[:-1][begins], self.first_b[:-1][begins])
        self.group_a = np.cumsum(self.in_a) - self.in_a
        self.group_b = np.cumsum(self.in_b) - self.in_b
        self.text = np.repeat(np.arange(len(n)), n)[self.in_a]  # of each group
        self.n_groups = np.bincount(self.text, minlength=len(n))

    def lists(self) -> list[pa.Array]:
        """Ids of both sides, and the sizes of the groups on both sides."""
        begin = np.r_[0, np.cumsum(self.n_groups)]
        count = len(self.text)
        return [W.ragged(self.a, self.first_a, pa.int32()), W.ragged(self.b, self.first_b, pa.int32()),
                W.ragged(np.bincount(self.group_a, minlength=count), begin, pa.int32()), W.ragged(np.bincount(self.group_b, minlength=count), begin, pa.int32())]

    def digests(self, shown: list[str], offset: int) -> list[str]:
        """SHA-256 of the groups written out; `shown` has for each id of A, then of B, its text before "," "|" ";" and an end."""
        before_b = np.searchsorted(self.group_b, self.group_a, "left")  # tokens of B in earlier groups
        before_a = np.searchsorted(self.group_a, self.group_b, "right")  # tokens of A up to and in this group
        code = np.empty(len(self.a) + len(self.b), np.int64)
        code[np.arange(len(self.a)) + before_b] = self.a * 4 + self.in_a
        last = np.zeros(len(self.b), bool)
        last[self.first_b[1:][np.diff(self.first_b) > 0] - 1] = True
        code[np.arange(len(self.b)) + before_a] = (self.b + offset) * 4 + np.where(last, 3, np.where(self.in_b, 2, 0))
        text = list(map(shown.__getitem__, code.tolist()))
        ends = (self.first_a + self.first_b).tolist()
        return [hashlib.sha256("".join(text[s:e]).encode()).hexdigest() if e > s else "" for s, e in zip(ends[:-1], ends[1:], strict=True)]

    def pairs(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Each text's distinct linked (a, b) as a * width + b, how often, and where each text's begin."""
        code = self.a[self.in_a] * width + self.b[self.in_b]
        order = np.lexsort((code, self.text))
        code, text = code[order], self.text[order]
        new = np.ones(len(code), bool)
        new[1:] = (code[1:] != code[:-1]) | (text[1:] != text[:-1])
        first = np.flatnonzero(new)
        return code[first], np.diff(np.r_[first, len(code)]), np.searchsorted(text[first], np.arange(len(self.n_groups) + 1))


def _tokenizers(spark, path_a: str, path_b: str):
    """The contents of both files as a broadcast; their size is the vocabularies'."""
    ship_package(spark)
    with open(path_a, encoding="utf-8") as file:
        a = file.read()
    with open(path_b, "rb") as file:
        b = file.read()
    return spark.sparkContext.broadcast((a, b)), len(Pieces(b).sizes)


def align(documents: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECES) -> DataFrame:
    """(doc_id, a_ids, b_ids, a_sizes, b_sizes): tokens, and how many of each side every group has."""
    held, _ = _tokenizers(documents.sparkSession, path_a, path_b)
    docs = documents.select("doc_id", "text")
    names = ["a_ids", "b_ids", "a_sizes", "b_sizes"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(*held.value)
        for batch in batches:
            for rows, _ in W.slices(batch, "text", SLICE):
                yield pa.RecordBatch.from_arrays([rows.column("doc_id"), *Aligned(rows.column("text"), memory).lists()], ["doc_id", *names])

    shape = StructType([docs.schema["doc_id"]])
    for name in names:
        shape = shape.add(name, ArrayType(IntegerType()))
    return docs.mapInArrow(run, shape)


def _links(documents: DataFrame, path_a: str, path_b: str) -> tuple[DataFrame, int]:
    """Numbers, digest and distinct linked pairs of each document; the width of pair codes."""
    held, width = _tokenizers(documents.sparkSession, path_a, path_b)
    docs = documents.select("doc_id", "text")
    names = ["n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "times"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = _memory(*held.value)
        sizes = [len(s.sizes) for s in memory.sides]
        shown = [f"{i}{end}" for n in sizes for i in range(n) for end in (",", "|", ";", "")]
        for batch in batches:
            for rows, _ in W.slices(batch, "text", SLICE):
                found = Aligned(rows.column("text"), memory)
                code, times, begin = found.pairs(width)
                counts = [np.diff(found.first_a), np.diff(found.first_b), found.n_groups, found.n_groups]
                yield pa.RecordBatch.from_arrays(
                    [rows.column("doc_id"), *(pa.array(c.astype(np.int64)) for c in counts), pa.array(found.digests(shown, sizes[0]), pa.string()),
                     W.ragged(code, begin, pa.int64()), W.ragged(times, begin, pa.int32())], ["doc_id", *names])

    shape = StructType([docs.schema["doc_id"]])
    for name in names[:4]:
        shape = shape.add(name, LongType())
    shape = shape.add("groups_sha256", StringType()).add("pairs", ArrayType(LongType())).add("times", ArrayType(IntegerType()))
    return store(docs.mapInArrow(run, shape), "aligned"), width


def _block_counts(batches: Iterator[pa.RecordBatch], block: int = 2_000_000) -> Iterator[pa.RecordBatch]:
    """(key, n) of the pairs of a task, merged in blocks."""
    key, n = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        pairs, times = (batch.column(c).flatten().to_numpy() for c in ("pairs", "times"))
        key, at = np.unique(np.r_[key, pairs], return_inverse=True)
        n = np.bincount(at, np.r_[n, times], len(key)).astype(np.int64)
        if len(key) > block:
            yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])
            key, n = key[:0], n[:0]
    yield pa.RecordBatch.from_arrays([pa.array(key), pa.array(n)], ["key", "n"])


def _counted(links: DataFrame, width: int) -> DataFrame:
    """(key, n, count, best) of each linked pair; best: 1 where no other pair of its B id is more frequent."""
    counts = links.select("pairs", "times").mapInArrow(_block_counts, "key long, n long").groupBy("key").agg(F.sum("n").alias("n"))
    counts = store(counts, "pairs")
    most = counts.groupBy(F.pmod("key", F.lit(width)).alias("b")).agg(F.max("n").alias("most"))  # one row a piece
    return store(counts.withColumn("b", F.pmod("key", F.lit(width))).join(most, "b").select(
        "key", "n", F.col("n").alias("count"), (F.col("n") == F.col("most")).cast("long").alias("best")), "counted-pairs")


def pair_counts(documents: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECES) -> DataFrame:
    """(a_id, b_id, n, best) of every pair of ids that is linked anywhere."""
    links, width = _links(documents, path_a, path_b)
    return _counted(links, width).select(
        F.floor(F.col("key") / width).cast("int").alias("a_id"), F.pmod("key", F.lit(width)).cast("int").alias("b_id"), "n", (F.col("best") == 1).alias("best"))


def alignment_summary(documents: DataFrame, path_a: str = BYTE_BPE, path_b: str = PIECES) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256) for each row."""
    links, width = _links(documents, path_a, path_b)
    keep = StructType([links.schema[c] for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256")])

    def held(batch: pa.RecordBatch):
        pairs, times = batch.column("pairs"), batch.column("times")
        size = pairs.value_lengths().to_numpy()
        yield batch, np.repeat(np.arange(batch.num_rows), size), pairs.flatten().to_numpy().view(np.uint64), times.flatten().to_numpy().astype(np.int64)

    added = add_up(links, held, keep, _counted(links, width), ["count", "best"])
    return added.select("doc_id", "n_a", "n_b", "n_groups", "n_links", F.col("best").alias("n_best"), F.col("count").alias("count_sum"), "groups_sha256")
