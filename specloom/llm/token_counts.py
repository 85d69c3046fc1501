"""Token counts of a SentencePiece model without encoding any document.

A text (with a blank put before it) is cut wherever its two neighbouring characters stand
side by side in no piece of the vocabulary: merges never cross such a place, so the parts,
its pre-tokens, are encoded alike in every text. All distinct pre-tokens of the corpus are
encoded once, by the library itself behind a guard character that joins with nothing, and
only their number of pieces is kept. Documents hold pre-token frequencies; joined with the
numbers and added up (`keyed_sums`) these give each document's count.

Cuts and hashes are vectorised over the bytes of a slice of texts. Pre-tokens stand as 64-bit
hashes; two different ones of N get one hash with chance N*N/2**65.

Defined results: a null or empty text has no bytes and no tokens; every input row gives one
row, repeated ids and texts too; a text of any length is counted whole; other columns are left
out; an empty table gives no rows. A literal "▁" counts as the blank it stands for, as in the
library. Models need a character that occurs in no piece next to another one (line feed or
another ASCII character); those with a normaliser other than identity are refused.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StructType

from specloom.session import ship_package, store

from . import words as W
from .keyed_sums import add_up
from .pieces import BLANK, PIECES

#: Distinct pre-tokens that a task holds before it sends them on.
BLOCK = 400_000


@dataclass
class Model:
    """A model file with the byte pairs that occur inside pieces and the guard character."""

    content: bytes
    inside: np.ndarray
    guard: str

    def open(self):
        import sentencepiece

        return sentencepiece.SentencePieceProcessor(model_proto=self.content)


def load(path: str = PIECES) -> Model:
    """Read a model and find where texts may be cut."""
    import sentencepiece

    with open(path, "rb") as file:
        content = file.read()
    model = sentencepiece.SentencePieceProcessor(model_proto=content)
    inside = np.zeros((256, 256), bool)
    for i in range(model.get_piece_size()):
        if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i)):
            piece = np.frombuffer(model.id_to_piece(i).replace(BLANK, " ").encode(), np.uint8)
            inside[piece[:-1], piece[1:]] = True
    probe = "ﬁ  Ⅳ a\n\tb"  # a ligature, a compatibility form, repeated blanks
    if model.normalize(probe) != (" " + probe).replace(" ", BLANK):
        raise ValueError("the model normalises texts or puts no blank before them; cuts by bytes would be wrong")
    lonely = [c for c in (0x0A, *range(0x80)) if not (inside[c].any() or inside[:, c].any())]
    if not lonely:
        raise ValueError("every ASCII character joins with another one; no guard is left")
    return Model(content, inside, chr(lonely[0]))


def with_blank(texts: W.Bytes) -> W.Bytes:
    """Texts with one blank before each that is not empty."""
    size = np.diff(texts.offsets)
    lead = np.cumsum(size > 0)
    data = np.full(len(texts.data) + (int(lead[-1]) if len(lead) else 0), 0x20, np.uint8)
    data[np.arange(len(texts.data)) + np.repeat(lead, size)] = texts.data
    return W.Bytes(data, texts.offsets + np.r_[0, lead])


def pre_tokens(texts: W.Bytes, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Beginnings and ends of the parts between places that no piece crosses, and each part's text."""
    n = len(texts.data)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    begins = np.ones(n, bool)
    begins[1:] = ~inside[texts.data[:-1], texts.data[1:]] & ((texts.data[1:] & 0xC0) != 0x80)
    begins[texts.offsets[:-1][np.diff(texts.offsets) > 0]] = True
    start = np.flatnonzero(begins)
    return start, np.r_[start[1:], n], np.searchsorted(texts.offsets, start, "right") - 1


def _cut(batch: pa.RecordBatch, inside: np.ndarray) -> Iterator[tuple[pa.RecordBatch, W.Bytes, np.ndarray, np.ndarray, np.ndarray]]:
    for rows, _ in W.slices(batch, "text"):
        texts = with_blank(W.as_bytes(pc.replace_substring(rows.column("text"), BLANK, " ")))
        yield rows, texts, *pre_tokens(texts, inside)


def ragged_bytes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> pa.Array:
    """The byte runs start:end as binary values."""
    size = end - start
    begin = np.r_[0, np.cumsum(size)]
    held = data[np.repeat(start - begin[:-1], size) + np.arange(begin[-1])]
    return pa.Array.from_buffers(pa.large_binary(), len(start), [None, pa.py_buffer(begin.astype(np.int64).tobytes()), pa.py_buffer(held.tobytes())]).cast(pa.binary())


def _distinct(batches: Iterator[pa.RecordBatch], inside: np.ndarray) -> Iterator[pa.RecordBatch]:
    """(key, n, piece) of a task's pre-tokens; a piece is sent once a block, its counts are added up."""
    keys, times, seen = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.uint64)
    for batch in batches:
        for _, texts, start, end, _ in _cut(batch, inside):
            key, first, n = np.unique(texts.hashes(start, end), return_index=True, return_counts=True)
            new = ~np.isin(key, seen)
            if new.any():
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(key[new])), pa.array(n[new]), ragged_bytes(texts.data, start[first[new]], end[first[new]])], ["key", "n", "piece"])
                seen = np.union1d(seen, key[new])
            keys, at = np.unique(np.r_[keys, key[~new]], return_inverse=True)
            times = np.bincount(at, np.r_[times, n[~new]], len(keys)).astype(np.int64)
            if len(seen) > BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys)), pa.array(times), pa.nulls(len(keys), pa.binary())], ["key", "n", "piece"])
                keys, times, seen = keys[:0], times[:0], seen[:0]
    yield pa.RecordBatch.from_arrays([pa.array(W.signed(keys)), pa.array(times), pa.nulls(len(keys), pa.binary())], ["key", "n", "piece"])


def _encode(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """(key, n, pieces): the number of pieces of each distinct pre-token."""
    model = held.value
    library = model.open()
    guard = len(library.encode(model.guard))
    for batch in batches:
        pieces = np.zeros(batch.num_rows, np.int64)
        for at in range(0, batch.num_rows, 2000):
            parts = [model.guard + p.decode("utf-8", "replace") for p in batch.column("piece").slice(at, 2000).to_pylist()]
            pieces[at : at + len(parts)] = [len(ids) - guard for ids in library.encode(parts, num_threads=1)]
        yield pa.RecordBatch.from_arrays([batch.column("key"), batch.column("n"), pa.array(pieces)], ["key", "n", "pieces"])


def vocabulary(documents: DataFrame, path: str = PIECES) -> DataFrame:
    """(key, n, pieces) of every distinct pre-token: its occurrences in the corpus and its tokens."""
    spark = documents.sparkSession
    ship_package(spark)
    model = load(path)
    held = spark.sparkContext.broadcast(model)  # of the model's size
    inside = model.inside
    found = documents.where("text IS NOT NULL").select("text").mapInArrow(lambda it: _distinct(it, inside), "key long, n long, piece binary")
    once = found.groupBy("key").agg(F.sum("n").alias("n"), F.first("piece", ignorenulls=True).alias("piece"))
    return once.mapInArrow(lambda it: _encode(it, held), "key long, n long, pieces long")


def token_counts(documents: DataFrame, path: str = PIECES) -> DataFrame:
    """(doc_id, n_bytes, n_tokens) for each row."""
    docs = documents.select("doc_id", "text")
    counted = store(vocabulary(docs, path), "pre-tokens")
    inside = load(path).inside
    keep = StructType([docs.schema["doc_id"]]).add("n_bytes", LongType())

    def held(batch: pa.RecordBatch):
        for rows, texts, start, end, text in _cut(batch, inside):
            size = pc.fill_null(pc.binary_length(rows.column("text")), 0).cast(pa.int64())
            kept = pa.RecordBatch.from_arrays([rows.column("doc_id"), size], ["doc_id", "n_bytes"])
            key = texts.hashes(start, end)
            order = np.lexsort((key, text))
            key, text = key[order], text[order]
            new = np.ones(len(key), bool)
            new[1:] = (key[1:] != key[:-1]) | (text[1:] != text[:-1])
            first = np.flatnonzero(new)
            yield kept, text[first], key[first], np.diff(np.r_[first, len(key)])

    return add_up(docs, held, keep, counted, ["pieces"]).withColumnRenamed("pieces", "n_tokens")
