"""SentencePiece encoding and decoding by a streaming Viterbi search.

A text, with blanks written as "▁" and one put before it, is cut into vocabulary pieces so
that the sum of their scores is highest; equal sums take the longer last piece. The search
keeps scores for a window as long as the longest piece and commits ids as soon as the
paths of all ends in the window meet at one boundary. A boundary whose two characters stand
side by side in no piece is such a meeting point in advance: units between them are encoded
once and remembered in a bounded table. Characters that no piece covers become the ids of
their UTF-8 bytes, so decoding gives every text back, a literal "▁" included.

The vocabulary is read on the driver (`path`) and broadcast: its size is the model's. No
shuffle; each document is encoded where it is read.

Defined results: a null text has null ids and decodes to null, an empty text has no ids;
repeated rows get equal ids; other columns pass through, those named like a result are
replaced; an empty table gives no rows.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from specloom.session import ship_package

from . import words as W

PIECES = "/opt/tokenizers/piece_bpe_32k.model"
BLANK = "▁"
#: Units a Python worker remembers before it starts its table anew.
REMEMBERED = 200_000


class Vocabulary:
    """Pieces with ids and scores, ids of bytes, and which character pairs occur inside pieces."""

    def __init__(self, pieces: list[tuple[str, int, float]], byte_ids: list[int]):
        self.pieces = {p: (i, s) for p, i, s in pieces}
        self.byte_ids = byte_ids
        self.longest = max(map(len, self.pieces), default=1)
        self.tails = {p[k:] for p in self.pieces for k in range(len(p))}
        self.unknown = min((s for _, _, s in pieces), default=0.0) - 10.0
        inner = {p[k : k + 2] for p in self.pieces for k in range(len(p) - 1)}
        words = not any(b[0] != BLANK and (b[1] == BLANK or b[0].isalpha() != b[1].isalpha()) for b in inner)
        blanks = not any(b[1] == BLANK and b[0] != BLANK for b in inner)
        # units end at boundaries that no piece crosses
        self.units = re.compile(rf"{BLANK}*[^\W\d_]+|{BLANK}*(?:(?![^\W\d_])[^{BLANK}])+|{BLANK}+" if words else rf"{BLANK}*[^{BLANK}]+|{BLANK}+" if blanks else r"(?s).+", re.DOTALL)
        width = max([*byte_ids, *(i for _, i, _ in pieces)]) + 1
        self.bytes_of = [b""] * width
        for p, i, _ in pieces:
            self.bytes_of[i] = p.replace(BLANK, " ").encode()
        for b, i in enumerate(byte_ids):
            self.bytes_of[i] = bytes([b])
        self.sizes = np.array([len(b) for b in self.bytes_of])
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.joined = np.frombuffer(b"".join(self.bytes_of), np.uint8)

    def bytes_for(self, ids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The bytes of all ids joined, and where each id's begin."""
        size = self.sizes[ids]
        begin = np.r_[0, np.cumsum(size)]
        return self.joined[np.repeat(self.starts[ids] - begin[:-1], size) + np.arange(begin[-1])], begin


def load(path: str = PIECES) -> Vocabulary:
    """Read a model's normal pieces and its byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    normal, byte_ids = [], [0] * 256
    for i in range(model.get_piece_size()):
        if model.is_byte(i):
            byte_ids[int(model.id_to_piece(i)[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            normal.append((model.id_to_piece(i), i, model.get_score(i)))
    return Vocabulary(normal, byte_ids)


class StreamingViterbi:
    """Feed characters one by one; `ids` grows whenever all surviving paths share a boundary."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.ids: list[int] = []
        self.window = ""  # the characters since the last commit, and for each end its best score, length and piece
        self.score, self.length, self.piece = [0.0], [0], [-1]

    def feed(self, char: str) -> None:
        v, window = self.v, self.window + char
        self.window = window
        end = len(window)
        best, length, piece = -np.inf, 1, -1
        for k in range(1, min(end, v.longest) + 1):
            part = window[end - k :]
            if part not in v.tails:
                break
            hit = v.pieces.get(part)
            if hit is not None and self.score[end - k] + hit[1] >= best:
                best, length, piece = self.score[end - k] + hit[1], k, hit[0]
        if char not in v.pieces and self.score[end - 1] + v.unknown > best:
            best, length, piece = self.score[end - 1] + v.unknown, 1, -1
        self.score.append(best)
        self.length.append(length)
        self.piece.append(piece)
        if end % (4 * v.longest) == 0:
            self._commit(self._meeting())

    def _meeting(self) -> int:
        """The last boundary on the best paths of every end that a later piece can start from."""
        live = set(range(max(0, len(self.window) - self.v.longest + 1), len(self.window) + 1))
        while len(live) > 1:
            last = max(live)
            live.remove(last)
            live.add(last - self.length[last])
        return live.pop()

    def _commit(self, upto: int) -> None:
        if not upto:
            return
        found, at = [], upto
        while at:
            start = at - self.length[at]
            found.append([self.piece[at]] if self.piece[at] >= 0 else [self.v.byte_ids[b] for b in self.window[start:at].encode("utf-8", "surrogatepass")])
            at = start
        for ids in reversed(found):
            self.ids += ids
        base = self.score[upto]
        self.window = self.window[upto:]
        self.score = [s - base for s in self.score[upto:]]
        self.length, self.piece = self.length[upto:], self.piece[upto:]

    def close(self) -> list[int]:
        self._commit(len(self.window))
        return self.ids


class Encoder:
    """Texts to ids; remembers the units it has seen."""

    def __init__(self, vocabulary: Vocabulary):
        self.v = vocabulary
        self.known: dict[str, bytes] = {}
        self.literal = np.array([vocabulary.byte_ids[b] for b in BLANK.encode()], np.int32).tobytes()
        # ends of pieces by hash, with the piece's id if the end is a whole piece
        ends = sorted(vocabulary.tails | set(vocabulary.pieces))
        h = self._hashes(*self._joined(ends), np.arange(len(ends)), None)
        order = np.argsort(h)
        self.tail = np.r_[h[order], np.zeros(8, np.uint64)]
        whole = [vocabulary.pieces.get(e, (-1, 0.0)) for e in ends]
        self.tail_id = np.array([w[0] for w in whole])[order]
        self.tail_score = np.array([w[1] for w in whole])[order]
        slot = (h[order] >> np.uint64(44)).astype(np.int64)
        self.slot = np.searchsorted(slot, np.arange((1 << 20) + 1))
        self.deepest = int(np.diff(self.slot).max())

    @staticmethod
    def _joined(units: list[str]) -> tuple[W.Bytes, np.ndarray]:
        points = np.frombuffer("".join(units).encode("utf-32-le", "surrogatepass"), np.uint32)
        first = np.r_[0, np.cumsum([len(u) for u in units])].astype(np.int64)
        return W.Bytes(points, first), first

    @staticmethod
    def _hashes(points: W.Bytes, first: np.ndarray, rows: np.ndarray, span: tuple | None) -> np.ndarray:
        start, end = (first[rows], first[rows + 1]) if span is None else span
        return points.hashes(start, end)

    def _look_up(self, h: np.ndarray) -> np.ndarray:
        """Places of hashes among the ends of pieces, or -1."""
        at = self.slot[(h >> np.uint64(44)).astype(np.int64)]
        out = np.full(len(h), -1, np.int64)
        for k in range(self.deepest):
            hit = self.tail[at + k] == h
            out[hit] = at[hit] + k
        return out

    def learn(self, units: list[str]) -> None:
        """Remember the ids of units that are one window each, all searched at once."""
        units = sorted(units, key=len, reverse=True)
        points, first = self._joined(units)
        size = np.diff(first)
        score, back, piece = np.zeros(len(points.data) + len(units)), np.ones(len(points.data) + len(units), np.int64), np.full(len(points.data) + len(units), -1)
        node = first[:-1] + np.arange(len(units))  # node of each unit's begin; one more node than characters
        for e in range(1, int(size[0]) + 1):
            alive = int(np.searchsorted(-size, -e, "right"))
            best, length, chosen = np.full(alive, -np.inf), np.ones(alive, np.int64), np.full(alive, -1)
            live = np.arange(alive)
            single = np.zeros(alive, bool)
            for k in range(1, min(e, self.v.longest) + 1):
                end = first[live] + e
                found = self._look_up(points.hashes(end - k, end))
                live, found = live[found >= 0], found[found >= 0]
                if not len(live):
                    break
                ids = self.tail_id[found]
                is_piece = ids >= 0
                who, ids = live[is_piece], ids[is_piece]
                total = score[node[who] + e - k] + self.tail_score[found[is_piece]]
                if k == 1:
                    single[who] = True
                better = total >= best[who]
                who = who[better]
                best[who], length[who], chosen[who] = total[better], k, ids[better]
            total = score[node[:alive] + e - 1] + self.v.unknown
            other = ~single & (total > best)
            best[other], length[other], chosen[other] = total[other], 1, -1
            at = node[:alive] + e
            score[at], back[at], piece[at] = best, length, chosen
        back, piece = back.tolist(), piece.tolist()
        for unit, begin, n in zip(units, node.tolist(), size.tolist(), strict=True):
            out, at = [], n
            while at:
                s = at - back[begin + at]
                if piece[begin + at] >= 0:
                    out.append(piece[begin + at])
                else:
                    out += [self.v.byte_ids[b] for b in reversed(unit[s:at].encode("utf-8", "surrogatepass"))]
                at = s
            out.reverse()
            self.known[unit] = array("i", out).tobytes()

    def encode_all(self, texts: list[str | None]) -> list[bytes | None]:
        """The ids of texts as 32-bit numbers."""
        cut = [None if t is None else [self.v.units.findall(p.replace(" ", BLANK)) for p in (" " + t).split(BLANK)] if t else [] for t in texts]
        fresh = {u for t in cut if t for part in t for u in part}
        if len(self.known) > REMEMBERED:
            self.known.clear()
        fresh.difference_update(self.known)
        long = [u for u in fresh if len(u) > 64]
        fresh.difference_update(long)
        if fresh:
            self.learn(list(fresh))
        for unit in long:
            search = StreamingViterbi(self.v)
            for char in unit:
                search.feed(char)
            self.known[unit] = array("i", search.close()).tobytes()
        out = [None if t is None else self.literal.join(b"".join(map(self.known.__getitem__, part)) for part in t) for t in cut]
        for unit in long:
            del self.known[unit]
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_all([text])[0]


def decode_ids(ids: list[int], vocabulary: Vocabulary) -> str:
    """The text of ids; the blank put before a text is taken away."""
    return b"".join(map(vocabulary.bytes_of.__getitem__, ids)).decode("utf-8", "replace")[1:]



def _encoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, column: str, into: str) -> Iterator[pa.RecordBatch]:
    encoder = Encoder(vocabulary)
    for batch in batches:
        for rows, _ in W.slices(batch, column):
            ids = encoder.encode_all(rows.column(column).to_pylist())
            begin = np.r_[0, np.cumsum([len(x or b"") // 4 for x in ids])].astype(np.int32)
            values = np.frombuffer(b"".join(x or b"" for x in ids), np.int32)
            lists = pa.ListArray.from_arrays(pa.array(begin), pa.array(values), mask=pa.array([x is None for x in ids]))
            yield pa.RecordBatch.from_arrays([*rows.columns, lists], [*rows.schema.names, into])


def _decoded(batches: Iterator[pa.RecordBatch], vocabulary: Vocabulary, column: str, into: str) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 500):
            rows = batch.slice(at, 500)
            lists = rows.column(column)
            flat, ends = lists.flatten().to_numpy(), np.r_[0, np.cumsum(lists.value_lengths().fill_null(0).to_numpy())]
            data, begin = vocabulary.bytes_for(flat)
            data, cut = data.tobytes(), begin[ends].tolist()
            # a text's first byte is the blank put before it
            texts = [None if null else data[min(a + 1, b) : b].decode("utf-8", "replace") for null, a, b in zip(lists.is_null().to_pylist(), cut[:-1], cut[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(texts, pa.string())], [*rows.schema.names, into])
        W.tidy()


def encode(documents: DataFrame, path: str = PIECES, column: str = "text", into: str = "ids") -> DataFrame:
    """Documents with the ids of their text."""
    spark = documents.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(load(path))
    base = documents.drop(into)
    return base.mapInArrow(lambda it: _encoded(it, held.value, column, into), StructType([*base.schema.fields]).add(into, ArrayType(IntegerType())))


def decode(encoded: DataFrame, path: str = PIECES, column: str = "ids", into: str = "decoded") -> DataFrame:
    """Rows with the text of their ids."""
    spark = encoded.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(load(path))
    base = encoded.drop(into)
    return base.mapInArrow(lambda it: _decoded(it, held.value, column, into), StructType([*base.schema.fields]).add(into, StringType()))


def encode_and_decode(documents: DataFrame, path: str = PIECES, column: str = "text") -> DataFrame:
    """`decode(encode(documents))` in one pass: a task has one Python worker with one vocabulary, not two."""
    spark = documents.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(load(path))
    base = documents.drop("ids", "decoded")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _decoded(_encoded(batches, held.value, column, "ids"), held.value, "ids", "decoded")

    return base.mapInArrow(run, StructType([*base.schema.fields]).add("ids", ArrayType(IntegerType())).add("decoded", StringType()))
