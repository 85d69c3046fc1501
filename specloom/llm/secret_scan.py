"""Secret scans: fixed patterns plus a linear-chain conditional random field.

Tokens of a line are tagged B (a secret begins), I (it goes on) or O. A token's features
are its shape, its beginning and its word, the shape and word of its neighbours, the
characters before it, and features of the whole file. Weights are learned by maximum
likelihood on a bounded sample in which the patterns' matches are the tags; Viterbi then
decodes every line of every text. Decoded spans that touch no pattern match are added.

The sample: the `sample` documents with the lowest hash of their id; of these all lines
with a match and one line of every sixteenth document. Scanning needs no shuffle.

Defined results: a null or empty text has no spans; equal rows have equal spans; offsets
are code points, end exclusive; other columns pass through, those named like a result are
replaced; without any match in the sample nothing is added. An empty table gives no rows.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructType

from specloom.session import ship_package

from . import words as W

#: Fixed patterns, over lowered bytes (assign) and bytes as they are.
ASSIGN = re.compile(rb"(password|passwd|secret|token|api_?key)[\"']?\x20*[:=]\x20*[\"']?([a-z0-9+/_.=-]+)")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
KINDS = ("assign", "access", "hex", "crf")
LEAST = {"assign": 6, "access": 20, "hex": 24}


def _class(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, bool)
    for a, b in ranges:
        out[a : b + 1] = True
    return out


_HEX = _class((0x30, 0x39), (0x61, 0x66))
_LOWER, _UPPER, _DIGIT, _BEYOND = _class((0x61, 0x7A)), _class((0x41, 0x5A)), _class((0x30, 0x39)), _class((0x80, 0xFF))
_MARK = _class((0x2B, 0x2B), (0x2F, 0x2F), (0x5F, 0x5F), (0x2D, 0x2D))
_TOKEN = _LOWER | _UPPER | _DIGIT | _MARK | _BEYOND
_LENGTHS = np.array([3, 6, 10, 16, 20, 24, 40])

#: Sizes of the feature groups: own shape, previous and next shape, word, previous and next word, beginning, characters before, file.
GROUPS = (1024, 1024, 1024, 4096, 4096, 4096, 1024, 32, 16)
_BASE = np.r_[0, np.cumsum(GROUPS)]
SIZE = int(_BASE[-1])
O, B, I = 0, 1, 2  # noqa: E741


def base_matches(texts: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, kind, start, end, start of the secret itself) of the fixed patterns, in bytes of the slice."""
    out = []
    held, low = texts.data.tobytes(), texts.lowered().data.tobytes()
    for i, (a, b) in enumerate(zip(texts.offsets[:-1].tolist(), texts.offsets[1:].tolist(), strict=True)):
        if held.find(b"=", a, b) >= 0 or held.find(b":", a, b) >= 0:
            out += [(i, 0, m.start(), m.end(), m.start(2)) for m in ASSIGN.finditer(low, a, b) if m.end() - m.start(2) >= LEAST["assign"]]
        if held.find(b"AKIA", a, b) >= 0:
            out += [(i, 1, m.start(), m.end(), m.start()) for m in ACCESS.finditer(held, a, b) if m.end() - m.start() >= LEAST["access"]]
    runs = W.find_words(texts, _HEX)
    long = np.flatnonzero(runs.end - runs.start >= LEAST["hex"])
    text = np.searchsorted(texts.offsets, runs.start[long], "right") - 1
    out += [(int(t), 2, int(s), int(e), int(s)) for t, s, e in zip(text, runs.start[long], runs.end[long], strict=True)]
    found = np.array(sorted(out, key=lambda x: (x[0], x[2], x[1])), np.int64).reshape(-1, 5)
    return tuple(found.T)


class Tokens:
    """Tokens of a slice with their features; a line is one sequence."""

    def __init__(self, texts: W.Bytes):
        data = texts.data
        found = W.find_words(texts, _TOKEN)
        self.start, self.end = start, end = found.start, found.end
        n = len(start)
        self.text = text = found.text_of()
        count = lambda kind: np.r_[0, np.cumsum(kind[data], dtype=np.int32)]
        digits = count(_DIGIT)
        held = lambda c: c[end] - c[start]
        length, digit = end - start, held(digits)
        share = np.where(digit == 0, 0, np.where(5 * digit < length, 1, np.where(2 * digit < length, 2, 3)))
        flags = sum((held(count(kind)) > 0).astype(np.int64) << k for k, kind in enumerate((_LOWER, _UPPER, _MARK, _BEYOND)))
        hexes = (held(count(_HEX)) == length).astype(np.int64)
        shape = ((np.searchsorted(_LENGTHS, length, "right") * 16 + flags) * 4 + share) * 2 + hexes
        low = texts.lowered()
        word = (low.hashes(start, end) & np.uint64(4095)).astype(np.int64)
        begins = (low.hashes(start, np.minimum(end, start + 4)) & np.uint64(1023)).astype(np.int64)
        lines = np.r_[0, np.cumsum(data == 0x0A)]
        self.new = new = np.ones(n, bool)
        new[1:] = (lines[start[1:]] != lines[start[:-1]]) | (text[1:] != text[:-1])
        before = np.zeros(n, np.int64)
        since = np.r_[0, end[:-1]] if n else end
        since = np.maximum(since, texts.offsets[text]) if n else since
        for k, byte in enumerate((0x3D, 0x3A, 0x22, 0x27, 0x2E)):
            c = np.r_[0, np.cumsum(data == byte, dtype=np.int32)]
            before |= ((c[start] - c[since]) > 0).astype(np.int64) << k
        size = np.maximum(np.diff(texts.offsets), 1)
        dense = (digits[texts.offsets[1:]] - digits[texts.offsets[:-1]]) / size
        equals = np.r_[0, np.cumsum((data == 0x3D) | (data == 0x3A))]
        signs = (equals[texts.offsets[1:]] - equals[texts.offsets[:-1]]) / size
        file = np.searchsorted([0.005, 0.02, 0.1], dense, "right") * 4 + np.searchsorted([0.0005, 0.005, 0.02], signs, "right")
        last = np.r_[new[1:], True] if n else new
        left = lambda x, none: np.where(new, none, np.r_[none, x[:-1]]) if n else x
        right = lambda x, none: np.where(last, none, np.r_[x[1:], none]) if n else x
        columns = (shape, left(shape, 1023), right(shape, 1023), word, left(word, 4095), right(word, 4095), begins, before, file[text] if n else shape)
        self.features = np.stack([c + b for c, b in zip(columns, _BASE[:-1], strict=True)], 1).astype(np.int32)


def _steps(new: np.ndarray) -> tuple[np.ndarray, list[int]]:
    """Beginnings of sequences, longest first, and how many are still alive at each step."""
    first = np.flatnonzero(new)
    size = np.diff(np.r_[first, len(new)])
    order = np.argsort(-size, kind="stable")
    first, size = first[order], size[order]
    alive = np.searchsorted(-size, -np.arange(1, (size[0] if len(size) else 0) + 1), "right")
    return first, alive.tolist()


def viterbi(scores: np.ndarray, moves: np.ndarray, new: np.ndarray) -> np.ndarray:
    """Best tags of all sequences; `scores` per token and tag, moves[a, b] from tag a to tag b."""
    first, alive = _steps(new)
    back = np.zeros(scores.shape, np.int8)
    best = scores[first].copy()
    best[:, I] = -1e9
    tags = np.zeros(len(scores), np.int8)
    for t, n in enumerate(alive):
        if t:
            ways = best[:n, :, None] + moves[None]
            back[first[:n] + t] = ways.argmax(1)
            best[:n] = ways.max(1) + scores[first[:n] + t]
    tag = best.argmax(1).astype(np.int8)
    for t in range(len(alive) - 1, -1, -1):
        at = first[: alive[t]] + t
        tags[at] = tag[: alive[t]]
        tag[: alive[t]] = back[at, tag[: alive[t]]]
    return tags


def train(features: np.ndarray, new: np.ndarray, tags: np.ndarray, rounds: int = 40) -> tuple[np.ndarray, np.ndarray]:
    """Weights (features x tags) and moves that maximise the likelihood of the tags."""
    weights, moves = np.zeros((SIZE, 3)), np.zeros((3, 3))
    held_w, held_m = np.full(weights.shape, 1e-6), np.full(moves.shape, 1e-6)
    forbidden = np.zeros((3, 3))
    forbidden[O, I] = -30
    first, alive = _steps(new)
    gold = np.eye(3)[tags]
    inner = np.flatnonzero(~new)
    seen = np.zeros((3, 3))
    np.add.at(seen, (tags[inner - 1], tags[inner]), 1)
    fold = lambda x: np.log(np.exp(x - x.max(1, keepdims=True)).sum(1)) + x.max(1)
    for _ in range(rounds):
        scores = weights[features].sum(1)
        m = moves + forbidden
        ahead, behind = scores.copy(), np.zeros_like(scores)
        ahead[first, I] -= 30
        for t, n in enumerate(alive[1:], 1):
            at = first[:n] + t
            ahead[at] += fold(ahead[at - 1][:, :, None] + m[None])
        for t in range(len(alive) - 1, 0, -1):
            at = first[: alive[t]] + t
            behind[at - 1] = fold((behind[at] + scores[at])[:, :, None] + m.T[None])
        total = fold((ahead + behind)[:, :, None])
        off = np.exp(ahead + behind - total) - gold
        pair = np.exp(ahead[inner - 1][:, :, None] + m[None] + (scores + behind)[inner][:, None, :] - total[inner][:, :, None]).sum(0) - seen
        grad = np.stack([np.bincount(features.ravel(), np.repeat(off[:, k], features.shape[1]), SIZE) for k in range(3)], 1) + 0.01 * weights
        held_w += grad * grad
        held_m += pair * pair
        weights -= 0.5 * grad / np.sqrt(held_w)
        moves -= 0.5 * pair / np.sqrt(held_m)
    return weights.astype(np.float32), (moves + forbidden).astype(np.float32)


def _tags(tokens: Tokens, matches) -> np.ndarray:
    """B, I, O from the secrets of the fixed patterns."""
    tags = np.zeros(len(tokens.start), np.int8)
    _, _, _, end, secret = matches
    for s, e in sorted(zip(secret.tolist(), end.tolist(), strict=True)):
        a, b = np.searchsorted(tokens.end, s, "right"), np.searchsorted(tokens.start, e, "left")
        a = a + int((tags[a:b] > 0).sum())
        if a < b and (a == 0 or tags[a] == 0):
            tags[a:b] = I
            tags[a] = B
    tags[tokens.new & (tags == I)] = B
    return tags


def _lines(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines to learn from: those with a match, and one line of each sixteenth document."""
    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            tokens = Tokens(texts)
            tags = _tags(tokens, base_matches(texts))
            line = np.cumsum(tokens.new) - 1
            wanted = np.zeros(int(line[-1]) + 1 if len(line) else 0, bool)
            wanted[line[tags > 0]] = True
            spare = np.flatnonzero(rows.column("spare").to_numpy(zero_copy_only=False))
            at = np.searchsorted(tokens.text, spare)
            wanted[line[at[(at < len(line))]]] = True
            keep = wanted[line] if len(line) else np.zeros(0, bool)
            yield pa.RecordBatch.from_arrays(
                [pa.array([np.r_[tokens.new[keep]].astype(np.int8).tobytes()]), pa.array([tags[keep].tobytes()]), pa.array([tokens.features[keep].tobytes()])], ["new", "tags", "features"])


def learn(documents: DataFrame, sample: int = 20_000, seed: int = 11) -> tuple[np.ndarray, np.ndarray] | None:
    """A field trained on a bounded sample, or None if the sample holds no match."""
    ship_package(documents.sparkSession)
    ids = documents.select("doc_id").where("doc_id IS NOT NULL").distinct().orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    ids = F.broadcast(ids.withColumn("spare", F.pmod(F.xxhash64("doc_id"), F.lit(16)) == 0))  # at most `sample` rows
    table = documents.select("doc_id", "text").join(ids, "doc_id").select("text", "spare").mapInArrow(_lines, "new binary, tags binary, features binary").toArrow()
    joined = lambda name, kind: np.frombuffer(b"".join(table[name].to_pylist()), kind)
    new, tags = joined("new", np.int8).astype(bool), joined("tags", np.int8)
    if not (tags > 0).any():
        return None
    return train(joined("features", np.int32).reshape(-1, len(GROUPS)), new, tags)


def scan(documents: DataFrame, model: tuple[np.ndarray, np.ndarray] | None) -> DataFrame:
    """Documents with n_assign, n_access, n_hex, base_spans and spans ("kind:start:end")."""
    spark = documents.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast(model)  # SIZE x 3 numbers
    base = documents.drop("n_assign", "n_access", "n_hex", "base_spans", "spans")
    names = base.columns
    shape = StructType([*base.schema.fields])
    for name in ("n_assign", "n_access", "n_hex"):
        shape = shape.add(name, LongType())
    shape = shape.add("base_spans", ArrayType(StringType())).add("spans", ArrayType(StringType()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                text, kind, start, end, _ = base_matches(texts)
                counts = [np.bincount(text[kind == k], minlength=texts.count) for k in range(3)]
                found = [[] for _ in range(texts.count)]
                points = W.code_points(texts)
                origin = points[texts.offsets]
                for t, k, s, e in zip(text.tolist(), kind.tolist(), start.tolist(), end.tolist(), strict=True):
                    found[t].append((int(points[s] - origin[t]), k, int(points[e] - origin[t])))
                added = [list(x) for x in found]
                if held.value is not None:
                    tokens = Tokens(texts)
                    weights, moves = held.value
                    scores = np.zeros((len(tokens.start), 3), np.float32)
                    for g in range(len(GROUPS)):
                        scores += weights[tokens.features[:, g]]
                    tags = viterbi(scores, moves, tokens.new) if len(scores) else np.zeros(0, np.int8)
                    for b in np.flatnonzero(tags == B).tolist():
                        upto = b
                        while upto + 1 < len(tags) and tags[upto + 1] == I and not tokens.new[upto + 1]:
                            upto += 1
                        t = int(tokens.text[b])
                        s, e = int(points[tokens.start[b]] - origin[t]), int(points[tokens.end[upto]] - origin[t])
                        if all(e <= s2 or s >= e2 for s2, _, e2 in found[t]):
                            added[t].append((s, 3, e))
                say = lambda spans: pa.array([[f"{KINDS[k]}:{s}:{e}" for s, k, e in sorted(x)] for x in spans], pa.list_(pa.string()))
                yield pa.RecordBatch.from_arrays([*rows.columns, *(pa.array(c.astype(np.int64)) for c in counts), say(found), say(added)], [*names, "n_assign", "n_access", "n_hex", "base_spans", "spans"])

    return base.mapInArrow(run, shape)


def secrets(documents: DataFrame) -> DataFrame:
    """Learn from the documents' own pattern matches, then scan every document."""
    return scan(documents, learn(documents))
