"""Toxicity by weak supervision.

Many voters (lexicons of words, patterns of word beginnings and endings, a surface
pattern) look at a document. A generative label model estimates by EM how often each
voter fires on toxic and on clean documents; voters whose votes stay correlated once the
label is known share their weight. Its posterior labels train a linear classifier,
which then scores every document.

Learning reads a bounded sample: at most `sample` labelled rows of each class, taken by a
hash of the id. Its features are counted in tasks; the driver gets the counts and, of each row, the
features that tell the classes apart. Scoring reads all documents and whole texts, without a shuffle.

Defined results: a null or empty text scores what the intercept says; repeated rows score
alike; other columns are ignored; without labelled rows of both classes every score is 0.
An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from specloom.session import drop_stored, ship_package, store

from . import words as W

BUCKETS = 1 << 18
_KINDS = ("word", "begin4", "begin5", "end5", "shouting")


def held_out(doc_id: Column) -> Column:
    """Rows that labels are never learned from."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1


def _features(texts: W.Bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Feature buckets of every word: (text of the entry, bucket, kind)."""
    low = texts.lowered()
    found = W.find_words(low, W.LETTERS_DIGITS)
    text, length = found.text_of(), found.end - found.start
    size = BUCKETS // 4
    bucket = lambda h, kind: (h & np.uint64(size - 1)).astype(np.int64) + kind * size
    out = [(text, bucket(low.hashes(found.start, found.end), 0))]
    for kind, width in ((1, 4), (2, 5)):
        long = length > width
        out.append((text[long], bucket(low.hashes(found.start[long], found.start[long] + width), kind)))
    long = length > 5
    out.append((text[long], bucket(low.hashes(found.end[long] - 5, found.end[long]), 3)))
    return (np.concatenate([t for t, _ in out]), np.concatenate([b for _, b in out]),
            np.concatenate([np.full(len(t), k) for k, (t, _) in enumerate(out)]))


def _shouting(texts: W.Bytes) -> np.ndarray:
    """The surface pattern: more than two exclamation marks in a hundred bytes."""
    marks = np.r_[0, np.cumsum(texts.data == 0x21)]
    n = np.diff(texts.offsets)
    return (marks[texts.offsets[1:]] - marks[texts.offsets[:-1]]) * 50 > n


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for rows, texts in W.slices(batch, "text"):
            text, bucket, _ = _features(texts)
            order = np.argsort(text, kind="stable")
            begin = np.searchsorted(text[order], np.arange(texts.count + 1))
            values, begin = W.distinct_per_text(bucket[order].astype(np.uint64), begin)
            yield pa.RecordBatch.from_arrays([rows.column("toxic").cast(pa.int32()), pa.array(_shouting(texts)), W.ragged(values.astype(np.int32), begin, pa.int32())], ["toxic", "shouting", "buckets"])


def _bucket_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """How many of the rows, and of the toxic ones, have each feature."""
    n, toxic = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    for batch in batches:
        lists = batch.column("buckets")
        flat = lists.flatten().to_numpy()
        bad = np.repeat(batch.column("toxic").to_numpy() == 1, lists.value_lengths().to_numpy())
        n += np.bincount(flat, minlength=BUCKETS)
        toxic += np.bincount(flat[bad], minlength=BUCKETS)
    held = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(held.astype(np.int32)), pa.array(n[held]), pa.array(toxic[held])], ["bucket", "n", "bad"])


def _only(batches: Iterator[pa.RecordBatch], held) -> Iterator[pa.RecordBatch]:
    """Rows with those of their features that are wanted."""
    for batch in batches:
        lists = batch.column("buckets")
        flat, size = lists.flatten().to_numpy(), lists.value_lengths().to_numpy()
        keep = held.value[flat]
        left = np.bincount(np.repeat(np.arange(len(size)), size)[keep], minlength=len(size))
        yield pa.RecordBatch.from_arrays(
            [batch.column("at"), batch.column("toxic"), batch.column("shouting"), W.ragged(flat[keep], np.r_[0, np.cumsum(left)], pa.int32())], ["at", "toxic", "shouting", "buckets"])


@dataclass
class Model:
    """A linear score over chosen feature buckets, and what the label model found."""

    weights: np.ndarray
    intercept: float
    voters: list[dict] = field(default_factory=list)


def label_model(votes: np.ndarray, prior: float, toxic_rate: np.ndarray, clean_rate: np.ndarray, rounds: int = 25) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Posterior of the label for each row of 0/1 votes, the voters' rates, and their shares.

    EM from the given first rates. A voter's share of its own evidence is one over the
    positive correlations that its votes have with all voters' votes given the label.
    """
    share = np.ones(votes.shape[1])
    for _ in range(rounds):
        p, q = np.clip(toxic_rate, 1e-4, 1 - 1e-4), np.clip(clean_rate, 1e-4, 1 - 1e-4)
        fires, quiet = np.log(p / q), np.log((1 - p) / (1 - q))
        logit = np.log(prior / (1 - prior)) + votes @ (share * fires) + (1 - votes) @ (share * quiet)
        post = 1 / (1 + np.exp(-np.clip(logit, -50, 50)))
        prior = float(np.clip(post.mean(), 1e-3, 1 - 1e-3))
        toxic_rate = (post @ votes + 0.1) / (post.sum() + 0.2)
        clean_rate = ((1 - post) @ votes + 0.1) / ((1 - post).sum() + 0.2)
        off = votes - post[:, None] * toxic_rate - (1 - post)[:, None] * clean_rate
        cov = off.T @ off / max(1, len(votes))
        scale = np.sqrt(np.maximum(np.diag(cov), 1e-12))
        share = 1 / np.maximum(1, np.clip(cov / np.outer(scale, scale), 0, 1).sum(1))
    return post, toxic_rate, clean_rate, share


def train(documents: DataFrame, labels: DataFrame, sample: int = 5000, voters_per_kind: int = 8, features: int = 1500, telling: float = 25.0, seed: int = 7) -> Model:
    """Learn from at most `sample` labelled rows of each class that are not held out.

    Lexicons and patterns hold features at least `telling` times as frequent in toxic rows.
    """
    spark = documents.sparkSession
    ship_package(spark)
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    by_hash = lambda y: known.where(F.col("toxic") == y).orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(sample)
    chosen = F.broadcast(by_hash(1).union(by_hash(0)))  # at most 2 * sample rows of two numbers
    rows = documents.select("doc_id", "text").join(chosen, "doc_id").select("toxic", "text").mapInArrow(_sets, "toxic int, shouting boolean, buckets array<int>")
    rows = store(rows.withColumn("at", F.monotonically_increasing_id()), "toxicity-sets")
    n, n1 = (int(x or 0) for x in rows.agg(F.count("*"), F.sum("toxic")).first())
    n0 = n - n1
    if not n1 or not n0:
        drop_stored(rows)
        return Model(np.zeros(BUCKETS, np.float32), -np.inf)
    counted = rows.select("toxic", "buckets").mapInArrow(_bucket_counts, "bucket int, n long, bad long").groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("bad").alias("bad")).toArrow()
    in1, in0 = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
    in1[counted["bucket"].to_numpy()] = counted["bad"].to_numpy()
    in0[counted["bucket"].to_numpy()] = counted["n"].to_numpy() - counted["bad"].to_numpy()
    rate1, rate0 = (in1 + 0.5) / (n1 + 1), (in0 + 0.5) / (n0 + 1)
    gain = rate1 * np.log(rate1 / rate0) + (1 - rate1) * np.log((1 - rate1) / (1 - rate0))
    least = max(3, min(12, 0.008 * n1))  # toxic rows that a feature must be in
    gain[(in1 < least) | (rate1 < telling * rate0)] = 0
    held = spark.sparkContext.broadcast(gain > 0)
    table = rows.mapInArrow(lambda it: _only(it, held), "at long, toxic int, shouting boolean, buckets array<int>").toArrow().sort_by("at")
    drop_stored(rows)
    y = table["toxic"].to_numpy()
    lists = table["buckets"].combine_chunks()
    flat, row = lists.flatten().to_numpy(), np.repeat(np.arange(n), lists.value_lengths().to_numpy())
    # each kind's best features, dealt in turn, are that kind's lexicons
    size, picked, votes = BUCKETS // 4, [], []
    rows_of = np.argsort(flat, kind="stable")
    sorted_flat = flat[rows_of]
    for kind in range(4):
        best = np.argsort(-gain[kind * size : (kind + 1) * size], kind="stable")[: 60 * voters_per_kind] + kind * size
        best = best[gain[best] > 0]
        for k in range(min(voters_per_kind, len(best))):
            own = best[k::voters_per_kind]
            vote = np.zeros(len(y))
            for b in own:
                vote[row[rows_of[np.searchsorted(sorted_flat, b) : np.searchsorted(sorted_flat, b, "right")]]] = 1
            votes.append(vote)
            picked.append({"kind": _KINDS[kind], "features": len(own)})
    votes.append(table["shouting"].to_numpy(zero_copy_only=False).astype(float))
    picked.append({"kind": "shouting", "features": 1})
    votes.append(y.astype(float))  # the people who labelled are one more voter, first trusted most
    picked.append({"kind": "annotator", "features": 0})
    v = np.stack(votes, 1)
    first1, first0 = (v[y == 1].sum(0) + 0.1) / (n1 + 0.2), (v[y == 0].sum(0) + 0.1) / (n0 + 0.2)
    post, toxic_rate, clean_rate, share = label_model(v, n1 / len(y), first1, first0)
    for voter, a, b, s in zip(picked, toxic_rate, clean_rate, share, strict=True):
        voter |= {"toxic_rate": round(float(a), 4), "clean_rate": round(float(b), 4), "share": round(float(s), 4)}
    # the linear classifier: logistic regression on the posteriors over the telling features
    usable = np.flatnonzero(gain > 0)
    usable = usable[np.argsort(-gain[usable], kind="stable")[:features]]
    slot = np.full(BUCKETS, -1)
    slot[usable] = np.arange(len(usable))
    keep = slot[flat] >= 0
    r, c = row[keep], slot[flat[keep]]
    w, b = np.zeros(len(usable)), 0.0
    grad_w, grad_b = np.full(len(usable), 1e-6), 1e-6
    balance = np.where(post > 0.5, 0.5 / max(post.mean(), 1e-3), 0.5 / max(1 - post.mean(), 1e-3))
    for _ in range(1500):
        score = 1 / (1 + np.exp(-np.clip(np.bincount(r, w[c], len(y)) + b, -50, 50)))
        off = (score - post) * balance / len(y)
        g, gb = np.bincount(c, off[r], len(usable)) + 1e-6 * w, off.sum()
        grad_w += g * g
        grad_b += gb * gb
        w -= 0.5 * g / np.sqrt(grad_w)
        b -= 0.5 * gb / np.sqrt(grad_b)
    weights = np.zeros(BUCKETS, np.float32)
    weights[usable] = w
    return Model(weights, float(b), picked)


def score(documents: DataFrame, model: Model, threshold: float = 0.7) -> DataFrame:
    """`documents` with `score` and `predicted` (these replace columns of the same names)."""
    spark = documents.sparkSession
    ship_package(spark)
    held = spark.sparkContext.broadcast((model.weights, model.intercept))  # BUCKETS numbers, whatever the input
    base = documents.drop("score", "predicted")
    names = base.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        weights, intercept = held.value
        for batch in batches:
            for rows, texts in W.slices(batch, "text"):
                text, bucket, _ = _features(texts)
                keep = weights[bucket] != 0
                pairs = np.unique(text[keep] * BUCKETS + bucket[keep])
                total = np.bincount(pairs // BUCKETS, weights[pairs % BUCKETS], texts.count) + intercept
                p = np.where(np.isneginf(total), 0.0, 1 / (1 + np.exp(-np.clip(total, -700, 700))))
                yield pa.RecordBatch.from_arrays([*rows.columns, pa.array(p), pa.array((p >= threshold).astype(np.int32))], [*names, "score", "predicted"])

    from pyspark.sql.types import DoubleType, IntegerType, StructType

    shape = StructType([*base.schema.fields]).add("score", DoubleType()).add("predicted", IntegerType())
    return base.mapInArrow(run, shape)


def toxicity(documents: DataFrame, labels: DataFrame, threshold: float = 0.7) -> DataFrame:
    """Train on the labelled rows, then score every document."""
    return score(documents, train(documents, labels), threshold)
