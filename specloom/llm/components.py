"""Connected components as Spark jobs: local union-find, then large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from specloom.session import drop_stored, ship_package, store

#: Edges that one task joins at a time before it passes them on.
BLOCK = 500_000


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges (node, smallest node it reaches) with the same components as the given edges."""
    nodes, at = np.unique(np.r_[a, b], return_inverse=True)
    a, b = at[: len(a)], at[len(a) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        np.minimum.at(label, before[a], low)
        np.minimum.at(label, before[b], low)
        while True:
            hop = label[label]
            if (hop == label).all():
                break
            label = hop
        if (label == before).all():
            break
    away = label != np.arange(len(nodes))
    return nodes[away], nodes[label[away]]


def _shrink(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    a, b = np.zeros(0, np.int64), np.zeros(0, np.int64)
    for batch in batches:
        a = np.r_[a, batch.column(0).to_numpy(zero_copy_only=False)]
        b = np.r_[b, batch.column(1).to_numpy(zero_copy_only=False)]
        if len(a) >= 2 * BLOCK:
            a, b = forest(a, b)
            if len(a) >= BLOCK:
                yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])
                a, b = a[:0], b[:0]
    a, b = forest(a, b)
    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(id, component_id) for every node of an edge list; component_id is the smallest id reached.

    Edges with a null end and loops are left out; repeated edges and extra columns do no
    harm. An empty list gives no rows. Each round writes the edges to the shared folder, so
    a lost executor costs one round. A node with very many edges is no hot key: minima are
    combined before the shuffle and the joins back are plain ones, which Spark splits.
    """
    spark = edges.sparkSession
    ship_package(spark)
    pairs = edges.select(F.col(a).cast("long").alias("a"), F.col(b).cast("long").alias("b")).where("a <> b")
    shape = "a long, b long"
    pairs = pairs.mapInArrow(_shrink, shape)
    current = store(pairs.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct().mapInArrow(_shrink, shape), "cc")
    previous = None
    while True:
        # large star: every larger neighbour of a node is tied to the node's smallest neighbour
        both = current.union(current.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        # small star: every smaller neighbour, and the node itself, is tied to the smallest one
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a")
        small = small.select("a", F.col("m").alias("b")).union(small.select(F.col("b").alias("a"), F.col("m").alias("b")))
        settled, current = current, store(small.where("a <> b").distinct(), "cc")
        drop_stored(settled)
        state = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
        if (state["n"], state["s"]) == previous:
            break
        previous = (state["n"], state["s"])
    # settled: every edge ties a node to its component's smallest node
    return current.select(F.col("a").alias("id"), F.col("b").alias("component_id")).union(
        current.select(F.col("b").alias("id"), F.col("b").alias("component_id")).distinct())
