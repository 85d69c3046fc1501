"""The corpus pipeline: five stages over the documents table, each kept as a table for the next.

Toxic documents go, repeated lines go, one document of each near-duplicate group stays,
documents contaminated by the benchmark go, and what is left is encoded. Every stage takes
(spark, docs, sf_dir), works on all rows that its predecessor kept and returns the columns
of documents; the last one returns ids. Null or empty texts pass every filter; rows without
id are never compared with others; an empty table gives an empty one.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from specloom.llm import decontaminate, jaccard_join, line_dedup, pieces, toxicity
from specloom.session import store

#: Bytes of a batch that goes to a Python worker; by rows alone it would be ten thousand whole texts.
BATCH = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))

#: run() as SQL: the label model, hashing and vocabulary search have none.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """Bound the batches of this session, where it has no bound of its own."""
    if spark.conf.get(BATCH[0], None) is None:
        spark.conf.set(*BATCH)


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not call toxic."""
    small_batches(spark)
    scored = toxicity.toxicity(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return scored.where("predicted = 0").select(docs.columns)


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier document or line has; those left with nothing go."""
    small_batches(spark)
    cut = line_dedup.without_lines(line_dedup.dedup_lines(docs))
    left = cut.where(F.col("dropped").isNull() | F.col("text").rlike(r"\S"))
    return left.withColumn("n_chars", F.when(F.col("dropped").isNull(), F.col("n_chars")).otherwise(F.length("text").cast("long"))).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of similar documents the one with the smallest id."""
    small_batches(spark)
    found = jaccard_join.groups(docs.select("doc_id", "text"))
    repeats = found.where("doc_id <> component_id").select("doc_id").distinct()
    return docs.join(repeats, "doc_id", "left_anti").select(docs.columns)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is found in the benchmark."""
    small_batches(spark)
    found = decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return found.where(~decontaminate.contaminated()).select(docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_pieces, ids, round_trip): ids of each text, and whether they decode to it."""
    small_batches(spark)
    coded = pieces.encode_and_decode(docs.select("doc_id", "text"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


STAGES = [
    ("toxicity", drop_toxic),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_each_group),
    ("benchmark decontamination", drop_contaminated),
    ("SentencePiece encoding and decoding", encode),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = store(stage(spark, docs, sf_dir), "corpus")
    return STAGES[-1][1](spark, docs, sf_dir)
