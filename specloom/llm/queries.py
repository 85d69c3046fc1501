"""The registered queries of this folder: name -> fn(spark, folder of tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline

from . import alignment as _alignment
from . import binary_codes as _binary_codes
from . import chaining as _chaining
from . import decontaminate as _decontaminate
from . import jaccard_join as _jaccard_join
from . import line_dedup as _line_dedup
from . import ngram_model as _ngram_model
from . import pieces as _pieces
from . import secret_scan as _secret_scan
from . import suffix_dedup as _suffix_dedup
from . import token_counts as _token_counts
from . import toxicity as _toxicity
from . import whitening as _whitening

QUERIES: dict = {}
CHECKS: dict[str, str] = {}


def _query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _table(spark: SparkSession, root: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{root}/{name}.parquet")


@_query
def op5_toxicity(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    scored = _toxicity.toxicity(docs, _table(spark, root, "labels"))
    return scored.select("doc_id", _toxicity.held_out(F.col("doc_id")).alias("held_out"), "score", "predicted")


@_query
def op4_decontamination(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    found = _decontaminate.decontaminate(docs, _table(spark, root, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.sort_array("items")).cast("binary"), 256).alias("items_sha256"),
        _decontaminate.contaminated().alias("contaminated"))


@_query
def op10_secret_scan(spark: SparkSession, root: str) -> DataFrame:
    found = _secret_scan.secrets(_table(spark, root, "documents").select("doc_id", "text"))
    return found.select(
        "doc_id", "n_assign", "n_access", "n_hex", F.sha2(F.concat_ws(",", "base_spans").cast("binary"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"))


@_query
def op3_sentencepiece(spark: SparkSession, root: str) -> DataFrame:
    coded = _pieces.encode_and_decode(_table(spark, root, "documents").select("doc_id", "text"))
    return coded.select("doc_id", F.size("ids").cast("long").alias("n_pieces"), "ids", F.col("decoded").eqNullSafe(F.col("text")).alias("round_trip"))


@_query
def op8_embedding_near_dedup(spark: SparkSession, root: str) -> DataFrame:
    return _binary_codes.near_duplicates(_table(spark, root, "embeddings"))


@_query
def op9_line_dedup(spark: SparkSession, root: str) -> DataFrame:
    docs = _table(spark, root, "documents").select("doc_id", "text")
    gone = _line_dedup.dropped_lines(docs).groupBy("doc_id").agg(F.sort_array(F.collect_list("no")).alias("dropped"))
    shown = docs.select("doc_id", _line_dedup.n_lines().alias("n_lines")).join(gone, "doc_id", "left")
    return shown.select("doc_id", "n_lines", F.coalesce(F.size("dropped"), F.lit(0)).cast("long").alias("n_dropped"), F.coalesce("dropped", F.array().cast("array<int>")).alias("dropped"))


@_query
def op7_ngram_jaccard_join(spark: SparkSession, root: str) -> DataFrame:
    corpus_pipeline.small_batches(spark)
    return _jaccard_join.groups(_table(spark, root, "documents").select("doc_id", "text"))


@_query
def op2_lm_scoring(spark: SparkSession, root: str) -> DataFrame:
    return _ngram_model.score(_table(spark, root, "documents").select("doc_id", "text"))


@_query
def op1_substring_dedup(spark: SparkSession, root: str) -> DataFrame:
    return _chaining.passages(_table(spark, root, "documents").select("doc_id", "text"))


@_query
def op6_suffix_array_dedup(spark: SparkSession, root: str) -> DataFrame:
    return _suffix_dedup.dedup(_table(spark, root, "documents").select("doc_id", "text"))


@_query
def op11_embedding_whitening(spark: SparkSession, root: str) -> DataFrame:
    white = _whitening.whiten(_table(spark, root, "embeddings"))
    both = F.posexplode(F.arrays_zip("whitened", "explained")).alias("at", "c")
    return white.select("vec_id", "n", "deviation", "identity_error", both).select(
        "vec_id", (F.col("at") + 1).alias("component"), "n", "deviation", "c.whitened", "c.explained", "identity_error")


@_query
def op12_token_counts(spark: SparkSession, root: str) -> DataFrame:
    counted = _token_counts.token_counts(_table(spark, root, "documents").select("doc_id", "text"))
    return counted.withColumn("over_limit", F.col("n_tokens") > 4096)


@_query
def op13_cross_tokenizer_alignment(spark: SparkSession, root: str) -> DataFrame:
    return _alignment.alignment_summary(_table(spark, root, "documents").select("doc_id", "text"))


QUERIES["pipeline"] = corpus_pipeline.run
if corpus_pipeline.ORACLE_SQL:
    CHECKS["pipeline"] = corpus_pipeline.ORACLE_SQL
