"""Nested JSON sources: the product catalogue and the price file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

_TEXT_MAP = T.MapType(T.StringType(), T.StringType())
CATALOGUE_TYPE = T.MapType(T.StringType(), T.MapType(T.StringType(), T.MapType(T.StringType(), _TEXT_MAP)))
DETAILS_TYPE = T.MapType(T.StringType(), _TEXT_MAP)


def _documents(spark: SparkSession, path: str, lines: bool | None) -> DataFrame:
    """One row a document. Unless told, `lines` is found: every line that is not blank is an object of its own."""
    rows = spark.read.text(path)
    filled = F.trim("value") != ""
    if lines is None:
        broken = F.json_object_keys("value").isNull()
        lines = not rows.where(filled).isEmpty() and rows.where(filled & broken).isEmpty()
    return rows.where(filled) if lines else spark.read.text(path, wholetext=True)


def read_catalogue_json(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """Brand > model > section > field > text, as (brand, model, details) rows.

    One JSON document per file or per line (for example one brand a line); large files
    of lines are split between tasks. A broken document stops the read instead of going missing.
    """
    doc = F.from_json("value", CATALOGUE_TYPE, {"mode": "FAILFAST"})
    return (
        _documents(spark, path, lines)
        .select(F.explode(doc).alias("brand", "models"))
        .select("brand", F.explode("models").alias("model", "details"))
    )


def price_entries(docs: DataFrame, col: str = "value") -> DataFrame:
    """S03 core: JSON text to (model, scraped_at, configs); both layouts, bad text gives no rows.

    New layout: {scraped_at, configs}. Old layout: the configs map itself, or null.
    """
    fields = F.from_json(F.col("entry"), "scraped_at STRING, configs MAP<STRING, STRING>")
    wrapped = F.coalesce(
        F.exists(F.json_object_keys("entry"), lambda k: k.isin("scraped_at", "configs")), F.lit(False)
    )
    # null entries stay as rows: "looked up, found nothing" is a fact about the model
    models = F.from_json(F.col(col), "MAP<STRING, STRING>")
    return docs.select(F.explode(models).alias("model", "entry")).select(
        "model",
        F.when(wrapped, fields["scraped_at"]).alias("scraped_at"),
        F.when(wrapped, fields["configs"]).otherwise(F.from_json("entry", "MAP<STRING, STRING>")).alias("configs"),
    )


def read_price_json(spark: SparkSession, path: str, lines: bool | None = None) -> DataFrame:
    """A missing file is an empty result, not an error."""
    try:
        docs = _documents(spark, path, lines)
    except AnalysisException as err:
        if "PATH_NOT_FOUND" not in str(err):
            raise
        docs = spark.createDataFrame([], "value STRING")
    return price_entries(docs)


def price_rows(entries: DataFrame) -> DataFrame:
    """R04 on price entries: Model, Configuration, Price; models without prices vanish."""
    return entries.select(F.col("model").alias("Model"), F.explode("configs").alias("Configuration", "Price"))
