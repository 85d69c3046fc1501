"""Tabular sources and sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ledger import Ledger
from ..schemas import STAR_SCHEMAS, Star


def _quotes_left_open(spark: SparkSession, path: str) -> bool:
    """Does a line hold an odd number of quotes, as where a quoted field runs on in the next line?"""
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


def read_csv(spark: SparkSession, path: str, schema: T.StructType, multiline: bool | None = None) -> DataFrame:
    """CSV with header and quoted commas; the schema is given, never inferred.

    A file whose fields hold line breaks is one task; others are split. Unless `multiline`
    says which, a scan of the lines for an open quote decides (it stops at the first one).
    Files with stray quotes in bare fields should name it.
    """
    if multiline is None:
        multiline = _quotes_left_open(spark, path)
    return (
        spark.read.schema(schema)
        .option("header", True).option("multiLine", multiline).option("escape", '"')
        .csv(path)
    )


def read_jdbc(spark: SparkSession, url: str, table: str, key: str | None = None,
              bounds: tuple[int, int] | None = None, parts: int = 32, **options) -> DataFrame:
    """S05 against a database: split on a numeric key so no single task reads it all."""
    reader = spark.read.format("jdbc").options(url=url, dbtable=table, **options)
    if key and bounds:
        reader = reader.options(
            partitionColumn=key, lowerBound=bounds[0], upperBound=bounds[1], numPartitions=parts
        )
    return reader.load()


def read_table(spark: SparkSession, root: str, name: str, schema: T.StructType | None = None) -> DataFrame:
    """One stored table."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(f"{root}/{name}")


def read_star(spark: SparkSession, root: str) -> Star:
    """All eight star tables below one folder, as of the last recorded batch of a load."""
    ledger = Ledger(spark, root)
    return Star(**{n: ledger.read(n, s) for n, s in STAR_SCHEMAS.items()})


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Overwrite a table; CSV carries a header even with no rows."""
    writer = df.write.mode("overwrite").format(fmt)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if fmt == "csv":
        # escape='"' doubles quotes, the form the reader above expects
        writer = writer.option("header", True).option("escape", '"')
    writer.save(path)


def append_table(df: DataFrame, path: str) -> None:
    """Add rows, keep what is there."""
    df.write.mode("append").parquet(path)
