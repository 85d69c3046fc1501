"""Reshaping and projection."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import storage_and_ram, strip
from ..session import store


def quoted(names) -> list[str]:
    """Names that may hold dots or spaces, safe for select."""
    return [f"`{c}`" for c in names]


def flatten_columns(df: DataFrame, sep: str = "_") -> DataFrame:
    """R01 for typed nesting: every leaf becomes a column named by its path.

    Structs are walked by schema. Arrays have no fixed length, so each stays one
    column; use `flatten_json` for index-numbered parts.
    """

    def leaves(dtype, col, name):
        if isinstance(dtype, T.StructType):
            for f in dtype.fields:
                yield from leaves(f.dataType, col[f.name], f"{name}{sep}{f.name}" if name else f.name)
        else:
            yield col.alias(name)

    out = []
    for f in df.schema.fields:
        out.extend(leaves(f.dataType, F.col(f"`{f.name}`"), f.name))
    return df.select(*out)


def flatten_json(df: DataFrame, json_col: str, keys: list[str], sep: str = "_") -> DataFrame:
    """R01 for JSON text of unknown shape and depth: long (keys, path, value) rows.

    The text is parsed once to a variant. Each round stores a level and explodes its
    objects and arrays into the next one, until nothing is nested; scalars leave as soon
    as they are reached, so each is read once. List positions become path parts, empty
    containers vanish, scalars come out as text and JSON null as NULL. A text that is no
    JSON gives one row with path `__broken` and the text itself.
    """
    tvf = df.sparkSession.tvf
    parsed = df.select(*keys, F.col(json_col).alias("__text"), F.try_parse_json(json_col).alias("node"))
    broken = parsed.filter("node IS NULL AND __text IS NOT NULL").select(*keys, F.lit("__broken").alias("path"), F.col("__text").alias("value"))
    level = parsed.filter("node IS NOT NULL OR __text IS NULL").select(*keys, F.lit(None).cast("string").alias("path"), "node")
    done = [broken]
    while True:
        typed = store(level.withColumn("__nested", F.coalesce(F.schema_of_variant("node").rlike("^(OBJECT|ARRAY)<"), F.lit(False))), "json-level")
        done.append(typed.filter(~F.col("__nested")).select(*keys, "path", F.col("node").cast("string").alias("value")))
        nested = typed.filter("__nested").select(*keys, "path", "node")
        if nested.isEmpty():
            return reduce(DataFrame.unionByName, done)
        level = nested.lateralJoin(tvf.variant_explode(F.col("node").outer())).select(
            *keys,
            F.concat_ws(sep, "path", F.coalesce(F.col("key"), F.col("pos").cast("string"))).alias("path"),
            F.col("value").alias("node"),
        )


def catalogue_fields(rows: DataFrame, sep: str = "_") -> DataFrame:
    """(brand, model, details) to long (brand, model, path, value)."""
    return (
        rows.select("brand", "model", F.explode("details").alias("section", "fields"))
        .select("brand", "model", "section", F.explode("fields").alias("field", "value"))
        .select("brand", "model", F.concat("section", F.lit(sep), "field").alias("path"), "value")
    )


def fields_to_rows(fields: DataFrame, paths: list[str], keys=("brand", "model")) -> DataFrame:
    """One row per product, one column per path, missing is NULL.

    The path list is an argument: finding it would cost another pass. The pivot
    aggregates before its shuffle, so a product with many fields is no hot group.
    """
    return fields.groupBy(*keys).pivot("path", paths).agg(F.max("value"))


def last_wins_index(df: DataFrame, key: str, value: str, ordinal: str) -> DataFrame:
    """The entry with the highest ordinal per key."""
    return df.groupBy(key).agg(F.max_by(value, ordinal).alias(value))


def explode_map(df: DataFrame, col: str, key: str, value: str) -> DataFrame:
    """One row per map entry; NULL maps vanish."""
    rest = [c for c in df.columns if c != col]
    return df.select(*[F.col(f"`{c}`") for c in rest], F.explode(col).alias(key, value))


def expand_configs(df: DataFrame, col: str = "Memory_Internal", storage="Storage", ram="RAM") -> DataFrame:
    """One row per memory piece that names both storage and RAM; others are dropped."""
    pieces = df.withColumn("__piece", F.explode(F.split(F.col(f"`{col}`"), "[,;]")))
    parsed = pieces.withColumn("__parsed", storage_and_ram(strip(F.col("__piece"))))
    return (
        parsed.withColumn(storage, F.col("__parsed.storage"))
        .withColumn(ram, F.col("__parsed.ram"))
        .filter(F.col(storage).isNotNull() & F.col(ram).isNotNull())
        .drop("__piece", "__parsed")
    )


def override_price(df: DataFrame, prices: DataFrame, price: str = "Misc_Price", model: str = "model",
                   storage: str = "Storage", ram: str = "RAM", *, ordinal: str) -> DataFrame:
    """A price listed for (model, configuration) replaces the raw one; the last by `ordinal` wins."""
    listed = (
        prices.select(
            F.col("Model").alias(model), F.col("Configuration").alias("__config"),
            F.col("Price").alias("__listed"), F.col(ordinal).alias("__at"),
        )
        .groupBy(model, "__config")
        .agg(F.max_by("__listed", "__at").alias("__listed"), F.lit(True).alias("__hit"))
    )
    config = F.concat(F.col(storage), F.lit(" "), F.col(ram), F.lit(" RAM"))
    return (
        df.withColumn("__config", config)
        .join(listed, [model, "__config"], "left")
        .withColumn(price, F.when(F.col("__hit"), F.col("__listed")).otherwise(F.col(f"`{price}`")))
        .select(*quoted(df.columns))
    )


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing required columns: {missing}")
    return df


def rename_and_require(df: DataFrame, names: dict[str, str], required: list[str]) -> DataFrame:
    """Rename known columns, then insist on the required ones."""
    return require_columns(df.withColumnsRenamed(names), required)


def drop_required(df: DataFrame, cols: list[str]) -> DataFrame:
    """Drop columns; an absent one is an error (plain drop would ignore it)."""
    return require_columns(df, cols).drop(*cols)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Give a frame every column of a schema; columns it lacks are NULL."""
    have = set(df.columns)
    absent = {f.name: F.lit(None).cast(f.dataType) for f in schema.fields if f.name not in have}
    return df.withColumns(absent) if absent else df


def project(df: DataFrame, columns: dict[str, str]) -> DataFrame:
    """Output name to source column."""
    return df.select(*[F.col(src).alias(out) for out, src in columns.items()])


def long_values(df: DataFrame, cols: list[str], keys: list[str] = ()) -> DataFrame:
    """Wide numeric columns to (column, value) rows, NULLs left out."""
    wide = df.select(*keys, *[F.col(c).cast("double").alias(c) for c in cols])
    return wide.unpivot(list(keys), cols, "column", "value").filter(F.col("value").isNotNull())
