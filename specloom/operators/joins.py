"""Joins (J01-J10).

No side carries a broadcast hint unless its row count has a proven bound. Stored
dimensions have file sizes, so Spark broadcasts them below
spark.sql.autoBroadcastJoinThreshold and sorts and merges above it, with AQE
splitting hot keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import is_stale, lookup_key, storage_tiers
from ..schemas import Star


def join_dim(fact: DataFrame, dim: DataFrame, fk: str, cols, how: str = "inner") -> DataFrame:
    """J01 (inner) and J02 (left): bring dimension columns to the fact, by its foreign key.

    `cols` is a list of names, or output name to dimension column.
    """
    named = cols if isinstance(cols, dict) else {c: c for c in cols}
    side = dim.select(F.col("id").alias(fk), *[F.col(src).alias(out) for out, src in named.items()])
    return fact.join(side, fk, how)


def left_join_dim(fact: DataFrame, dim: DataFrame, fk: str, cols) -> DataFrame:
    """Facts without a match stay."""
    return join_dim(fact, dim, fk, cols, "left")


def recommend_star(t: Star) -> DataFrame:
    """Names are required, other dimensions optional."""
    out = join_dim(t.Device, t.Device_Name, "device_name_id", ["brand", "model"])
    out = left_join_dim(out, t.Platform, "platform_id", ["ram_gb", "internal_storage_gb", "chipset_manufacturer"])
    out = left_join_dim(out, t.Display, "display_id", ["display_size_inch"])
    out = left_join_dim(out, t.OS, "os_id", ["os_name"])
    return left_join_dim(out, t.Network_Technology, "network_technology_id", ["technology"])


def full_star(t: Star) -> DataFrame:
    """All dimensions, devices with any unknown attribute left out."""
    out = join_dim(t.Device, t.Device_Name, "device_name_id", ["brand", "model"])
    out = join_dim(out, t.Platform, "platform_id",
                   ["chipset_manufacturer", "cpu_core_count", "internal_storage_gb", "ram_gb"])
    out = join_dim(out, t.Display, "display_id",
                   ["display_size_inch", "display_size_cm", "screen_to_body_ratio", "resolution_pixels",
                    "resolution_ratio", "ppi_density"])
    out = join_dim(out, t.OS, "os_id", ["os_name", "os_version"])
    out = join_dim(out, t.Camera, "camera_id",
                   ["main_cameras_num", "selfie_cameras_num", "highest_maincam_res", "highest_selfiecam_res"])
    out = join_dim(out, t.Sim, "sim_id", ["sim_count", "sim_type"])
    return join_dim(out, t.Network_Technology, "network_technology_id", ["technology"])


def key_columns(df: DataFrame, keys: list[str], prefix: str = "__k") -> dict[str, Column]:
    """Normalised key texts, one helper column per key part."""
    kinds = dict(df.dtypes)
    return {f"{prefix}{i}": lookup_key(F.col(f"`{k}`"), kinds[k]) for i, k in enumerate(keys)}


def lookup_side(dim: DataFrame, keys: list[str], id_col: str, prefix: str = "__k", dim_id: str = "id") -> DataFrame:
    """A dimension reduced to its normalised key and the id that key stands for."""
    names = key_columns(dim, keys, prefix)
    return (
        dim.select(*[c.alias(k) for k, c in names.items()], F.col(dim_id).alias(id_col))
        .groupBy(*names)
        .agg(F.min(id_col).alias(id_col))
    )


def attach_lookup_id(df: DataFrame, dim: DataFrame, keys: list[str], id_col: str, dim_id: str = "id",
                     dim_keys: list[str] | None = None) -> DataFrame:
    """Left join on normalised keys, NULL matching NULL; unmatched ids stay NULL."""
    names = key_columns(df, keys)
    left = df.drop(id_col).withColumns(names)
    return left.join(lookup_side(dim, dim_keys or keys, id_col, dim_id=dim_id), list(names), "left").drop(*names)


def new_rows(df: DataFrame, existing: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose normalised key is not yet in the target."""
    names = key_columns(df, keys)
    seen = existing.select(*[c.alias(k) for k, c in key_columns(existing, keys).items()])
    return df.withColumns(names).join(seen, list(names), "left_anti").drop(*names)


def keep_groups(df: DataFrame, groups: DataFrame, key: str, bounded: bool = False) -> DataFrame:
    """Rows of the listed groups. `bounded` says the list is a LIMIT result."""
    side = groups.select(key)
    return df.join(F.broadcast(side) if bounded else side, key, "left_semi")


def work_queue(known: DataFrame, done: DataFrame, url: str = "url") -> DataFrame:
    """Known entries whose URL was not processed."""
    return known.join(done.select(url), url, "left_anti")


def work_queue_counts(known: DataFrame, done: DataFrame, url: str = "url") -> DataFrame:
    """Total known, still to do, already done."""
    seen = done.select(url).distinct().withColumn("__seen", F.lit(1))
    return known.join(seen, url, "left").agg(
        F.count("*").alias("known"),
        F.count_if(F.col("__seen").isNull()).alias("queued"),
        F.count("__seen").alias("already_done"),
    )


def refresh_states(devices: DataFrame, urls: DataFrame, existing: DataFrame, older_than_days: int | None,
                   now: Column, memory: str = "Memory_Internal") -> DataFrame:
    """Multi-configuration products, each marked queued, fresh or missing_url.

    `urls` has one row per model (see last_wins_index), `existing` one per model
    with its scraped_at text.
    """
    known = existing.select("model", "scraped_at", F.lit(True).alias("__known"))
    state = (
        F.when(F.coalesce(F.col("url"), F.lit("")) == "", "missing_url")
        .when(F.col("__known") & ~is_stale(F.col("scraped_at"), older_than_days, now), "fresh")
        .otherwise("queued")
    )
    return (
        devices.filter(storage_tiers(F.col(memory)) > 1)
        .join(urls.select("model", "url"), "model", "left")
        .join(known, "model", "left")
        .withColumn("state", state)
        .drop("__known")
    )


def refresh_queue(devices, urls, existing, older_than_days, now, limit: int | None = None, **kw) -> DataFrame:
    """The (model, url) pairs to fetch."""
    states = refresh_states(devices, urls, existing, older_than_days, now, **kw)
    queue = states.filter(F.col("state") == "queued").select("model", "url")
    return queue if limit is None else queue.limit(limit)
