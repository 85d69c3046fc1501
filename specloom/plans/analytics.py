"""Catalogue summaries, distributions, rankings and trends."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import network_generations
from ..operators import aggregates as agg
from ..operators.filters import form_filter
from ..operators.joins import join_dim, keep_groups, left_join_dim
from ..operators.ranking import best_per_key, best_per_top_groups
from ..operators.reshape import long_values
from ..schemas import Star
from ..stats.hypothesis import ci_moments, t_interval
from ..stats.moments import correlation, pair_moments

# The quantitative columns of the correlation matrix, then of the distributions.
CORRELATED = [
    "weight", "length", "width", "height", "volume", "battery_mah", "price_eur", "display_size_inch",
    "screen_to_body_ratio", "resolution_pixels", "ppi_density", "cpu_core_count", "internal_storage_gb", "ram_gb",
]
DISTRIBUTED = [
    "weight", "length", "width", "height", "volume", "battery_mah", "price_eur", "display_size_inch",
    "screen_to_body_ratio", "ppi_density", "ram_gb", "internal_storage_gb",
]


def _devices(t: Star, form_factor: str) -> DataFrame:
    return t.Device.filter(form_filter(form_factor))


def _named(t: Star, form_factor: str, *cols: str) -> DataFrame:
    return join_dim(_devices(t, form_factor), t.Device_Name, "device_name_id", list(cols) or ["brand"])


def brand_summary(t: Star, form_factor: str = "phone") -> DataFrame:
    """A01."""
    priced = _named(t, form_factor).filter(F.col("price_eur").isNotNull())
    return (
        priced.groupBy("brand")
        .agg(
            F.count("*").alias("device_count"), F.round(F.avg("price_eur"), 2).alias("avg_price_eur"),
            F.min("year").alias("first_year"), F.max("year").alias("last_year"),
        )
        .filter(F.col("device_count") >= 3)
        .orderBy(F.desc("device_count"), "brand")
    )


def annual_launches(t: Star, until: int, form_factor: str = "phone", since: int = 2010) -> DataFrame:
    """A02 up to the year `until` (the current one, for a report): devices without a platform count as launches; averages skip unknowns."""
    rows = _devices(t, form_factor).filter(F.col("year").between(since, until))
    rows = left_join_dim(rows, t.Platform, "platform_id", ["ram_gb", "internal_storage_gb"])
    return (
        rows.groupBy("year")
        .agg(
            F.count("*").alias("launches"), F.round(F.avg("price_eur"), 2).alias("avg_price_eur"),
            F.round(F.avg("battery_capacity_mah"), 0).alias("avg_battery_mah"),
            F.round(F.avg("ram_gb"), 2).alias("avg_ram_gb"),
            F.round(F.avg("internal_storage_gb"), 2).alias("avg_storage_gb"),
        )
        .orderBy("year")
    )


def _count_by(rows: DataFrame, key: str, limit: int | None = None, by_key: bool = False) -> DataFrame:
    counts = rows.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("device_count"))
    counts = counts.orderBy(key) if by_key else counts.orderBy(F.desc("device_count"), F.asc(key))
    return counts if limit is None else counts.limit(limit)


def chipset_popularity(t: Star, form_factor: str = "phone", limit: int = 15) -> DataFrame:
    """A03."""
    rows = join_dim(_devices(t, form_factor), t.Platform, "platform_id", ["chipset_manufacturer"])
    return _count_by(rows, "chipset_manufacturer", limit)


def price_vs_battery(t: Star, form_factor: str = "phone") -> DataFrame:
    """One point per device with both values."""
    rows = _named(t, form_factor).dropna(subset=["price_eur", "battery_capacity_mah"])
    rows = join_dim(rows, t.Platform, "platform_id", ["ram_gb"])
    return rows.select("brand", "price_eur", F.col("battery_capacity_mah").alias("battery_mah"), "ram_gb", "year")


def ram_distribution(t: Star, form_factor: str = "phone") -> DataFrame:
    """A05."""
    return _count_by(join_dim(_devices(t, form_factor), t.Platform, "platform_id", ["ram_gb"]), "ram_gb", by_key=True)


def network_technology(t: Star, form_factor: str = "phone") -> DataFrame:
    """Devices per generation and their share. A device may count in several."""
    rows = join_dim(_devices(t, form_factor), t.Network_Technology, "network_technology_id", ["technology"])
    flags = network_generations(F.col("technology"))
    one = rows.agg(F.count("*").alias("total"), *[F.count_if(c).alias(g) for g, c in flags.items()])
    pct = F.coalesce(F.round(F.try_divide(100.0 * F.col("device_count"), F.col("total")), 2), F.lit(0.0))
    return one.unpivot(["total"], list(flags), "generation", "device_count").select(
        "generation", "device_count", pct.alias("pct")
    )


def sim_type_distribution(t: Star, form_factor: str = "phone") -> DataFrame:
    """A07."""
    return _count_by(join_dim(_devices(t, form_factor), t.Sim, "sim_id", ["sim_type"]), "sim_type")


def top_android_versions(t: Star, limit: int = 10, form_factor: str = "phone") -> DataFrame:
    """A08."""
    rows = join_dim(_devices(t, form_factor), t.OS.filter("os_name = 'Android'"), "os_id", ["os_version"])
    return _count_by(rows, "os_version", limit)


def top_expensive(t: Star, limit: int = 50, form_factor: str = "phone") -> DataFrame:
    """The dearest configuration of each product, then the dearest products."""
    rows = _named(t, form_factor, "brand", "model")
    rows = left_join_dim(rows, t.OS, "os_id", ["os_name", "os_version"]).select(
        "brand", "model", "year", "price_eur", "os_name", "os_version"
    )
    ties = [F.asc("brand"), F.asc("model"), F.asc("year"), F.asc_nulls_last("os_name"), F.asc_nulls_last("os_version")]
    return best_per_key(rows, ["brand", "model"], "price_eur", limit, ties)


def top_brands(t: Star, n: int, form_factor: str = "phone") -> DataFrame:
    """A14 on brands."""
    return agg.top_groups(_named(t, form_factor), "brand", n)


def best_per_top_brand(t: Star, n: int = 5, form_factor: str = "phone") -> DataFrame:
    """The dearest product of each of the n largest brands."""
    rows = _named(t, form_factor, "brand", "model").select("brand", "model", "price_eur")
    return best_per_top_groups(rows, top_brands(t, n, form_factor), "brand", "price_eur", [F.asc("model")])


def ppi_trend(t: Star, form_factor: str = "phone", brands: int = 3) -> DataFrame:
    """A09."""
    rows = keep_groups(_named(t, form_factor), top_brands(t, brands, form_factor), "brand", bounded=True)
    rows = join_dim(rows, t.Display, "display_id", ["ppi_density"]).filter(F.col("ppi_density").isNotNull())
    return (
        rows.groupBy("brand", "year")
        .agg(F.round(F.avg("ppi_density"), 2).alias("avg_ppi"), F.count("*").alias("device_count"))
        .orderBy("year", "brand")
    )


def quantitative_base(t: Star, form_factor: str = "phone") -> DataFrame:
    rows = _devices(t, form_factor).withColumn("battery_mah", F.col("battery_capacity_mah"))
    rows = left_join_dim(rows, t.Display, "display_id",
                         ["display_size_inch", "screen_to_body_ratio", "resolution_pixels", "ppi_density"])
    rows = left_join_dim(rows, t.Platform, "platform_id", ["cpu_core_count", "internal_storage_gb", "ram_gb"])
    return rows.select(*CORRELATED)


def correlation_matrix(t: Star, form_factor: str = "phone", digits: int = 3) -> DataFrame:
    """A10: Pearson r over pairwise complete rows, long form; undefined is NULL.

    Masked moments of all pairs come out of one pass, whichever columns have gaps.
    """
    r = correlation(pair_moments(quantitative_base(t, form_factor), CORRELATED))
    return r.select("column_a", "column_b", F.round("r", digits).alias("r"))


def quantitative_distributions(t: Star, form_factor: str = "phone", bins: int = 20) -> DataFrame:
    """A histogram per column, all columns in one job. Charts need bins, not raw rows."""
    rows = long_values(quantitative_base(t, form_factor), DISTRIBUTED)
    return agg.histogram(rows, "value", bins, ["column"])


def quantitative_quartiles(t: Star, form_factor: str = "phone") -> DataFrame:
    """Box-plot numbers per column."""
    return agg.quartiles(long_values(quantitative_base(t, form_factor), DISTRIBUTED), "value", ["column"])


def available_years(t: Star, form_factor: str = "phone") -> DataFrame:
    """A11."""
    return _devices(t, form_factor).filter("year IS NOT NULL").select("year").distinct().orderBy(F.desc("year"))


def price_ci_by_brand(t: Star, year: int | None = None, alpha: float = 0.05, form_factor: str = "phone") -> DataFrame:
    """Prices of one year (default: the latest) for the five largest brands."""
    latest = agg.resolve_year(_devices(t, form_factor), year).scalar()
    rows = _named(t, form_factor).filter(F.col("year") == latest)
    moments = ci_moments(rows, "brand", "price_eur", top_brands(t, 5, form_factor))
    return t_interval(moments, alpha).withColumn("year", latest)


def battery_ci_by_brand(t: Star, alpha: float = 0.05, form_factor: str = "phone") -> DataFrame:
    """Battery capacity over all years."""
    moments = ci_moments(_named(t, form_factor), "brand", "battery_capacity_mah", top_brands(t, 5, form_factor))
    return t_interval(moments, alpha)
