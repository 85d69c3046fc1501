"""The nine catalogue hypothesis tests (H10) in one envelope."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import size_class
from ..operators.aggregates import group_summary
from ..operators.filters import form_filter
from ..operators.joins import join_dim, keep_groups
from ..schemas import Star
from ..session import store
from ..stats import hypothesis as h
from .analytics import top_brands


@dataclass(frozen=True)
class Spec:
    """What is measured, by which factors, over which dimensions."""

    value: str
    factors: tuple[str, ...]
    kind: str  # two_sample, one_way, two_way
    title: str
    dims: tuple[tuple[str, str, str], ...]  # (table, foreign key, column)
    levels: tuple[str, ...] = ()
    top_brands: int = 0


_DISPLAY = ("Display", "display_id", "display_size_inch")
_BRAND = ("Device_Name", "device_name_id", "brand")

TESTS = {
    "price_by_sim_and_size": Spec(
        "price_eur", ("sim_type", "size"), "two_way", "Price differs by SIM type and device size?",
        (("Sim", "sim_id", "sim_type"), _DISPLAY), ("nano", "micro", "mini"),
    ),
    "ppi_by_size": Spec(
        "ppi_density", ("size",), "two_sample", "PPI differs between small and large devices?",
        (_DISPLAY, ("Display", "display_id", "ppi_density")), ("small", "large"),
    ),
    "weight_android_vs_ios": Spec(
        "weight", ("os_name",), "two_sample", "Weight differs between Android and iOS?",
        (("OS", "os_id", "os_name"),), ("Android", "iOS"),
    ),
    "battery_by_brand_and_size": Spec(
        "battery_capacity_mah", ("brand", "size"), "two_way", "Battery capacity differs by brand and device size?",
        (_BRAND, _DISPLAY), top_brands=3,
    ),
    "price_by_brand_and_size": Spec(
        "price_eur", ("brand", "size"), "two_way", "Price differs by brand and device size?",
        (_BRAND, _DISPLAY), top_brands=3,
    ),
    "weight_by_size": Spec(
        "weight", ("size",), "two_sample", "Weight differs between small and large devices?",
        (_DISPLAY,), ("small", "large"),
    ),
    "battery_by_cpu": Spec(
        "battery_capacity_mah", ("cpu_core_count",), "one_way", "Battery capacity differs by CPU core count?",
        (("Platform", "platform_id", "cpu_core_count"),),
    ),
    "price_by_chipset": Spec(
        "price_eur", ("chipset_manufacturer",), "one_way", "Price differs by chipset maker?",
        (("Platform", "platform_id", "chipset_manufacturer"),),
    ),
    "price_by_main_camera": Spec(
        "price_eur", ("main_cameras_num",), "one_way", "Price differs by main-camera count?",
        (("Camera", "camera_id", "main_cameras_num"),),
    ),
}


def test_rows(t: Star, name: str, form_factor: str = "phone") -> DataFrame:
    """The rows a test looks at: its value and factors, all known."""
    spec = TESTS[name]
    rows = t.Device.filter(form_filter(form_factor))
    by_table: dict[tuple[str, str], list[str]] = {}
    for table, fk, col in spec.dims:
        by_table.setdefault((table, fk), []).append(col)
    for (table, fk), cols in by_table.items():
        rows = join_dim(rows, getattr(t, table), fk, cols)
    if spec.top_brands:
        rows = keep_groups(rows, top_brands(t, spec.top_brands, form_factor), "brand", bounded=True)
    if "size" in spec.factors:
        rows = rows.filter(F.col("display_size_inch").isNotNull())
        rows = rows.withColumn("size", size_class(F.col("display_size_inch")))
    rows = rows.select(spec.value, *spec.factors).dropna()
    if spec.levels:
        rows = rows.filter(F.col(spec.factors[0]).isin(*spec.levels))
    return rows


test_rows.__test__ = False


def test_groups(t: Star, name: str, form_factor: str = "phone") -> DataFrame:
    """n, mean, deviation and median of each group of a test."""
    spec = TESTS[name]
    return group_summary(test_rows(t, name, form_factor), list(spec.factors), spec.value)


test_groups.__test__ = False


def anova_rows(t: Star, name: str, form_factor: str = "phone") -> DataFrame:
    """The analysis-of-variance table of a test."""
    spec = TESTS[name]
    rows = h.anova(test_rows(t, name, form_factor), spec.value, list(spec.factors))
    return t.Device.sparkSession.createDataFrame(
        [(r["factor"], r["sum_sq"], r["df"], r["F"], r["p_value"]) for r in rows],
        "factor string, sum_sq double, df double, F double, p_value double",
    )


def _claims(spec: Spec) -> tuple[str, str, str]:
    """What a test looks at, its null and its alternative, in words."""
    by = " and ".join(spec.factors)
    about = f"{spec.value} compared across {by}" + (f" ({', '.join(spec.levels)})" if spec.levels else "")
    if spec.kind == "two_sample":
        return about, f"{spec.value} is distributed alike in both groups", f"{spec.value} differs between the groups"
    return about, f"mean {spec.value} is equal for all levels of {by}", f"mean {spec.value} differs for some level of {by}"


def run_test(t: Star, name: str, form_factor: str = "phone", alpha: float = 0.05) -> tuple[DataFrame, DataFrame]:
    """One row with the question, test, statistic, p-values, decision and table of effects; and the groups.

    The star is joined once: all statistics read the stored rows of the test.
    """
    spec = TESTS[name]
    effects, got = [], {}
    rows = store(test_rows(t, name, form_factor), "test-rows")
    if spec.kind == "two_sample":
        got = h.two_sample(rows, spec.value, spec.factors[0], *spec.levels)
        test, statistic, p = got["test"], got["statistic"], got["p_value"]
    else:
        effects = h.anova(rows, spec.value, list(spec.factors))
        first = effects[0] if effects else {"F": None, "p_value": None}
        test = "one-way ANOVA" if spec.kind == "one_way" else "two-way ANOVA"
        statistic, p = first["F"], first["p_value"]
    row = (spec.title, *_claims(spec), test, got.get("method"), statistic, p, alpha, h.decision(p, alpha), h.conclusion(p, alpha),
           got.get("shapiro_p_a"), got.get("shapiro_p_b"), [(r["factor"], r["sum_sq"], r["df"], r["F"], r["p_value"]) for r in effects])
    one = t.Device.sparkSession.createDataFrame(
        [row],
        "name string, description string, null_hypothesis string, alternative string, test string, method string, statistic double,"
        "p_value double, alpha double, decision string, conclusion string, shapiro_p_a double, shapiro_p_b double,"
        "effects array<struct<factor: string, sum_sq: double, df: double, f: double, p_value: double>>",
    )
    return one, group_summary(rows, list(spec.factors), spec.value)
