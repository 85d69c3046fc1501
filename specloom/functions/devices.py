"""Device attributes: network, SIM, OS, chipset, cameras, status, form factor."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import contains_any, group_of, number, strip

__all__ = [
    "network_flag", "network_generations", "sim_type", "sim_count", "base_os", "os_version",
    "chipset_maker", "cpu_cores", "launch_status", "highest_mp", "video_res", "form_factor",
    "first_non_null", "count_from_populated", "BRAND_SPELLING", "GENERATIONS",
]

# Words and names the rules look for, in order of precedence.
SIM_TYPES = ("nano", "micro", "mini", "esim")
NO_SIM = ("no", "none", "-")
LONG_OS_NAMES = ("Wear OS", "Blue OS", "Firefox OS")
OS_SPELLING = {
    "Harmony": "HarmonyOS",
    "Android-based": "Android",
    "Symbian^3": "Symbian",
    "Firefox": "Firefox OS",
}
BRAND_SPELLING = {"alcatel": "Alcatel"}
CHIPSET_MAKERS = ("Qualcomm", "Mediatek", "Apple", "Samsung", "Exynos", "Intel Atom")
CORE_WORDS = {"dual": 2, "quad": 4, "hexa": 6, "octa": 8, "deca": 10}
LEGACY_MP = {"qcif": 0.025, "qvga": 0.077, "cif": 0.101, "vga": 0.307, "svga": 0.480}
WATCH_WORDS = ("watch", "gear ", "fitbit")
TABLET_WORDS = (
    "tab ", "tab a", "tab s", "tab pro", "tab plus", "tab active",
    "ipad", "matepad", "mediapad", "mipad", "mi pad",
)
BAND_WORDS = ("band", "mi band", "smart band")
GENERATIONS = {
    "2G": ("GSM", "CDMA"),
    "3G": ("HSPA", "EVDO", "CDMA2000"),
    "4G": ("LTE",),
    "5G": ("5G",),
}


def network_flag(c: Column) -> Column:
    """1 where the band text exists."""
    return c.isNotNull().cast("int")


def network_generations(c: Column) -> dict[str, Column]:
    """One flag per generation; a text may carry several."""
    return {g: contains_any(c, words) for g, words in GENERATIONS.items()}


def sim_type(c: Column) -> Column:
    """C11."""
    text = F.lower(strip(c))
    label = F.when(c.isNull(), None).when(text.isin(*NO_SIM), "none")
    for kind in SIM_TYPES:
        label = label.when(text.contains(kind), kind)
    return label.otherwise("unknown")


def sim_count(c: Column) -> Column:
    """Triple beats dual beats single; any other SIM or 'yes' is single."""
    text = F.lower(strip(c))
    label = F.when(c.isNull(), None).when(text.isin(*NO_SIM), "none")
    for word in ("triple", "dual", "single"):
        label = label.when(text.contains(word), word)
    return label.when(text.contains("sim") | (text == "yes"), "single").otherwise("none")


def base_os(c: Column) -> Column:
    """A known long name at the start, else the first word in its usual spelling."""
    text = strip(c)
    word = F.regexp_replace(F.get(F.split(text, " "), F.lit(0)), r"[,.;:]+$", "")
    long_names = [F.when(text.rlike(rf"^{n}($|[ ,])"), F.lit(n)) for n in LONG_OS_NAMES]
    known = [F.when(word == old, F.lit(new)) for old, new in OS_SPELLING.items()]
    return F.coalesce(*long_names, *known, word)


def os_version(c: Column) -> Column:
    """C14."""
    return group_of(c, r"(?U)\b(\d+(?:\.\d+)*)\b")


def chipset_maker(c: Column) -> Column:
    """First known maker in the text; NULL counts as Other."""
    return F.coalesce(*[F.when(c.contains(m), F.lit(m)) for m in CHIPSET_MAKERS], F.lit("Other"))


def cpu_cores(c: Column) -> Column:
    """C17: core count word; any other text means one core."""
    word = F.lower(group_of(c, r"(?iU)(Dual|Quad|Hexa|Octa|Deca)-core"))
    known = [F.when(word == w, F.lit(n)) for w, n in CORE_WORDS.items()]
    return F.when(strip(c) != "", F.coalesce(*known, F.lit(1)))


def launch_status(c: Column) -> Column:
    """C19."""
    text = F.lower(strip(c))
    return (
        F.when(text.startswith("available"), "Available")
        .when(text.contains("discontinued"), "Discontinued")
        .when(text.contains("cancel"), "Canceled")
        .when(contains_any(text, ("rumor", "coming")), "Rumored")
    )


def highest_mp(c: Column) -> Column:
    """Largest megapixel number, else the best legacy class, else the text itself."""
    found = F.regexp_extract_all(c, F.lit(r"(?U)(\d+(?:\.\d+)?)\s*MP"), F.lit(1))
    legacy = F.array_max(
        F.array(*[F.when(F.lower(c).rlike(rf"(?U)\b{k}\b"), F.lit(v)) for k, v in LEGACY_MP.items()])
    )
    return F.coalesce(F.array_max(F.transform(found, number)).cast("string"), legacy.cast("string"), c)


def video_res(c: Column) -> Column:
    """The part before '@', trimmed when there is one."""
    return F.when(c.contains("@"), strip(F.substring_index(c, "@", 1))).otherwise(c)


def form_factor(c: Column) -> Column:
    """Watch beats tablet beats band; the rest are phones, no name is other."""
    text = F.lower(c)
    return (
        F.when(c.isNull(), "other")
        .when(contains_any(text, WATCH_WORDS), "watch")
        .when(contains_any(text, TABLET_WORDS), "tablet")
        .when(contains_any(text, BAND_WORDS), "band")
        .otherwise("phone")
    )


def first_non_null(*cols: Column) -> Column:
    """R07."""
    return F.coalesce(*cols)


def count_from_populated(counts: dict[str, int]) -> Column:
    """Count that belongs to the last populated column, 0 when all are empty."""
    picks = [F.when(F.col(f"`{c}`").isNotNull(), F.lit(n)) for c, n in counts.items()]
    return F.coalesce(*reversed(picks), F.lit(0))
