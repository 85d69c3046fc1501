"""Generic text rules: trimming, numbers in text, lookup keys, list parsing."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

__all__ = [
    "group_of", "number", "strip", "clean_text", "first_number", "first_int", "max_number",
    "lookup_key", "row_signature", "is_sentinel", "comparable", "split_list", "sensor_list",
    "canonical", "contains_any", "is_block_page", "is_stale", "let",
]

# Stand-in for a missing key part, texts that mean "no value",
# phrases of a block page, and the timestamp layout.
MISSING_KEY = "__missing__"
SENTINELS = ("", "nan", "unknown", "none")
BLOCK_MARKERS = ("Just a moment", "cf-challenge", "Attention Required", "Access denied", "hcaptcha")
STAMP_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"
# The code points of Unicode's White_Space property.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), 0x20, 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))


def group_of(c: Column, pattern: str, group: int = 1) -> Column:
    """A capture group of the first match, NULL where nothing matched."""
    return F.nullif(F.regexp_extract(c, pattern, group), F.lit(""))


def number(c: Column) -> Column:
    """Text to double; NULL instead of an ANSI error when it is not a number."""
    return c.try_cast("double")


def strip(c: Column) -> Column:
    """Trim every Unicode space, not only U+0020."""
    return F.btrim(c, F.lit(SPACES))


def contains_any(c: Column, words) -> Column:
    return reduce(lambda a, b: a | b, [c.contains(w) for w in words])


def clean_text(c: Column, lowercase: bool = False) -> Column:
    """Collapse spaces, trim, blank or 'nan' to NULL."""
    text = strip(F.regexp_replace(c.cast("string"), r"(?U)\s+", " "))
    text = F.when(~F.lower(text).isin("", "nan"), text)
    return F.lower(text) if lowercase else text


def first_number(c: Column) -> Column:
    """First signed number in a text, as double."""
    return number(group_of(c.cast("string"), r"(?U)-?\d+(\.\d+)?", 0))


def first_int(c: Column) -> Column:
    """The same, cut to an integer toward zero."""
    return first_number(c).try_cast("long")


def max_number(c: Column) -> Column:
    """Largest number in a text."""
    found = F.regexp_extract_all(c.cast("string"), F.lit(r"(?U)-?\d+(?:\.\d+)?"), F.lit(0))
    return F.array_max(F.transform(found, number))


def let(value: Column, body) -> Column:
    """`body(v)` with v bound to a value that is computed once, however often it is used.

    Keeps generated code small where an expression would otherwise be repeated.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


# Text of a number: whole numbers as integers, others with 6 significant digits.
#
# Java formats the shortest decimal text of a double (28565.55 would round up),
# while the key format rounds the stored binary value (a little below, so it rounds
# down). They differ only where the value has seven digits and the last is a 5. For
# those, x * 10^k minus the seven-digit integer, with the exact product error from
# splitting both factors in halves, tells the side the stored value lies on, and
# the value is moved one unit of its seventh digit that way. Kept as SQL text: one
# expression to parse instead of hundreds of Column calls.
_TIE_SIDE = """
    transform(array(named_struct('x', 134217729D * x - (134217729D * x - x),
                                 'p', 134217729D * t.p - (134217729D * t.p - t.p))), h ->
      sign((x * t.p - t.d)
           + (((h.x * h.p - x * t.p) + h.x * (t.p - h.p) + (x - h.x) * h.p) + (x - h.x) * (t.p - h.p))))[0]"""
_OFF_TIE = f"""
    transform(array(format_string('%.6e', x)), s ->
      CASE WHEN try_cast(s AS DOUBLE) = x AND substring_index(s, 'e', 1) LIKE '%5'
                AND try_cast(substring_index(s, 'e', -1) AS INT) BETWEEN -16 AND 6
      THEN transform(array(named_struct(
             'd', try_cast(replace(substring_index(s, 'e', 1), '.', '') AS BIGINT),
             'k', 6 - try_cast(substring_index(s, 'e', -1) AS INT),
             'p', try_cast(concat('1e', 6 - try_cast(substring_index(s, 'e', -1) AS INT)) AS DOUBLE))), t ->
             transform(array({_TIE_SIDE}), side ->
               try_cast(concat(t.d + CAST(CASE WHEN side <> 0 THEN side WHEN (abs(t.d) DIV 10) % 2 = 0 THEN -sign(x)
                                               ELSE sign(x) END AS BIGINT), 'e', -t.k) AS DOUBLE))[0])[0]
      ELSE x END)[0]"""
# Values of everyday size take a short way: scale to six integer digits, round, and
# divide back; the quotient's shortest text is the wanted one. Anything near a
# rounding tie, tiny or huge goes through the formatter.
_SCALE = """CASE WHEN abs(x) < 1e-3 THEN NULL WHEN abs(x) < 1e-2 THEN 1e8 WHEN abs(x) < 1e-1 THEN 1e7
    WHEN abs(x) < 1e0 THEN 1e6 WHEN abs(x) < 1e1 THEN 1e5 WHEN abs(x) < 1e2 THEN 1e4 WHEN abs(x) < 1e3 THEN 1e3
    WHEN abs(x) < 1e4 THEN 1e2 WHEN abs(x) < 1e5 THEN 1e1 WHEN abs(x) < 1e6 THEN 1e0 END"""
_FORMATTED = f"""regexp_replace(regexp_replace(format_string('%.6g', {_OFF_TIE}),
    '([.][0-9]*?)0+(?=$|e)', '$1'), '[.](?=$|e)', '')"""
_NUMBER_TEXT = f"""
    x -> CASE WHEN abs(x) >= 9e15 THEN format_string('%.0f', x)
              WHEN x = floor(x) THEN CAST(CAST(x AS BIGINT) AS STRING)
              ELSE transform(array({_SCALE}), q ->
                CASE WHEN abs(x * q - floor(x * q) - 0.5D) > 1e-5 AND abs(rint(x * q)) < 1e6
                     THEN CASE WHEN rint(x * q) % q = 0 THEN CAST(CAST(rint(x * q) / q AS BIGINT) AS STRING)
                               ELSE CAST(rint(x * q) / q AS STRING) END
                     ELSE {_FORMATTED} END)[0] END"""


def _number_key(value: Column) -> Column:
    return F.get(F.call_function("transform", F.array(value), F.expr(_NUMBER_TEXT)), F.lit(0))


def lookup_key(c: Column, dtype: str) -> Column:
    """One text per key part, equal for every spelling of the same value.

    `dtype` is the Spark type name of `c`; a text that reads as a number is
    keyed as that number.
    """
    if dtype in ("tinyint", "smallint", "int", "bigint"):
        key = c.cast("string")
    elif dtype in ("double", "float") or dtype.startswith("decimal"):
        known = c.isNotNull() & ~F.isnan(c.cast("double"))
        key = F.when(known, _number_key(c.cast("double")))
    else:
        text = strip(c.cast("string"))
        plain = text.rlike(r"^[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?$")
        key = F.when(plain, _number_key(number(text))).otherwise(F.lower(text))
    return F.coalesce(key, F.lit(MISSING_KEY))


def row_signature(df, cols: list[str]) -> Column:
    """SHA-256 over the '|'-joined key texts (no part is NULL, so none is skipped)."""
    kinds = dict(df.dtypes)
    return F.sha2(F.concat_ws("|", *[lookup_key(F.col(f"`{c}`"), kinds[c]) for c in cols]), 256)


def is_sentinel(c: Column, dtype: str = "string") -> Column:
    """Missing, or a text that stands for missing. Numbers: NULL only."""
    if dtype != "string":
        return c.isNull()
    return c.isNull() | F.lower(strip(c)).isin(*SENTINELS)


def comparable(c: Column, dtype: str) -> Column:
    """Numbers (also numeric text) half-even rounded to 4 places, all else unchanged."""
    if dtype == "boolean":
        return c.cast("string")
    if dtype == "string":
        return F.coalesce(F.bround(number(c), 4).cast("string"), c)
    if dtype in ("tinyint", "smallint", "int", "bigint", "float", "double") or dtype.startswith("decimal"):
        return F.bround(c.cast("double"), 4).cast("string")
    return c.cast("string")


def split_list(c: Column) -> Column:
    """Split on commas, parts untouched."""
    return F.split(c, ",")


def sensor_list(c: Column) -> Column:
    """A list literal or comma list to clean lower-case items, first spelling kept."""
    text = strip(c)
    item = r"""('[^']*'|"[^"]*")"""
    literal = text.rlike(rf"^[\[\(\{{]\s*{item}(\s*,\s*{item})*\s*,?\s*[\]\)\}}]$") | text.rlike(rf"^{item}$")
    parts = F.when(literal, F.regexp_extract_all(text, F.lit(item), F.lit(1))).otherwise(
        F.split(F.regexp_replace(text, r"^[\[\]]+|[\[\]]+$", ""), ",")
    )
    cleaned = F.transform(
        parts, lambda p: clean_text(F.regexp_replace(strip(p), r"""^['"]+|['"]+$""", ""), lowercase=True)
    )
    kept = F.array_distinct(F.filter(cleaned, lambda p: p.isNotNull()))
    return F.coalesce(kept, F.array().cast("array<string>"))


def canonical(c: Column, spelling: dict[str, str]) -> Column:
    """Replace known spellings, leave the rest."""
    return F.coalesce(*[F.when(c == old, F.lit(new)) for old, new in spelling.items()], c)


def is_block_page(c: Column, markers=BLOCK_MARKERS) -> Column:
    """Does the body hold any marker phrase?"""
    return contains_any(c, markers)


def is_stale(c: Column, older_than_days: int | None, now: Column) -> Column:
    """No threshold is never stale; a missing or bad stamp always is; else strictly older."""
    if older_than_days is None:
        return F.lit(False)
    stamp = F.try_to_timestamp(c, F.lit(STAMP_FORMAT))
    return F.coalesce(stamp < now - F.expr(f"INTERVAL {int(older_than_days)} DAYS"), F.lit(True))
