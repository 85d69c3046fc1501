"""A bounded bit table that sieves rows before a semi-join."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Bits of the table. They travel as at most BITS / 64 rows of two numbers, whatever the input;
#: a full table lets all rows pass on to the join.
BITS = 1 << 24


def likely(rows: DataFrame, key: str, wanted: DataFrame) -> DataFrame:
    """Rows whose long `key` may occur in `wanted`; all that do are kept, others mostly go."""
    place = F.pmod(F.xxhash64(F.col(key).cast("long")), F.lit(BITS))
    words = wanted.select(place.alias("__p")).groupBy(F.shiftright("__p", 6).alias("__word")).agg(
        F.bit_or(F.expr("shiftleft(1L, cast(__p & 63 as int))")).alias("__bits"))
    sieved = rows.withColumn("__p", place).withColumn("__word", F.shiftright("__p", 6)).join(F.broadcast(words), "__word")
    return sieved.where("shiftright(__bits, cast(__p & 63 as int)) & 1 = 1").select(rows.columns)
