"""Lists of ids as text, in a number of parts that the caller chooses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def part_of(value: Column, parts: int) -> Column:
    """The part, 0 to ``parts - 1``, of a value, from the MD5 of its text; null is in part 0."""
    digest = F.conv(F.substring(F.md5(value.cast("string").cast("binary")), 1, 8), 16, 10).cast("bigint")
    return F.coalesce(F.pmod(digest, F.lit(parts)), F.lit(0)).cast("int")


def _dealt(counted: DataFrame, value: str, parts: int) -> DataFrame:
    """A row per part that has copies of a value: the first is in the value's own part, the others go round."""
    copies = F.when(F.col(value).isNull(), F.lit(1).cast("bigint")).otherwise(F.col("copies"))
    last = (F.least(copies, F.lit(parts)) - 1).cast("int")
    steps = counted.withColumn("copies", copies).withColumn("step", F.explode(F.sequence(F.lit(0), last)))
    place = F.pmod(part_of(F.col(value), parts) + F.col("step"), F.lit(parts)).cast("int")
    here = F.call_function("div", F.col("copies") + parts - 1 - F.col("step"), F.lit(parts))
    return steps.withColumn("part", place).withColumn("copies", here).drop("step")


def text_lists(
    counted: DataFrame, group: list[str], value: str, alias: str, parts: int, dealt: bool = False
) -> DataFrame:
    """Comma-separated values of each group, each repeated ``copies`` times, sorted as text.

    Every group has up to ``parts`` rows, whatever its size, one for each part that has values; choose
    them so that a part of the largest group fits a row. Null values are not listed. All copies of a value are in
    one part; ``dealt``, they go round all parts, so a value with very many copies is not in one row either.
    """
    placed = _dealt(counted, value, parts) if dealt else counted.withColumn("part", part_of(F.col(value), parts))
    repeated = F.array_repeat(F.col(value).cast("string"), F.col("copies").cast("int"))
    text = F.concat_ws(",", F.sort_array(F.flatten(F.collect_list(repeated))))
    return placed.groupBy(*group, "part").agg(text.alias(alias))
