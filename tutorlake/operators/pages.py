"""Page visits: hits, funnel rates and visits by province."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.functions.numbers import ipv4_number, percent_text

# The funnel's pages in order; each one's rate is relative to the page before it.
FUNNEL = ["1", "2", "3"]
FIRST_RATE = "100%"
ADDRESSES_PER_BUCKET = 65536


def page_hits(visits: DataFrame) -> DataFrame:
    """Visits per page, for batch and stream."""
    return visits.groupBy("page_id").agg(F.count("page_id").alias("num"))


def page_steps(visits: DataFrame) -> DataFrame:
    """Visits per page together with the page before and after, for batch and stream."""
    return visits.groupBy("last_page_id", "page_id", "next_page_id").agg(F.count("page_id").alias("num"))


def funnel(hits: DataFrame, pages: list[str] = FUNNEL) -> DataFrame:
    """Page counts with the rate of each funnel page as percent text.

    The first page is 100%; a page whose predecessor has no visits is 0%; pages outside the funnel
    have no rate. Each page looks up the count of the page before it.
    """
    before = F.lit(None).cast("string")
    for earlier, page in zip(pages, pages[1:]):
        before = F.when(F.col("page_id") == page, earlier).otherwise(before)
    earlier_hits = hits.select(F.col("page_id").alias("before"), F.col("num").alias("before_num"))
    joined = hits.withColumn("before", before).join(earlier_hits, "before", "left")
    ratio = F.try_divide(F.col("num").cast("double"), F.col("before_num"))
    rate = F.when(F.col("page_id") == pages[0], FIRST_RATE).when(F.col("before").isNotNull(), percent_text(ratio))
    return joined.select("page_id", "num", rate.alias("jump_rate"))


def range_starts(ranges: DataFrame) -> DataFrame:
    """Address ranges (``lo``, ``hi``, ``province``) cut at buckets of 65,536 addresses.

    There are 65,536 buckets in all, so ranges that do not overlap give at most that many extra rows.
    """
    size = F.lit(ADDRESSES_PER_BUCKET).cast("bigint")
    first = F.call_function("div", F.col("lo"), size)
    last = F.call_function("div", F.col("hi"), size)
    cut = ranges.withColumn("bucket", F.explode(F.sequence(first, last)))
    return cut.select("bucket", F.greatest(F.col("lo"), F.col("bucket") * size).alias("position"), "hi", "province")


def province_counts(visits: DataFrame, ranges: DataFrame) -> DataFrame:
    """Visits per province; addresses outside all ranges count under null. Ranges do not overlap.

    Visits are counted per address first. After that a bucket has at most 65,536 addresses however
    many visits it has, and as many range starts. Both are sorted together and each address takes the
    last range that starts at or before it, so no pairs are formed, no prefix is hot, and the ranges
    need not be small enough to broadcast.
    """
    size = F.lit(ADDRESSES_PER_BUCKET).cast("bigint")
    per_address = visits.groupBy(ipv4_number(F.col("ip")).alias("position")).agg(F.count(F.lit(1)).alias("visits"))
    placed = per_address.withColumn("bucket", F.call_function("div", F.col("position"), size))
    starts = range_starts(ranges).select("bucket", "position", F.struct("hi", "province").alias("range"))
    mixed = placed.unionByName(starts, allowMissingColumns=True)

    range_first = Window.partitionBy("bucket").orderBy("position", F.col("visits").isNotNull())
    latest = F.last("range", ignorenulls=True).over(range_first.rowsBetween(Window.unboundedPreceding, 0))
    found = mixed.withColumn("latest", latest).where(F.col("visits").isNotNull())
    province = F.when(F.col("position") <= F.col("latest.hi"), F.col("latest.province"))
    return found.groupBy(province.alias("province")).agg(F.sum("visits").alias("num"))


def add_counts(history: DataFrame, batch: DataFrame, key: str = "province") -> DataFrame:
    """Totals so far plus a batch's counts; keys may be on either side only. Null is a key too."""
    old = history.select(F.col(key).alias("old_key"), F.col("num").alias("old_num"))
    joined = old.join(batch, F.col("old_key").eqNullSafe(F.col(key)), "full")
    total = F.coalesce("old_num", F.lit(0)) + F.coalesce("num", F.lit(0))
    return joined.select(F.coalesce(key, "old_key").alias(key), total.alias("num"))


def top_provinces(counts: DataFrame, places: int = 3) -> DataFrame:
    """The provinces with most visits; equal counts go by name."""
    return counts.orderBy(F.desc("num"), F.asc_nulls_last("province")).limit(places)
