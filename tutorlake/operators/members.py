"""Member wide table and the day's payments."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.functions.days import OPEN_END, day_to_date_text
from tutorlake.functions.numbers import MONEY_SUM

MEMBER_KEY = ["uid", "dn"]


def left_chain(
    member: DataFrame,
    regtype: DataFrame,
    base_ad: DataFrame,
    base_website: DataFrame,
    payment: DataFrame,
    vip_level: DataFrame,
) -> DataFrame:
    """Members with registration, ad, site, payments and level, one row per payment.

    ``siteid`` and ``vip_id`` are those of the site and level rows, so they are null when nothing
    matches. No side is forced into a broadcast: ads, sites and levels are broadcast when their size
    is below the session's threshold, and joined by shuffle (with skew splitting) beyond it.
    """
    site = base_website.withColumnRenamed("siteid", "matched_siteid").withColumnRenamed("dn", "site_dn")
    level = vip_level.withColumnRenamed("vip_id", "matched_vip_id").withColumnRenamed("dn", "vip_dn")
    on_site = (F.col("siteid") == F.col("matched_siteid")) & (F.col("dn") == F.col("site_dn"))
    on_level = (F.col("vip_id") == F.col("matched_vip_id")) & (F.col("dn") == F.col("vip_dn"))
    return (
        member.join(regtype, MEMBER_KEY, "left")
        .join(base_ad, ["ad_id", "dn"], "left")
        .join(site, on_site, "left")
        .drop("siteid", "site_dn")
        .withColumnRenamed("matched_siteid", "siteid")
        .join(payment, MEMBER_KEY, "left")
        .join(level, on_level, "left")
        .drop("vip_id", "vip_dn")
        .withColumnRenamed("matched_vip_id", "vip_id")
    )


def _one_per_member(rows: DataFrame) -> DataFrame:
    """One whole row per member: the smallest one, so that reruns pick the same."""
    others = [c for c in rows.columns if c not in MEMBER_KEY]
    chosen = F.min(F.struct(*others)).alias("chosen")
    return rows.groupBy(*MEMBER_KEY).agg(chosen).select(*MEMBER_KEY, "chosen.*")


LEVEL_KEY = [*MEMBER_KEY, "vip_id"]


def paid_by_level(payment: DataFrame, *more: str) -> DataFrame:
    """Money per member and level (and ``more`` columns): ``paid``, ``payments`` and how many of them have an ``amounts``.

    The counts make it possible to add such sums up and to take some of them off again: ``paid`` is null
    without amounts, and a member without payments has no row.
    """
    return payment.groupBy(*more, *LEVEL_KEY).agg(
        F.sum("paymoney").cast(MONEY_SUM).alias("paid"),
        F.count(F.lit(1)).alias("payments"),
        F.count("paymoney").alias("amounts"),
    )


def added_levels(sums: DataFrame) -> DataFrame:
    """Several sums of :func:`paid_by_level` added up; those to take off have all three numbers negated."""
    added = sums.groupBy(*LEVEL_KEY).agg(
        F.sum("paid").cast(MONEY_SUM).alias("paid"), F.sum("payments").alias("payments"), F.sum("amounts").alias("amounts")
    )
    return added.where(F.col("payments") > 0).withColumn("paid", F.when(F.col("amounts") > 0, F.col("paid")))


def payment_summary(payment: DataFrame, vip_level: DataFrame) -> DataFrame:
    """Money and level of each member who paid; see :func:`summary_of_levels`."""
    return summary_of_levels(paid_by_level(payment), vip_level)


def summary_of_levels(per_level: DataFrame, vip_level: DataFrame) -> DataFrame:
    """Money and level of each member who paid, from sums per member and level.

    Money is summed per member and level before the level table is joined, and in a second step per
    member, so neither a member nor a level with very many payments reaches the join unreduced.
    """
    level = vip_level.withColumnRenamed("vip_id", "matched_vip_id").withColumnRenamed("dn", "vip_dn")
    matched = (F.col("vip_id") == F.col("matched_vip_id")) & (F.col("dn") == F.col("vip_dn"))
    joined = per_level.join(level, matched, "left").drop("vip_id", "vip_dn")

    def of_first_level(column: str) -> Column:
        return F.min_by(column, "matched_vip_id").alias(column)

    return joined.groupBy(*MEMBER_KEY).agg(
        F.sum("paid").cast(MONEY_SUM).alias("paymoney"),
        F.min("matched_vip_id").alias("vip_id"),
        F.max("vip_level").alias("vip_level"),
        F.min("vip_start_time").alias("vip_start_time"),
        F.max("vip_end_time").alias("vip_end_time"),
        F.max("vip_last_modify_time").alias("vip_last_modify_time"),
        F.max("vip_next_level").alias("vip_next_level"),
        of_first_level("vip_max_free"),
        of_first_level("vip_min_free"),
        of_first_level("vip_operator"),
    )


def member_wide(
    member: DataFrame,
    regtype: DataFrame,
    base_ad: DataFrame,
    base_website: DataFrame,
    payment: DataFrame,
    vip_level: DataFrame,
) -> DataFrame:
    """One wide row per member and day.

    Each large input is reduced to one row per member before joining. The reductions and both joins
    share the (uid, dn) partitioning, so every large input is shuffled once, and repeated registration
    rows cannot multiply the money. ``member`` holds one day.
    """
    return wide_of_sums(member, regtype, base_ad, base_website, paid_by_level(payment), vip_level)


def wide_of_sums(
    member: DataFrame,
    regtype: DataFrame,
    base_ad: DataFrame,
    base_website: DataFrame,
    per_level: DataFrame,
    vip_level: DataFrame,
) -> DataFrame:
    """:func:`member_wide` from sums per member and level in place of the payments."""
    reduced = _one_per_member(member).join(_one_per_member(regtype), MEMBER_KEY, "left")
    paid = reduced.join(summary_of_levels(per_level, vip_level), MEMBER_KEY, "left")
    site = base_website.withColumnRenamed("siteid", "matched_siteid").withColumnRenamed("dn", "site_dn")
    on_site = (F.col("siteid") == F.col("matched_siteid")) & (F.col("dn") == F.col("site_dn"))
    return (
        paid.join(base_ad, ["ad_id", "dn"], "left")
        .join(site, on_site, "left")
        .drop("siteid", "site_dn")
        .withColumnRenamed("matched_siteid", "siteid")
    )


def day_payments(payment: DataFrame, vip_level: DataFrame, from_day: str | None = None) -> DataFrame:
    """Money and best level per member, site and day, as open history rows.

    Payments without a matching level do not count. Money is summed per level first, as above.
    """
    chosen = payment if from_day is None else payment.where(F.col("dt") >= F.lit(from_day))
    per_level = chosen.groupBy(*MEMBER_KEY, "vip_id", "dt").agg(F.sum("paymoney").alias("paid"))
    joined = per_level.join(vip_level.select("vip_id", "dn", "vip_level"), ["vip_id", "dn"])
    return (
        joined.groupBy(*MEMBER_KEY, "dt")
        .agg(F.sum("paid").cast(MONEY_SUM).alias("paymoney"), F.max("vip_level").alias("vip_level"))
        .select(
            "uid",
            "paymoney",
            "vip_level",
            day_to_date_text(F.col("dt")).alias("start_time"),
            F.lit(OPEN_END).alias("end_time"),
            "dn",
        )
    )
