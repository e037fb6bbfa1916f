"""Reports over the member wide table."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

# Report tables and the column each one counts by.
COUNT_REPORTS = {
    "ads_register_appregurlnum": "appregurl",
    "ads_register_sitenamenum": "sitename",
    "ads_register_regsourcenamenum": "regsourcename",
    "ads_register_adnamenum": "adname",
    "ads_register_memberlevelnum": "memberlevel",
    "ads_register_viplevelnum": "vip_level",
}
TOP_PAYERS_COLUMNS = [
    "uid", "memberlevel", "register", "appregurl", "regsourcename", "adname", "sitename", "vip_level",
    "paymoney", "rownum", "dt", "dn",
]


def count_members(members: DataFrame, column: str) -> DataFrame:
    """Members per value of ``column``, day and site. Null is a group of its own.

    Counts are made before the shuffle, so a value shared by most members costs no more than others.
    """
    return members.groupBy(column, "dt", "dn").agg(F.count("uid").alias("uid_count"))


def all_counts(members: DataFrame) -> DataFrame:
    """Rows ``(report, value, uid_count, dt, dn)`` of all count reports, from one scan of the members.

    Each member gives a row per report, all of which are summed in the scan's own tasks before the shuffle. Values are
    texts; null is a group of its own in each report.
    """
    parts = [
        F.struct(F.lit(report).alias("report"), F.col(column).cast("string").alias("value"))
        for report, column in COUNT_REPORTS.items()
    ]
    values = members.select("uid", "dt", "dn", F.inline(F.array(*parts)))
    return values.groupBy("report", "value", "dt", "dn").agg(F.count("uid").alias("uid_count"))


def one_report(counts: DataFrame, report: str) -> DataFrame:
    """One of the reports of :func:`all_counts`, in the columns of its own table."""
    own = counts.where(F.col("report") == report)
    return own.select(F.col("value").alias(COUNT_REPORTS[report]), "dt", "dn", "uid_count")


def top_payers(members: DataFrame, places: int = 3, ordered: bool = False) -> DataFrame:
    """The members who paid most, per day, site and member level; equal sums go by ``uid``.

    The rank limit is pushed below the shuffle, so each task sends on only ``places`` rows per group.
    """
    ranking = Window.partitionBy("dt", "dn", "memberlevel").orderBy(F.desc("paymoney"), "uid")
    ranked = members.withColumn("rownum", F.row_number().over(ranking))
    best = ranked.where(F.col("rownum") <= places).select(*TOP_PAYERS_COLUMNS)
    return best.orderBy("memberlevel", "rownum") if ordered else best
