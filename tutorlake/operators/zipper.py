"""History of payments and level per member, with validity dates."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.functions.days import OPEN_END
from tutorlake.functions.numbers import MONEY_SUM

ZIPPER_COLUMNS = ["uid", "paymoney", "vip_level", "start_time", "end_time", "dn"]


def zipper_merge(history: DataFrame, days: DataFrame, from_date: str) -> DataFrame:
    """Add new day rows to the history.

    A new row closes the member's open row at its own start and carries that row's money on. ``days``
    holds one day or several (each with one row per member); ``from_date`` is the first of them as
    ``yyyy-MM-dd``. History from that date on is rebuilt: rows that start there are dropped and rows
    that were closed there are reopened, so running a day again gives the same table.

    Rows closed before ``from_date`` cannot change and pass by without a shuffle, so the shuffle holds
    one open row per member and the new rows, however long the history grows. A window holds at most
    one row per new day of one member, since day rows are summed beforehand.
    """
    start, end, date = F.col("start_time"), F.col("end_time"), F.lit(from_date)
    closed = history.where((start < date) & (end < date)).select(*ZIPPER_COLUMNS)
    reopened = history.where((start < date) & (end >= date)).withColumn("end_time", F.lit(OPEN_END))
    rows = reopened.withColumn("is_new", F.lit(False)).unionByName(days.withColumn("is_new", F.lit(True)))

    by_start = Window.partitionBy("uid", "dn").orderBy("start_time")
    until_now = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = F.sum("paymoney").over(until_now)
    next_start = F.lead("start_time").over(by_start)
    merged = rows.select(
        "uid",
        F.when(F.col("is_new"), carried).otherwise(F.col("paymoney")).cast(MONEY_SUM).alias("paymoney"),
        "vip_level",
        "start_time",
        F.coalesce(next_start, F.lit(OPEN_END)).alias("end_time"),
        "dn",
    )
    return closed.unionByName(merged)
