"""One day of the member area: wide table, payment history and reports."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.functions.numbers import MONEY_SUM, money
from tutorlake.operators.member_reports import COUNT_REPORTS, all_counts, one_report, top_payers
from tutorlake.operators.members import day_payments, wide_of_sums
from tutorlake.operators.zipper import zipper_merge
from tutorlake.plans.member_history import update_history
from tutorlake.plans.member_sums import update_sums
from tutorlake.sources.tables import on_day, read_table, read_version, write_table, write_version
from tutorlake.sources.views import VIEWS, view

PARTITIONS = ["dt", "dn"]
ZIPPER = "dws_member_zipper"
ZIPPER_SCHEMA = f"uid bigint, paymoney {MONEY_SUM}, vip_level string, start_time string, end_time string, dn string"


def _view(spark: SparkSession, root: str, name: str, day: str | None = None) -> DataFrame:
    return view(read_table(spark, root, VIEWS[name].table), name, day)


def build_members(spark: SparkSession, root: str, day: str) -> None:
    """The wide table's partitions of the day, from the stored payment sums and the loads that are new to them."""
    wide = wide_of_sums(
        _view(spark, root, "member", day),
        _view(spark, root, "regtype"),
        _view(spark, root, "base_ad"),
        _view(spark, root, "base_website"),
        update_sums(spark, root),
        _view(spark, root, "vip_level"),
    )
    write_table(wide, root, "dws_member", PARTITIONS)


def update_zipper(spark: SparkSession, root: str, day: str, last_day: str | None = None) -> None:
    """Add a day, or the days up to ``last_day``, to the payment history as a new version of the whole of it.

    For histories small enough to be copied; :mod:`tutorlake.plans.member_history` keeps closed rows in place.

    Versions are numbered by their last day, and a run starts from the newest version before ``day``,
    so running a day again, or an older day and all after it, gives the same history.
    """
    last = last_day or day
    payments = read_table(spark, root, "dwd_pcentermempaymoney").where(F.col("dt").between(day, last))
    paid = payments.withColumn("paymoney", money(F.col("paymoney")))
    days = day_payments(paid, read_table(spark, root, "dwd_vip_level"))
    history = read_version(spark, root, ZIPPER, before=int(day))
    if history is None:
        history = spark.createDataFrame([], ZIPPER_SCHEMA)
    from_date = f"{day[:4]}-{day[4:6]}-{day[6:]}"
    merged = zipper_merge(history, days, from_date)
    write_version(merged, root, ZIPPER, int(last))


def report_members(spark: SparkSession, root: str, day: str) -> None:
    """All member reports of the day, from the columns they need."""
    members = on_day(view(read_table(spark, root, "dws_member"), "member_report"), day)
    # One row per value of a report: small, and made by one scan of the day.
    counts = all_counts(members).persist()
    try:
        for table in COUNT_REPORTS:
            write_table(one_report(counts, table), root, table, PARTITIONS)
    finally:
        counts.unpersist()
    write_table(top_payers(members), root, "ads_register_top3memberpay", PARTITIONS)


def member_day(spark: SparkSession, root: str, day: str, last_day: str | None = None) -> None:
    """The wide table and reports of ``day``, and the payment history of the days up to ``last_day``."""
    build_members(spark, root, day)
    update_history(spark, root, day, last_day)
    report_members(spark, root, day)
