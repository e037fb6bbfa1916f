"""The payment history of members as a stored table that a day adds to without rewriting it.

Rows that a newer row has closed are kept under the run that closed them and never written again; open rows, one
per member, are written anew by each run. So a day writes what it changed and one row per member, however
long the history is. A manifest names the runs whose closed rows count and the run whose open rows count;
readers follow the newest one, so a run is seen as a whole or not at all, and may be repeated.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.functions.days import OPEN_END
from tutorlake.functions.numbers import MONEY_SUM, money
from tutorlake.operators.members import day_payments
from tutorlake.operators.zipper import ZIPPER_COLUMNS, zipper_merge
from tutorlake.sources.tables import drop_folder, read_table, read_version, versions, write_version

HISTORY = "dws_member_history"
HISTORY_SCHEMA = f"uid bigint, paymoney {MONEY_SUM}, vip_level string, start_time string, end_time string, dn string"
MANIFEST_SCHEMA = "state string, day bigint, run int"
KEPT = 3


def _stored(spark: SparkSession, root: str, entries: list[tuple[str, int, int]]) -> DataFrame:
    """The rows of some entries of a manifest; runs and states are folders, so others are not read."""
    if not entries:
        return spark.createDataFrame([], HISTORY_SCHEMA)
    rows = spark.read.schema(f"{HISTORY_SCHEMA}, run int, state string").parquet(f"{root}/{HISTORY}/rows")
    chosen = F.lit(False)
    for state in ("open", "closed"):
        runs = [run for s, _, run in entries if s == state]
        if runs:
            chosen = chosen | ((F.col("state") == state) & F.col("run").isin(runs))
    return rows.where(chosen).select(*ZIPPER_COLUMNS)


def _manifest(spark: SparkSession, root: str, version: int | None = None) -> list[tuple[str, int, int]]:
    """Entries ``(state, day, run)``: one per run, the last day it added, and one for the open rows."""
    found = read_version(spark, root, f"{HISTORY}/manifest", before=None if version is None else version + 1)
    return [] if found is None else [tuple(r) for r in found.select("state", "day", "run").collect()]


def read_history(spark: SparkSession, root: str) -> DataFrame:
    """All rows of the history, closed and open; none when no day has been added."""
    return _stored(spark, root, _manifest(spark, root))


def add_days(spark: SparkSession, root: str, days: DataFrame, day: int, last_day: int) -> None:
    """Add the day rows of ``day`` to ``last_day``, numbers like 20190722, to the stored history.

    What the history holds from ``day`` on is replaced, so ``days`` must reach the newest day it knows; rows
    that were closed from then on are opened again. Days before it are neither read nor written.
    """
    entries = _manifest(spark, root)
    if entries and max(e[1] for e in entries) > last_day:
        raise ValueError("the history goes on behind the last day given")
    settled = [e for e in entries if e[0] == "closed" and e[1] < day]
    again = [e for e in entries if e not in settled]
    text = str(day)
    merged = zipper_merge(_stored(spark, root, again), days, f"{text[:4]}-{text[4:6]}-{text[6:]}")
    run = max(versions(spark, root, f"{HISTORY}/manifest"), default=-1) + 1
    state = F.when(F.col("end_time") == OPEN_END, "open").otherwise("closed")
    (
        merged.withColumn("state", state)
        .hint("rebalance", "state")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("state")
        .parquet(f"{root}/{HISTORY}/rows/run={run}")
    )
    entries = [*settled, ("closed", last_day, run), ("open", last_day, run)]
    write_version(spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1), root, f"{HISTORY}/manifest", run)
    _drop_unnamed(spark, root, run)


def _drop_unnamed(spark: SparkSession, root: str, run: int) -> None:
    """Delete what the manifest that goes out of use names and none of the newest ones."""
    found = versions(spark, root, f"{HISTORY}/manifest")
    kept = {(s, r) for version in found[-KEPT:] for s, _, r in _manifest(spark, root, version)}
    for version in found[:-KEPT]:
        for state, _, old in _manifest(spark, root, version):
            if (state, old) not in kept:
                drop_folder(spark, f"{root}/{HISTORY}/rows/run={old}/state={state}")
        drop_folder(spark, f"{root}/{HISTORY}/manifest/version={version:012d}")


def update_history(spark: SparkSession, root: str, day: str, last_day: str | None = None) -> None:
    """Add a day, or the days up to ``last_day``, from the cleaned payments.

    Adding a day again, also one in the middle, rebuilds the history from that day to the newest one it knows,
    late payments included. ``day`` is like 20190722.
    """
    newest = max((e[1] for e in _manifest(spark, root)), default=0)
    last = max(int(last_day or day), newest)
    payments = read_table(spark, root, "dwd_pcentermempaymoney").where(F.col("dt").between(day, str(last)))
    paid = payments.withColumn("paymoney", money(F.col("paymoney")))
    add_days(spark, root, day_payments(paid, read_table(spark, root, "dwd_vip_level")), int(day), last)
