"""Payment sums per member and level as a stored table that is brought up to date load by load.

The sums of each load are kept, and the sums over all loads beside them. A load that is new, or was cleaned again,
is read, its earlier sums are taken off and the new ones added; no other payment is read. A load that is gone is taken
off. A manifest names the loads that count with their marks, the run that summed each, and is written last, so
an update is seen as a whole or not at all: one that broke off has the same number when it is run again, and
replaces what it left.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.functions.numbers import MONEY_SUM, money
from tutorlake.operators.members import LEVEL_KEY, added_levels, paid_by_level
from tutorlake.sources.tables import (
    drop_folder,
    load_marks,
    numbered_folders,
    read_loads,
    read_version,
    versions,
    write_version,
)

PAYMENTS = "dwd_pcentermempaymoney"
SUMS = "dws_member_paid"
NUMBERS = ["paid", "payments", "amounts"]
SUMS_SCHEMA = f"uid bigint, dn string, vip_id bigint, paid {MONEY_SUM}, payments bigint, amounts bigint"
MANIFEST_SCHEMA = "load string, mark string, run int"
KEPT = 3


def _manifest(spark: SparkSession, root: str, version: int) -> dict[str, tuple[str, int]]:
    """Mark and run of each load that counts: a row per load."""
    found = read_version(spark, root, f"{SUMS}/manifest", before=version + 1, since=version)
    return {} if found is None else {r["load"]: (r["mark"], r["run"]) for r in found.collect()}


def read_sums(spark: SparkSession, root: str) -> DataFrame:
    """The sums over all loads, as :func:`tutorlake.operators.members.paid_by_level` gives them; none at first."""
    done = versions(spark, root, f"{SUMS}/manifest")
    if not done:
        return spark.createDataFrame([], SUMS_SCHEMA)
    return read_version(spark, root, f"{SUMS}/totals", before=done[-1] + 1, since=done[-1])


def _of_loads(spark: SparkSession, root: str, loads: dict[str, tuple[str, int]]) -> list[DataFrame]:
    """The stored sums of some loads, one frame for each run that summed some of them."""
    runs: dict[int, list[str]] = {}
    for load, (_, run) in loads.items():
        runs.setdefault(run, []).append(load)
    return [
        spark.read.parquet(f"{root}/{SUMS}/loads/run={run}").where(F.col("load").isin(names)).drop("load")
        for run, names in runs.items()
    ]


def update_sums(spark: SparkSession, root: str) -> DataFrame:
    """Bring the stored sums up to date with the cleaned payments, and return them.

    Loads whose mark is known are not read. When nothing has changed, nothing is written.
    """
    marks = load_marks(spark, root, PAYMENTS)
    done = versions(spark, root, f"{SUMS}/manifest")
    known = _manifest(spark, root, done[-1]) if done else {}
    fresh = [load for load, mark in marks.items() if known.get(load, ("", -1))[0] != mark]
    stale = {load: entry for load, entry in known.items() if load in fresh or load not in marks}
    if not fresh and not stale:
        return read_sums(spark, root)

    run = max(done, default=-1) + 1
    changes = [
        rows.select(*LEVEL_KEY, *[(-F.col(c)).alias(c) for c in NUMBERS]) for rows in _of_loads(spark, root, stale)
    ]
    if fresh:
        payments = read_loads(spark, root, PAYMENTS, fresh).withColumn("paymoney", money(F.col("paymoney")))
        path = f"{root}/{SUMS}/loads/run={run}"
        paid_by_level(payments, "load").write.mode("overwrite").parquet(path)
        changes.append(spark.read.parquet(path).drop("load"))
    parts = [part.select(*[F.col(f.name).cast(f.dataType) for f in read_sums(spark, root).schema]) for part in changes]
    write_version(added_levels(reduce(DataFrame.unionByName, parts, read_sums(spark, root))), root, f"{SUMS}/totals", run)
    entries = [(load, *entry) for load, entry in known.items() if load not in stale]
    entries += [(load, marks[load], run) for load in fresh]
    write_version(spark.createDataFrame(entries, MANIFEST_SCHEMA).coalesce(1), root, f"{SUMS}/manifest", run)
    _drop_unnamed(spark, root)
    return read_sums(spark, root)


def _drop_unnamed(spark: SparkSession, root: str) -> None:
    """Delete versions before the newest ``KEPT``, and sums of loads that none of these names."""
    done = versions(spark, root, f"{SUMS}/manifest")
    named = {run for version in done[-KEPT:] for _, run in _manifest(spark, root, version).values()}
    for run in numbered_folders(spark, f"{root}/{SUMS}/loads", "run"):
        if run not in named:
            drop_folder(spark, f"{root}/{SUMS}/loads/run={run}")
    for version in done[:-KEPT]:
        for part in ("manifest", "totals"):
            drop_folder(spark, f"{root}/{SUMS}/{part}/version={version:012d}")
