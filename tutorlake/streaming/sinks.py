"""Repeat-safe result tables of streaming jobs.

A micro-batch that is run again after a failure has the same number and writes to the same place,
so a retry replaces what the failed attempt left behind. Values are absolute, never increments.

Batches count from 0 for every checkpoint. What a checkpoint writes belongs to a generation, whose number
goes before the batch number, see :func:`claimed_generation`. A job that starts without its checkpoint is a new
generation: as soon as it has written a batch, readers see its values and nothing of the old ones.

A job that writes several tables marks each batch as committed when all are written, see :func:`together`;
read up to :func:`last_commit`, all tables are those of one batch.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tutorlake.sources.tables import (
    drop_folder,
    drop_versions,
    folder_exists,
    mark_folder,
    numbered_folders,
    read_version,
    versions,
    write_version,
)

BatchWriter = Callable[[DataFrame, int], None]
KEPT = 3
FOLD_EVERY = 20
# A base is cut into slots by a hash of the keys, of about this many rows each, so that a batch reads the slots
# of its keys only. There are no more than MOST_SLOTS folders; beyond that the slots get larger.
ROWS_PER_SLOT = 1_000_000
MOST_SLOTS = 4096
SLOTS = ["of_slots", "in_slot"]
# Batches that one generation can number.
GENERATION = 1_000_000_000


def claimed_generation(spark: SparkSession, root: str, job: str, checkpoint: str) -> int:
    """The generation of results that belongs to a checkpoint; a new one for a checkpoint that is new or lost.

    The claim is kept below ``root``, beside the tables, and in the checkpoint itself, so both go their own way
    when the checkpoint is deleted. A checkpoint from before there were claims goes on as generation 0.
    """
    held = numbered_folders(spark, f"{checkpoint}/generation", "number")
    if held:
        return held[-1]
    claims = f"{root}/_generations/{job}"
    taken = numbered_folders(spark, claims, "number")
    going_on = folder_exists(spark, f"{checkpoint}/offsets")
    number = taken[-1] + 1 if taken and not going_on else 0
    mark_folder(spark, f"{claims}/number={number}")
    mark_folder(spark, f"{checkpoint}/generation/number={number}")
    return number


def first_of_generation(stamp: int) -> int:
    return stamp // GENERATION * GENERATION


def together(root: str, job: str, write: BatchWriter) -> BatchWriter:
    """A batch whose tables, written by ``write``, become visible at once, or not at all.

    A batch that is written again is withdrawn first, so readers fall back to the one before it meanwhile.
    """

    def run(batch: DataFrame, stamp: int) -> None:
        spark = batch.sparkSession
        commits = f"{root}/_commits/{job}"
        drop_folder(spark, f"{commits}/batch={stamp}")
        write(batch, stamp)
        mark_folder(spark, f"{commits}/batch={stamp}")
        for old in numbered_folders(spark, commits, "batch")[:-KEPT]:
            drop_folder(spark, f"{commits}/batch={old}")

    return run


def last_commit(spark: SparkSession, root: str, job: str) -> int:
    """The newest batch of which all tables are written."""
    done = numbered_folders(spark, f"{root}/_commits/{job}", "batch")
    if not done:
        raise ValueError(f"{job} has written nothing to {root} yet")
    return done[-1]


def replace_table(root: str, table: str, keep: int = KEPT) -> BatchWriter:
    """Each batch holds the whole result (complete mode) and becomes the table's new version.

    The newest ``keep`` versions stay, for readers that have started.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        write_version(batch, root, table, batch_id)
        drop_versions(batch.sparkSession, root, table, keep)

    return write


def upsert_table(root: str, table: str, keys: list[str], fold_every: int = FOLD_EVERY) -> BatchWriter:
    """Each batch holds the changed keys (update mode) with their new values.

    Only changes are written, so a batch costs what it changed and not what the table holds. Every
    ``fold_every`` batches they are folded into a new base, see :func:`compact`, so the table is never more
    than two bases and twice that many changes.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/{table}/changes/batch={batch_id}")
        if batch_id % GENERATION % fold_every == fold_every - 1:
            compact(batch.sparkSession, root, table, keys)

    return write


def change_batches(spark: SparkSession, root: str, table: str) -> list[int]:
    """Batches of changes that are complete, oldest first; one without its commit marker does not count."""
    return numbered_folders(spark, f"{root}/{table}/changes", "batch")


def _newest_generation(spark: SparkSession, root: str, table: str, upto: int | None) -> tuple[list[int], list[int]]:
    """Bases and changes of the newest generation, up to a batch."""
    bases, changes = (
        [n for n in found if upto is None or n <= upto]
        for found in (versions(spark, root, f"{table}/base"), change_batches(spark, root, table))
    )
    first = first_of_generation(max([*bases, *changes], default=0))
    return [n for n in bases if n >= first], [n for n in changes if n >= first]


def _slot(keys: list[str], slots: int) -> Column:
    return F.pmod(F.xxhash64(*keys), F.lit(slots)).cast("int")


def in_slots(base: DataFrame, keys: list[str], among: DataFrame) -> DataFrame:
    """The slots of a base that can hold the keys in ``among``. Their numbers, at most ``MOST_SLOTS``, are collected."""
    first = base.select(SLOTS[0]).first() if SLOTS[0] in base.columns else None
    if first is None:
        return base
    slots = int(first[0])
    # The hash depends on the type.
    typed = among.select(*[F.col(k).cast(base.schema[k].dataType).alias(k) for k in keys])
    met = [row[0] for row in typed.select(_slot(keys, slots)).distinct().collect()]
    return base if len(met) == slots else base.where(F.col(SLOTS[1]).cast("int").isin(met))


def current(
    spark: SparkSession, root: str, table: str, keys: list[str], upto: int | None = None, among: DataFrame | None = None
) -> DataFrame:
    """The newest values of each key: the last compacted base and the complete changes since, up to batch ``upto``.

    With ``among``, values of keys that are not in it may be missing, and files of the base that hold no such keys are
    not read.
    """
    bases, changed = _newest_generation(spark, root, table, upto)
    base_version = bases[-1] if bases else None
    base = None if base_version is None else read_version(spark, root, f"{table}/base", before=base_version + 1)
    if base is not None:
        base = (base if among is None else in_slots(base, keys, among)).drop(*SLOTS)
    newer = [n for n in changed if base_version is None or n > base_version]
    if not newer:
        if base is None:
            raise ValueError(f"{root}/{table} holds nothing yet")
        return base
    paths = [f"{root}/{table}/changes/batch={n}" for n in newer]
    changes = spark.read.option("basePath", f"{root}/{table}/changes").parquet(*paths)
    changes = changes.withColumn("batch", F.col("batch").cast("bigint"))
    values = [column for column in changes.columns if column not in (*keys, "batch")]
    if base is not None:
        changes = changes.unionByName(base.withColumn("batch", F.lit(base_version).cast("bigint")))
    newest = F.max_by(F.struct(*values), "batch").alias("newest")
    return changes.groupBy(*keys).agg(newest).select(*keys, "newest.*")


def known_keys(spark: SparkSession, root: str, table: str, keys: list[str], touched: DataFrame, stamp: int) -> DataFrame | None:
    """The values that ``touched`` keys had before batch ``stamp``; None in the first batch of a generation."""
    bases, changed = _newest_generation(spark, root, table, stamp - 1)
    if max([*bases, *changed], default=-1) < first_of_generation(stamp):
        return None
    wanted = touched.select(*[F.col(k).alias(f"__{k}") for k in keys]).distinct()
    same = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in keys]
    return current(spark, root, table, keys, stamp - 1, touched).join(wanted, same, "left_semi")


def add_to_table(
    root: str, table: str, keys: list[str], sums: list[str], more: DataFrame, stamp: int, fold_every: int = FOLD_EVERY
) -> None:
    """Write the new totals of the keys in ``more``: what they had before this batch, and what it adds.

    ``more`` has a row per key. Columns other than ``sums`` take the batch's own value, ``updatetime`` for
    instance. The totals of the batch before are read from the table itself, so a retried batch adds to the same
    totals again and only changed keys are written.
    """
    spark = more.sparkSession
    before = known_keys(spark, root, table, keys, more, stamp)
    rows = more
    if before is not None:
        others = [c for c in more.columns if c not in (*keys, *sums)]
        old = before.select(*keys, *[F.col(c).alias(f"__{c}") for c in sums]).toDF(*[f"_{k}" for k in keys], *[f"__{c}" for c in sums])
        same = [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in keys]
        total = [F.coalesce(F.col(c) + F.col(f"__{c}"), c, f"__{c}").alias(c) for c in sums]
        rows = more.join(old, same, "left").select(*keys, *total, *others)
    upsert_table(root, table, keys, fold_every)(rows, stamp)


def compact(spark: SparkSession, root: str, table: str, keys: list[str]) -> None:
    """Fold the complete changes into a new base, so that later reads start from it.

    The base before stays, with the changes since it, for readers that have started; what is older goes.
    """
    batches = change_batches(spark, root, table)
    before = max(versions(spark, root, f"{table}/base"), default=-1)
    if not batches or batches[-1] <= before:
        return
    # Changes of a generation before are not folded in; they go with the next fold.
    rows, stored = current(spark, root, table, keys), _rows_stored(spark, root, table)
    slots = min(-(-stored // ROWS_PER_SLOT), MOST_SLOTS)
    if slots > 1:
        rows = rows.withColumn(SLOTS[0], F.lit(slots)).withColumn(SLOTS[1], _slot(keys, slots)).hint("rebalance", SLOTS[1])
    write_version(rows, root, f"{table}/base", batches[-1], SLOTS if slots > 1 else ())
    drop_versions(spark, root, f"{table}/base", keep=2)
    for batch in batches:
        if batch <= before:
            drop_folder(spark, f"{root}/{table}/changes/batch={batch}")


def _rows_stored(spark: SparkSession, root: str, table: str) -> int:
    """An upper bound of the keys of a table, from the footers of its files."""
    bases, changed = _newest_generation(spark, root, table, None)
    paths = [f"{root}/{table}/base/version={n:012d}" for n in bases[-1:]]
    paths += [f"{root}/{table}/changes/batch={n}" for n in changed if not bases or n > bases[-1]]
    return sum(spark.read.parquet(path).count() for path in paths)


def start(
    stream: DataFrame,
    writer: BatchWriter,
    root: str,
    job: str,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
) -> StreamingQuery:
    """Start a job. Without ``every`` it takes what is there, in several batches, and then ends.

    The writer is given batch numbers of the checkpoint's generation, see :func:`claimed_generation`.
    """
    first = claimed_generation(stream.sparkSession, root, job, checkpoint) * GENERATION
    query = (
        stream.writeStream.outputMode(mode)
        .option("checkpointLocation", checkpoint)
        .foreachBatch(lambda batch, batch_id: writer(batch, first + batch_id))
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return query.trigger(**trigger).start()
