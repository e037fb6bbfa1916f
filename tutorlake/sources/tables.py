"""Warehouse tables as partitioned Parquet folders under one root."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tutorlake.session import fresh_dir


# The columns that name folders of a table. They are texts, so sites 007 and 7 stay apart.
PARTITION_COLUMNS = ("load", "dt", "dn")


def read_table(spark: SparkSession, root: str, table: str, day: str | None = None) -> DataFrame:
    """A table with all its loads, or one day of it. The day is a partition, so other days are not read.

    Partition values are read as text whatever the session's settings are.
    """
    rows = _partitions_as_text(spark, f"{root}/{table}").drop("load")
    return rows if day is None else on_day(rows, day)


def _partitions_as_text(spark: SparkSession, path: str) -> DataFrame:
    fields = [
        T.StructField(f.name, T.StringType()) if f.name in PARTITION_COLUMNS else f
        for f in spark.read.parquet(path).schema.fields
    ]
    return spark.read.schema(T.StructType(fields)).parquet(path)


def read_loads(spark: SparkSession, root: str, table: str, loads: list[str]) -> DataFrame:
    """Some loads of a table, with column ``load``; files of the others are not read.

    A table that was not written load by load is one load with an empty name.
    """
    rows = _partitions_as_text(spark, f"{root}/{table}")
    if "load" not in rows.columns:
        return rows.withColumn("load", F.lit("")) if "" in loads else rows.withColumn("load", F.lit("")).limit(0)
    return rows.where(F.col("load").isin(loads))


def load_marks(spark: SparkSession, root: str, table: str) -> dict[str, str]:
    """A mark for each load of a table that holds files, which changes when the load is written again.

    It is made of the time, the number of files and the bytes. A table that was not written load by load is one
    load with an empty name.
    """
    jvm = spark._jvm.org.apache.hadoop.fs
    path = jvm.Path(f"{root}/{table}")
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(path):
        return {}

    def mark(folder: str) -> str | None:
        place = jvm.Path(folder)
        done, held = jvm.Path(f"{folder}/_SUCCESS"), files.getContentSummary(place)
        time = files.getFileStatus(done if files.exists(done) else place).getModificationTime()
        return f"{time}-{held.getFileCount()}-{held.getLength()}" if held.getLength() else None

    loads = [status.getPath() for status in files.globStatus(jvm.Path(f"{root}/{table}/load=*"))]
    marks = {load.getName().removeprefix("load="): mark(load.toString()) for load in loads} or {"": mark(f"{root}/{table}")}
    return {load: found for load, found in marks.items() if found}


def on_day(rows: DataFrame, day: str | None) -> DataFrame:
    """Rows of one day; all rows when no day is given. The day is compared as text, as it is stored."""
    return rows if day is None else rows.where(F.col("dt") == F.lit(day))


def write_table(rows: DataFrame, root: str, table: str, partitions: list[str]) -> None:
    """Replace exactly the partitions present in ``rows``, so a rerun gives the same table.

    For tables worked out from others; loads of raw rows add up, see :func:`write_load`. Rebalancing groups
    rows by partition and lets AQE choose file sizes; a day or site with a third of all rows is split over
    many tasks.
    """
    (
        rows.hint("rebalance", *partitions)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(*partitions)
        .parquet(f"{root}/{table}")
    )


def write_load(rows: DataFrame, root: str, table: str, load: str, partitions: list[str]) -> None:
    """Replace one load of a table, whole, and leave all other loads as they are.

    Days and sites of several loads add up, a late row of an earlier day included, and loading the same log
    again changes nothing. Every task writes its own files and nothing is shuffled.
    """
    if not load or "/" in load:
        raise ValueError("a load needs a name that can be a folder")
    (
        rows.write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy(*partitions)
        .parquet(f"{root}/{table}/load={load}")
    )


def write_version(rows: DataFrame, root: str, table: str, version: int, partitions: Sequence[str] = ()) -> None:
    """A whole new version of a table that is read while it is being replaced.

    Readers keep the highest complete version; writing the same version again replaces it.
    """
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy(*partitions)
    writer.parquet(f"{root}/{table}/version={version:012d}")


def numbered_folders(spark: SparkSession, path: str, name: str) -> list[int]:
    """Numbers of the complete folders ``name=number``, lowest first. One counts once its commit marker is there."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    if not files.exists(folder):
        return []
    found = files.globStatus(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{name}=*/_SUCCESS"))
    return sorted(int(status.getPath().getParent().getName().split("=")[1]) for status in found)


def folder_exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def mark_folder(spark: SparkSession, path: str) -> None:
    """Make a folder that counts as complete: an empty commit marker, created in one step, is all it holds."""
    marker = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/_SUCCESS")
    marker.getFileSystem(spark._jsc.hadoopConfiguration()).create(marker, True).close()


def drop_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def versions(spark: SparkSession, root: str, table: str) -> list[int]:
    """Complete versions, oldest first."""
    return numbered_folders(spark, f"{root}/{table}", "version")


def read_version(
    spark: SparkSession, root: str, table: str, before: int | None = None, since: int = 0
) -> DataFrame | None:
    """The newest version, or the newest one below ``before`` and not below ``since``; None when there is none."""
    usable = [v for v in versions(spark, root, table) if v >= since and (before is None or v < before)]
    if not usable:
        return None
    return spark.read.parquet(f"{root}/{table}/version={usable[-1]:012d}")


def drop_versions(spark: SparkSession, root: str, table: str, keep: int = 3) -> None:
    """Delete all but the newest ``keep`` versions. Keep enough for readers that have already started."""
    for version in versions(spark, root, table)[:-keep]:
        drop_folder(spark, f"{root}/{table}/version={version:012d}")


_watching: list[list[str]] = []


@contextmanager
def stored_paths() -> Iterator[list[str]]:
    """The paths that :func:`settle` writes to in the meantime, for whoever knows when they have been read for good."""
    paths: list[str] = []
    _watching.append(paths)
    try:
        yield paths
    finally:
        _watching[:] = [other for other in _watching if other is not paths]


def settle(rows: DataFrame, name: str) -> DataFrame:
    """Write an intermediate result to the shared folder and read it back.

    Used where a result feeds several jobs: it cuts the lineage and survives lost executors.
    """
    spark = rows.sparkSession
    path = fresh_dir(spark, name)
    rows.write.parquet(path)
    for paths in _watching:
        paths.append(path)
    return spark.read.parquet(path)
