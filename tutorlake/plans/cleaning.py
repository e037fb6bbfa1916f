"""Raw logs to cleaned tables."""

from __future__ import annotations

from pyspark.sql import SparkSession

from tutorlake.sources.logs import LOGS, read_log
from tutorlake.sources.tables import write_load


def clean_logs(
    spark: SparkSession, log_dir: str, root: str, tables: list[str] | None = None, load: str | None = None
) -> None:
    """Clean the named logs (all by default) and add them to their tables as one load.

    Without a name the load is called after the log folder. A rerun replaces what the load of that name
    wrote and nothing else. A log goes from its splits to its table in one narrow pass, without a shuffle.
    """
    name = load or log_dir.rstrip("/").rpartition("/")[2]
    for table in tables or list(LOGS):
        write_load(read_log(spark, log_dir, table), root, table, name, LOGS[table].partitions)
