"""Day texts: the warehouse keeps days as ``yyyyMMdd``, validity dates as ``yyyy-MM-dd``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Text formats and the end date of a row that is still valid.
DAY_FORMAT = "yyyyMMdd"
DATE_FORMAT = "yyyy-MM-dd"
TIME_FORMAT = "yyyy-MM-dd HH:mm:ss"
OPEN_END = "9999-12-31"


def day_to_date_text(day: Column) -> Column:
    return F.date_format(F.to_date(day, DAY_FORMAT), DATE_FORMAT)


def day_of(time: Column) -> Column:
    return F.date_format(time, DAY_FORMAT)


def time_text(time: Column) -> Column:
    return F.date_format(time, TIME_FORMAT)
