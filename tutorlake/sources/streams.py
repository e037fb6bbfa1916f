"""Stream inputs: a message topic in production, files of lines when replaying."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.functions.numbers import int_or_zero
from tutorlake.sources.lines import json_objects, tab_fields

# Fields of the messages.
REGISTER_FIELDS = ["userid", "platform_code", "createtime"]
QUIZ_FIELDS = ["uid", "courseid", "pointid", "questionid", "istrue", "createtime"]
PAGE_FIELDS = ["uid", "app_id", "device_id", "ip", "last_page_id", "page_id", "next_page_id"]
WATCH_NUMBERS = ["uid", "cwareid", "videoid", "chapterid", "edutypeid", "subjectid", "speed", "ps", "pe"]
WATCH_TIMES = ["ts", "te"]
WATCH_TEXTS = ["sourceType"]


def topic_stream(
    spark: SparkSession, servers: str, topic: str, per_trigger: int | None = None, **options: str
) -> DataFrame:
    """Messages of a Kafka topic as column ``value``, from the earliest one on the first start.

    Later starts go on where the query's checkpoint ended. ``per_trigger`` limits the intake.
    Needs the Kafka connector on the classpath.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
        .options(**options)
    )
    if per_trigger:
        reader = reader.option("maxOffsetsPerTrigger", per_trigger)
    return reader.load().select(F.col("value").cast("string").alias("value"))


def folder_stream(spark: SparkSession, folder: str, files_per_trigger: int | None = None) -> DataFrame:
    """Lines of the text files that arrive in a folder, as column ``value``."""
    reader = spark.readStream.format("text")
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.load(folder)


def registrations(lines: DataFrame) -> DataFrame:
    return tab_fields(lines, REGISTER_FIELDS)


def quiz_answers(lines: DataFrame) -> DataFrame:
    return tab_fields(lines, QUIZ_FIELDS)


def page_visits(lines: DataFrame) -> DataFrame:
    """Visits whose three page ids are all present; other missing fields become empty text."""
    visits = json_objects(lines, PAGE_FIELDS).fillna("", PAGE_FIELDS)
    return visits.where((F.col("last_page_id") != "") & (F.col("page_id") != "") & (F.col("next_page_id") != ""))


def watch_events(lines: DataFrame) -> DataFrame:
    """Video watch events: whole numbers default to 0, times in epoch milliseconds."""
    events = json_objects(lines, WATCH_NUMBERS + WATCH_TIMES + WATCH_TEXTS)
    return events.select(
        *[int_or_zero(F.col(name)).alias(name) for name in WATCH_NUMBERS],
        *[F.col(name).try_cast("bigint").alias(name) for name in WATCH_TIMES],
        *[F.col(name) for name in WATCH_TEXTS],
    )
