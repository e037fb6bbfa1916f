"""Quiz mastery per learner and topic, and registration counts."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tutorlake.functions.coding import platform
from tutorlake.operators.lists import text_lists

TOPIC = ["userid", "courseid", "pointid"]
# Fixed value: a topic is assumed to have this many questions.
QUESTIONS_PER_TOPIC = 30


def _update_time(rows: DataFrame) -> list[str]:
    """The time of change is carried along where rows have one."""
    return [c for c in rows.columns if c == "updatetime"]


def question_totals(answers: DataFrame) -> DataFrame:
    """Answers, right answers and first time per learner, topic and question; batch and stream.

    This is the state behind :func:`mastery`. Each entry is of fixed size, unlike a set of question
    ids per topic, and a topic with very many answers is summed before it is shuffled.
    """
    named = answers.select(
        F.col("uid").try_cast("bigint").alias("userid"),
        F.col("courseid").try_cast("bigint").alias("courseid"),
        F.col("pointid").try_cast("bigint").alias("pointid"),
        "questionid", "istrue", "createtime", *_update_time(answers),
    )
    return named.groupBy(*TOPIC, "questionid").agg(
        F.count(F.lit(1)).alias("answers"),
        F.count_if(F.col("istrue") == "1").alias("right"),
        F.min("createtime").alias("createtime"),
        *[F.max(c).alias(c) for c in _update_time(answers)],
    )


def mastery(totals: DataFrame) -> DataFrame:
    """Answers, distinct questions, right answers and rates per learner and topic."""
    rolled = totals.groupBy(*TOPIC).agg(
        F.sum("answers").alias("qz_sum"),
        F.count(F.lit(1)).alias("qz_count"),
        F.sum("right").alias("qz_istrue"),
        F.min("createtime").alias("createtime"),
        *[F.max(c).alias(c) for c in _update_time(totals)],
    )
    correct = F.try_divide(F.col("qz_istrue").cast("double"), F.col("qz_sum"))
    done = F.col("qz_count") / F.lit(float(QUESTIONS_PER_TOPIC))
    return rolled.withColumn("correct_rate", correct).withColumn("mastery_rate", done * correct)


def question_ids(totals: DataFrame, parts: int = 1) -> DataFrame:
    """The answered question ids of each learner and topic, as sorted comma-separated text in ``parts`` parts.

    ``totals`` itself is the form to store, one row per question.
    """
    single = totals.select(*TOPIC, "questionid", F.lit(1).cast("bigint").alias("copies"))
    return text_lists(single, TOPIC, "questionid", "questionids", parts)


def with_platform(registrations: DataFrame) -> DataFrame:
    return registrations.withColumn("app_name", platform(F.col("platform_code")))


def registrations_by_platform(registrations: DataFrame) -> DataFrame:
    """Registrations per platform so far, for batch and stream."""
    return with_platform(registrations).groupBy("app_name").agg(F.count(F.lit(1)).alias("num"))


def event_time() -> Column:
    """When a registration happened, as it says itself; null where that cannot be read."""
    return F.col("createtime").try_cast("timestamp")


def registrations_in_window(
    registrations: DataFrame, time: Column | None = None, length: str = "60 seconds", slide: str = "6 seconds",
    lateness: str | None = None,
) -> DataFrame:
    """Registrations per platform in sliding windows over ``time``, for batch and stream; none is lost.

    Without ``time`` a registration counts when it arrives. With :func:`event_time`, it counts at that time, however late it comes; those whose time cannot be read are counted in a window without start and
    end. That keeps all windows in the state. ``lateness`` lets a stream forget windows: rows that come later
    than that, and rows whose time cannot be read, are then left out.
    """
    seen_at, forgotten = (F.current_timestamp(), lateness or length) if time is None else (time, lateness)
    timed = with_platform(registrations).withColumn("seen_at", seen_at)
    if forgotten:
        window = F.window("seen_at", length, slide)
        counted = timed.withWatermark("seen_at", forgotten).groupBy(window, "app_name").agg(F.count(F.lit(1)).alias("num"))
        return counted.select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "app_name", "num"
        )
    micros = [pd.Timedelta(text) // pd.Timedelta("1us") for text in (length, slide)]
    size, step = (F.lit(n).cast("bigint") for n in micros)
    at = F.unix_micros("seen_at")
    last = at - F.pmod(at, step)
    starts = F.filter(
        F.transform(F.sequence(F.lit(0), F.lit(-(-micros[0] // micros[1]) - 1)), lambda k: last - k * step),
        lambda start: start + size > at,
    )
    counted = timed.select("app_name", F.explode_outer(starts).alias("start")).groupBy("start", "app_name").agg(
        F.count(F.lit(1)).alias("num")
    )
    return counted.select(
        F.timestamp_micros("start").alias("window_start"),
        F.timestamp_micros(F.col("start") + size).alias("window_end"),
        "app_name",
        "num",
    )
