"""The streaming jobs. Each takes raw lines (column ``value``) and returns its running query.

Where a job's state grows with keys (learners, videos), only the changed keys are written per batch;
small results (platforms, provinces, pages) are written whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tutorlake.functions.days import day_of
from tutorlake.operators.learners import (
    TOPIC,
    mastery,
    question_totals,
    registrations_by_platform,
    registrations_in_window,
    with_platform,
)
from tutorlake.operators.pages import FUNNEL, add_counts, funnel, page_hits, page_steps, province_counts, top_provinces
from tutorlake.operators.watching import VIDEO, batch_coverage, learn_time
from tutorlake.sources.streams import page_visits, quiz_answers, registrations, watch_events
from tutorlake.sources.tables import drop_versions, read_version, write_version
from tutorlake.streaming.coverage_state import fold_coverage
from tutorlake.streaming.sinks import (
    add_to_table,
    current,
    first_of_generation,
    known_keys,
    last_commit,
    replace_table,
    start,
    together,
    upsert_table,
)

WINDOW_KEY = ["window_start", "app_name"]
LEARN_KEY = ["dimension", "key"]
QUESTION = [*TOPIC, "questionid"]
STEP_KEY = ["last_page_id", "page_id", "next_page_id"]


def count_registrations(lines: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Running registrations per platform: table ``register_total``."""
    counts = registrations_by_platform(registrations(lines))
    return start(counts, replace_table(root, "register_total"), root, "registrations", checkpoint, "complete", every)


def count_registrations_in_window(
    lines: DataFrame, root: str, checkpoint: str, every: str | None = None, time: Column | None = None, **windows: str
) -> StreamingQuery:
    """Registrations per platform in sliding windows: table ``register_window``.

    Windows are over the time of arrival unless ``time`` names the time of the event.
    """
    counts = registrations_in_window(registrations(lines), time, **windows)
    return start(counts, upsert_table(root, "register_window", WINDOW_KEY), root, "registration-windows", checkpoint, "update", every)


def arriving(events: DataFrame) -> DataFrame:
    """Events with the time of the batch they came in, which stays the same when the batch is run again."""
    return events.withColumn("updatetime", F.date_format(F.current_timestamp(), "yyyy-MM-dd HH:mm:ss"))


def track_mastery(
    lines: DataFrame, root: str, checkpoint: str, every: str | None = None, updatetime: bool = False
) -> StreamingQuery:
    """Question totals per learner and topic: table ``qz_point_history``; see :func:`mastery_now`.

    With ``updatetime``, totals and mastery tell the time of the last batch that changed them.
    """
    totals = question_totals(arriving(quiz_answers(lines)) if updatetime else quiz_answers(lines))
    return start(totals, upsert_table(root, "qz_point_history", QUESTION), root, "mastery", checkpoint, "update", every)


def mastery_now(spark: SparkSession, root: str) -> DataFrame:
    """Mastery per learner and topic from the newest question totals."""
    return mastery(current(spark, root, "qz_point_history", QUESTION))


def sum_learn_time(
    lines: DataFrame, root: str, checkpoint: str, every: str | None = None, unit_ms: dict[str, int] | None = None
) -> StreamingQuery:
    """Learning time by five dimensions: table ``learn_detail``."""
    totals = learn_time(watch_events(lines), unit_ms)
    return start(totals, upsert_table(root, "learn_detail", LEARN_KEY), root, "learn-time", checkpoint, "update", every)


def _cover(batch: DataFrame, root: str, table: str, stamp: int) -> None:
    """Fold what a batch brings into the watched ranges its videos had, and write these videos."""
    fresh = batch_coverage(batch).persist()
    try:
        known = known_keys(batch.sparkSession, root, table, VIDEO, fresh, stamp)
        upsert_table(root, table, VIDEO)(fold_coverage(fresh, known), stamp)
    finally:
        fresh.unpersist()


def track_coverage(lines: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Watched ranges and times per learner and video: table ``video_learn_detail``, which is the state.

    Spark reduces a batch to one row per start second of a video; a batch reads the ranges its videos had from the
    table and writes the new ones.
    """

    def write(batch: DataFrame, stamp: int) -> None:
        _cover(batch, root, "video_learn_detail", stamp)

    return start(arriving(watch_events(lines)), write, root, "coverage", checkpoint, "append", every)


def coverage_now(spark: SparkSession, root: str) -> DataFrame:
    return current(spark, root, "video_learn_detail", VIDEO).drop("starts", "ends", "updatetime")


def track_registrations(
    lines: DataFrame, root: str, checkpoint: str, every: str | None = None, time: Column | None = None,
    length: str = "60 seconds", slide: str = "6 seconds",
) -> StreamingQuery:
    """Both registration counts from one read: tables ``register_total`` and ``register_window``, of one batch always.

    The tables are the state: a batch adds to the totals of the platforms and windows it touches, which are read from
    the tables and written in full. Windows are over the time of arrival unless ``time`` is given, and none is
    forgotten. Read them with :func:`registrations_now`.
    """

    def write(batch: DataFrame, stamp: int) -> None:
        batch.persist()
        try:
            stamped = F.max("updatetime").alias("updatetime")
            totals = with_platform(batch).groupBy("app_name").agg(F.count(F.lit(1)).alias("num"), stamped)
            add_to_table(root, "register_total_detail", ["app_name"], ["num"], totals, stamp)
            seen = F.col("arrived") if time is None else time
            windows = registrations_in_window(batch, seen, length, slide)
            add_to_table(root, "register_window_detail", [*WINDOW_KEY, "window_end"], ["num"], windows, stamp)
        finally:
            batch.unpersist()

    rows = arriving(registrations(lines)).withColumn("arrived", F.current_timestamp())
    return start(rows, together(root, "register-topic", write), root, "register-topic", checkpoint, "append", every)


def registrations_now(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Totals and windows of the last batch that is written as a whole."""
    upto = last_commit(spark, root, "register-topic")
    return (
        current(spark, root, "register_total_detail", ["app_name"], upto),
        current(spark, root, "register_window_detail", [*WINDOW_KEY, "window_end"], upto),
    )


def track_course_learn(
    lines: DataFrame, root: str, checkpoint: str, every: str | None = None, unit_ms: dict[str, int] | None = None
) -> StreamingQuery:
    """Watched ranges per video and learning time by five dimensions from one read of the topic.

    A batch is reduced to one row per start second of a video, and per key of a dimension, before it meets the
    values these keys had, which come from the tables themselves. Read them with :func:`course_learn_now`.
    """

    def write(batch: DataFrame, stamp: int) -> None:
        batch.persist()
        try:
            spent = learn_time(batch, unit_ms, F.max("updatetime").alias("updatetime"))
            add_to_table(root, "learn_time_detail", LEARN_KEY, ["totaltime"], spent, stamp)
            _cover(batch, root, "coverage_detail", stamp)
        finally:
            batch.unpersist()

    rows = arriving(watch_events(lines))
    return start(rows, together(root, "course-learn", write), root, "course-learn", checkpoint, "append", every)


def course_learn_now(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Coverage and learning time of the last batch that is written as a whole."""
    upto = last_commit(spark, root, "course-learn")
    coverage = current(spark, root, "coverage_detail", VIDEO, upto).drop("starts", "ends")
    return coverage, current(spark, root, "learn_time_detail", LEARN_KEY, upto)


def count_pages(lines: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Visits by page steps, and page counts with funnel rates: ``page_steps`` and ``page_jump_rate``.

    The steps are the state; both tables come from one evaluation of each batch.
    """

    def write(steps: DataFrame, batch_id: int) -> None:
        steps.persist()
        try:
            spark = steps.sparkSession
            write_version(steps, root, "page_steps", batch_id)
            drop_versions(spark, root, "page_steps")
            hits = steps.groupBy("page_id").agg(F.sum("num").alias("num"))
            write_version(funnel(hits), root, "page_jump_rate", batch_id)
            drop_versions(spark, root, "page_jump_rate")
        finally:
            steps.unpersist()

    return start(page_steps(page_visits(lines)), together(root, "pages", write), root, "pages", checkpoint, "complete", every)


def track_pages(lines: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Visits by page steps, per page, and funnel rates, of which a batch writes what it changes.

    The tables are the state, as in :func:`track_registrations`. Rates are worked out for the pages of the batch and
    those of the funnel, which may follow one of them. Read them with :func:`pages_now`.
    """

    def write(batch: DataFrame, stamp: int) -> None:
        spark = batch.sparkSession
        steps = page_steps(batch).persist()
        try:
            hits = steps.groupBy("page_id").agg(F.sum("num").alias("num"))
            add_to_table(root, "page_steps_detail", STEP_KEY, ["num"], steps, stamp)
            add_to_table(root, "page_hits_detail", ["page_id"], ["num"], hits, stamp)
            pages = hits.select("page_id").union(spark.createDataFrame([(page,) for page in FUNNEL], "page_id string"))
            # The values after this batch are those before the next.
            counted = known_keys(spark, root, "page_hits_detail", ["page_id"], pages, stamp + 1)
            upsert_table(root, "page_jump_detail", ["page_id"])(funnel(counted), stamp)
        finally:
            steps.unpersist()

    return start(page_visits(lines), together(root, "page-topic", write), root, "page-topic", checkpoint, "append", every)


def pages_now(spark: SparkSession, root: str) -> tuple[DataFrame, DataFrame]:
    """Page steps, and page counts with funnel rates, of the last batch that is written as a whole."""
    upto = last_commit(spark, root, "page-topic")
    steps = current(spark, root, "page_steps_detail", STEP_KEY, upto)
    return steps, current(spark, root, "page_jump_detail", ["page_id"], upto)


def count_page_hits(lines: DataFrame, root: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Visits per page: table ``page_hits``."""
    return start(page_hits(page_visits(lines)), replace_table(root, "page_hits"), root, "page-hits", checkpoint, "complete", every)


def count_provinces(
    lines: DataFrame, ranges: DataFrame, root: str, checkpoint: str, every: str | None = None
) -> StreamingQuery:
    """Visits per province so far, and the top three: ``tmp_city_num_detail`` and ``top_city_num``.

    A batch's counts are added to the totals of the batch before it. A retried batch starts from the
    same totals again, so it never counts twice. A lost checkpoint starts from none.
    """

    def write(visits: DataFrame, batch_id: int) -> None:
        spark = visits.sparkSession
        counts = province_counts(visits, ranges)
        history = read_version(spark, root, "tmp_city_num_detail", before=batch_id, since=first_of_generation(batch_id))
        totals = counts if history is None else add_counts(history, counts)
        write_version(totals, root, "tmp_city_num_detail", batch_id)
        written = read_version(spark, root, "tmp_city_num_detail", before=batch_id + 1)
        write_version(top_provinces(written), root, "top_city_num", batch_id)
        for table in ("tmp_city_num_detail", "top_city_num"):
            drop_versions(spark, root, table)

    return start(page_visits(lines), together(root, "provinces", write), root, "provinces", checkpoint, "append", every)


def archive(
    lines: DataFrame,
    topic: str,
    root: str,
    checkpoint: str,
    every: str | None = None,
    day: Column | None = None,
    compression: str = "snappy",
) -> StreamingQuery:
    """Raw lines as compressed text under ``topic=…/day=…``; the day is the arrival day by default."""
    arrived = day_of(F.current_timestamp()) if day is None else day
    stamped = lines.select("value", F.lit(topic).alias("topic"), arrived.alias("day"))
    query = (
        stamped.writeStream.format("text")
        .partitionBy("topic", "day")
        .option("path", f"{root}/archive")
        .option("compression", compression)
        .option("checkpointLocation", checkpoint)
    )
    trigger = {"processingTime": every} if every else {"availableNow": True}
    return query.trigger(**trigger).start()
