"""Video watching: learning time by dimension, and coverage of a video by what was watched."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tutorlake.functions.numbers import whole_units

VIDEO = ["userid", "cwareid", "videoid"]
# Result tables of learning time, and the event column each one sums by.
LEARN_DIMENSIONS = {
    "chapter_learn_detail": "chapterid",
    "cwareid_learn_detail": "cwareid",
    "edutype_learn_detail": "edutypeid",
    "sourcetype_learn_detail": "sourceType",
    "subject_learn_detail": "subjectid",
}


def learn_rows(events: DataFrame, unit_ms: dict[str, int] | None = None) -> DataFrame:
    """One row per event and dimension: table, key as text, whole time units.

    The unit is a second in every dimension; ``unit_ms`` sets another one for single tables.
    """
    units = unit_ms or {}
    parts = [
        F.struct(
            F.lit(table).alias("dimension"),
            F.col(column).cast("string").alias("key"),
            whole_units(F.col("ts"), F.col("te"), units.get(table, 1000)).alias("spent"),
        )
        for table, column in LEARN_DIMENSIONS.items()
    ]
    carried = [c for c in events.columns if c == "updatetime"]
    return events.select(F.explode(F.array(*parts)).alias("part"), *carried).select("part.*", *carried)


def learn_time(events: DataFrame, unit_ms: dict[str, int] | None = None, *more: Column) -> DataFrame:
    """Total learning time by each dimension, for batch and stream, and ``more`` aggregates.

    One scan for all five dimensions; partial sums keep hot keys out of the shuffle.
    """
    rows = learn_rows(events, unit_ms)
    return rows.groupBy("dimension", "key").agg(F.sum("spent").alias("totaltime"), *more)


def _by_start(events: DataFrame, *more: Column) -> DataFrame:
    """Events reduced to one row per video and start position, before anything is ordered.

    Of the events that start at one position, the longest decides what is newly covered (the rest
    adds nothing), and their elapsed times add up. A video watched by a third of all events shrinks
    to at most one row per second of its length.
    """
    elapsed = F.coalesce(whole_units(F.col("ts"), F.col("te")), F.lit(0).cast("bigint"))
    end_then_time = F.struct("pe", elapsed.alias("elapsed"))
    return events.withColumnRenamed("uid", "userid").groupBy(*VIDEO, "ps").agg(
        F.max("pe").alias("pe"), F.max_by(elapsed, end_then_time).alias("elapsed"), F.sum(elapsed).alias("total"), *more
    )


def batch_coverage(events: DataFrame) -> DataFrame:
    """Per learner and video what a batch brings: ``fresh`` ranges in order of start, elapsed ``spent``, ``updatetime``.

    An array per video, of one range per second at most; events without extent only add to the time.
    """
    changed = F.max("updatetime").alias("updatetime")
    reduced = _by_start(events, changed)
    ranged = F.when(F.col("pe") > F.col("ps"), F.struct(*[F.col(c).cast("bigint").alias(c) for c in ("ps", "pe", "elapsed")]))
    return reduced.groupBy(*VIDEO).agg(
        F.sort_array(F.collect_list(ranged)).alias("fresh"), F.sum("total").cast("bigint").alias("spent"), changed
    )


def coverage(events: DataFrame) -> DataFrame:
    """Per learner and video: total, effective and completed watching time of one set of events.

    Completed is the length of the union of the watched ranges. Events count in the order of their
    start positions: what an event newly covers is what lies beyond the furthest end so far, and its
    effective time is its elapsed time times the newly covered fraction, cut to whole seconds.

    The window sees one row per second of a video at most, however often it was watched, and the sums
    reuse its partitioning.
    """
    earlier = Window.partitionBy(*VIDEO).orderBy("ps").rowsBetween(Window.unboundedPreceding, -1)
    reached = F.greatest("ps", F.max("pe").over(earlier))
    marked = _by_start(events).withColumn("fresh", F.greatest(F.col("pe") - reached, F.lit(0)))
    worth = F.when(
        F.col("pe") > F.col("ps"), F.call_function("div", F.col("elapsed") * F.col("fresh"), F.col("pe") - F.col("ps"))
    ).otherwise(F.lit(0))
    return marked.groupBy(*VIDEO).agg(
        F.sum("total").alias("totaltime"), F.sum(worth).alias("effecttime"), F.sum("fresh").alias("completetime")
    )


def watched_ranges(events: DataFrame) -> DataFrame:
    """The watched parts of each video as separate ranges; overlapping and touching ones are joined.

    A range opens where a start position lies beyond everything reached before it, and ends at the
    furthest end reached before the next one opens.
    """
    by_start = Window.partitionBy(*VIDEO).orderBy("ps")
    reached = F.max("pe").over(by_start.rowsBetween(Window.unboundedPreceding, -1))
    so_far = by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    watched = _by_start(events).where(F.col("pe") > F.col("ps"))
    opened = watched.withColumn("opens", F.coalesce(F.col("ps") > reached, F.lit(True)))
    numbered = opened.withColumn("range_no", F.count_if("opens").over(so_far))
    ranges = numbered.groupBy(*VIDEO, "range_no").agg(F.min("ps").alias("range_start"), F.max("pe").alias("range_end"))
    return ranges.drop("range_no")


def range_text(ranges: DataFrame) -> DataFrame:
    """The ranges of each video as text such as ``0-10,15-20``, in order of position."""
    text = F.concat_ws("-", "range_start", "range_end").alias("text")
    in_order = F.sort_array(F.collect_list(F.struct("range_start", text)))
    return ranges.groupBy(*VIDEO).agg(F.concat_ws(",", in_order["text"]).alias("play_interval"))
