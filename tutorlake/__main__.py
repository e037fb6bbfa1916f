"""Run a job: ``python -m tutorlake <job> --root … [options]``, or the same with ``spark-submit``."""

from __future__ import annotations

import argparse

from tutorlake.operators.learners import event_time
from tutorlake.plans.cleaning import clean_logs
from tutorlake.plans.member_day import build_members, member_day, report_members, update_zipper
from tutorlake.plans.quiz_day import build_quiz, quiz_day, report_quiz
from tutorlake.session import build_session, stream_session
from tutorlake.sources.streams import folder_stream, topic_stream
from tutorlake.streaming import jobs
from tutorlake.streaming.publish import publish, publish_files, read_lines

DAY_JOBS = {
    "member-day": member_day,
    "member-wide": build_members,
    "member-zipper": update_zipper,
    "member-reports": report_members,
    "quiz-day": quiz_day,
    "quiz-wide": build_quiz,
    "quiz-reports": report_quiz,
}
# Each streaming job with the topic it reads by default.
STREAM_JOBS = {
    "registrations": (jobs.count_registrations, "register_topic"),
    "registration-windows": (jobs.count_registrations_in_window, "register_topic"),
    "mastery": (jobs.track_mastery, "qz_log"),
    "pages": (jobs.count_pages, "page_topic"),
    "provinces": (jobs.count_provinces, "page_topic"),
    "learn-time": (jobs.sum_learn_time, "course_learn"),
    "coverage": (jobs.track_coverage, "course_learn"),
    "archive": (jobs.archive, "page_topic"),
    "register-topic": (jobs.track_registrations, "register_topic"),
    "course-learn": (jobs.track_course_learn, "course_learn"),
    "page-topic": (jobs.track_pages, "page_topic"),
}


def parse(arguments: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(prog="tutorlake")
    names = parser.add_subparsers(dest="job", required=True)

    clean = names.add_parser("clean", help="raw logs to cleaned tables")
    clean.add_argument("--logs", required=True)
    clean.add_argument("--tables", nargs="*")
    clean.add_argument("--root", required=True)
    clean.add_argument("--load", help="name of the load; the log folder's name by default")

    for name in DAY_JOBS:
        job = names.add_parser(name)
        job.add_argument("--root", required=True)
        job.add_argument("--day", required=True, help="yyyyMMdd")
        if name in ("member-day", "member-zipper"):
            job.add_argument("--last-day", help="add the payments of all days up to this one, yyyyMMdd")
        if name in ("quiz-day", "quiz-reports"):
            job.add_argument("--parts", type=int, default=1, help="parts of the list of users in a score band")
            job.add_argument("--dealt", action="store_true", help="deal the answers of one user over the parts too")
            job.add_argument("--keep-all", action="store_true", help="rates of all papers and questions")

    for name, (_, topic) in STREAM_JOBS.items():
        job = names.add_parser(name)
        job.add_argument("--root", required=True)
        job.add_argument("--topic", default=topic)
        source = job.add_mutually_exclusive_group(required=True)
        source.add_argument("--servers", help="read the topic from these brokers")
        source.add_argument("--folder", help="read text files that arrive here")
        job.add_argument("--per-trigger", type=int, help="most messages, or files, per batch")
        job.add_argument("--every", help="batch interval such as '3 seconds'; without it, take what is there and end")
        job.add_argument("--state-partitions", type=int)
        if name == "mastery":
            job.add_argument("--updatetime", action="store_true", help="tell when each learner's totals last changed")
        if name in ("registration-windows", "register-topic"):
            job.add_argument("--length", default="60 seconds")
            job.add_argument("--slide", default="6 seconds")
            job.add_argument("--event-time", action="store_true", help="count at the event's own time, not on arrival")
        if name == "registration-windows":
            job.add_argument("--lateness", help="forget windows after this time; later rows are left out")
        if name in ("learn-time", "course-learn"):
            job.add_argument(
                "--unit-ms", nargs="*", default=[], metavar="DIMENSION=MS", help="unit of one dimension's learning time"
            )
        if name == "provinces":
            job.add_argument("--ranges", required=True, help="table of address ranges: lo, hi, province")

    replay = names.add_parser("publish", help="a text file to a topic or folder")
    replay.add_argument("--file", required=True)
    replay.add_argument("--topic")
    target = replay.add_mutually_exclusive_group(required=True)
    target.add_argument("--servers")
    target.add_argument("--folder")
    return parser.parse_args(arguments)


def run(options: argparse.Namespace) -> None:
    spark = build_session(f"tutorlake {options.job}")
    if options.job == "clean":
        clean_logs(spark, options.logs, options.root, options.tables, options.load)
    elif options.job in DAY_JOBS:
        chosen = {k: v for k, v in vars(options).items() if k in ("last_day", "parts", "dealt", "keep_all")}
        DAY_JOBS[options.job](spark, options.root, options.day, **chosen)
    elif options.job == "publish":
        lines = read_lines(spark, options.file)
        if options.servers:
            publish(lines, options.servers, options.topic)
        else:
            publish_files(lines, options.folder)
    else:
        start_stream(stream_session(spark, options.state_partitions), options)


def start_stream(spark, options: argparse.Namespace) -> None:
    job, _ = STREAM_JOBS[options.job]
    if options.servers:
        lines = topic_stream(spark, options.servers, options.topic, options.per_trigger)
    else:
        lines = folder_stream(spark, options.folder, options.per_trigger)
    more = ()
    if options.job == "provinces":
        more = (spark.read.parquet(options.ranges),)
    elif options.job == "archive":
        more = (options.topic,)
    named = {}
    if options.job == "mastery":
        named = {"updatetime": options.updatetime}
    if options.job == "registration-windows":
        named["lateness"] = options.lateness
    if options.job in ("registration-windows", "register-topic"):
        named |= {"length": options.length, "slide": options.slide}
        named["time"] = event_time() if options.event_time else None
    if options.job in ("learn-time", "course-learn"):
        named["unit_ms"] = {key: int(ms) for key, _, ms in (unit.partition("=") for unit in options.unit_ms)}
    checkpoint = f"{options.root}/checkpoints/{options.job}"
    job(lines, *more, options.root, checkpoint, every=options.every, **named).awaitTermination()


if __name__ == "__main__":
    run(parse())
