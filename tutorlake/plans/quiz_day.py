"""One day of the quiz area: wide tables and reports."""

from __future__ import annotations

from functools import partial

from pyspark.sql import DataFrame, SparkSession

from tutorlake.operators import paper_reports, quiz_wide
from tutorlake.sources.tables import read_table, write_table
from tutorlake.sources.views import VIEWS, view

PARTITIONS = ["dt", "dn"]
DETAIL = "dws_user_paper_detail"


def build_quiz(spark: SparkSession, root: str, day: str) -> None:
    """The five wide tables, then the answers joined with them.

    The wide tables are read back for the last join: their real sizes then decide which of them are
    broadcast.
    """

    def part(name: str) -> DataFrame:
        return view(read_table(spark, root, VIEWS[name].table), name, day)

    chapters = quiz_wide.chapter_wide(
        part("qz_chapter"), part("qz_chapter_list"), part("qz_point"), part("qz_point_question")
    )
    write_table(chapters, root, "dws_qz_chapter", PARTITIONS)
    courses = quiz_wide.course_wide(part("qz_site_course"), part("qz_course"), part("qz_course_edusubject"))
    write_table(courses, root, "dws_qz_course", PARTITIONS)
    majors = quiz_wide.major_wide(part("qz_major"), part("qz_website"), part("qz_business"))
    write_table(majors, root, "dws_qz_major", PARTITIONS)
    papers = quiz_wide.paper_wide(part("qz_paper_view"), part("qz_center_paper"), part("qz_center"), part("qz_paper"))
    write_table(papers, root, "dws_qz_paper", PARTITIONS)
    questions = quiz_wide.question_wide(part("qz_question"), part("qz_question_type"))
    write_table(questions, root, "dws_qz_question", PARTITIONS)

    answers = quiz_wide.answer_wide(
        part("qz_answer"), part("wide_course"), part("wide_chapter_question"), part("wide_major"), part("wide_paper"),
        part("wide_question"),
    )
    write_table(answers, root, DETAIL, PARTITIONS)


def report_quiz(
    spark: SparkSession, root: str, day: str, parts: int = 1, dealt: bool = False, keep_all: bool = False
) -> None:
    """All quiz reports of the day. Each reads only its own columns of the day's partitions.

    ``parts`` and ``dealt`` go to the user lists, ``keep_all`` to both rates.
    """
    answers = read_table(spark, root, DETAIL)
    reports = {
        "ads_paper_avgtimeandscore": paper_reports.paper_averages,
        "ads_paper_maxdetail": paper_reports.paper_extremes,
        "ads_top3_userdetail": paper_reports.best_answers,
        "ads_low3_userdetail": paper_reports.worst_answers,
        "ads_paper_scoresegment_user": partial(paper_reports.band_users, parts=parts, dealt=dealt),
        "ads_user_paper_detail": partial(paper_reports.pass_rates, keep_all=keep_all),
        "ads_user_question_detail": partial(paper_reports.error_rates, keep_all=keep_all),
    }
    for table, report in reports.items():
        write_table(report(answers, day), root, table, PARTITIONS)


def quiz_day(
    spark: SparkSession, root: str, day: str, parts: int = 1, dealt: bool = False, keep_all: bool = False
) -> None:
    build_quiz(spark, root, day)
    report_quiz(spark, root, day, parts, dealt, keep_all)
