"""Wide tables of the quiz area.

Every join is an equi-join on an id plus the site. None carries a broadcast hint: small tables are
broadcast by the session's size threshold, others are joined by shuffle, where AQE splits hot keys.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

# Columns of the chapter table that belong to a point and its question.
POINT_COLUMNS = (
    "pointid pointname pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist point_score "
    "thought remid pointnamelist typelistids pointlist questype"
).split()


def chapter_wide(
    chapter: DataFrame, chapter_list: DataFrame, point: DataFrame, point_question: DataFrame
) -> DataFrame:
    """Chapters with their list, points and questions: one row per point and question."""
    listed = chapter.join(chapter_list, ["chapterlistid", "dn"])
    return listed.join(point, ["chapterid", "dn"]).join(point_question, ["pointid", "dn"])


def course_wide(site_course: DataFrame, course: DataFrame, edusubject: DataFrame) -> DataFrame:
    return site_course.join(course, ["courseid", "dn"]).join(edusubject, ["courseid", "dn"])


def major_wide(major: DataFrame, website: DataFrame, business: DataFrame) -> DataFrame:
    site = website.drop("creator", "createtime")
    return major.join(site, ["siteid", "dn"]).join(business, ["businessid", "dn"])


def paper_wide(
    paper_view: DataFrame, center_paper: DataFrame, center: DataFrame, paper: DataFrame
) -> DataFrame:
    """Paper views with their paper; the exam centre is optional."""
    return (
        paper_view.drop("papertype", "downurl")
        .join(center_paper, ["paperviewid", "dn"], "left")
        .join(center.drop("centerparam"), ["centerid", "dn"], "left")
        .join(paper.drop("chapter"), ["paperid", "dn"])
    )


def question_wide(question: DataFrame, question_type: DataFrame) -> DataFrame:
    """Questions with their type, including the type's description."""
    return question.join(question_type, ["questypeid", "dn"])


def answer_wide(
    answer: DataFrame,
    wide_course: DataFrame,
    wide_chapter: DataFrame,
    wide_major: DataFrame,
    wide_paper: DataFrame,
    wide_question: DataFrame,
    repeat_chapters: bool = False,
) -> DataFrame:
    """Answers with course, chapter, major, paper and question, from the views of the wide tables.

    The chapter table has one row per point and question; ``wide_chapter`` is its view with the question.
    An answer takes its chapter and the points that have its own question; without one the point's columns
    are null. With ``repeat_chapters`` it appears once for every point and question of its chapter instead,
    as many times as the chapter has questions.

    Answers are shuffled once for a large table, with what was joined before. So papers, which many answers lack, come
    first, wide texts late, and majors, few enough to be broadcast, last. Points follow questions: a session that
    :func:`tutorlake.session.build_session` sets up joins them on the partitions of the questions.
    """
    listed = wide_chapter.drop("chapter_sequence", "chapter_status", "chapter_courseid")
    course = wide_course.drop("majorid", "chapterlistid", "pointlistid").withColumnsRenamed(
        {"sitecourse_creator": "course_creator", "sitecourse_createtime": "course_createtime"}
    )
    question = wide_question.drop("question_score")
    joined = (
        answer.withColumnRenamed("question_answer", "user_question_answer")
        .drop("paperid")
        .join(wide_paper.drop("courseid"), ["paperviewid", "dn"])
        .join(course, ["sitecourseid", "dn"])
    )
    if repeat_chapters:
        asked = joined.join(question, ["questionid", "dn"])
        return asked.join(listed.drop("questionid"), ["chapterid", "dn"]).join(wide_major, ["majorid", "dn"])
    points = listed.select("chapterid", "questionid", "dn", *POINT_COLUMNS)
    chapters = listed.drop("questionid", *POINT_COLUMNS).distinct()
    asked = joined.join(chapters, ["chapterid", "dn"]).join(question, ["questionid", "dn"])
    return asked.join(points, ["questionid", "chapterid", "dn"], "left").join(wide_major, ["majorid", "dn"])
