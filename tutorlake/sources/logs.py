"""The raw JSON logs: what each one holds and how it is cleaned.

A log is described by the columns of its cleaned table. Column types follow one rule, so only names
are listed: a name that ends in ``id`` is a whole number (0 when missing), a name that ends in
``score`` is a decimal with one fraction digit, everything else is text. Exceptions are below.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tutorlake.functions.coding import register_source
from tutorlake.functions.numbers import int_or_zero, tenth
from tutorlake.functions.privacy import mask_name, mask_phone, redacted_password
from tutorlake.sources.lines import json_objects

# Exceptions to the type rule.
TEXT_ENDING_IN_ID = {"bdp_uuid", "remid"}
OTHER_NUMBERS = {
    "delete", "spendtime", "question_answer", "quesviewtype", "optnum", "excisenum", "questype",
    "chapterallnum", "chapternum",
}


@dataclass(frozen=True)
class Log:
    """One raw log and its cleaned table.

    ``keys`` maps a column to its key in the log where the two differ. ``daily`` tables are
    partitioned by day and site, the others are small dimensions partitioned by site.
    """

    file: str
    columns: list[str]
    keys: dict[str, str] = field(default_factory=dict)
    daily: bool = True
    missing_score: str | None = None

    def kind(self, column: str) -> str:
        if column.endswith("score"):
            return "tenth"
        if column in OTHER_NUMBERS or (column.endswith("id") and column not in TEXT_ENDING_IN_ID):
            return "int"
        return "string"

    @property
    def partitions(self) -> list[str]:
        return ["dt", "dn"] if self.daily else ["dn"]


def _log(file: str, columns: str, daily: bool = True, missing_score: str | None = None, **keys: str) -> Log:
    return Log(file, columns.split() + (["dt", "dn"] if daily else ["dn"]), keys, daily, missing_score)


# Log names, column names and the keys that are spelled differently in a log.
LOGS = {
    "dwd_member_regtype": _log(
        "memberRegtype.log",
        "uid appkey appregurl bdp_uuid createtime domain isranreg regsource regsourcename websiteid",
        domain="webA", regsourcename="regsource",
    ),
    "dwd_member": _log(
        "member.log",
        "uid ad_id birthday email fullname iconurl lastlogin mailaddr memberlevel password paymoney phone qq "
        "register regupdatetime unitname userip zipcode",
    ),
    "dwd_base_ad": _log("baseadlog.log", "adid adname", daily=False),
    "dwd_base_website": _log(
        "baswewebsite.log", "siteid sitename siteurl delete createtime creator", daily=False,
    ),
    "dwd_pcentermempaymoney": _log(
        "pcentermempaymoney.log", "uid paymoney site_id vip_id", site_id="siteid",
    ),
    "dwd_vip_level": _log(
        "pcenterMemViplevel.log",
        "vip_id vip_level start_time end_time last_modify_time max_free min_free next_level operator",
        daily=False,
    ),
    "dwd_qz_member_paper_question": _log(
        "QzMemberPaperQuestion.log",
        "userid paperviewid chapterid sitecourseid questionid majorid useranswer istrue lasttime opertype "
        "paperid spendtime score question_answer",
    ),
    "dwd_qz_question_type": _log(
        "QzQuestionType.log",
        "quesviewtype viewtypename questypeid description status creator createtime papertypename sequence "
        "remark splitscoretype",
    ),
    "dwd_qz_question": _log(
        "QzQuestion.log",
        "questionid parentid questypeid quesviewtype content answer analysis limitminute score splitscore "
        "status optnum lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty "
        "quesskill vdeoaddr",
        missing_score="0.0",
    ),
    "dwd_qz_center": _log(
        "QzCenter.log",
        "centerid centername centeryear centertype openstatus centerparam description creator createtime "
        "sequence provideuser centerviewtype stage",
    ),
    "dwd_qz_paper": _log(
        "QzPaper.log",
        "paperid papercatid courseid paperyear chapter suitnum papername status creator createtime "
        "totalscore chapterid chapterlistid",
    ),
    "dwd_qz_center_paper": _log(
        "QzCenterPaper.log", "paperviewid centerid openstatus sequence creator createtime",
    ),
    "dwd_qz_paper_view": _log(
        "QzPaperView.log",
        "paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime "
        "conteststarttime contestendtime contesttimelimit dayiid status creator createtime paperviewcatid "
        "modifystatus description papertype downurl paperuse paperdifficult testreport paperuseshow",
    ),
    "dwd_qz_business": _log(
        "QzBusiness.log", "businessid businessname sequence status creator createtime siteid",
    ),
    "dwd_qz_major": _log(
        "QzMajor.log",
        "majorid businessid siteid majorname shortname status sequence creator createtime columm_sitetype",
    ),
    "dwd_qz_website": _log(
        "QzWebsite.log",
        "siteid sitename domain sequence multicastserver templateserver status creator createtime "
        "multicastgateway multicastport",
    ),
    "dwd_qz_course_edusubject": _log(
        "QzCourseEduSubject.log", "courseeduid edusubjectid courseid creator createtime majorid",
    ),
    "dwd_qz_course": _log(
        "QzCourse.log",
        "courseid majorid coursename coursechapter sequence isadvc creator createtime status chapterlistid "
        "pointlistid",
        sequence="sequece",
    ),
    "dwd_qz_site_course": _log(
        "QzSiteCourse.log",
        "sitecourseid siteid courseid sitecoursename coursechapter sequence status creator createtime "
        "helppaperstatus servertype boardid showstatus",
        helppaperstatus="helpparperstatus",
    ),
    "dwd_qz_point_question": _log(
        "QzPointQuestion.log", "pointid questionid questype creator createtime", questype="questtype",
    ),
    "dwd_qz_point": _log(
        "QzPoint.log",
        "pointid courseid pointname pointyear chapter creator createtime status modifystatus excisenum "
        "pointlistid chapterid sequence pointdescribe pointlevel typelist score thought remid pointnamelist "
        "typelistids pointlist",
        sequence="sequece",
    ),
    "dwd_qz_chapter_list": _log(
        "QzChapterList.log",
        "chapterlistid chapterlistname courseid chapterallnum sequence status creator createtime",
    ),
    "dwd_qz_chapter": _log(
        "QzChapter.log",
        "chapterid chapterlistid chaptername sequence showstatus status creator createtime courseid "
        "chapternum outchapterid",
    ),
}

# Columns whose value is more than the text found in the log.
RULES = {
    ("dwd_member_regtype", "regsourcename"): register_source,
    ("dwd_member", "fullname"): mask_name,
    ("dwd_member", "phone"): mask_phone,
    ("dwd_member", "password"): lambda _: redacted_password(),
}


def clean(lines: DataFrame, table: str) -> DataFrame:
    """Raw lines of one log to the rows of its cleaned table. Narrow: no shuffle, one pass."""
    log = LOGS[table]
    source = {column: log.keys.get(column, column) for column in log.columns}
    objects = json_objects(lines, list(dict.fromkeys(source.values())))

    def value(column: str) -> Column:
        text = F.col(f"`{source[column]}`")
        if (table, column) in RULES:
            return RULES[table, column](text)
        kind = log.kind(column)
        if kind == "int":
            return int_or_zero(text)
        if kind == "tenth":
            return tenth(F.coalesce(text, F.lit(log.missing_score)))
        return text

    return objects.select(*[value(column).alias(column) for column in log.columns])


def read_log(spark: SparkSession, folder: str, table: str) -> DataFrame:
    """The cleaned rows of the log for ``table``, read from ``folder``."""
    return clean(spark.read.text(f"{folder}/{LOGS[table].file}"), table)
