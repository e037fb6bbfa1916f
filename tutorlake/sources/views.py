"""Column views over warehouse tables: which columns a job takes and under what name.

A view names every column it takes. The optimizer prunes columns, so a view costs nothing beyond the columns a
query really uses; columns that a table has besides are not seen.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tutorlake.functions.numbers import money
from tutorlake.sources.tables import on_day


@dataclass(frozen=True)
class View:
    """A table, pairs of table column and view column, and the view columns that hold money."""

    table: str
    columns: list[tuple[str, str]]
    money: list[str]


def _view(table: str, text: str, money: str = "") -> View:
    """A view from a text of its columns; ``old>new`` gives a column another name."""
    parts = [word.partition(">") for word in text.split()]
    return View(table, [(old, new or old) for old, _, new in parts], money.split())


# View names, the columns they take in order, and the names these get.
VIEWS = {
    "member": _view(
        "dwd_member",
        """
        uid ad_id email fullname iconurl lastlogin mailaddr memberlevel password phone qq register
        regupdatetime unitname userip zipcode dt dn
        """,
    ),
    "regtype": _view(
        "dwd_member_regtype",
        """
        uid appkey appregurl bdp_uuid createtime>reg_createtime domain isranreg regsource regsourcename
        websiteid>siteid dn
        """,
    ),
    "base_ad": _view(
        "dwd_base_ad",
        """
        adid>ad_id adname dn
        """,
    ),
    "base_website": _view(
        "dwd_base_website",
        """
        siteid sitename siteurl delete>site_delete createtime>site_createtime creator>site_creator dn
        """,
    ),
    "vip_level": _view(
        "dwd_vip_level",
        """
        vip_id vip_level start_time>vip_start_time end_time>vip_end_time
        last_modify_time>vip_last_modify_time max_free>vip_max_free min_free>vip_min_free
        next_level>vip_next_level operator>vip_operator dn
        """,
    ),
    "payment": _view(
        "dwd_pcentermempaymoney",
        """
        uid paymoney vip_id dn
        """,
        money="paymoney",
    ),
    "member_report": _view(
        "dws_member",
        """
        uid ad_id memberlevel register appregurl regsource regsourcename adname siteid sitename
        vip_level paymoney dt dn
        """,
    ),
    "qz_chapter": _view(
        "dwd_qz_chapter",
        """
        chapterid chapterlistid chaptername sequence showstatus status creator>chapter_creator
        createtime>chapter_createtime courseid>chapter_courseid chapternum outchapterid dt dn
        """,
    ),
    "qz_chapter_list": _view(
        "dwd_qz_chapter_list",
        """
        chapterlistid chapterlistname chapterallnum dn
        """,
    ),
    "qz_point": _view(
        "dwd_qz_point",
        """
        pointid pointname pointyear chapter excisenum pointlistid chapterid pointdescribe pointlevel
        typelist score>point_score thought remid pointnamelist typelistids pointlist dn
        """,
    ),
    "qz_point_question": _view(
        "dwd_qz_point_question",
        """
        pointid questionid questype dn
        """,
    ),
    "qz_site_course": _view(
        "dwd_qz_site_course",
        """
        sitecourseid siteid courseid sitecoursename coursechapter sequence status
        creator>sitecourse_creator createtime>sitecourse_createtime helppaperstatus servertype boardid
        showstatus dt dn
        """,
    ),
    "qz_course": _view(
        "dwd_qz_course",
        """
        courseid majorid coursename isadvc chapterlistid pointlistid dn
        """,
    ),
    "qz_course_edusubject": _view(
        "dwd_qz_course_edusubject",
        """
        courseeduid edusubjectid courseid dn
        """,
    ),
    "qz_major": _view(
        "dwd_qz_major",
        """
        majorid businessid siteid majorname shortname status sequence creator>major_creator
        createtime>major_createtime dt dn
        """,
    ),
    "qz_website": _view(
        "dwd_qz_website",
        """
        siteid sitename domain multicastserver templateserver creator createtime multicastgateway
        multicastport dn
        """,
    ),
    "qz_business": _view(
        "dwd_qz_business",
        """
        businessid businessname dn
        """,
    ),
    "qz_paper_view": _view(
        "dwd_qz_paper_view",
        """
        paperviewid paperid paperviewname paperparam openstatus explainurl iscontest contesttime
        conteststarttime contestendtime contesttimelimit dayiid status creator>paper_view_creator
        createtime>paper_view_createtime paperviewcatid modifystatus description papertype downurl
        paperuse paperdifficult testreport paperuseshow dt dn
        """,
    ),
    "qz_center_paper": _view(
        "dwd_qz_center_paper",
        """
        paperviewid centerid sequence dn
        """,
    ),
    "qz_paper": _view(
        "dwd_qz_paper",
        """
        paperid papercatid courseid paperyear chapter suitnum papername totalscore chapterid
        chapterlistid dn
        """,
    ),
    "qz_center": _view(
        "dwd_qz_center",
        """
        centerid centername centeryear centertype centerparam provideuser centerviewtype stage dn
        """,
    ),
    "qz_question": _view(
        "dwd_qz_question",
        """
        questionid parentid questypeid quesviewtype content answer analysis limitminute score splitscore
        status optnum lecture creator createtime modifystatus attanswer questag vanalysisaddr difficulty
        quesskill vdeoaddr dt dn
        """,
    ),
    "qz_question_type": _view(
        "dwd_qz_question_type",
        """
        viewtypename questypeid description papertypename remark splitscoretype dn
        """,
    ),
    "qz_answer": _view(
        "dwd_qz_member_paper_question",
        """
        userid paperviewid chapterid sitecourseid questionid majorid useranswer istrue lasttime opertype
        paperid spendtime score question_answer dt dn
        """,
    ),
    "wide_chapter": _view(
        "dws_qz_chapter",
        """
        pointid dn chapterid chapterlistid chaptername sequence>chapter_sequence status>chapter_status
        chapter_courseid chapternum outchapterid chapterlistname chapterallnum pointname pointyear
        chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid
        pointnamelist typelistids pointlist questype
        """,
    ),
    "wide_chapter_question": _view(
        "dws_qz_chapter",
        """
        pointid dn chapterid chapterlistid chaptername sequence>chapter_sequence status>chapter_status
        chapter_courseid chapternum outchapterid chapterlistname chapterallnum pointname pointyear
        chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid
        pointnamelist typelistids pointlist questionid questype
        """,
    ),
    "wide_course": _view(
        "dws_qz_course",
        """
        courseid dn sitecourseid siteid sitecoursename coursechapter sequence>course_sequence
        status>course_status sitecourse_creator sitecourse_createtime helppaperstatus servertype boardid
        showstatus majorid coursename isadvc chapterlistid pointlistid courseeduid edusubjectid
        """,
    ),
    "wide_major": _view(
        "dws_qz_major",
        """
        businessid dn majorid majorname shortname status>major_status sequence>major_sequence
        major_creator major_createtime sitename domain multicastserver templateserver multicastgateway
        multicastport businessname
        """,
    ),
    "wide_paper": _view(
        "dws_qz_paper",
        """
        paperid dn centerid paperviewid paperviewname paperparam openstatus explainurl iscontest
        contesttime conteststarttime contestendtime contesttimelimit dayiid status>paper_status
        paper_view_creator paper_view_createtime paperviewcatid modifystatus description paperuse
        testreport sequence>paper_sequence centername centeryear centertype provideuser centerviewtype
        stage>paper_stage papercatid courseid paperyear suitnum papername totalscore
        """,
    ),
    "wide_question": _view(
        "dws_qz_question",
        """
        questypeid dn questionid parentid>question_parentid quesviewtype content>question_content
        answer>question_answer analysis>question_analysis limitminute>question_limitminute
        score>question_score splitscore lecture creator>question_creator createtime>question_createtime
        modifystatus>question_modifystatus attanswer>question_attanswer questag>question_questag
        vanalysisaddr>question_vanalysisaddr difficulty>question_difficulty quesskill vdeoaddr
        description>question_description splitscoretype>question_splitscoretype
        """,
    ),
}


def view(rows: DataFrame, name: str, day: str | None = None) -> DataFrame:
    """Apply a view to its table's rows, after keeping one day when ``day`` is given."""
    spec = VIEWS[name]
    return on_day(rows, day).select(
        *[(money(F.col(old)) if new in spec.money else F.col(old)).alias(new) for old, new in spec.columns]
    )
