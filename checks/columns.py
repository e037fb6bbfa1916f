"""Column lists the checks expect, written out so that they do not depend on the library's own lists."""

from __future__ import annotations

from dataclasses import dataclass

# The columns of each cleaned table, in order. ``:int`` is a whole number, ``:tenth`` a decimal with one
# fraction digit, the others are text; ``=`` names the key in the log where it differs.
LOG_TEXTS = {
    "dwd_member_regtype": """
        uid:int appkey appregurl bdp_uuid createtime domain=webA isranreg regsource regsourcename=regsource
        websiteid:int dt dn
    """,
    "dwd_member": """
        uid:int ad_id:int birthday email fullname iconurl lastlogin mailaddr memberlevel password paymoney
        phone qq register regupdatetime unitname userip zipcode dt dn
    """,
    "dwd_base_ad": """
        adid:int adname dn
    """,
    "dwd_base_website": """
        siteid:int sitename siteurl delete:int createtime creator dn
    """,
    "dwd_pcentermempaymoney": """
        uid:int paymoney site_id:int=siteid vip_id:int dt dn
    """,
    "dwd_vip_level": """
        vip_id:int vip_level start_time end_time last_modify_time max_free min_free next_level operator dn
    """,
    "dwd_qz_member_paper_question": """
        userid:int paperviewid:int chapterid:int sitecourseid:int questionid:int majorid:int useranswer istrue
        lasttime opertype paperid:int spendtime:int score:tenth question_answer:int dt dn
    """,
    "dwd_qz_question_type": """
        quesviewtype:int viewtypename questypeid:int description status creator createtime papertypename
        sequence remark splitscoretype dt dn
    """,
    "dwd_qz_question": """
        questionid:int parentid:int questypeid:int quesviewtype:int content answer analysis limitminute
        score:tenth splitscore:tenth status optnum:int lecture creator createtime modifystatus attanswer
        questag vanalysisaddr difficulty quesskill vdeoaddr dt dn
    """,
    "dwd_qz_center": """
        centerid:int centername centeryear centertype openstatus centerparam description creator createtime
        sequence provideuser centerviewtype stage dt dn
    """,
    "dwd_qz_paper": """
        paperid:int papercatid:int courseid:int paperyear chapter suitnum papername status creator createtime
        totalscore:tenth chapterid:int chapterlistid:int dt dn
    """,
    "dwd_qz_center_paper": """
        paperviewid:int centerid:int openstatus sequence creator createtime dt dn
    """,
    "dwd_qz_paper_view": """
        paperviewid:int paperid:int paperviewname paperparam openstatus explainurl iscontest contesttime
        conteststarttime contestendtime contesttimelimit dayiid:int status creator createtime
        paperviewcatid:int modifystatus description papertype downurl paperuse paperdifficult testreport
        paperuseshow dt dn
    """,
    "dwd_qz_business": """
        businessid:int businessname sequence status creator createtime siteid:int dt dn
    """,
    "dwd_qz_major": """
        majorid:int businessid:int siteid:int majorname shortname status sequence creator createtime
        columm_sitetype dt dn
    """,
    "dwd_qz_website": """
        siteid:int sitename domain sequence multicastserver templateserver status creator createtime
        multicastgateway multicastport dt dn
    """,
    "dwd_qz_course_edusubject": """
        courseeduid:int edusubjectid:int courseid:int creator createtime majorid:int dt dn
    """,
    "dwd_qz_course": """
        courseid:int majorid:int coursename coursechapter sequence=sequece isadvc creator createtime status
        chapterlistid:int pointlistid:int dt dn
    """,
    "dwd_qz_site_course": """
        sitecourseid:int siteid:int courseid:int sitecoursename coursechapter sequence status creator
        createtime helppaperstatus=helpparperstatus servertype boardid:int showstatus dt dn
    """,
    "dwd_qz_point_question": """
        pointid:int questionid:int questype:int=questtype creator createtime dt dn
    """,
    "dwd_qz_point": """
        pointid:int courseid:int pointname pointyear chapter creator createtime status modifystatus
        excisenum:int pointlistid:int chapterid:int sequence=sequece pointdescribe pointlevel typelist
        score:tenth thought remid pointnamelist typelistids pointlist dt dn
    """,
    "dwd_qz_chapter_list": """
        chapterlistid:int chapterlistname courseid:int chapterallnum:int sequence status creator createtime dt
        dn
    """,
    "dwd_qz_chapter": """
        chapterid:int chapterlistid:int chaptername sequence showstatus status creator createtime courseid:int
        chapternum:int outchapterid:int dt dn
    """,
}
# Tables whose missing scores are zero.
ZERO_SCORES = {"dwd_qz_question"}
# Each view's table, then its columns in order; ``>`` gives the column's name in the view.
VIEW_TEXTS = {
    "member": """
        dwd_member uid ad_id email fullname iconurl lastlogin mailaddr memberlevel password phone qq register
        regupdatetime unitname userip zipcode dt dn
    """,
    "regtype": """
        dwd_member_regtype uid appkey appregurl bdp_uuid createtime>reg_createtime domain isranreg regsource
        regsourcename websiteid>siteid dn
    """,
    "base_ad": """
        dwd_base_ad adid>ad_id adname dn
    """,
    "base_website": """
        dwd_base_website siteid sitename siteurl delete>site_delete createtime>site_createtime
        creator>site_creator dn
    """,
    "vip_level": """
        dwd_vip_level vip_id vip_level start_time>vip_start_time end_time>vip_end_time
        last_modify_time>vip_last_modify_time max_free>vip_max_free min_free>vip_min_free
        next_level>vip_next_level operator>vip_operator dn
    """,
    "payment": """
        dwd_pcentermempaymoney uid paymoney vip_id dn
    """,
    "member_report": """
        dws_member uid ad_id memberlevel register appregurl regsource regsourcename adname siteid sitename
        vip_level paymoney dt dn
    """,
    "qz_chapter": """
        dwd_qz_chapter chapterid chapterlistid chaptername sequence showstatus status creator>chapter_creator
        createtime>chapter_createtime courseid>chapter_courseid chapternum outchapterid dt dn
    """,
    "qz_chapter_list": """
        dwd_qz_chapter_list chapterlistid chapterlistname chapterallnum dn
    """,
    "qz_point": """
        dwd_qz_point pointid pointname pointyear chapter excisenum pointlistid chapterid pointdescribe
        pointlevel typelist score>point_score thought remid pointnamelist typelistids pointlist dn
    """,
    "qz_point_question": """
        dwd_qz_point_question pointid questionid questype dn
    """,
    "qz_site_course": """
        dwd_qz_site_course sitecourseid siteid courseid sitecoursename coursechapter sequence status
        creator>sitecourse_creator createtime>sitecourse_createtime helppaperstatus servertype boardid
        showstatus dt dn
    """,
    "qz_course": """
        dwd_qz_course courseid majorid coursename isadvc chapterlistid pointlistid dn
    """,
    "qz_course_edusubject": """
        dwd_qz_course_edusubject courseeduid edusubjectid courseid dn
    """,
    "qz_major": """
        dwd_qz_major majorid businessid siteid majorname shortname status sequence creator>major_creator
        createtime>major_createtime dt dn
    """,
    "qz_website": """
        dwd_qz_website siteid sitename domain multicastserver templateserver creator createtime
        multicastgateway multicastport dn
    """,
    "qz_business": """
        dwd_qz_business businessid businessname dn
    """,
    "qz_paper_view": """
        dwd_qz_paper_view paperviewid paperid paperviewname paperparam openstatus explainurl iscontest
        contesttime conteststarttime contestendtime contesttimelimit dayiid status creator>paper_view_creator
        createtime>paper_view_createtime paperviewcatid modifystatus description papertype downurl paperuse
        paperdifficult testreport paperuseshow dt dn
    """,
    "qz_center_paper": """
        dwd_qz_center_paper paperviewid centerid sequence dn
    """,
    "qz_paper": """
        dwd_qz_paper paperid papercatid courseid paperyear chapter suitnum papername totalscore chapterid
        chapterlistid dn
    """,
    "qz_center": """
        dwd_qz_center centerid centername centeryear centertype centerparam provideuser centerviewtype stage
        dn
    """,
    "qz_question": """
        dwd_qz_question questionid parentid questypeid quesviewtype content answer analysis limitminute score
        splitscore status optnum lecture creator createtime modifystatus attanswer questag vanalysisaddr
        difficulty quesskill vdeoaddr dt dn
    """,
    "qz_question_type": """
        dwd_qz_question_type viewtypename questypeid description papertypename remark splitscoretype dn
    """,
    "qz_answer": """
        dwd_qz_member_paper_question userid paperviewid chapterid sitecourseid questionid majorid useranswer
        istrue lasttime opertype paperid spendtime score question_answer dt dn
    """,
    "wide_chapter": """
        dws_qz_chapter pointid dn chapterid chapterlistid chaptername sequence>chapter_sequence
        status>chapter_status chapter_courseid chapternum outchapterid chapterlistname chapterallnum pointname
        pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid
        pointnamelist typelistids pointlist questype
    """,
    "wide_chapter_question": """
        dws_qz_chapter pointid dn chapterid chapterlistid chaptername sequence>chapter_sequence
        status>chapter_status chapter_courseid chapternum outchapterid chapterlistname chapterallnum pointname
        pointyear chapter excisenum pointlistid pointdescribe pointlevel typelist point_score thought remid
        pointnamelist typelistids pointlist questionid questype
    """,
    "wide_course": """
        dws_qz_course courseid dn sitecourseid siteid sitecoursename coursechapter sequence>course_sequence
        status>course_status sitecourse_creator sitecourse_createtime helppaperstatus servertype boardid
        showstatus majorid coursename isadvc chapterlistid pointlistid courseeduid edusubjectid
    """,
    "wide_major": """
        dws_qz_major businessid dn majorid majorname shortname status>major_status sequence>major_sequence
        major_creator major_createtime sitename domain multicastserver templateserver multicastgateway
        multicastport businessname
    """,
    "wide_paper": """
        dws_qz_paper paperid dn centerid paperviewid paperviewname paperparam openstatus explainurl iscontest
        contesttime conteststarttime contestendtime contesttimelimit dayiid status>paper_status
        paper_view_creator paper_view_createtime paperviewcatid modifystatus description paperuse testreport
        sequence>paper_sequence centername centeryear centertype provideuser centerviewtype stage>paper_stage
        papercatid courseid paperyear suitnum papername totalscore
    """,
    "wide_question": """
        dws_qz_question questypeid dn questionid parentid>question_parentid quesviewtype
        content>question_content answer>question_answer analysis>question_analysis
        limitminute>question_limitminute score>question_score splitscore lecture creator>question_creator
        createtime>question_createtime modifystatus>question_modifystatus attanswer>question_attanswer
        questag>question_questag vanalysisaddr>question_vanalysisaddr difficulty>question_difficulty quesskill
        vdeoaddr description>question_description splitscoretype>question_splitscoretype
    """,
}
# Amounts that a view turns from text into decimals.
VIEW_MONEY = {"payment": ["paymoney"]}


@dataclass(frozen=True)
class Log:
    columns: list[str]
    kinds: dict[str, str]
    keys: dict[str, str]
    missing_score: str | None

    def kind(self, column: str) -> str:
        return self.kinds.get(column, "string")


@dataclass(frozen=True)
class View:
    table: str
    pairs: list[tuple[str, str]]
    money: list[str]


def _log(table: str, text: str) -> Log:
    columns, kinds, keys = [], {}, {}
    for word in text.split():
        name, _, key = word.partition("=")
        column, _, kind = name.partition(":")
        columns.append(column)
        kinds |= {column: kind} if kind else {}
        keys |= {column: key} if key else {}
    return Log(columns, kinds, keys, "0.0" if table in ZERO_SCORES else None)


def _view(name: str, text: str) -> View:
    table, *words = text.split()
    pairs = [(a, b or a) for a, _, b in (word.partition(">") for word in words)]
    return View(table, pairs, VIEW_MONEY.get(name, []))


LOGS = {table: _log(table, text) for table, text in LOG_TEXTS.items()}
VIEWS = {name: _view(name, text) for name, text in VIEW_TEXTS.items()}
