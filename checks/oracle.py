"""DuckDB SQL that each registered query is compared with.

Written as plain joins, groupings and subqueries, in other shapes than the library's own plans where
those are rewritten (one-pass rates, pre-summed payments, ranked distinct scores, bucketed ranges).
"""

from __future__ import annotations

from checks.columns import LOGS, VIEWS
from checks.raw_logs import expected_rows
from checks.shapes import SHAPES, TABLES
from tutorlake.operators.member_reports import COUNT_REPORTS

SITE_NAMES = {table: table for table in TABLES}


def shape_sql(name: str) -> str:
    return SHAPES[name].format(**SITE_NAMES)


def with_shapes(names: list[str], body: str, **more: str) -> str:
    """``body`` with the named shapes, then further named queries, in front."""
    parts = [f"{name} as ({shape_sql(name)})" for name in names]
    parts += [f"{name} as ({sql})" for name, sql in more.items()]
    return f"with {', '.join(parts)} {body}"


def view_sql(name: str) -> str:
    spec = VIEWS[name]
    columns = ", ".join(
        f"{f'cast({column} as decimal(18,4))' if column in spec.money else column} as {alias}"
        for column, alias in spec.pairs
    )
    return f"select {columns} from {spec.table}"


# Wide tables: the views joined, the columns left out, and the shapes they need.
WIDE = {
    "dws_qz_chapter": (
        "select * from qz_chapter join qz_chapter_list using (chapterlistid, dn) "
        "join qz_point using (chapterid, dn) join qz_point_question using (pointid, dn)",
        ["qz_chapter", "qz_chapter_list", "qz_point", "qz_point_question"],
    ),
    "dws_qz_course": (
        "select * from qz_site_course join qz_course using (courseid, dn) "
        "join qz_course_edusubject using (courseid, dn)",
        ["qz_site_course", "qz_course", "qz_course_edusubject"],
    ),
    "dws_qz_major": (
        "select * exclude (creator, createtime) from qz_major join qz_website using (siteid, dn) "
        "join qz_business using (businessid, dn)",
        ["qz_major", "qz_website", "qz_business"],
    ),
    "dws_qz_paper": (
        "select * exclude (papertype, downurl, centerparam, chapter) from qz_paper_view "
        "left join qz_center_paper using (paperviewid, dn) left join qz_center using (centerid, dn) "
        "join qz_paper using (paperid, dn)",
        ["qz_paper_view", "qz_center_paper", "qz_center", "qz_paper"],
    ),
    "dws_qz_question": (
        "select * from qz_question join qz_question_type using (questypeid, dn)",
        ["qz_question", "qz_question_type"],
    ),
}
DECIMAL_COLUMNS = {
    "dws_qz_chapter": ["point_score"],
    "dws_qz_paper": ["totalscore"],
    "dws_qz_question": ["score", "splitscore"],
}


def wide_parts(table: str) -> tuple[list[str], dict[str, str]]:
    body, names = WIDE[table]
    views = {name: view_sql(name) for name in names}
    return [VIEWS[name].table for name in names], {**views, table: body}


def as_double(columns: list[str]) -> str:
    return ", ".join(f"cast({column} as double) as {column}" for column in columns)


def wide_sql(table: str) -> str:
    shapes, more = wide_parts(table)
    doubles = DECIMAL_COLUMNS.get(table)
    chosen = f"* replace ({as_double(doubles)})" if doubles else "*"
    return with_shapes(shapes, f"select {chosen} from {table}", **more)


MEMBER_SHAPES = [
    "dwd_member", "dwd_member_regtype", "dwd_base_ad", "dwd_base_website", "dwd_pcentermempaymoney", "dwd_vip_level",
]
MEMBER_CHAIN = """
    select a.uid, a.ad_id, a.email, a.fullname, a.iconurl, a.lastlogin, a.mailaddr, a.memberlevel, a.password, a.phone,
           a.qq, a.register, a.regupdatetime, a.unitname, a.userip, a.zipcode, a.dt, a.dn, b.appkey, b.appregurl,
           b.bdp_uuid, b.createtime as reg_createtime, b.domain, b.isranreg, b.regsource, b.regsourcename, c.adname,
           d.siteid, d.sitename, d.siteurl, d.delete as site_delete, d.createtime as site_createtime,
           d.creator as site_creator, cast(e.paymoney as decimal(18,4)) as paymoney, f.vip_id, f.vip_level,
           f.start_time as vip_start_time, f.end_time as vip_end_time, f.last_modify_time as vip_last_modify_time,
           f.max_free as vip_max_free, f.min_free as vip_min_free, f.next_level as vip_next_level,
           f.operator as vip_operator
    from dwd_member a
    left join dwd_member_regtype b on a.uid = b.uid and a.dn = b.dn
    left join dwd_base_ad c on a.ad_id = c.adid and a.dn = c.dn
    left join dwd_base_website d on b.websiteid = d.siteid and b.dn = d.dn
    left join dwd_pcentermempaymoney e on a.uid = e.uid and a.dn = e.dn
    left join dwd_vip_level f on e.vip_id = f.vip_id and e.dn = f.dn"""
MEMBER_FIXED = (
    "ad_id email fullname iconurl lastlogin mailaddr memberlevel password phone qq register regupdatetime unitname "
    "userip zipcode appkey appregurl bdp_uuid reg_createtime domain isranreg regsource regsourcename adname siteid "
    "sitename siteurl site_delete site_createtime site_creator"
).split()
MEMBER_WIDE = f"""
    select uid, dn, dt, {', '.join(f'min({c}) as {c}' for c in MEMBER_FIXED)},
           cast(sum(paymoney) as decimal(28,4)) as paymoney, min(vip_id) as vip_id, max(vip_level) as vip_level,
           min(vip_start_time) as vip_start_time, max(vip_end_time) as vip_end_time,
           max(vip_last_modify_time) as vip_last_modify_time, arg_min(vip_max_free, vip_id) as vip_max_free,
           arg_min(vip_min_free, vip_id) as vip_min_free, max(vip_next_level) as vip_next_level,
           arg_min(vip_operator, vip_id) as vip_operator
    from chain group by uid, dn, dt"""


def member_sql(body: str) -> str:
    return with_shapes(MEMBER_SHAPES, body, chain=MEMBER_CHAIN, dws_member=MEMBER_WIDE)


def member_count(column: str) -> str:
    return member_sql(
        f"select {column}, dt, dn, count(uid) as uid_count from dws_member group by {column}, dt, dn"
    )


DAY_PAYMENTS = """
    select a.uid, a.dn, a.dt, sum(cast(a.paymoney as decimal(18,4))) as paid, max(b.vip_level) as vip_level
    from dwd_pcentermempaymoney a join dwd_vip_level b on a.vip_id = b.vip_id and a.dn = b.dn
    group by a.uid, a.dn, a.dt"""
PAYMENT_SHAPES = ["dwd_pcentermempaymoney", "dwd_vip_level"]
DAY_START = "strftime(strptime(dt, '%Y%m%d'), '%Y-%m-%d')"

RANKED = (
    "userid, paperviewid, paperviewname, chaptername, pointname, sitecoursename, coursename, majorname, shortname, "
    "papername, cast(score as double) as score, cast(rk as int) as rk, dt, dn"
)
BAND = """case when score >= 0 and score <= 20 then '0-20' when score > 20 and score <= 40 then '20-40'
          when score > 40 and score <= 60 then '40-60' when score > 60 and score <= 80 then '60-80'
          when score > 80 and score <= 100 then '80-100' end"""


def part_of(value: str, parts: int) -> str:
    return f"cast(cast('0x' || substr(md5(cast({value} as string)), 1, 8) as bigint) % {parts} as int)"


def answers_sql(body: str) -> str:
    return with_shapes(["answers"], body)


def ranked(order: str) -> str:
    return answers_sql(
        f"select {RANKED} from (select *, dense_rank() over (partition by paperviewid, dt order by score {order}) as rk "
        "from answers) t where rk <= 3"
    )


VISITS = """select uid, app_id, device_id, ip, last_page_id, page_id, next_page_id from page_events
            where last_page_id <> '' and page_id <> '' and next_page_id <> ''"""
HITS = "select page_id, count(*) as num from visits group by page_id"
FUNNEL_RATES = """select h.page_id, h.num, case when h.page_id = '1' then '100%' when h.page_id in ('2', '3') then
                  cast(cast(round_even(coalesce(h.num / e.num, 0) * 100, 0) as bigint) as string) || '%' end as jump_rate
                  from hits h left join hits e on cast(e.page_id as int) = cast(h.page_id as int) - 1"""
ADDRESS = """cast(split_part(ip, '.', 1) as bigint) * 16777216 + cast(split_part(ip, '.', 2) as bigint) * 65536
             + cast(split_part(ip, '.', 3) as bigint) * 256 + cast(split_part(ip, '.', 4) as bigint)"""
PROVINCES = f"""select province, count(*) as num from (select {ADDRESS} as address from visits) v
                left join ip_ranges on address between lo and hi group by province"""


def pages_sql(body: str, *shapes: str, **more: str) -> str:
    return with_shapes(["page_events", *shapes], body, visits=VISITS, **more)


LEARN = " union all ".join(
    f"select '{table}' as dimension, cast({column} as string) as key, cast(sum((te - ts) // 1000) as bigint) as totaltime "
    f"from watch_events group by {column}"
    for table, column in (
        ("chapter_learn_detail", "chapterid"), ("cwareid_learn_detail", "cwareid"),
        ("edutype_learn_detail", "edutypeid"), ("sourcetype_learn_detail", "sourceType"),
        ("subject_learn_detail", "subjectid"),
    )
)
VIDEO = "uid, cwareid, videoid"
# Every event in order of start, the longest first among equal starts.
COVERAGE = f"""
    select uid as userid, cwareid, videoid, cast(sum(elapsed) as bigint) as totaltime,
           cast(sum(case when pe > ps then elapsed * fresh // (pe - ps) else 0 end) as bigint) as effecttime,
           cast(sum(fresh) as bigint) as completetime
    from (select *, greatest(pe - greatest(ps, coalesce(reached, ps)), 0) as fresh
          from (select *, (te - ts) // 1000 as elapsed,
                       max(pe) over (partition by {VIDEO} order by ps, pe desc, (te - ts) // 1000 desc
                                     rows between unbounded preceding and 1 preceding) as reached
                from watch_events) o) f
    group by uid, cwareid, videoid"""
ISLANDS = f"""
    select {VIDEO}, island, min(ps) as low, max(pe) as high
    from (select *, sum(opens) over (partition by {VIDEO} order by ps, pe rows unbounded preceding) as island
          from (select *, case when ps > max(pe) over (partition by {VIDEO} order by ps, pe
                               rows between unbounded preceding and 1 preceding) then 1 else 0 end as opens
                from watch_events) o) n
    group by {VIDEO}, island"""
RANGE_TEXT = """
    select uid as userid, cwareid, videoid,
           string_agg(cast(low as string) || '-' || cast(high as string), ',' order by low) as play_interval
    from islands group by uid, cwareid, videoid"""

# Good tab lines count twice: as they are and with trailing tabs.
REGISTERED = "(select *, unnest([1, 2]) as copy from register_events) e"
QUIZ = "(select *, unnest([1, 2]) as copy from quiz_events) q"
PLATFORM = "case platform_code when 1 then 'PC' when 2 then 'APP' else 'Other' end"


def all_oracles() -> dict[str, str]:
    found: dict[str, str] = {}
    found.update({f"clean_{table.removeprefix('dwd_')}": expected_rows(table) for table in LOGS})
    for name, spec in VIEWS.items():
        key = f"view_{name}"
        if spec.table in LOGS:
            doubles = [b for a, b in spec.pairs if LOGS[spec.table].kind(a) == "tenth"] + spec.money
            chosen = f"* replace ({as_double(doubles)})" if doubles else "*"
            found[key] = with_shapes([spec.table], f"select {chosen} from ({view_sql(name)}) v")
    found["view_member_report"] = member_sql(
        "select uid, ad_id, memberlevel, register, appregurl, regsource, regsourcename, adname, siteid, sitename, "
        "vip_level, cast(paymoney as double) as paymoney, dt, dn from dws_member"
    )
    wide_views = {}
    for name in ("wide_chapter", "wide_chapter_question", "wide_course", "wide_major", "wide_paper", "wide_question"):
        spec = VIEWS[name]
        wide_views[name] = view_sql(name)
        shapes, more = wide_parts(spec.table)
        doubles = [b for a, b in spec.pairs if a in DECIMAL_COLUMNS.get(spec.table, [])]
        chosen = f"* replace ({as_double(doubles)})" if doubles else "*"
        found[f"view_{name}"] = with_shapes(shapes, f"select {chosen} from {name}", **more, **{name: wide_views[name]})

    answer_shapes, answer_more = ["dwd_qz_member_paper_question"], {}
    for table in WIDE:
        shapes, more = wide_parts(table)
        answer_shapes += [s for s in shapes if s not in answer_shapes]
        answer_more.update(more)
    answer_more.update(wide_views)
    found["quiz_answer_wide"] = with_shapes(
        answer_shapes,
        """select a.userid, a.questionid, a.useranswer, cast(a.score as double) as score, a.spendtime,
                  a.question_answer as user_question_answer, a.sitecourseid, c.siteid, c.courseid, c.coursename,
                  c.sitecourse_creator as course_creator, c.edusubjectid, a.chapterid, h.chaptername, h.chapterlistname,
                  t.pointid, t.pointname, cast(t.point_score as double) as point_score, a.majorid, m.majorname,
                  m.businessname, m.sitename, a.paperviewid, p.paperviewname, p.centerid, p.centername, p.papername,
                  cast(p.totalscore as double) as totalscore, q.questypeid, q.question_content, q.question_answer,
                  q.question_description, a.dt, a.dn
           from dwd_qz_member_paper_question a
           join wide_course c on a.sitecourseid = c.sitecourseid and a.dn = c.dn
           join (select distinct chapterid, dn, chaptername, chapterlistname from wide_chapter) h
             on a.chapterid = h.chapterid and a.dn = h.dn
           left join (select chapterid, dn, questionid, pointid, pointname, point_score from dws_qz_chapter) t
             on a.chapterid = t.chapterid and a.dn = t.dn and a.questionid = t.questionid
           join wide_major m on a.majorid = m.majorid and a.dn = m.dn
           join wide_paper p on a.paperviewid = p.paperviewid and a.dn = p.dn
           join wide_question q on a.questionid = q.questionid and a.dn = q.dn""",
        **answer_more,
    )
    found["quiz_answer_wide_repeated"] = with_shapes(
        answer_shapes,
        """select a.userid, a.questionid, a.useranswer, cast(a.score as double) as score, a.spendtime,
                  a.question_answer as user_question_answer, a.sitecourseid, c.siteid, c.courseid, c.coursename,
                  c.sitecourse_creator as course_creator, c.edusubjectid, a.chapterid, h.chaptername, h.chapterlistname,
                  h.pointid, h.pointname, cast(h.point_score as double) as point_score, a.majorid, m.majorname,
                  m.businessname, m.sitename, a.paperviewid, p.paperviewname, p.centerid, p.centername, p.papername,
                  cast(p.totalscore as double) as totalscore, q.questypeid, q.question_content, q.question_answer,
                  q.question_description, a.dt, a.dn
           from dwd_qz_member_paper_question a
           join wide_course c on a.sitecourseid = c.sitecourseid and a.dn = c.dn
           join wide_chapter h on a.chapterid = h.chapterid and a.dn = h.dn
           join wide_major m on a.majorid = m.majorid and a.dn = m.dn
           join wide_paper p on a.paperviewid = p.paperviewid and a.dn = p.dn
           join wide_question q on a.questionid = q.questionid and a.dn = q.dn""",
        **answer_more,
    )
    found.update(
        clean_json_keys="select cast(event_id as string) as event_id, event_type, cast(null as string) as absent "
        "from events",
        clean_two_loads=f"""
            select right(coalesce(dt, 'none'), 1) as dt, site || cast(uid % 3 as string) as dn, count(*) as n,
                   max(uid) as uid, count(paymoney) as paid
            from ({expected_rows('dwd_pcentermempaymoney')}) e, (select unnest(['00', '']) as site) s
            group by 1, 2""",
        clean_tsv_arity=with_shapes(
            ["register_events"],
            f"select cast(userid as string) as userid, cast(platform_code as string) as platform_code, createtime, "
            f"{PLATFORM} as app_name from {REGISTERED}",
        ),
        clean_page_visits=with_shapes(["page_events"], VISITS),
        mask_pii="""select c_custkey, left(c_name, 1) || 'xx' as fullname,
                           '138*****' || substr('138' || lpad(cast(c_custkey as string), 8, '0'), 8, 4) as phone,
                           case when length(c_mktsegment) >= 11 then left(c_mktsegment, 3) || '*****' ||
                           substr(c_mktsegment, 8, 4) else '*****' end as short_phone, '******' as password
                    from customer""",
        code_map=f"""select o_orderkey,
                            case left(o_orderpriority, 1) when '1' then 'PC' when '2' then 'Mobile' when '3' then 'App'
                            when '4' then 'WeChat' else 'other' end as regsourcename,
                            case left(o_orderpriority, 1) when '1' then 'PC' when '2' then 'APP' else 'Other' end
                            as app_name, {BAND} as score_segment
                     from (select *, cast(o_totalprice / 4000 as decimal(10,1)) as score from orders) o""",
        round_scores="""select l_orderkey, l_linenumber, cast(cast(cast(l_extendedprice as decimal(12,2))
                               * cast(l_discount as decimal(4,2)) as decimal(12,1)) as double) as score from lineitem""",
        day_texts="""select o_orderkey, strftime(o_orderdate, '%Y%m%d') as day,
                            strftime(o_orderdate, '%Y-%m-%d') as date_text,
                            strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') as time_text from orders""",
        address_numbers=with_shapes(
            ["page_events"], f"select ip, {ADDRESS} as address, cast(null as bigint) as none from page_events"
        ),
        elapsed_units=with_shapes(
            ["watch_events"],
            "select uid, ps, (te - ts) // 1000 as seconds, (te - ts) // 100 as tenths from watch_events",
        ),
        member_wide_left_chain=member_sql("select * replace (cast(paymoney as double) as paymoney) from chain"),
        member_wide=member_sql("select * replace (cast(paymoney as double) as paymoney) from dws_member"),
        member_day_pay=with_shapes(
            PAYMENT_SHAPES,
            f"select uid, cast(cast(paid as decimal(28,4)) as double) as paymoney, vip_level, {DAY_START} as start_time, "
            "'9999-12-31' as end_time, dn from days",
            days=DAY_PAYMENTS,
        ),
        zipper_merge=with_shapes(
            PAYMENT_SHAPES,
            f"""select uid, cast(cast(sum(paid) over (partition by uid, dn order by dt) as decimal(28,4)) as double)
                       as paymoney, vip_level, {DAY_START} as start_time,
                       coalesce(lead({DAY_START}) over (partition by uid, dn order by dt), '9999-12-31') as end_time, dn
                from days""",
            days=DAY_PAYMENTS,
        ),
        member_count_appregurl=member_count("appregurl"),
        member_count_sitename=member_count("sitename"),
        member_count_regsource=member_count("regsourcename"),
        member_count_adname=member_count("adname"),
        member_count_level=member_count("memberlevel"),
        member_count_vip=member_count("vip_level"),
        member_counts=member_sql(
            " union all ".join(
                f"select '{report}' as report, {column} as value, dt, dn, count(uid) as uid_count "
                f"from dws_member group by {column}, dt, dn"
                for report, column in COUNT_REPORTS.items()
            )
        ),
        member_top3_pay=member_sql(
            """select uid, memberlevel, register, appregurl, regsourcename, adname, sitename, vip_level,
                      cast(paymoney as double) as paymoney, cast(place as int) as rownum, dt, dn
               from (select *, row_number() over (partition by dt, dn, memberlevel
                               order by paymoney desc nulls last, uid) as place from dws_member) t
               where place <= 3"""
        ),
        quiz_chapter_wide=wide_sql("dws_qz_chapter"),
        quiz_course_wide=wide_sql("dws_qz_course"),
        quiz_major_wide=wide_sql("dws_qz_major"),
        quiz_paper_wide=wide_sql("dws_qz_paper"),
        quiz_question_wide=wide_sql("dws_qz_question"),
        paper_avg=answers_sql(
            """select paperviewid, paperviewname, dt, dn,
                      cast(cast(avg(score) as decimal(4,1)) as double) as avgscore,
                      cast(cast(avg(spendtime) as decimal(10,1)) as double) as avgspendtime
               from answers group by paperviewid, paperviewname, dt, dn"""
        ),
        paper_minmax=answers_sql(
            """select paperviewid, paperviewname, dt, dn, cast(max(score) as double) as maxscore,
                      cast(min(score) as double) as minscore
               from answers group by paperviewid, paperviewname, dt, dn"""
        ),
        paper_top3=ranked("desc nulls last"),
        paper_low3=ranked("asc nulls first"),
        paper_segments=answers_sql(
            f"""select paperviewid, paperviewname, score_segment, {part_of('userid', 4)} as part,
                       string_agg(cast(userid as string), ',' order by cast(userid as string)) as userids, dt, dn
                from (select *, {BAND} as score_segment from answers) t
                group by paperviewid, paperviewname, score_segment, dt, dn, {part_of('userid', 4)}"""
        ),
        paper_segments_dealt=answers_sql(
            f"""select paperviewid, paperviewname, score_segment, cast(({part_of('userid', 3)} + copy) % 3 as int) as part,
                       string_agg(cast(userid as string), ',' order by cast(userid as string)) as userids, dt, dn
                from (select *, row_number() over (
                          partition by paperviewid, paperviewname, score_segment, dt, dn, userid) - 1 as copy
                      from (select *, {BAND} as score_segment from answers) b) t
                group by all"""
        ),
        paper_segment_users=answers_sql(
            f"""select paperviewid, paperviewname, score_segment, dt, dn, userid, count(*) as copies
                from (select *, {BAND} as score_segment from answers) t
                group by paperviewid, paperviewname, score_segment, dt, dn, userid"""
        ),
        paper_pass_rate=answers_sql(
            """select a.paperviewid, a.paperviewname, a.dt, a.dn, passcount, unpasscount,
                      cast(cast(passcount / (passcount + unpasscount) as decimal(4,2)) as double) as rate
               from (select paperviewid, paperviewname, dt, dn, count(*) as unpasscount from answers
                     where score between 0 and 60 group by paperviewid, paperviewname, dt, dn) a
               join (select paperviewid, dt, dn, count(*) as passcount from answers
                     where score > 60 and score <= 100 group by paperviewid, dt, dn) b
               on a.paperviewid = b.paperviewid and a.dn = b.dn and a.dt = b.dt"""
        ),
        question_error_rate=answers_sql(
            """select a.questionid, a.dt, a.dn, errcount, rightcount,
                      cast(cast(errcount / (errcount + rightcount) as decimal(4,2)) as double) as rate
               from (select questionid, dt, dn, count(*) as errcount from answers
                     where user_question_answer = '0' group by questionid, dt, dn) a
               join (select questionid, dt, dn, count(*) as rightcount from answers
                     where user_question_answer = '1' group by questionid, dt, dn) b
               on a.questionid = b.questionid and a.dn = b.dn and a.dt = b.dt"""
        ),
        register_total=with_shapes(
            ["register_events"],
            f"select {PLATFORM} as app_name, count(*) as num from {REGISTERED} group by 1",
        ),
        register_sliding=with_shapes(
            ["register_events"],
            f"""select strftime(opened - to_hours(6 * back), '%Y-%m-%d %H:%M:%S') as window_start, app_name,
                       count(*) as num
                from (select time_bucket(interval '6 hours', cast(createtime as timestamp), timestamp '2000-01-01')
                             as opened, {PLATFORM} as app_name, unnest(range(4)) as back from {REGISTERED}
                      union all select null, {PLATFORM}, 0 from {REGISTERED}) r
                group by 1, 2""",
        ),
        quiz_mastery=with_shapes(
            ["quiz_events"],
            f"""select cast(uid as bigint) as userid, cast(courseid as bigint) as courseid, cast(pointid as bigint) as pointid,
                       count(*) as qz_sum, count(distinct questionid) as qz_count,
                       count(*) filter (istrue = '1') as qz_istrue, min(createtime) as createtime,
                       cast(count(*) filter (istrue = '1') as double) / count(*) as correct_rate,
                       count(distinct questionid) / cast(30 as double)
                       * (cast(count(*) filter (istrue = '1') as double) / count(*)) as mastery_rate
                from {QUIZ} group by uid, courseid, pointid""",
        ),
        quiz_history=with_shapes(
            ["quiz_events"],
            f"""select cast(uid as bigint) as userid, cast(courseid as bigint) as courseid, cast(pointid as bigint) as pointid,
                      {part_of('questionid', 3)} as part,
                      string_agg(distinct questionid, ',' order by questionid) as questionids
               from quiz_events group by uid, courseid, pointid, {part_of('questionid', 3)}""",
        ),
        learn_by_dim=with_shapes(["watch_events"], LEARN),
        video_coverage=with_shapes(["watch_events"], COVERAGE),
        video_ranges=with_shapes(["watch_events"], RANGE_TEXT, islands=ISLANDS),
        video_coverage_stream=with_shapes(
            ["watch_events"],
            "select * from coverage join ranges using (userid, cwareid, videoid)",
            islands=ISLANDS, coverage=COVERAGE, ranges=RANGE_TEXT,
        ),
        register_topic=with_shapes(
            ["register_events"],
            f"""select 'total' as counted, cast(null as varchar) as window_start, {PLATFORM} as app_name, count(*) as num
                from {REGISTERED} group by 3
                union all
                select 'window', strftime(opened - to_hours(6 * back), '%Y-%m-%d %H:%M:%S'), app_name, count(*)
                from (select time_bucket(interval '6 hours', cast(createtime as timestamp), timestamp '2000-01-01')
                             as opened, {PLATFORM} as app_name, unnest(range(4)) as back from {REGISTERED}) r
                group by 2, 3""",
        ),
        course_learn_topic=with_shapes(
            ["watch_events"],
            f"""select dimension, key, totaltime, cast(null as bigint) as effecttime, cast(null as bigint) as completetime,
                       cast(null as varchar) as play_interval from ({LEARN}) l
                union all
                select 'video_learn_detail', concat_ws('_', userid, cwareid, videoid), totaltime, effecttime, completetime,
                       play_interval from coverage join ranges using (userid, cwareid, videoid)""",
            islands=ISLANDS, coverage=COVERAGE, ranges=RANGE_TEXT,
        ),
        page_hits=pages_sql(HITS),
        page_steps=pages_sql(
            "select last_page_id, page_id, next_page_id, count(*) as num from visits "
            "group by last_page_id, page_id, next_page_id"
        ),
        page_topic=pages_sql(
            f"""select last_page_id, page_id, next_page_id, count(*) as num, cast(null as varchar) as jump_rate
                from visits group by last_page_id, page_id, next_page_id
                union all select null, page_id, null, num, jump_rate from ({FUNNEL_RATES}) f""",
            hits=HITS,
        ),
        page_funnel=pages_sql(FUNNEL_RATES, hits=HITS),
        province_counts=pages_sql(PROVINCES, "ip_ranges"),
        province_detail=pages_sql(PROVINCES, "ip_ranges"),
        province_top3=pages_sql(
            "select * from provinces order by num desc, province nulls last limit 3", "ip_ranges", provinces=PROVINCES
        ),
        province_totals="""
            select province, count(*) as num
            from (select c_nationkey as province from customer union all select s_nationkey + 5 from supplier) u
            group by province""",
        raw_archive="""
            select concat_ws(chr(9), cast(event_id as string), event_type, props, strftime(ts, '%Y%m%d')) as value,
                   'page_topic' as topic, strftime(ts, '%Y%m%d') as day from events""",
    )
    found["member_history"] = found["zipper_merge"]
    found["member_wide_stored"] = found["member_wide"]
    return found
