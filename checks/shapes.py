"""Warehouse-shaped inputs built from the given star-schema tables.

Each input is one SELECT over whole tables that reads the same in Spark SQL and DuckDB; base tables
appear in braces. Key columns are mapped by hand; the others follow a rule: text columns hold their
name and the row's id, whole numbers a small number made from the id.
"""

from __future__ import annotations

from checks.columns import LOGS

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DAY = "20190722"
SITE = "'r' || cast(n_regionkey as string)"


def shaped(table: str, source: str, row_id: str, **known: str) -> str:
    """A SELECT with all columns of a cleaned table."""
    log = LOGS[table]
    values = {"dt": f"'{DAY}'", "dn": SITE, **known}
    columns = []
    for position, column in enumerate(log.columns):
        if column in values:
            value = values[column]
        elif log.kind(column) == "int":
            value = f"({row_id}) % 90 + {position}"
        elif log.kind(column) == "tenth":
            value = f"({row_id}) % 1000 * 0.1"
        else:
            value = f"'{column}_' || cast(({row_id}) as string)"
        if log.kind(column) == "int":
            value = f"cast({value} as int)"
        elif log.kind(column) == "tenth":
            value = f"cast({value} as decimal(10,1))"
        columns.append(f"{value} as {column}")
    return f"select {', '.join(columns)} from {source}"


CUSTOMERS = "{customer} join {nation} on c_nationkey = n_nationkey"
SUPPLIERS = "{supplier} join {nation} on s_nationkey = n_nationkey"
NATIONS = "{nation}"
# Every combination of a fifth of the nations with a site.
FIFTHS = "(select cast(floor(n_nationkey / 5) as int) as fifth, n_nationkey % 5 as n_regionkey from {nation}) f"
# Suppliers, and nations, on each of the five sites.
SUPPLIER_SITES = (
    "(select s_suppkey, s_nationkey, n_nationkey % 5 as n_regionkey from {supplier} join {nation} "
    "on floor(s_nationkey / 5) = floor(n_nationkey / 5)) s"
)
NATION_SITES = (
    "(select a.n_nationkey, a.n_name, a.n_regionkey as home, b.n_nationkey % 5 as n_regionkey from {nation} a "
    "join {nation} b on floor(a.n_nationkey / 5) = floor(b.n_nationkey / 5)) n"
)
# Each part has one site.
PARTS = "(select *, p_partkey % 5 as n_regionkey from {part}) p"
SIZES = "(select distinct p_size, p_partkey % 5 as n_regionkey from {part}) sizes"
FIRST_ORDERS = (
    "(select o_custkey as buyer, min(o_orderkey) as first_order from {orders} group by o_custkey) b "
    "join {orders} on o_orderkey = first_order join {customer} on c_custkey = buyer "
    "join {nation} on c_nationkey = n_nationkey"
)
SOURCE_DIGIT = "substring(o_orderpriority, 1, 1)"

WAREHOUSE = {
    "dwd_member": shaped(
        "dwd_member", CUSTOMERS, "c_custkey", uid="c_custkey", ad_id="c_nationkey",
        fullname="substring(c_name, 1, 1) || 'xx'", password="'******'", memberlevel="c_mktsegment",
    ),
    "dwd_member_regtype": shaped(
        "dwd_member_regtype", FIRST_ORDERS, "o_orderkey", uid="c_custkey",
        appregurl="'http://' || o_orderpriority", regsource=SOURCE_DIGIT, websiteid="o_orderkey % 10",
        regsourcename=f"case {SOURCE_DIGIT} when '1' then 'PC' when '2' then 'Mobile' when '3' then 'App' "
        "when '4' then 'WeChat' else 'other' end",
    ),
    # Shifted by five, so the first five nations' members match no ad.
    "dwd_base_ad": shaped("dwd_base_ad", NATIONS, "n_nationkey", adid="n_nationkey + 5", adname="n_name"),
    "dwd_base_website": shaped("dwd_base_website", SUPPLIERS, "s_suppkey", siteid="s_suppkey", sitename="s_name"),
    "dwd_pcentermempaymoney": shaped(
        "dwd_pcentermempaymoney",
        "{orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey",
        "o_orderkey", uid="o_custkey", paymoney="cast(cast(o_totalprice as decimal(10,4)) as string)",
        site_id="o_orderkey % 10", vip_id="o_orderkey % 6", dt="cast(year(o_orderdate) as string) || '0101'",
    ),
    "dwd_vip_level": shaped(
        "dwd_vip_level", FIFTHS, "fifth", vip_id="fifth", vip_level="'v' || cast(fifth as string)",
        start_time="'2019-01-0' || cast(fifth + 1 as string)", end_time="'2020-01-0' || cast(fifth + 1 as string)",
    ),
    "dwd_qz_chapter": shaped(
        "dwd_qz_chapter", SUPPLIER_SITES, "s_suppkey", chapterid="s_suppkey", chapterlistid="s_nationkey % 5",
        courseid="s_nationkey",
    ),
    "dwd_qz_chapter_list": shaped("dwd_qz_chapter_list", FIFTHS, "fifth", chapterlistid="fifth"),
    "dwd_qz_point": shaped(
        "dwd_qz_point", SUPPLIER_SITES, "s_suppkey", pointid="s_suppkey", chapterid="s_suppkey",
        courseid="s_nationkey",
    ),
    # A point for each supplier and site, with a question for each return flag of what was sold there.
    "dwd_qz_point_question": shaped(
        "dwd_qz_point_question",
        "(select distinct l_suppkey, l_returnflag, l_partkey % 5 as n_regionkey from {lineitem}) flags",
        "l_suppkey", pointid="l_suppkey",
        questionid="l_suppkey * 3 + case l_returnflag when 'A' then 0 when 'N' then 1 else 2 end",
    ),
    "dwd_qz_site_course": shaped(
        "dwd_qz_site_course", SUPPLIER_SITES, "s_suppkey", sitecourseid="s_suppkey", siteid="s_nationkey",
        courseid="s_nationkey",
    ),
    "dwd_qz_course": shaped(
        "dwd_qz_course", NATION_SITES, "n_nationkey", courseid="n_nationkey", majorid="home", coursename="n_name",
    ),
    "dwd_qz_course_edusubject": shaped(
        "dwd_qz_course_edusubject", NATION_SITES, "n_nationkey", courseid="n_nationkey",
        edusubjectid="n_nationkey % 7",
    ),
    "dwd_qz_major": shaped(
        "dwd_qz_major", NATION_SITES, "n_nationkey", majorid="n_nationkey", siteid="n_nationkey", businessid="home",
    ),
    "dwd_qz_website": shaped(
        "dwd_qz_website", NATION_SITES, "n_nationkey", siteid="n_nationkey", sitename="n_name",
    ),
    "dwd_qz_business": shaped("dwd_qz_business", FIFTHS, "fifth", businessid="fifth"),
    "dwd_qz_paper_view": shaped("dwd_qz_paper_view", PARTS, "p_partkey", paperviewid="p_partkey", paperid="p_size"),
    # Even paper views only have a centre, and centre 5 does not exist.
    "dwd_qz_center_paper": shaped(
        "dwd_qz_center_paper", PARTS, "p_partkey", paperviewid="p_partkey * 2", centerid="p_size % 6",
        dn="'r' || cast(p_partkey * 2 % 5 as string)",
    ),
    "dwd_qz_center": shaped("dwd_qz_center", FIFTHS, "fifth", centerid="fifth"),
    # Even papers only exist, so paper views of odd papers drop out.
    "dwd_qz_paper": shaped("dwd_qz_paper", SIZES, "p_size", paperid="p_size * 2"),
    "dwd_qz_question": shaped(
        "dwd_qz_question", PARTS, "p_partkey", questionid="p_partkey", questypeid="p_size % 7",
    ),
    # Types 1 to 7, so questions of type 0 drop out.
    "dwd_qz_question_type": shaped(
        "dwd_qz_question_type",
        "(select distinct p_size % 7 + 1 as type_no, p_partkey % 5 as n_regionkey from {part}) types",
        "type_no", questypeid="type_no",
    ),
    "dwd_qz_member_paper_question": shaped(
        "dwd_qz_member_paper_question",
        "{lineitem} join {orders} on l_orderkey = o_orderkey join {supplier} on l_suppkey = s_suppkey",
        "l_orderkey", userid="o_custkey", paperviewid="l_partkey", chapterid="l_suppkey", sitecourseid="l_suppkey",
        questionid="l_partkey", majorid="s_nationkey", paperid="l_partkey", spendtime="l_linenumber * 60",
        score="l_quantity * 2.1", question_answer="case l_linestatus when 'O' then 1 else 0 end",
        dn="'r' || cast(l_partkey % 5 as string)",
    ),
}

OTHERS = {
    # Quiz answers as the paper reports read them.
    "answers": """
        select cast(o_custkey as int) as userid, cast(l_orderkey % 3000 as int) as paperviewid,
               'paper' || cast(l_orderkey % 3000 as string) as paperviewname, cast(l_partkey as int) as questionid,
               case when l_orderkey % 89 <> 0 then cast(l_quantity * 2.1 as decimal(4,1)) end as score,
               l_linenumber * 60 as spendtime, case l_linestatus when 'O' then '1' else '0' end as user_question_answer,
               'chapter' || cast(l_suppkey as string) as chaptername, 'point' || l_returnflag as pointname,
               'site' || cast(l_suppkey % 7 as string) as sitecoursename,
               'course' || cast(l_suppkey % 11 as string) as coursename,
               'major' || o_orderpriority as majorname, o_orderstatus as shortname,
               'name' || cast(l_orderkey % 3000 as string) as papername,
               cast(year(l_shipdate) as string) || '0101' as dt, 'r' || cast(l_orderkey % 5 as string) as dn
        from {lineitem} join {orders} on l_orderkey = o_orderkey""",
    "quiz_events": """
        select user_id as uid, event_id % 3 as courseid, event_id % 4 as pointid,
               regexp_extract(props, '[0-9]+', 0) as questionid,
               case when value >= 20 then '1' else '0' end as istrue, cast(ts as string) as createtime
        from {events}""",
    "watch_events": """
        select cast(user_id as bigint) as uid, cast(user_id % 7 as bigint) as cwareid, k % 5 as videoid,
               k % 10 as chapterid, cast(event_id % 3 as bigint) as edutypeid,
               cast(event_id % 4 as bigint) as subjectid, event_type as sourceType, 1 as speed,
               began as ts, began + cast(floor(value * 1000) as bigint) as te,
               k as ps, k + 1 + cast(floor(value) as int) % 60 as pe
        from (select *, cast(regexp_extract(props, '[0-9]+', 0) as bigint) as k,
                     1704067200000 + event_id * 1000 as began from {events}) e""",
    "page_events": """
        select cast(user_id as string) as uid, 'app' as app_id, 'device' as device_id,
               cast(cast(floor(user_id / 256) as int) as string) || '.' || cast(user_id % 256 as string) || '.' ||
               cast(cast(floor(event_id % 65536 / 256) as int) as string) || '.' ||
               cast(event_id % 256 as string) as ip,
               case when event_id % 17 = 0 then '' else cast(page - 1 as string) end as last_page_id,
               cast(page as string) as page_id, cast(page + 1 as string) as next_page_id
        from (select *, case event_type when 'view' then 1 when 'click' then 2 when 'purchase' then 3
                             when 'signup' then 4 else 5 end as page from {events}) e""",
    "ip_ranges": """
        select cast(n_nationkey as bigint) * 5 * 65536 as lo, cast(n_nationkey as bigint) * 5 * 65536 + 5 * 65536 - 1
               as hi, n_name as province
        from {nation}""",
    "register_events": """
        select user_id as userid, event_id % 3 + 1 as platform_code, cast(ts as string) as createtime
        from {events}""",
}

SHAPES = {**WAREHOUSE, **OTHERS}
