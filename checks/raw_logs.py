"""Raw log lines made from whole tables, and the cleaned rows they must give.

Each table row becomes one good line plus broken ones that cleaning must drop: cut short, wrapped in
an array, followed by other text, by a second object or by a torn rest, in single quotes, a bare text, and
an empty line. In the good lines, whole numbers are bare, quoted or missing and some beyond 32 bits, and
texts are sometimes missing.
"""

from __future__ import annotations

from checks.columns import LOGS

# The table each log is made from, and its row id.
ORIGINS = {
    "dwd_member_regtype": ("orders", "o_orderkey"),
    "dwd_member": ("customer", "c_custkey"),
    "dwd_base_ad": ("nation", "n_nationkey"),
    "dwd_base_website": ("supplier", "s_suppkey"),
    "dwd_pcentermempaymoney": ("orders", "o_orderkey"),
    "dwd_vip_level": ("region", "r_regionkey"),
    "dwd_qz_member_paper_question": ("lineitem", "l_orderkey * 8 + l_linenumber"),
    "dwd_qz_question_type": ("nation", "n_nationkey"),
    "dwd_qz_question": ("part", "p_partkey"),
    "dwd_qz_center": ("supplier", "s_suppkey"),
    "dwd_qz_paper": ("part", "p_partkey"),
    "dwd_qz_center_paper": ("part", "p_partkey"),
    "dwd_qz_paper_view": ("part", "p_partkey"),
    "dwd_qz_business": ("region", "r_regionkey"),
    "dwd_qz_major": ("nation", "n_nationkey"),
    "dwd_qz_website": ("supplier", "s_suppkey"),
    "dwd_qz_course_edusubject": ("customer", "c_custkey"),
    "dwd_qz_course": ("supplier", "s_suppkey"),
    "dwd_qz_site_course": ("customer", "c_custkey"),
    "dwd_qz_point_question": ("events", "event_id"),
    "dwd_qz_point": ("customer", "c_custkey"),
    "dwd_qz_chapter_list": ("nation", "n_nationkey"),
    "dwd_qz_chapter": ("customer", "c_custkey"),
}

PHONE = "case when {id} % 13 = 0 then '12345' else '138' || lpad(cast({id} % 100000000 as string), 8, '0') end"
SPECIAL_TEXT = {"phone": PHONE, "regsource": "cast({id} % 6 as string)", "fullname": "'Name' || cast({id} as string)"}


def _parts(table: str, column: str) -> tuple[str, str, str]:
    """SQL of a column's plain text, of when it is missing and of when a number is quoted."""
    log = LOGS[table]
    row = f"({ORIGINS[table][1]})"
    at = log.columns.index("regsource" if column == "regsourcename" else column)
    kind = log.kind(column)
    if kind == "int":
        number = f"case when {row} % 17 = 0 then 3000000000 + {row} % 90 else {row} % 90 + {at} end"
        return f"cast({number} as string)", f"({row} + {at}) % 7 = 0", f"({row} + {at}) % 5 = 0"
    if kind == "tenth":
        plain = f"cast(cast({row} % 1000 * 0.25 as decimal(10,2)) as string)"
        return plain, f"({row} + {at}) % 7 = 0", f"({row} + {at}) % 5 = 0"
    plain = SPECIAL_TEXT.get(column, f"'{column}_' || cast({{id}} as string)").format(id=row)
    return plain, f"({row} + {at}) % 11 = 0", "true"


def good_line(table: str) -> str:
    """Spark SQL for the JSON line of a row; missing keys are left out by ``concat_ws``."""
    log = LOGS[table]
    members = []
    for column in log.columns:
        if column in ("regsourcename", "password"):
            continue
        plain, missing, quoted = _parts(table, column)
        key = log.keys.get(column, column)
        value = f"case when {quoted} then '\"' || {plain} || '\"' else {plain} end"
        members.append(f"case when {missing} then null else '\"{key}\":' || {value} end")
    return f"'{{' || concat_ws(',', {', '.join(members)}) || '}}'"


def expected_rows(table: str) -> str:
    """DuckDB SQL for the cleaned rows."""
    log = LOGS[table]
    columns = []
    for column in log.columns:
        plain, missing, _ = _parts(table, "regsource" if column == "regsourcename" else column)
        present = f"case when {missing} then null else {plain} end"
        if column == "password":
            value = "'******'"
        elif column == "regsourcename":
            value = (
                f"case {present} when '1' then 'PC' when '2' then 'Mobile' when '3' then 'App' "
                "when '4' then 'WeChat' else 'other' end"
            )
        elif column == "fullname":
            value = f"left({present}, 1) || 'xx'"
        elif column == "phone":
            value = (
                f"case when length({present}) >= 11 then substr({present}, 1, 3) || '*****' || substr({present}, 8, 4) "
                f"when {present} is not null then '*****' end"
            )
        elif log.kind(column) == "int":
            value = f"coalesce(cast({present} as bigint), 0)"
        elif log.kind(column) == "tenth":
            default = log.missing_score or "null"
            value = f"cast(coalesce(cast(cast({present} as decimal(10,2)) as decimal(10,1)), {default}) as double)"
        else:
            value = present
        columns.append(f"{value} as {column}")
    return f"select {', '.join(columns)} from {ORIGINS[table][0]}"
