"""The batch jobs end to end, from raw log files to report tables."""

from __future__ import annotations

import json
import re
from decimal import Decimal

import pytest
from conftest import rows

from tutorlake.functions.coding import BANDS
from tutorlake.operators.paper_reports import paper_averages
from tutorlake.plans.cleaning import clean_logs
from tutorlake.plans.member_day import member_day, update_zipper
from tutorlake.plans.quiz_day import quiz_day
from tutorlake.sources.logs import LOGS
from tutorlake.sources.tables import read_table, read_version

DAY = "20190722"
IDS = {"dt": DAY, "dn": "web"}


def write_logs(folder, data):
    folder.mkdir(exist_ok=True)
    for table, log in LOGS.items():
        lines = [json.dumps({**IDS, **record}) for record in data.get(table, [{}])]
        (folder / log.file).write_text("\n".join([*lines, "{broken", ""]))


@pytest.fixture
def warehouse(spark, tmp_path):
    root = str(tmp_path / "warehouse")

    def load(data, tables=None):
        write_logs(tmp_path / "logs", data)
        clean_logs(spark, str(tmp_path / "logs"), root, tables)
        return root

    return load


MEMBER_TABLES = [table for table in LOGS if not table.startswith("dwd_qz")]


def test_member_day(spark, warehouse):
    people = [{"uid": n, "ad_id": 1 + n % 2, "memberlevel": "gold", "fullname": "Ann", "phone": "13812345678"} for n in range(6)]
    root = warehouse(
        {
            "dwd_member": people,
            "dwd_member_regtype": [
                {"uid": n, "websiteid": 5, "appregurl": "a_b", "regsource": str(n)} for n in range(5)
            ],
            "dwd_base_ad": [{"adid": 1, "adname": "ad1"}],
            "dwd_base_website": [{"siteid": 5, "sitename": "site5"}],
            "dwd_vip_level": [{"vip_id": 1, "vip_level": "v1"}, {"vip_id": 2, "vip_level": "v2"}],
            "dwd_pcentermempaymoney": [
                {"uid": 1, "paymoney": "10.5", "vip_id": 1}, {"uid": 1, "paymoney": "2", "vip_id": 2},
                {"uid": 2, "paymoney": "20", "vip_id": 1}, {"uid": 3, "paymoney": "5", "vip_id": 8},
            ],
        },
        MEMBER_TABLES,
    )
    for _ in range(2):
        member_day(spark, root, DAY)
    wide = rows(read_table(spark, root, "dws_member"), "uid", "paymoney", "vip_level", "sitename", "adname", "phone")
    assert wide[0] == (0, None, None, "site5", "ad1", "138*****5678")
    assert wide[1] == (1, Decimal("12.5000"), "v2", "site5", None, "138*****5678")
    assert wide[5][3] is None and len(wide) == 6

    def report(table, *columns):
        return rows(read_table(spark, root, table, DAY), *columns)

    assert report("ads_register_appregurlnum", "appregurl", "uid_count") == [("a_b", 5), (None, 1)]
    assert report("ads_register_regsourcenamenum", "regsourcename", "uid_count") == [
        ("App", 1), ("Mobile", 1), ("PC", 1), ("WeChat", 1), ("other", 1), (None, 1)
    ]
    assert report("ads_register_viplevelnum", "vip_level", "uid_count") == [("v1", 1), ("v2", 1), (None, 4)]
    assert report("ads_register_adnamenum", "adname", "uid_count") == [("ad1", 3), (None, 3)]
    assert report("ads_register_memberlevelnum", "memberlevel", "uid_count") == [("gold", 6)]
    assert report("ads_register_sitenamenum", "sitename", "uid_count") == [("site5", 5), (None, 1)]
    assert report("ads_register_top3memberpay", "uid", "rownum") == [(1, 2), (2, 1), (3, 3)]


def test_zipper_versions(spark, warehouse):
    levels = [{"vip_id": 1, "vip_level": "v1"}]
    pays = [
        {"uid": 1, "paymoney": "1", "vip_id": 1, "dt": "20190720"}, {"uid": 1, "paymoney": "2", "vip_id": 1, "dt": "20190721"},
        {"uid": 2, "paymoney": "4", "vip_id": 1, "dt": "20190722"}, {"uid": 1, "paymoney": "8", "vip_id": 1, "dt": "20190722"},
    ]
    root = warehouse({"dwd_vip_level": levels, "dwd_pcentermempaymoney": pays}, ["dwd_vip_level", "dwd_pcentermempaymoney"])
    expected = [
        (1, Decimal("1.0000"), "2019-07-20", "2019-07-21"), (1, Decimal("11.0000"), "2019-07-22", "9999-12-31"),
        (1, Decimal("3.0000"), "2019-07-21", "2019-07-22"), (2, Decimal("4.0000"), "2019-07-22", "9999-12-31"),
    ]
    columns = ["uid", "paymoney", "start_time", "end_time"]
    for day in ("20190720", "20190721", "20190722", "20190722"):
        update_zipper(spark, root, day)
    assert rows(read_version(spark, root, "dws_member_zipper"), *columns) == expected
    update_zipper(spark, root, "20190721", "20190722")
    assert rows(read_version(spark, root, "dws_member_zipper"), *columns) == expected


def test_quiz_day(spark, warehouse):
    question_ids = [1, 2]
    root = warehouse(
        {
            "dwd_qz_chapter": [{"chapterid": 1, "chapterlistid": 1, "chaptername": "c1", "courseid": 9}],
            "dwd_qz_chapter_list": [{"chapterlistid": 1, "chapterlistname": "l1"}],
            "dwd_qz_point": [{"pointid": 1, "chapterid": 1, "pointname": "p1", "score": "1.25"}],
            "dwd_qz_point_question": [{"pointid": 1, "questionid": 1}],
            "dwd_qz_site_course": [{"sitecourseid": 1, "courseid": 1, "siteid": 1}],
            "dwd_qz_course": [{"courseid": 1, "coursename": "maths"}],
            "dwd_qz_course_edusubject": [{"courseid": 1, "edusubjectid": 3}],
            "dwd_qz_major": [{"majorid": 1, "siteid": 1, "businessid": 1, "majorname": "m1"}],
            "dwd_qz_website": [{"siteid": 1, "sitename": "s1", "creator": "someone"}],
            "dwd_qz_business": [{"businessid": 1, "businessname": "b1"}],
            "dwd_qz_paper_view": [{"paperviewid": 1, "paperid": 1, "paperviewname": "pv1"}],
            "dwd_qz_center_paper": [{"paperviewid": 7, "centerid": 1}],
            "dwd_qz_center": [{"centerid": 1}],
            "dwd_qz_paper": [{"paperid": 1, "papername": "paper", "totalscore": "100"}],
            "dwd_qz_question": [{"questionid": q, "questypeid": 1, "content": f"q{q}"} for q in question_ids],
            "dwd_qz_question_type": [{"questypeid": 1, "description": "about"}],
            "dwd_qz_member_paper_question": [
                {"userid": user, "paperviewid": 1, "chapterid": 1, "sitecourseid": 1, "questionid": 1 + user % 2,
                 "majorid": 1, "score": 15 * user, "spendtime": 60, "question_answer": user % 3 // 2}
                for user in range(1, 7)
            ],
        },
        [table for table in LOGS if table.startswith("dwd_qz")],
    )
    for _ in range(2):
        quiz_day(spark, root, DAY)
    detail = read_table(spark, root, "dws_user_paper_detail")
    assert len(detail.columns) == 119 and len(set(detail.columns)) == 119
    first = detail.where("userid = 1").first()
    assert (first.chaptername, first.majorname, first.papername, first.question_content) == ("c1", "m1", "paper", "q2")
    assert (first.question_description, first.centerid, first.point_score) == ("about", None, None)
    assert str(detail.where("userid = 2").first().point_score) == "1.3"

    plan = paper_averages(detail, DAY)._jdf.queryExecution().executedPlan().toString()
    read = re.search(r"ReadSchema: struct<(.*)>", plan).group(1)
    assert {part.split(":")[0] for part in re.findall(r"\w+:\w+", read)} == {
        "paperviewid", "paperviewname", "score", "spendtime"
    }
    assert "PartitionFilters: [isnotnull(dt" in plan

    def report(table, *columns):
        return rows(read_table(spark, root, table, DAY), *columns)

    assert report("ads_paper_avgtimeandscore", "avgscore", "avgspendtime") == [(Decimal("52.5"), Decimal("60.0"))]
    assert report("ads_paper_maxdetail", "maxscore", "minscore") == [(Decimal("90.0"), Decimal("15.0"))]
    assert report("ads_top3_userdetail", "userid", "rk") == [(4, 3), (5, 2), (6, 1)]
    assert report("ads_low3_userdetail", "userid", "rk") == [(1, 1), (2, 2), (3, 3)]
    segments = report("ads_paper_scoresegment_user", "score_segment", "userids")
    assert segments == [("0-20", "1"), ("20-40", "2"), ("40-60", "3,4"), ("60-80", "5"), ("80-100", "6")]
    assert [s for s, _ in segments] == [f"{low}-{high}" for low, high in BANDS]
    assert report("ads_user_paper_detail", "passcount", "unpasscount", "rate") == [(2, 4, Decimal("0.33"))]
    assert report("ads_user_question_detail", "questionid", "errcount", "rightcount") == [(1, 2, 1), (2, 2, 1)]
