from __future__ import annotations

import re

from decimal import Decimal

import pytest
from conftest import rows
from pyspark.sql import functions as F

from checks.registry import answer_wide
from tutorlake.operators import paper_reports
from tutorlake.operators.lists import text_lists
from tutorlake.operators.paper_reports import RANKED_COLUMNS
from tutorlake.session import BROADCAST_LIMIT

TEXTS = "chaptername pointname sitecoursename coursename majorname shortname papername".split()


@pytest.fixture
def answers(spark):
    """Paper, user, score, question, answer flag, day, site."""
    data = [
        (1, 11, "10.0", 1, "0", "d1", "a"), (1, 12, "20.0", 1, "1", "d1", "a"), (1, 13, "60.0", 2, "1", "d1", "a"),
        (1, 14, "60.1", 2, "1", "d1", "a"), (1, 15, "99.9", 3, "0", "d1", "a"), (1, 11, "99.9", 3, "0", "d1", "a"),
        (2, 11, "100.5", 1, "0", "d1", "a"), (2, 12, "30.0", 1, "0", "d1", "a"), (1, 11, "50.0", 1, "1", "d2", "a"),
        (3, 11, "70.0", 4, "0", "d1", "b"), (3, 12, None, 4, "1", "d1", "b"),
    ]
    frame = spark.createDataFrame(
        [(p, u, None if s is None else Decimal(s), q, f, d, n) for p, u, s, q, f, d, n in data],
        "paperviewid int, userid int, score decimal(4,1), questionid int, user_question_answer string, dt string, dn string",
    )
    return frame.select(
        "*", F.concat(F.lit("p"), "paperviewid").alias("paperviewname"), (F.col("userid") * 3).alias("spendtime"),
        *[F.lit("x").alias(t) for t in TEXTS],
    )


def test_averages_and_extremes_of_a_day(answers):
    got = rows(paper_reports.paper_averages(answers, "d1"), "paperviewid", "avgscore", "avgspendtime")
    assert got == [(1, Decimal("58.3"), Decimal("38.0")), (2, Decimal("65.3"), Decimal("34.5")), (3, Decimal("70.0"), Decimal("34.5"))]
    got = rows(paper_reports.paper_extremes(answers, "d2"), "paperviewid", "maxscore", "minscore")
    assert got == [(1, Decimal("50.0"), Decimal("50.0"))]


def test_ordered_averages(answers):
    ordered = paper_reports.paper_averages(answers, "d1", ordered=True).collect()
    assert [r.paperviewid for r in ordered] == [3, 2, 1]


def test_best_and_worst_include_ties_and_rank_within_the_day(answers):
    best = paper_reports.best_answers(answers, "d1")
    assert best.columns == RANKED_COLUMNS
    assert rows(best.where("paperviewid = 1"), "userid", "rk") == [(11, 1), (13, 3), (14, 2), (15, 1)]
    worst = paper_reports.worst_answers(answers.where("paperviewid = 1"))
    assert rows(worst, "userid", "rk", "dt") == [(11, 1, "d1"), (11, 1, "d2"), (12, 2, "d1"), (13, 3, "d1")]


def test_band_users_keep_repeats_and_the_empty_band(answers):
    got = rows(paper_reports.band_users(answers, "d1"), "paperviewid", "score_segment", "part", "userids")
    assert got == [
        (1, "0-20", 0, "11,12"), (1, "40-60", 0, "13"), (1, "60-80", 0, "14"), (1, "80-100", 0, "11,15"),
        (2, "20-40", 0, "12"), (2, None, 0, "11"), (3, "60-80", 0, "11"), (3, None, 0, "12"),
    ]


def test_long_lists_are_split_without_loss(spark):
    counted = spark.createDataFrame(
        [("hot", n, 1) for n in range(5000)] + [("hot", 9999, 70), ("cold", 1, 2)], "g string, v int, copies bigint"
    )
    lists = text_lists(counted, ["g"], "v", "ids", parts=10).collect()
    hot = [r for r in lists if r.g == "hot"]
    ids = [i for r in hot for i in r.ids.split(",")]
    assert len(ids) == 5070 and ids.count("9999") == 70 and len(set(ids)) == 5001
    assert len(hot) == 10 and max(len(r.ids.split(",")) for r in hot) < 700
    assert [r.ids for r in lists if r.g == "cold"] == ["1,1"]


def test_copies_of_one_value_go_round_the_parts(spark):
    data = [("hot", 9999, 700), ("hot", 1, 2), ("hot", None, 5), ("cold", 1, 1)]
    counted = spark.createDataFrame(data, "g string, v int, copies bigint")
    lists = text_lists(counted, ["g"], "v", "ids", parts=7, dealt=True).collect()
    hot = sorted(i for r in lists if r.g == "hot" for i in r.ids.split(",") if i)
    assert hot == sorted(["9999"] * 700 + ["1"] * 2) and len([r for r in lists if r.g == "hot"]) == 7
    assert max(r.ids.split(",").count("9999") for r in lists) == 100
    assert [r.ids for r in lists if r.g == "cold"] == ["1"]
    assert rows(text_lists(counted.limit(0), ["g"], "v", "ids", parts=7, dealt=True)) == []


def test_missing_scores_rank_lowest(spark):
    names = [c for c in RANKED_COLUMNS if c != "rk"]
    data = [{**dict.fromkeys(names, "x"), "userid": n, "paperviewid": 1, "score": s} for n, s in enumerate([None, 1, 2, 2, 3])]
    frame = spark.createDataFrame(data, ", ".join(f"{c} {'int' if c in ('userid', 'paperviewid', 'score') else 'string'}" for c in names))
    assert rows(paper_reports.worst_answers(frame), "userid", "rk") == [(0, 1), (1, 2), (2, 3), (3, 3)]
    assert rows(paper_reports.best_answers(frame, places=4), "userid", "rk") == [(0, 4), (1, 3), (2, 2), (3, 2), (4, 1)]


def test_pass_rates(answers):
    got = rows(paper_reports.pass_rates(answers, "d1"), "paperviewid", "passcount", "unpasscount", "rate")
    assert got == [(1, 3, 3, Decimal("0.50"))]
    kept = rows(paper_reports.pass_rates(answers, "d1", keep_all=True), "paperviewid", "passcount", "unpasscount", "rate")
    assert kept == [(1, 3, 3, Decimal("0.50")), (2, 0, 1, Decimal("0.00")), (3, 1, 0, Decimal("1.00"))]


def test_error_rates(answers):
    got = rows(paper_reports.error_rates(answers, "d1"), "questionid", "errcount", "rightcount", "rate")
    assert got == [(1, 3, 1, Decimal("0.75")), (4, 1, 1, Decimal("0.50"))]
    assert len(paper_reports.error_rates(answers, "d1", keep_all=True).collect()) == 4


def test_rates_and_ranks_use_one_pass(answers):
    plan = paper_reports.pass_rates(answers, "d1")._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange") == 1


def test_points_take_the_partitions_of_questions(spark, sf_dir):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = answer_wide(spark, sf_dir)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", BROADCAST_LIMIT)
    keys = [found for found in re.findall(r"hashpartitioning\(([^)]*)\)", plan)]
    assert any("questionid" in found for found in keys)
    assert not any("questionid" in found and "chapterid" in found for found in keys)
