from __future__ import annotations

import random
from decimal import Decimal

from conftest import rows
from pyspark.sql import functions as F

from tutorlake.operators import member_reports
from tutorlake.operators.member_reports import count_members, top_payers
from tutorlake.operators.members import day_payments, left_chain, member_wide
from tutorlake.operators.zipper import zipper_merge
from tutorlake.sources.tables import settle

ZIPPER = "uid int, paymoney decimal(28,4), vip_level string, start_time string, end_time string, dn string"
OPEN = "9999-12-31"


def inputs(spark):
    member = spark.createDataFrame(
        [(1, "a", 10, "gold", "d"), (2, "a", 99, "iron", "d"), (1, "b", 10, "iron", "d")],
        "uid int, dn string, ad_id int, memberlevel string, dt string",
    )
    regtype = spark.createDataFrame(
        [(1, "a", 5, "url"), (1, "a", 5, "url"), (2, "a", 6, "url")], "uid int, dn string, siteid int, appregurl string"
    )
    ad = spark.createDataFrame([(10, "a", "ad10")], "ad_id int, dn string, adname string")
    site = spark.createDataFrame([(5, "a", "site5")], "siteid int, dn string, sitename string")
    payment = spark.createDataFrame(
        [(1, Decimal("1.5"), 1, "a"), (1, Decimal("2.5"), 2, "a"), (1, Decimal("4"), 9, "a"), (2, None, 9, "a")],
        "uid int, paymoney decimal(18,4), vip_id int, dn string",
    )
    names = "start_time end_time last_modify_time max_free min_free next_level operator".split()
    level = spark.createDataFrame(
        [(1, "v1", "a"), (2, "v2", "a")], "vip_id int, vip_level string, dn string"
    ).select("*", *[F.concat("vip_level", F.lit("_" + n)).alias("vip_" + n) for n in names])
    return member, regtype, ad, site, payment, level


def test_left_chain_keeps_members_and_repeats_payments(spark):
    got = rows(left_chain(*inputs(spark)), "uid", "dn", "adname", "siteid", "sitename", "paymoney", "vip_id")
    one = [r for r in got if r[:2] == (1, "a")]
    assert len(one) == 6 and {r[6] for r in one} == {1, 2, None} and {r[3] for r in one} == {5}
    assert [r for r in got if r[0] == 2] == [(2, "a", None, None, None, None, None)]
    assert [r for r in got if r[1] == "b"] == [(1, "b", None, None, None, None, None)]


def test_wide_row_does_not_multiply_money(spark):
    wide = member_wide(*inputs(spark))
    got = rows(wide, "uid", "dn", "paymoney", "vip_id", "vip_level", "vip_start_time", "vip_max_free", "siteid", "adname")
    assert got == [
        (1, "a", Decimal("8.0000"), 1, "v2", "v1_start_time", "v1_max_free", 5, "ad10"),
        (1, "b", None, None, None, None, None, None, None),
        (2, "a", None, None, None, None, None, None, None),
    ]


def test_counts_keep_values_with_underscores_and_null(spark):
    members = spark.createDataFrame(
        [(1, "a_b", "d", "n"), (2, "a_b", "d", "n"), (3, None, "d", "n")], "uid int, sitename string, dt string, dn string"
    )
    assert rows(count_members(members, "sitename")) == [("a_b", "d", "n", 2), (None, "d", "n", 1)]


def test_top_payers_break_ties_by_uid_and_put_null_last(spark):
    data = [(u, "gold", Decimal(m) if m else None) for u, m in ((4, "5"), (2, "5"), (3, "9"), (1, None), (5, "5"))]
    members = spark.createDataFrame(data, "uid int, memberlevel string, paymoney decimal(18,4)")
    texts = "register appregurl regsourcename adname sitename vip_level dt dn".split()
    got = top_payers(members.select("*", *[F.lit("x").alias(t) for t in texts]), ordered=True)
    assert [(r.uid, r.rownum) for r in got.collect()] == [(3, 1), (2, 2), (4, 3)]


def test_day_payments_are_per_site(spark):
    pay = spark.createDataFrame(
        [(1, Decimal("1"), 1, "20190722", "a"), (1, Decimal("2"), 1, "20190722", "a"), (1, Decimal("4"), 1, "20190722", "b"),
         (1, Decimal("8"), 7, "20190722", "a"), (1, Decimal("16"), 1, "20190723", "a")],
        "uid int, paymoney decimal(18,4), vip_id int, dt string, dn string",
    )
    level = spark.createDataFrame([(1, "v1", "a"), (1, "v9", "b")], "vip_id int, vip_level string, dn string")
    got = rows(day_payments(pay, level, "20190722"))
    assert got == [
        (1, Decimal("16.0000"), "v1", "2019-07-23", OPEN, "a"),
        (1, Decimal("3.0000"), "v1", "2019-07-22", OPEN, "a"),
        (1, Decimal("4.0000"), "v9", "2019-07-22", OPEN, "b"),
    ]


def zipper_rows(spark, *data):
    return spark.createDataFrame([(u, Decimal(m), v, s, e, "a") for u, m, v, s, e in data], ZIPPER)


def test_zipper_closes_the_open_row_and_carries_money(spark):
    history = zipper_rows(
        spark, (1, "5", "v1", "2019-07-01", "2019-07-10"), (1, "8", "v2", "2019-07-10", OPEN), (2, "1", "v1", "2019-07-01", OPEN)
    )
    day = zipper_rows(spark, (1, "4", "v3", "2019-07-22", OPEN), (3, "7", "v1", "2019-07-22", OPEN))
    merged = zipper_merge(history, day, "2019-07-22")
    expected = [
        (1, Decimal("12.0000"), "v3", "2019-07-22", OPEN, "a"),
        (1, Decimal("5.0000"), "v1", "2019-07-01", "2019-07-10", "a"),
        (1, Decimal("8.0000"), "v2", "2019-07-10", "2019-07-22", "a"),
        (2, Decimal("1.0000"), "v1", "2019-07-01", OPEN, "a"),
        (3, Decimal("7.0000"), "v1", "2019-07-22", OPEN, "a"),
    ]
    assert rows(merged) == expected
    assert rows(zipper_merge(merged, day, "2019-07-22")) == expected


def test_zipper_several_days_at_once_equal_day_by_day(spark):
    days = [
        zipper_rows(spark, (1, "1", "v1", "2019-07-20", OPEN), (2, "10", "v1", "2019-07-20", OPEN)),
        zipper_rows(spark, (1, "2", "v2", "2019-07-21", OPEN)),
        zipper_rows(spark, (1, "4", "v1", "2019-07-22", OPEN), (2, "20", "v3", "2019-07-22", OPEN)),
    ]
    none = zipper_rows(spark).limit(0)
    by_day = none
    for at, day in enumerate(days):
        by_day = zipper_merge(by_day, day, f"2019-07-{20 + at}")
    at_once = zipper_merge(none, days[0].union(days[1]).union(days[2]), "2019-07-20")
    assert rows(at_once) == rows(by_day)
    redone = zipper_merge(by_day, days[1].union(days[2]), "2019-07-21")
    assert rows(redone) == rows(by_day)


def one_row_at_a_time(history, day_rows):
    """The merge as a loop over one member's rows: close the row before the last one, carry its money."""
    listed = sorted(history + day_rows, key=lambda r: r["start"])
    if len(listed) > 1 and listed[-2]["end"] == OPEN and listed[-1] in day_rows:
        listed[-2]["end"] = listed[-1]["start"]
        listed[-1]["money"] += listed[-2]["money"]
    return listed


def test_zipper_matches_a_loop_over_days(spark):
    chance = random.Random(4)
    dates = [f"2019-07-{20 + n}" for n in range(6)]
    paid = {(d, u): chance.randint(1, 9) for d in dates for u in range(5) if chance.random() < 0.6}
    model = {u: [] for u in range(5)}
    stored = zipper_rows(spark).limit(0)
    for date in dates:
        day = []
        for user in model:
            if (date, user) in paid:
                new = {"start": date, "end": OPEN, "money": paid[date, user]}
                model[user] = one_row_at_a_time(model[user], [new])
                day.append((user, str(paid[date, user]), "v1", date, OPEN))
        stored = settle(zipper_merge(stored, zipper_rows(spark, *day), date), "zipper-test")
    expected = sorted((u, Decimal(r["money"]), r["start"], r["end"]) for u, found in model.items() for r in found)
    assert sorted((r.uid, r.paymoney, r.start_time, r.end_time) for r in stored.collect()) == expected


def test_wide_plan_shuffles_each_large_input_once(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        member, regtype, ad, site, payment, level = inputs(spark)
        from tutorlake.operators.members import payment_summary

        plan = payment_summary(payment, level)._jdf.queryExecution().executedPlan().toString()
        assert "CartesianProduct" not in plan and "NestedLoop" not in plan
        full = member_wide(member, regtype, ad, site, payment, level)._jdf.queryExecution().executedPlan().toString()
        by_member = [line for line in full.splitlines() if "Exchange hashpartitioning(uid" in line and "vip_id" not in line]
        assert len(by_member) == 3
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_all_counts_are_those_of_each_report_from_one_scan(spark):
    columns = list(member_reports.COUNT_REPORTS.values())
    data = [(n, *[None if n % 5 == k else f"{c}{n % (k + 2)}" for k, c in enumerate(columns)], "20190722", "web") for n in range(40)]
    members = spark.createDataFrame([*data, (None, *data[0][1:])], ["uid", *columns, "dt", "dn"])
    counts = member_reports.all_counts(members)
    for report, column in member_reports.COUNT_REPORTS.items():
        order = [column, "dt", "dn", "uid_count"]
        assert rows(member_reports.one_report(counts, report), *order) == rows(member_reports.count_members(members, column), *order)
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Scan ExistingRDD") <= 1 and plan.count("hashpartitioning") <= 1
    assert counts.where("report = 'none'").isEmpty() and member_reports.all_counts(members.limit(0)).isEmpty()
