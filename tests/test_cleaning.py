from __future__ import annotations

import json

from conftest import rows

from tutorlake.plans.cleaning import clean_logs
from tutorlake.sources.lines import json_objects, tab_fields
from tutorlake.sources.logs import LOGS, clean
from tutorlake.sources.tables import read_table


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_only_json_objects_survive(spark):
    good = ['{"a": 1}', ' {"a": "x"} ', "{}", '{"a": null}']
    bad = ['{"a": 1', '[{"a": 1}]', "", "  ", "nope", '"text"', "12", "null", '{"a": 1} tail', '{"a": [1, 2}']
    bad += ['{"a": 1}{"a": 2}', '{"a": 1},{"a": 2}', '{"a": 1} x}', "{'a': 1}", '{"a": 1}] [{"a": 2}', '{"a": 1} {}']
    got = rows(json_objects(lines(spark, *good, *bad), ["a"]))
    assert got == [("1",), ("x",), (None,), (None,)]


def test_objects_are_whole_to_the_last_character(spark):
    good = ['{"a":1}', '\t{ "a" :[1,{"b":"}"}] }\r', '{"a":"x{}"}', '{"a":true}', "{ } ", '{"__end":1,"a":"y"}', '{"__bad":1}']
    bad = ['{"a":1,"b":{2}}', '{"a":1,"b":[,]}', '{"a":"\\u001","b":[]}', '{"a":1,}', '{"a":1,"}', '{"a":}', '{"}', "{,}", "}"]
    bad += ['{"a":{"b":1}', '{"a":[1}', '{"a":1}x"}', '{"a":1}{}', '{"a":"x\\"}', '{"a":"é', "{'a':1}", '{"__end":1}{}', '{"a":1é}']
    got = rows(json_objects(lines(spark, *good, *bad), ["a"]))
    assert sorted(map(str, got)) == sorted(map(str, [("1",), ('[1,{"b":"}"}]',), ("x{}",), ("true",), (None,), ("y",), (None,)]))


def test_numbers_read_the_same_bare_and_quoted(spark):
    got = rows(clean(lines(spark, '{"adid": 12, "adname": 5}', '{"adid": "12"}', '{"dn": "w"}'), "dwd_base_ad"))
    assert got == [(0, None, "w"), (12, "5", None), (12, None, None)]


def test_tab_fields_ignore_trailing_empty_fields(spark):
    texts = ["a\tb\tc", "a\tb\tc\t\t", "a\tb", "a\tb\t", "a\tb\tc\td", "", "a\t\tc"]
    got = rows(tab_fields(lines(spark, *texts), ["x", "y", "z"]))
    assert got == [("a", "", "c"), ("a", "b", "c"), ("a", "b", "c")]


def test_member_is_masked(spark):
    line = json.dumps({"uid": "7", "fullname": "Li Lei", "phone": "13812345678", "password": "secret", "dt": "d"})
    got = clean(lines(spark, line), "dwd_member").first()
    assert (got.uid, got.fullname, got.phone, got.password) == (7, "Lxx", "138*****5678", "******")


def test_keys_that_differ_from_their_column(spark):
    regtype = clean(lines(spark, '{"webA": "site", "regsource": 2, "uid": 1}'), "dwd_member_regtype").first()
    assert (regtype.domain, regtype.regsource, regtype.regsourcename) == ("site", "2", "Mobile")
    course = clean(lines(spark, '{"sequece": "s", "sequence": "no"}'), "dwd_qz_course").first()
    assert course.sequence == "s"
    site_course = clean(lines(spark, '{"helpparperstatus": "h"}'), "dwd_qz_site_course").first()
    assert site_course.helppaperstatus == "h"
    question = clean(lines(spark, '{"questtype": 3}'), "dwd_qz_point_question").first()
    assert question.questype == 3


def test_missing_scores(spark):
    question = clean(lines(spark, '{"splitscore": 1.25}'), "dwd_qz_question").first()
    assert (str(question.score), str(question.splitscore)) == ("0.0", "1.3")
    paper = clean(lines(spark, "{}"), "dwd_qz_paper").first()
    assert paper.totalscore is None


def test_every_log_has_a_schema(spark):
    assert len(LOGS) == 23
    for table, log in LOGS.items():
        assert clean(lines(spark, "{}"), table).columns == log.columns


def test_loads_add_up_and_a_rerun_changes_nothing(spark, tmp_path):
    root, file = str(tmp_path / "warehouse"), LOGS["dwd_pcentermempaymoney"].file
    first, second = tmp_path / "monday", tmp_path / "tuesday"
    for folder in (first, second):
        folder.mkdir()
    one = '{{"uid": {}, "paymoney": "5.5", "dt": "{}", "dn": "{}"}}\n'.format
    (first / file).write_text(one(1, "20190722", "007") + "broken\n" + one(3000000000, "20190722", "7"))
    (second / file).write_text(one(2, "20190722", "007") + one(4, "20190723", "007"))
    for folder in (first, second, second, first):
        clean_logs(spark, str(folder), root, ["dwd_pcentermempaymoney"])
    table = read_table(spark, root, "dwd_pcentermempaymoney")
    everything = [(1, "20190722", "007"), (2, "20190722", "007"), (3000000000, "20190722", "7"), (4, "20190723", "007")]
    assert rows(table, "uid", "dt", "dn") == everything
    (first / file).write_text(one(1, "20190722", "007"))
    clean_logs(spark, str(first), root, ["dwd_pcentermempaymoney"])
    assert [r[0] for r in rows(read_table(spark, root, "dwd_pcentermempaymoney"), "uid")] == [1, 2, 4]


def test_partition_values_are_text_in_any_session(spark, tmp_path):
    other = spark.newSession()
    other.conf.set("spark.sql.sources.partitionColumnTypeInference.enabled", "true")
    other.sql("select 1 as uid, '007' as dn").union(other.sql("select 2, '7'")).write.partitionBy("dn").parquet(
        f"{tmp_path}/members"
    )
    assert rows(read_table(other, str(tmp_path), "members"), "uid", "dn") == [(1, "007"), (2, "7")]


def test_one_day_reads_one_partition(spark, tmp_path):
    root, logs = str(tmp_path / "warehouse"), tmp_path / "logs"
    logs.mkdir()
    (logs / LOGS["dwd_pcentermempaymoney"].file).write_text(
        '{"uid": 1, "dt": "20190722", "dn": "a"}\n{"uid": 2, "dt": "20190723", "dn": "a"}\n'
    )
    clean_logs(spark, str(logs), root, ["dwd_pcentermempaymoney"])
    day = read_table(spark, root, "dwd_pcentermempaymoney", "20190722")
    assert rows(day, "uid") == [(1,)]
    assert "PartitionFilters: [isnotnull(dt" in day._jdf.queryExecution().executedPlan().toString()


def test_a_line_is_parsed_once(spark):
    lines = spark.createDataFrame([('{"uid": 1}',)], "value string")
    for table in ("dwd_member", "dwd_qz_member_paper_question"):
        plan = clean(lines, table)._jdf.queryExecution().optimizedPlan().toString()
        assert plan.lower().count("from_json") + plan.count("JsonToStructs") == 1
