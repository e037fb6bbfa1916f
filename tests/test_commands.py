from __future__ import annotations

import json

import pytest
from conftest import rows

from tutorlake.__main__ import DAY_JOBS, parse, run
from tutorlake.sources.tables import read_table, read_version
from tutorlake.streaming import jobs


def test_clean_and_replay_and_count(spark, tmp_path):
    root, logs = str(tmp_path / "root"), tmp_path / "logs"
    logs.mkdir()
    (logs / "baseadlog.log").write_text(json.dumps({"adid": 3, "adname": "ad", "dn": "w"}) + "\n[]\n")
    run(parse(["clean", "--logs", str(logs), "--tables", "dwd_base_ad", "--root", root]))
    assert rows(read_table(spark, root, "dwd_base_ad")) == [(3, "ad", "w")]

    (tmp_path / "register.log").write_text("1\t1\tt\n2\t2\tt\nbad\n")
    topic = str(tmp_path / "topic")
    run(parse(["publish", "--file", str(tmp_path / "register.log"), "--folder", topic]))
    run(parse(["registrations", "--folder", topic, "--root", root, "--state-partitions", "2"]))
    assert rows(read_version(spark, root, "register_total")) == [("APP", 1), ("PC", 1)]


def test_provinces_and_archive(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "in"
    folder.mkdir()
    visit = {"page_id": "1", "last_page_id": "0", "next_page_id": "2", "ip": "0.0.0.9"}
    (folder / "a.txt").write_text(json.dumps(visit) + "\n")
    spark.createDataFrame([(0, 99, "here")], "lo bigint, hi bigint, province string").write.parquet(f"{root}/ranges")
    run(parse(["provinces", "--folder", str(folder), "--root", root, "--ranges", f"{root}/ranges"]))
    assert rows(read_version(spark, root, "top_city_num")) == [("here", 1)]
    run(parse(["archive", "--folder", str(folder), "--root", root]))
    assert spark.read.text(f"{root}/archive").count() == 1


def test_options_of_day_jobs(monkeypatch):
    asked = []
    monkeypatch.setitem(DAY_JOBS, "quiz-reports", lambda *args, **named: asked.append((args[1:], named)))
    monkeypatch.setitem(DAY_JOBS, "member-day", lambda *args, **named: asked.append((args[1:], named)))
    run(parse(["quiz-reports", "--root", "r", "--day", "20190722", "--parts", "4", "--dealt", "--keep-all"]))
    run(parse(["member-day", "--root", "r", "--day", "20190722", "--last-day", "20190724"]))
    assert asked == [
        (("r", "20190722"), {"parts": 4, "dealt": True, "keep_all": True}),
        (("r", "20190722"), {"last_day": "20190724"}),
    ]


def test_a_stream_needs_one_source():
    with pytest.raises(SystemExit):
        parse(["mastery", "--root", "x"])


def test_jobs_that_write_several_tables(spark, tmp_path):
    root, folder = str(tmp_path / "root"), tmp_path / "in"
    folder.mkdir()
    (folder / "a.txt").write_text("1\t1\t2024-01-01 00:00:01\nbad\n")
    run(parse(["register-topic", "--folder", str(folder), "--root", root, "--event-time", "--length", "6 seconds"]))
    totals, windows = jobs.registrations_now(spark, root)
    assert rows(totals, "app_name", "num") == [("PC", 1)] and windows.count() == 1
    learned = tmp_path / "learned"
    learned.mkdir()
    event = {"uid": 1, "cwareid": 2, "videoid": 3, "ts": 0, "te": 5000, "ps": 0, "pe": 5, "chapterid": 1, "sourceType": "pc"}
    (learned / "a.txt").write_text(json.dumps(event) + "\n")
    run(parse(["course-learn", "--folder", str(learned), "--root", root, "--unit-ms", "sourcetype_learn_detail=100"]))
    coverage, times = jobs.course_learn_now(spark, root)
    assert rows(coverage, "totaltime", "play_interval") == [(5, "0-5")] and times.count() == 5
    assert rows(times.where("dimension = 'sourcetype_learn_detail'"), "totaltime") == [(50,)]
    (folder / "a.txt").write_text("1\t1\t1\tq1\t1\t2024-01-02\n")
    run(parse(["mastery", "--folder", str(folder), "--root", root, "--updatetime"]))
    assert jobs.mastery_now(spark, root).where("updatetime is not null").count() == 1
