"""Result tables over lost checkpoints, and jobs that write several tables from one read."""

from __future__ import annotations

import shutil
from pathlib import Path

import pytest
from conftest import rows
from pyspark.sql import functions as F
from test_streams import COVERAGE, Feed, brute_force, ip_ranges, page_line, parsed, quiz_lines, watch_lines

from tutorlake.operators import learners, pages, watching
from tutorlake.session import stream_session
from tutorlake.sources import streams
from tutorlake.sources.tables import read_version, versions
from tutorlake.streaming import jobs, sinks

VALUE = "k string, n int"


@pytest.fixture
def feed(spark, tmp_path):
    return Feed(stream_session(spark, state_partitions=2), tmp_path)


def lose(feed):
    """The checkpoint goes, and the topic now holds other messages."""
    shutil.rmtree(f"{feed.root}/checkpoint")
    for file in feed.folder.iterdir():
        file.unlink()


def test_replaced_table_after_a_lost_checkpoint(spark, feed):
    for code in (1, 1, 2):
        feed.add([f"1\t{code}\t2024-01-01 00:00:01"])
    feed.run(jobs.count_registrations)
    assert versions(spark, feed.root, "register_total") == [0, 1, 2]
    lose(feed)
    feed.add(["1\t1\t2024-01-01 00:00:01"])
    feed.run(jobs.count_registrations)
    assert rows(read_version(spark, feed.root, "register_total")) == [("PC", 1)]
    assert versions(spark, feed.root, "register_total")[-1] == sinks.GENERATION


def test_changed_keys_after_a_lost_checkpoint(spark, feed):
    for seed in range(6):
        feed.add(quiz_lines(seed, 20))
    feed.run(jobs.track_mastery)
    sinks.compact(spark, feed.root, "qz_point_history", jobs.QUESTION)
    lose(feed)
    feed.add(quiz_lines(30, 3))
    feed.add(quiz_lines(31, 3))
    feed.run(jobs.track_mastery)
    expected = learners.mastery(learners.question_totals(streams.quiz_answers(feed.batch(spark))))
    assert rows(jobs.mastery_now(spark, feed.root)) == rows(expected)
    feed.add(quiz_lines(32, 3))
    feed.run(jobs.track_mastery)
    sinks.compact(spark, feed.root, "qz_point_history", jobs.QUESTION)
    expected = learners.mastery(learners.question_totals(streams.quiz_answers(feed.batch(spark))))
    assert rows(jobs.mastery_now(spark, feed.root)) == rows(expected)


def test_history_of_provinces_after_a_lost_checkpoint(spark, feed):
    feed.add([page_line(1, 0, 2, "0.1.0.1")] * 5)
    feed.add([page_line(1, 0, 2, "0.1.0.1")] * 5)
    feed.run(jobs.count_provinces, ip_ranges(feed.sibling))
    lose(feed)
    feed.add([page_line(1, 0, 2, "0.1.0.1")] * 2)
    feed.run(jobs.count_provinces, ip_ranges(feed.sibling))
    assert rows(read_version(spark, feed.root, "tmp_city_num_detail")) == [("north", 2)]


def test_generations_are_claimed_once(spark, tmp_path):
    root, checkpoint = str(tmp_path / "out"), tmp_path / "checkpoint"
    assert [sinks.claimed_generation(spark, root, "j", str(checkpoint)) for _ in range(2)] == [0, 0]
    assert sinks.claimed_generation(spark, root, "other", str(tmp_path / "c2")) == 0
    for number in (1, 2):
        shutil.rmtree(checkpoint)
        assert [sinks.claimed_generation(spark, root, "j", str(checkpoint)) for _ in range(2)] == [number, number]
    older = tmp_path / "older"
    (older / "offsets").mkdir(parents=True)
    assert sinks.claimed_generation(spark, root, "j", str(older)) == 0


def test_old_generations_are_folded_away(spark, tmp_path):
    root, write = str(tmp_path), sinks.upsert_table(str(tmp_path), "t", ["k"], fold_every=2)
    for stamp in [0, 1, 2, *(sinks.GENERATION + n for n in range(4))]:
        write(spark.createDataFrame([("a" if stamp < 5 else "b", stamp % 97)], VALUE), stamp)
        if stamp == sinks.GENERATION:
            assert rows(sinks.current(spark, root, "t", ["k"])) == [("b", stamp % 97)]
    assert rows(sinks.current(spark, root, "t", ["k"])) == [("b", (sinks.GENERATION + 3) % 97)]
    assert min(sinks.change_batches(spark, root, "t")) >= sinks.GENERATION


def test_a_batch_is_seen_with_all_its_tables_or_not_at_all(spark, tmp_path):
    root = str(tmp_path)

    def write(batch, stamp):
        sinks.add_to_table(root, "a", ["k"], ["n"], batch, stamp)
        if batch.where("n = 13").count():
            raise RuntimeError("lost")
        sinks.add_to_table(root, "b", ["k"], ["n"], batch.withColumn("n", F.col("n") * 10), stamp)

    def seen():
        upto = sinks.last_commit(spark, root, "j")
        return [rows(sinks.current(spark, root, t, ["k"], upto)) for t in "ab"]

    run = sinks.together(root, "j", write)
    with pytest.raises(ValueError):
        sinks.last_commit(spark, root, "j")
    run(spark.createDataFrame([("x", 1), (None, 2)], VALUE), 0)
    run(spark.createDataFrame([("x", 5), ("y", 1)], VALUE), 1)
    whole = [[("x", 6), ("y", 1), (None, 2)], [("x", 60), ("y", 10), (None, 20)]]
    assert seen() == whole
    with pytest.raises(RuntimeError):
        run(spark.createDataFrame([("x", 13)], VALUE), 2)
    assert seen() == whole
    # Run again, the batch adds to what was there before it, not to what its first attempt left.
    for _ in range(2):
        run(spark.createDataFrame([("x", 1), (None, 1)], VALUE), 2)
        assert seen() == [[("x", 7), ("y", 1), (None, 3)], [("x", 70), ("y", 10), (None, 30)]]


def test_commits_hold_over_folds(spark, tmp_path):
    root = str(tmp_path)
    run = sinks.together(root, "j", lambda batch, stamp: sinks.add_to_table(root, "a", ["k"], ["n"], batch, stamp, fold_every=2))
    for stamp in range(9):
        run(spark.createDataFrame([(f"k{stamp % 3}", 1)], VALUE), stamp)
        upto = sinks.last_commit(spark, root, "j")
        assert sum(r["n"] for r in sinks.current(spark, root, "a", ["k"], upto).collect()) == stamp + 1
    assert len(list(Path(f"{root}/_commits/j").glob("batch=*"))) == sinks.KEPT


def test_both_registration_counts_of_one_read(spark, feed):
    feed.add(["1\t1\t2024-01-01 00:00:01", "2\t2\t2024-01-01 00:00:08", "broken\t1"])
    feed.add(["3\t1\t2024-01-01 00:00:09", "4\t9\tnever"])
    options = {"time": learners.event_time(), "length": "12 seconds", "slide": "6 seconds"}
    feed.run(jobs.track_registrations, **options)
    feed.add(["5\t1\t2024-01-01 00:00:02"])
    feed.run(jobs.track_registrations, **options)
    totals, windows = jobs.registrations_now(spark, feed.root)
    events = streams.registrations(feed.batch(spark))
    assert rows(totals, "app_name", "num") == rows(learners.registrations_by_platform(events))
    expected = learners.registrations_in_window(events, learners.event_time(), "12 seconds", "6 seconds")
    columns = ["window_start", "window_end", "app_name", "num"]
    assert rows(windows, *columns) == rows(expected, *columns)


def test_registrations_of_one_read_by_arrival(spark, feed):
    feed.add(["1\t1\t1999-01-01 00:00:01"])
    feed.add(["2\t1\tnever"])
    feed.run(jobs.track_registrations, length="6 seconds", slide="6 seconds")
    windows = jobs.registrations_now(spark, feed.root)[1]
    assert windows.agg(F.sum("num")).first()[0] == 2 and windows.where("year(window_start) < 2025").count() == 0


def test_coverage_and_five_sums_of_one_read(spark, feed):
    parts = [watch_lines(seed, 12) for seed in (5, 6, 7)]
    feed.add(parts[0])
    feed.add(parts[1])
    feed.run(jobs.track_course_learn)
    feed.add(parts[2])
    feed.run(jobs.track_course_learn)
    coverage, times = jobs.course_learn_now(spark, feed.root)
    events = streams.watch_events(feed.batch(spark))
    assert rows(coverage, *COVERAGE) == brute_force([parsed(p) for p in parts])
    assert rows(coverage, *watching.VIDEO, "play_interval") == rows(watching.range_text(watching.watched_ranges(events)))
    assert rows(times, "dimension", "key", "totaltime") == rows(watching.learn_time(events))
    assert coverage.where("updatetime is null").isEmpty() and times.where("updatetime is null").isEmpty()
    lose(feed)
    feed.add(parts[1])
    feed.run(jobs.track_course_learn)
    assert rows(jobs.course_learn_now(spark, feed.root)[0], *COVERAGE) == brute_force([parsed(parts[1])])


def test_update_time_is_that_of_the_last_change(spark, feed):
    feed.add(["1\t1\t1\tq1\t1\t2024-01-02", "2\t1\t1\tq1\t0\t2024-01-01"])
    feed.run(jobs.track_mastery, updatetime=True)
    first = {r["userid"]: r["updatetime"] for r in jobs.mastery_now(spark, feed.root).collect()}
    assert set(first) == {1, 2} and all(first.values())
    query = spark.sql("select date_format(current_timestamp() + interval 1 second, 'yyyy-MM-dd HH:mm:ss')").first()[0]
    while spark.sql("select date_format(current_timestamp(), 'yyyy-MM-dd HH:mm:ss')").first()[0] < query:
        pass
    feed.add(["1\t1\t1\tq2\t1\t2024-01-03"])
    feed.run(jobs.track_mastery, updatetime=True)
    second = {r["userid"]: r["updatetime"] for r in jobs.mastery_now(spark, feed.root).collect()}
    assert second[1] > first[1] and second[2] == first[2]


def page_batches():
    first = [page_line(1, 0, 2, "0.1.0.1")] * 5 + [page_line(2, 1, 3, "0.1.0.2")] * 4 + ["{bad"]
    second = [page_line(3, 2, 4, "0.2.0.1")] * 3 + [page_line(2, 1, 3, "0.9.0.1"), page_line(7, 7, 7, "0.1.0.1")]
    return first, second, [page_line(1, 0, 2, "0.1.0.1")] * 5


def test_pages_by_what_a_batch_changes(spark, feed):
    for texts in page_batches():
        feed.add(texts)
        feed.run(jobs.track_pages)
        steps, rates = jobs.pages_now(spark, feed.root)
        visits = streams.page_visits(feed.batch(spark))
        assert rows(steps, *jobs.STEP_KEY, "num") == rows(pages.page_steps(visits), *jobs.STEP_KEY, "num")
        assert rows(rates, "page_id", "num", "jump_rate") == rows(pages.funnel(pages.page_hits(visits)))
    assert dict(rows(rates, "page_id", "jump_rate"))["2"] == "50%"
    written = [
        spark.read.parquet(f"{feed.root}/page_steps_detail/changes/batch={n}").count()
        for n in sinks.change_batches(spark, feed.root, "page_steps_detail")
    ]
    assert written == [2, 3, 1]


def test_a_batch_reads_the_slots_of_its_keys(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(sinks, "ROWS_PER_SLOT", 100)
    touched = spark.createDataFrame([(5, 1), (None, 1), (77, 1)], "k int, n int")
    files = {}
    for size in (500, 5000):
        root = f"{tmp_path}/{size}"
        values = spark.range(size).select(F.col("id").alias("k"), F.col("id").cast("int").alias("n"))
        values = values.union(spark.createDataFrame([(None, -1)], "k bigint, n int"))
        sinks.upsert_table(root, "t", ["k"], fold_every=1)(values, 0)
        base = sinks.in_slots(read_version(spark, root, "t/base"), ["k"], touched)
        files[size] = base.select(F.input_file_name()).distinct().count()
        assert int(base.select("of_slots").first()[0]) == size // 100 + 1
        assert rows(sinks.known_keys(spark, root, "t", ["k"], touched, 1), "k", "n") == [(5, 5), (77, 77), (None, -1)]
        sinks.add_to_table(root, "t", ["k"], ["n"], touched, 1, fold_every=1)
        assert sinks.current(spark, root, "t", ["k"]).columns == ["k", "n"]
        after = sinks.current(spark, root, "t", ["k"]).where("k in (5, 6, 77) or k is null")
        assert rows(after, "k", "n") == [(5, 6), (6, 6), (77, 78), (None, 0)]
        assert sinks.current(spark, root, "t", ["k"]).count() == size + 1
    assert max(files.values()) <= 3


def test_an_empty_table_is_folded(spark, tmp_path):
    root = str(tmp_path)
    for stamp in range(2):
        sinks.upsert_table(root, "t", ["k"], fold_every=1)(spark.createDataFrame([], VALUE), stamp)
        assert rows(sinks.current(spark, root, "t", ["k"])) == []
