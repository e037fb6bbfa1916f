"""Each job in one go, in several batches, and stopped and started again, must match the batch form."""

from __future__ import annotations

import json
import os
import random

import numpy as np
import pytest
from conftest import rows
from pyspark.sql import functions as F

from tutorlake.operators import learners, pages, watching
from tutorlake.session import stream_session
from tutorlake.sources import streams
from tutorlake.sources.tables import drop_versions, read_version, versions, write_version
from tutorlake.streaming import coverage_state, jobs, sinks
from tutorlake.streaming.publish import publish_files, read_lines


@pytest.fixture
def sibling(spark):
    return stream_session(spark, state_partitions=2)


class Feed:
    """A folder of text files that a stream reads one per batch."""

    def __init__(self, sibling, tmp_path):
        self.sibling, self.folder = sibling, tmp_path / "in"
        self.folder.mkdir()
        self.root, self.files = str(tmp_path / "out"), 0

    def add(self, texts):
        file = self.folder / f"part-{self.files:04d}.txt"
        file.write_text("\n".join(texts) + "\n")
        # Files are taken in order of their time, which must differ.
        os.utime(file, (1_700_000_000 + self.files, 1_700_000_000 + self.files))
        self.files += 1

    def run(self, job, *more, **options):
        lines = streams.folder_stream(self.sibling, str(self.folder), files_per_trigger=1)
        job(lines, *more, self.root, self.root + "/checkpoint", **options).awaitTermination()

    def batch(self, spark):
        return spark.read.text(str(self.folder))


@pytest.fixture
def feed(sibling, tmp_path):
    return Feed(sibling, tmp_path)


def test_registrations_over_restarts(spark, feed):
    feed.add(["1\t1\t2024-01-01 00:00:01", "2\t2\t2024-01-01 00:00:02", "broken\t1"])
    feed.add(["3\t1\t2024-01-01 00:00:03"])
    feed.run(jobs.count_registrations)
    feed.add(["4\t9\t2024-01-01 00:00:04\t\t", "5\t1\t2024-01-01 00:00:05"])
    feed.run(jobs.count_registrations)
    total = read_version(spark, feed.root, "register_total")
    assert rows(total) == [("APP", 1), ("Other", 1), ("PC", 3)]
    assert rows(learners.registrations_by_platform(streams.registrations(feed.batch(spark)))) == rows(total)


def test_sliding_windows(spark, feed):
    feed.add(["1\t1\t2024-01-01 00:00:01", "2\t1\t2024-01-01 00:00:08"])
    feed.add(["3\t1\t2024-01-01 00:00:09", "9\t1\t2024-06-01 12:00:00"])
    feed.add(["4\t1\t2024-01-01 00:00:02", "5\t1\tnever", "6\t1\tnever"])
    feed.run(jobs.count_registrations_in_window, time=learners.event_time(), length="12 seconds", slide="6 seconds")
    counts = sinks.current(spark, feed.root, "register_window", jobs.WINDOW_KEY).where("month(window_start) <> 6 or window_start is null")
    got = rows(counts, F.date_format("window_start", "HH:mm:ss"), "num")
    assert got == [("00:00:00", 4), ("00:00:06", 2), ("23:59:54", 2), (None, 2)]


def test_registrations_count_when_they_arrive(spark, feed):
    feed.add(["1\t1\t2024-01-01 00:00:01", "2\t1\tnever"])
    feed.add(["3\t1\t1999-01-01 00:00:09"])
    feed.run(jobs.count_registrations_in_window, length="6 seconds", slide="6 seconds")
    counts = sinks.current(spark, feed.root, "register_window", jobs.WINDOW_KEY)
    assert counts.agg(F.sum("num")).first()[0] == 3 and counts.where("year(window_start) < 2025").count() == 0


def test_tables_stay_small(spark, tmp_path):
    root, write = str(tmp_path), sinks.upsert_table(str(tmp_path), "t", ["k"], fold_every=4)
    replace = sinks.replace_table(root, "whole")
    for n in range(50):
        batch = spark.createDataFrame([(n % 3, n)], "k int, v int")
        write(batch, n)
        if n < 9:
            replace(batch, n)
    assert rows(sinks.current(spark, root, "t", ["k"])) == [(0, 48), (1, 49), (2, 47)]
    assert len(sinks.change_batches(spark, root, "t")) <= 8 and len(versions(spark, root, "t/base")) == 2
    assert versions(spark, root, "whole") == [6, 7, 8]
    (tmp_path / "t" / "changes" / "batch=49" / "_SUCCESS").unlink()
    assert rows(sinks.current(spark, root, "t", ["k"])) == [(0, 48), (1, 46), (2, 47)]


def quiz_lines(seed, count):
    chance = random.Random(seed)
    return [
        f"{chance.randint(1, 3)}\t1\t{chance.randint(1, 2)}\tq{chance.randint(1, 9)}\t{chance.randint(0, 1)}\t2024-01-{chance.randint(10, 28)}"
        for _ in range(count)
    ]


def test_mastery_over_restarts_and_compaction(spark, feed):
    feed.add(quiz_lines(1, 40))
    feed.add(quiz_lines(2, 40))
    feed.run(jobs.track_mastery)
    sinks.compact(spark, feed.root, "qz_point_history", [*learners.TOPIC, "questionid"])
    feed.add(quiz_lines(3, 40))
    feed.run(jobs.track_mastery)
    expected = learners.mastery(learners.question_totals(streams.quiz_answers(feed.batch(spark))))
    assert rows(jobs.mastery_now(spark, feed.root)) == rows(expected)
    sinks.compact(spark, feed.root, "qz_point_history", [*learners.TOPIC, "questionid"])
    assert rows(jobs.mastery_now(spark, feed.root)) == rows(expected)


def test_mastery_numbers(spark):
    texts = ["1\t1\t1\tq1\t1\t2024-01-02", "1\t1\t1\tq1\t0\t2024-01-01", "1\t1\t1\tq2\t1\t2024-01-03", "too\tfew"]
    totals = learners.question_totals(streams.quiz_answers(spark.createDataFrame([(t,) for t in texts], "value string")))
    got = learners.mastery(totals).first()
    assert (got.qz_sum, got.qz_count, got.qz_istrue, got.createtime) == (3, 2, 2, "2024-01-01")
    assert got.correct_rate == 2 / 3 and got.mastery_rate == 2 / 30 * (2 / 3)
    assert learners.question_ids(totals).first().questionids == "q1,q2"


def watch_line(chance):
    start = chance.randint(0, 60)
    began = chance.randint(0, 10**6)
    return json.dumps(
        {"uid": chance.randint(1, 2), "cwareid": 1, "videoid": str(chance.randint(1, 2)), "chapterid": chance.randint(1, 3),
         "edutypeid": 1, "subjectid": 2, "sourceType": chance.choice(["pc", "app"]), "speed": 1, "ts": began,
         "te": began + chance.randint(0, 90000), "ps": start, "pe": start + chance.randint(0, 15)}
    )


def watch_lines(seed, count):
    chance = random.Random(seed)
    return [watch_line(chance) for _ in range(count)] + ["not json"]


def test_learn_time_over_batches(spark, feed):
    feed.add(watch_lines(1, 30))
    feed.add(watch_lines(2, 30))
    feed.run(jobs.sum_learn_time)
    got = sinks.current(spark, feed.root, "learn_detail", jobs.LEARN_KEY)
    events = streams.watch_events(feed.batch(spark))
    assert rows(got) == rows(watching.learn_time(events))
    tenths = watching.learn_time(events, {"cwareid_learn_detail": 100})
    spent = sum((e.te - e.ts) // 100 for e in events.collect())
    assert rows(tenths.where("dimension = 'cwareid_learn_detail'"), "totaltime") == [(spent,)]


def brute_force(batches):
    """Coverage by sets of unit positions, event by event."""
    seen, times = {}, {}
    for batch in batches:
        for e in sorted(batch, key=lambda e: (e["ps"], -e["pe"], -((e["te"] - e["ts"]) // 1000))):
            key = (int(e["uid"]), int(e["cwareid"]), int(e["videoid"]))
            elapsed = (e["te"] - e["ts"]) // 1000
            points = set(range(e["ps"], e["pe"]))
            fresh = len(points - seen.setdefault(key, set()))
            seen[key] |= points
            total, effective = times.get(key, (0, 0))
            times[key] = (total + elapsed, effective + (elapsed * fresh // len(points) if points else 0))
    return sorted((*key, *times[key], len(seen[key])) for key in times)


def parsed(texts):
    return [json.loads(t) for t in texts if t.startswith("{")]


COVERAGE = ["userid", "cwareid", "videoid", "totaltime", "effecttime", "completetime"]


def test_coverage_over_batches_and_restart(spark, feed):
    parts = [watch_lines(seed, 12) for seed in (5, 6, 7)]
    feed.add(parts[0])
    feed.add(parts[1])
    feed.run(jobs.track_coverage)
    feed.add(parts[2])
    feed.run(jobs.track_coverage)
    now = jobs.coverage_now(spark, feed.root)
    assert rows(now, *COVERAGE) == brute_force([parsed(p) for p in parts])
    ranges = watching.range_text(watching.watched_ranges(streams.watch_events(feed.batch(spark))))
    assert rows(now, *watching.VIDEO, "play_interval") == rows(ranges)


@pytest.mark.parametrize("seed", range(3))
def test_batch_coverage_matches_brute_force(spark, seed):
    texts = watch_lines(seed + 100, 80)
    events = streams.watch_events(spark.createDataFrame([(t,) for t in texts], "value string"))
    assert rows(watching.coverage(events), *COVERAGE) == brute_force([parsed(texts)])


def test_touching_ranges_join(spark):
    events = spark.createDataFrame(
        [(1, 1, 1, 0, 10), (1, 1, 1, 10, 20), (1, 1, 1, 25, 30), (1, 1, 1, 26, 27)], "uid int, cwareid int, videoid int, ps int, pe int"
    ).select("*", F.lit(0).cast("bigint").alias("ts"), F.lit(1000).cast("bigint").alias("te"))
    assert watching.range_text(watching.watched_ranges(events)).first().play_interval == "0-20,25-30"


def test_range_arithmetic_at_random():
    chance = np.random.default_rng(3)
    for _ in range(300):
        count = chance.integers(0, 6)
        known = chance.integers(0, 40, count)
        starts, ends = coverage_state.join_ranges(known, known + chance.integers(1, 9, count))
        assert (starts[1:] > ends[:-1]).all()
        fresh_start = np.unique(chance.integers(0, 40, chance.integers(1, 6)))
        fresh_end = fresh_start + chance.integers(1, 9, len(fresh_start))
        seen = {p for low, high in zip(starts, ends) for p in range(low, high)}
        expected = []
        for low, high in zip(fresh_start, fresh_end):
            expected.append(len(set(range(low, high)) - seen))
            seen |= set(range(low, high))
        assert coverage_state.newly_covered(starts, ends, fresh_start, fresh_end).tolist() == expected


def page_line(page, before, after, ip, **more):
    return json.dumps({"uid": 1, "page_id": page, "last_page_id": before, "next_page_id": after, "ip": ip, **more})


@pytest.fixture
def page_texts():
    first = [page_line(1, 0, 2, "0.1.0.1")] * 5 + [page_line(2, 1, 3, "0.1.0.2")] * 4 + ["{bad"]
    second = [page_line(3, 2, 4, "0.2.0.1")] * 3 + [page_line(2, 1, 3, "0.9.0.1"), page_line(1, "", 2, "0.1.0.1")]
    return first, second + [page_line(4, 3, 5, "not an address"), '{"page_id": 1}']


def test_pages_and_funnel(spark, feed, page_texts):
    for texts in page_texts:
        feed.add(texts)
    feed.run(jobs.count_pages)
    got = rows(read_version(spark, feed.root, "page_jump_rate"))
    assert got == [("1", 5, "100%"), ("2", 5, "100%"), ("3", 3, "60%"), ("4", 1, None)]
    steps = pages.page_steps(streams.page_visits(feed.batch(spark)))
    assert rows(read_version(spark, feed.root, "page_steps")) == rows(steps)


def test_funnel_without_first_page(spark):
    hits = spark.createDataFrame([("2", 4), ("3", 1)], "page_id string, num bigint")
    assert rows(pages.funnel(hits)) == [("2", 4, "0%"), ("3", 1, "25%")]


def ip_ranges(spark):
    data = [(65536, 65536 + 1, "north"), (65536 + 2, 2 * 65536 + 5, "south"), (2 * 65536 + 9, 2 * 65536 + 9, "west")]
    return spark.createDataFrame(data, "lo bigint, hi bigint, province string")


def test_provinces_over_restart(spark, feed, page_texts):
    feed.add(page_texts[0])
    feed.run(jobs.count_provinces, ip_ranges(feed.sibling))
    feed.add(page_texts[1])
    feed.run(jobs.count_provinces, ip_ranges(feed.sibling))
    expected = [("north", 5), ("south", 7), (None, 2)]
    assert rows(read_version(spark, feed.root, "tmp_city_num_detail")) == expected
    assert rows(read_version(spark, feed.root, "top_city_num")) == expected
    assert versions(spark, feed.root, "tmp_city_num_detail") == [0, 1]
    visits = streams.page_visits(feed.batch(spark))
    assert rows(pages.province_counts(visits, ip_ranges(spark))) == expected


def test_province_lookup_matches_a_plain_range_join(spark):
    chance = random.Random(1)
    bounds = sorted(chance.sample(range(0, 5 * 65536), 80))
    data = [(low, high - chance.randint(1, 5), f"p{n % 9}") for n, (low, high) in enumerate(zip(bounds, bounds[1:]))]
    ranges = spark.createDataFrame([d for d in data if d[1] >= d[0]], "lo bigint, hi bigint, province string")
    addresses = [chance.randint(0, 6 * 65536) for _ in range(500)]
    visits = spark.createDataFrame([(f"0.{a // 65536}.{a // 256 % 256}.{a % 256}",) for a in addresses], "ip string")
    expected = {}
    for address in addresses:
        found = [p for low, high, p in data if low <= address <= high]
        expected[found[0] if found else None] = expected.get(found[0] if found else None, 0) + 1
    assert dict(rows(pages.province_counts(visits, ranges))) == expected


def test_a_retried_batch_counts_once(spark, tmp_path):
    root = str(tmp_path)
    write = sinks.upsert_table(root, "t", ["k"])
    frame = spark.createDataFrame([("a", 1), ("b", 1)], "k string, n int")
    write(frame, 0)
    write(spark.createDataFrame([("a", 5)], "k string, n int"), 1)
    write(spark.createDataFrame([("a", 3)], "k string, n int"), 1)
    assert rows(sinks.current(spark, root, "t", ["k"])) == [("a", 3), ("b", 1)]


def test_old_versions_can_be_dropped(spark, tmp_path):
    for version in range(5):
        write_version(spark.createDataFrame([(version,)], "n int"), str(tmp_path), "t", version)
    drop_versions(spark, str(tmp_path), "t", keep=2)
    assert versions(spark, str(tmp_path), "t") == [3, 4]
    assert rows(read_version(spark, str(tmp_path), "t")) == [(4,)]
    assert rows(read_version(spark, str(tmp_path), "t", before=4)) == [(3,)]
    assert read_version(spark, str(tmp_path), "t", before=3) is None


def test_top_three_and_totals(spark):
    history = spark.createDataFrame([("a", 5), ("b", 2), (None, 1)], "province string, num bigint")
    batch = spark.createDataFrame([("b", 4), ("c", 6), (None, 2)], "province string, num bigint")
    totals = pages.add_counts(history, batch)
    assert rows(totals) == [("a", 5), ("b", 6), ("c", 6), (None, 3)]
    assert [tuple(r) for r in pages.top_provinces(totals).collect()] == [("b", 6), ("c", 6), ("a", 5)]


def test_archive_and_replay(spark, feed, tmp_path):
    feed.add(["x 1", "y 2"])
    lines = streams.folder_stream(feed.sibling, str(feed.folder))
    jobs.archive(lines, "page_topic", feed.root, feed.root + "/c", day=F.lit("20240101")).awaitTermination()
    feed.add(["z 3"])
    jobs.archive(
        streams.folder_stream(feed.sibling, str(feed.folder)), "page_topic", feed.root, feed.root + "/c", day=F.lit("20240102")
    ).awaitTermination()
    kept = spark.read.text(feed.root + "/archive")
    assert rows(kept) == [("x 1", "page_topic", "20240101"), ("y 2", "page_topic", "20240101"), ("z 3", "page_topic", "20240102")]

    again = str(tmp_path / "replayed")
    publish_files(read_lines(spark, str(feed.folder)), again)
    assert rows(spark.read.text(again)) == [("x 1",), ("y 2",), ("z 3",)]


def test_a_video_is_one_row_of_ranges(spark):
    """However many events a video has, Python gets a range per start second, of the longest event there."""
    data = [(1, 1, 1, n % 7, n % 7 + 1 + n % 3, 0, 1000 * (n % 5), "t") for n in range(5000)] + [(1, 1, 2, 4, 4, 0, 3000, "t")]
    events = spark.createDataFrame(data, "uid int, cwareid int, videoid int, ps int, pe int, ts long, te long, updatetime string")
    fresh = watching.batch_coverage(events)
    assert [(r.videoid, len(r.fresh), r.spent) for r in fresh.orderBy("videoid").collect()] == [(1, 7, 10000), (2, 0, 3)]
    got = coverage_state.fold_coverage(fresh, None)
    want = [(1, 1, 1, 0, 9, "0-9"), (1, 1, 2, 0, 0, "")]
    assert rows(got, *watching.VIDEO, F.col("effecttime") * 0, "completetime", "play_interval") == want
    again = coverage_state.fold_coverage(fresh, got)
    assert rows(again, "totaltime", "completetime", "play_interval", "starts") == [(20000, 9, "0-9", [0]), (6, 0, "", [])]
    assert rows(again, "effecttime") == rows(got, "effecttime")
    assert rows(coverage_state.fold_coverage(fresh.limit(0), got)) == []
