"""The stored payment history against a merge of all days, over many days, reruns and late payments."""

from __future__ import annotations

from pathlib import Path

import pytest
from conftest import rows

from tutorlake.operators.zipper import zipper_merge
from tutorlake.plans import member_history
from tutorlake.plans.member_history import HISTORY, add_days, read_history, update_history
from tutorlake.sources.tables import write_load

DAYS = [20190600 + n for n in range(1, 31)]


def day_rows(spark, day, money=1):
    text = str(day)
    data = [(n, str(money + n), f"v{(n + day) % 3}", f"{text[:4]}-{text[4:6]}-{text[6:]}", "9999-12-31", "web") for n in range(4)]
    return spark.createDataFrame(data, "uid long, paymoney string, vip_level string, start_time string, end_time string, dn string").selectExpr(
        "uid", "cast(paymoney as decimal(15,4)) paymoney", "vip_level", "start_time", "end_time", "dn"
    )


def union(frames):
    whole = frames[0]
    for frame in frames[1:]:
        whole = whole.union(frame)
    return whole


def at_once(spark, days):
    return rows(zipper_merge(spark.createDataFrame([], member_history.HISTORY_SCHEMA), union(days), "0001-01-01"))


def written(root, run):
    """Bytes of one run's own files, both states."""
    return sum(f.stat().st_size for f in Path(f"{root}/{HISTORY}/rows/run={run}").rglob("*.parquet"))


def test_a_day_writes_what_it_changed(spark, tmp_path):
    root, sizes = str(tmp_path), []
    assert read_history(spark, root).count() == 0
    for n, day in enumerate(DAYS):
        add_days(spark, root, day_rows(spark, day), day, day)
        sizes.append(written(root, n))
    assert rows(read_history(spark, root)) == at_once(spark, [day_rows(spark, d) for d in DAYS])
    assert max(sizes[2:]) <= 1.2 * min(sizes[2:])
    # Open rows of runs that no manifest names any more are gone, closed ones are all there.
    assert len(list(Path(f"{root}/{HISTORY}/rows").glob("run=*/state=open"))) == member_history.KEPT
    assert len(list(Path(f"{root}/{HISTORY}/rows").glob("run=*/state=closed"))) == len(DAYS) - 1


def test_days_again_and_in_the_middle(spark, tmp_path):
    root, days = str(tmp_path), DAYS[:8]
    for day in days:
        add_days(spark, root, day_rows(spark, day), day, day)
    before = rows(read_history(spark, root))
    add_days(spark, root, day_rows(spark, days[-1]), days[-1], days[-1])
    assert rows(read_history(spark, root)) == before
    add_days(spark, root, union([day_rows(spark, d) for d in days[3:]]), days[3], days[-1])
    assert rows(read_history(spark, root)) == before
    # Within a run of several days, the first of which stay as they are.
    add_days(spark, root, union([day_rows(spark, d) for d in days[5:]]), days[5], days[-1])
    assert rows(read_history(spark, root)) == before
    changed = [day_rows(spark, d, 1 + 50 * (d == days[4])) for d in days]
    add_days(spark, root, union(changed[4:]), days[4], days[-1])
    assert rows(read_history(spark, root)) == at_once(spark, changed)
    with pytest.raises(ValueError):
        add_days(spark, root, day_rows(spark, days[2]), days[2], days[2])


def test_a_run_that_fails_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    add_days(spark, root, day_rows(spark, DAYS[0]), DAYS[0], DAYS[0])
    before = rows(read_history(spark, root))

    def lost(*_):
        raise RuntimeError("lost")

    with monkeypatch.context() as patch:
        patch.setattr(member_history, "write_version", lost)
        with pytest.raises(RuntimeError):
            add_days(spark, root, day_rows(spark, DAYS[1], 9), DAYS[1], DAYS[1])
    assert rows(read_history(spark, root)) == before
    add_days(spark, root, day_rows(spark, DAYS[1]), DAYS[1], DAYS[1])
    assert rows(read_history(spark, root)) == at_once(spark, [day_rows(spark, d) for d in DAYS[:2]])


def test_from_cleaned_payments_with_a_late_one(spark, tmp_path):
    root = str(tmp_path)
    levels = spark.createDataFrame([(1, "v1", "web")], "vip_id long, vip_level string, dn string")
    write_load(levels, root, "dwd_vip_level", "a", ["dn"])

    def pay(load, *data):
        frame = spark.createDataFrame([(u, m, 1, d, "web") for u, m, d in data], "uid long, paymoney string, vip_id long, dt string, dn string")
        write_load(frame, root, "dwd_pcentermempaymoney", load, ["dt", "dn"])

    pay("one", (1, "1", "20190720"), (1, "2", "20190721"), (2, "4", "20190722"), (1, "8", "20190722"))
    for day in ("20190720", "20190721", "20190722"):
        update_history(spark, root, day)
    columns = ["uid", "start_time", "end_time"]
    assert rows(read_history(spark, root).selectExpr("*", "cast(paymoney as int) p"), *columns, "p") == [
        (1, "2019-07-20", "2019-07-21", 1), (1, "2019-07-21", "2019-07-22", 3), (1, "2019-07-22", "9999-12-31", 11),
        (2, "2019-07-22", "9999-12-31", 4),
    ]
    pay("late", (1, "100", "20190721"))
    update_history(spark, root, "20190721")
    assert rows(read_history(spark, root).selectExpr("*", "cast(paymoney as int) p"), *columns, "p") == [
        (1, "2019-07-20", "2019-07-21", 1), (1, "2019-07-21", "2019-07-22", 103), (1, "2019-07-22", "9999-12-31", 111),
        (2, "2019-07-22", "9999-12-31", 4),
    ]
