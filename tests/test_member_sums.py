"""Payment sums that are brought up to date load by load, against sums of all payments."""

from __future__ import annotations

import random
import shutil

import pytest
from conftest import rows

from tutorlake.operators.members import paid_by_level
from tutorlake.plans import member_sums
from tutorlake.plans.member_sums import PAYMENTS, SUMS, read_sums, update_sums
from tutorlake.sources.tables import read_loads, read_table, versions, write_load
from tutorlake.sources.views import view

SCHEMA = "uid bigint, paymoney decimal(18,4), vip_id bigint, dt string, dn string"


def payments(spark, seed, n=40):
    draw = random.Random(seed)
    pick = draw.choice
    data = [(pick([1, 2, 3, None]), pick([None, "1.5", "2"]), pick([1, 2, None]), pick("de"), pick(["07", "7", "x"])) for _ in range(n)]
    return spark.createDataFrame(data, SCHEMA.replace("decimal(18,4)", "string")).selectExpr(
        "uid", "cast(paymoney as decimal(18,4)) as paymoney", "vip_id", "dt", "dn"
    )


def whole(spark, root):
    return rows(paid_by_level(view(read_table(spark, root, PAYMENTS), "payment")))


def load(spark, root, name, seed, n=40):
    write_load(payments(spark, seed, n), root, PAYMENTS, name, ["dt", "dn"])


def test_loads_are_added_replaced_and_taken_off(spark, tmp_path):
    root = str(tmp_path)
    assert rows(update_sums(spark, root)) == []
    load(spark, root, "20190722", 1)
    load(spark, root, "7", 2)
    assert rows(update_sums(spark, root)) == whole(spark, root)
    load(spark, root, "007", 3)
    load(spark, root, "7", 4, n=3)
    assert rows(update_sums(spark, root)) == whole(spark, root)
    shutil.rmtree(f"{root}/{PAYMENTS}/load=20190722")
    assert rows(update_sums(spark, root)) == whole(spark, root)
    load(spark, root, "7", 5, n=0)
    assert rows(update_sums(spark, root)) == whole(spark, root)
    for name in ("7", "007"):
        shutil.rmtree(f"{root}/{PAYMENTS}/load={name}")
    assert rows(update_sums(spark, root)) == []
    assert len(versions(spark, root, f"{SUMS}/manifest")) == len(versions(spark, root, f"{SUMS}/totals")) == member_sums.KEPT


def test_a_day_reads_its_load_only(spark, tmp_path, monkeypatch):
    root, asked = str(tmp_path), []

    def recorded(*args):
        found = read_loads(*args)
        asked.append((args[-1], found))
        return found

    monkeypatch.setattr(member_sums, "read_loads", recorded)
    for n in range(5):
        load(spark, root, f"d{n}", n)
    update_sums(spark, root)
    update_sums(spark, root)
    assert [names for names, _ in asked] == [[f"d{n}" for n in range(5)]]
    load(spark, root, "d9", 9)
    assert rows(update_sums(spark, root)) == whole(spark, root)
    names, found = asked[-1]
    assert names == ["d9"] and len(asked) == 2
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(load" in plan and "d9" in plan.split("PartitionFilters:")[1].split("]")[0]


def test_an_update_that_breaks_off_is_not_seen(spark, tmp_path, monkeypatch):
    root = str(tmp_path)
    load(spark, root, "a", 1)
    update_sums(spark, root)
    seen = rows(read_sums(spark, root))
    load(spark, root, "b", 2)
    written = member_sums.write_version

    def broken(frame, place, table, version):
        if table.endswith("manifest"):
            raise RuntimeError("lost")
        written(frame, place, table, version)

    monkeypatch.setattr(member_sums, "write_version", broken)
    with pytest.raises(RuntimeError):
        update_sums(spark, root)
    assert rows(read_sums(spark, root)) == seen
    monkeypatch.undo()
    # Another load has come meanwhile; what the broken run left under its number counts for nothing.
    load(spark, root, "b", 3)
    load(spark, root, "c", 4)
    assert rows(update_sums(spark, root)) == whole(spark, root)


def test_a_table_without_loads_is_one_load(spark, tmp_path):
    root = str(tmp_path)
    for seed in (1, 2):
        payments(spark, seed).write.mode("overwrite").partitionBy("dt").parquet(f"{root}/{PAYMENTS}")
        assert rows(update_sums(spark, root)) == whole(spark, root)
