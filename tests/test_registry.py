"""Registered queries against their SQL on the smallest tables."""

from __future__ import annotations

import duckdb
import pytest
from conftest import rows

import __spark_entry__ as contract
from checks import registry
from checks.oracle import all_oracles
from checks.registry import all_queries
from checks.shapes import TABLES
from tutorlake.sources.logs import LOGS
from tutorlake.sources.views import VIEWS

# Views and cleaned tables differ by their column lists only; a few of them stand for all here.
SAMPLED = ["clean_member", "clean_qz_question", "view_payment", "view_wide_major", "view_qz_point"]
CHECKED = SAMPLED + [name for name in all_queries() if not name.startswith(("clean_", "view_", "member_count"))]


@pytest.fixture(scope="module")
def duck(sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_oracles())
    assert {f"clean_{table.removeprefix('dwd_')}" for table in LOGS} <= set(all_queries())
    assert {f"view_{name}" for name in VIEWS} <= set(all_queries())


@pytest.mark.parametrize("name", CHECKED)
def test_query_matches_sql(spark, duck, sf_dir, name):
    frame = all_queries()[name](spark, sf_dir)
    cursor = duck.execute(all_oracles()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    expected = sorted(cursor.fetchall(), key=lambda r: tuple((v is None, str(v)) for v in r))
    assert rows(frame, *columns) == expected


def test_entry_gives_rows(spark, sf_dir):
    assert contract.entry(spark).count() == 75


def test_spread_tables_get_more_tasks_with_their_bytes(spark, tmp_path, monkeypatch):
    spark.range(5000).repartition(1).write.parquet(str(tmp_path / "ids"))
    stored = spark.read.parquet(str(tmp_path / "ids"))
    monkeypatch.setattr(registry, "PIECE", registry.stored_bytes(stored) // 50)
    many = registry.spread(stored, "id")
    assert many.rdd.getNumPartitions() >= 50 and many.count() == 5000


def test_two_loads_are_parsed_once(spark, sf_dir, monkeypatch):
    plans, write = [], registry.write_load

    def watched(rows, *place):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        write(rows, *place)

    monkeypatch.setattr(registry, "write_load", watched)
    assert registry.two_loads(spark, sf_dir).count() > 0
    assert len(plans) == 3 and not any("from_json" in plan for plan in plans)
