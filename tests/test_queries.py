"""Every registered query against its SQL on the smallest given tables."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pytest

from __spark_entry__ import entry, oracle_sql, queries
from workload import frames
from workload.queries import REGISTERED
from tools.check import rows_of

SF_DIR = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).is_dir(), reason="needs the given tables")


@pytest.fixture(scope="module")
def db():
    connection = duckdb.connect()
    for table in Path(SF_DIR).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {table.stem} AS SELECT * FROM '{table}'")
    return connection


def test_every_query_has_its_sql():
    assert set(REGISTERED) <= set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_agrees_with_sql(spark, db, name):
    got = queries()[name](spark, SF_DIR)
    cursor = db.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert sorted(got.columns) == sorted(names)
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


# Expected figures of FIXTURES.md: bookings, live bookings, spend, cost per booking, hosts.
KPI = {
    "0.001": (537, 108, 130525804.98, 243064.813743, 14),
    "0.01": (5203, 1132, 877389699.85, 168631.501028, 19),
    "0.1": (52165, 11496, 1210931212.67, 23213.480546, 19),
}


@pytest.mark.parametrize("sf", KPI)
def test_headline_figures(spark, sf):
    row = queries()["kpi_summary"](spark, f"/root/testdata/sf{sf}").first()
    assert (
        row.total_bookings,
        row.live_bookings,
        round(row.total_spend, 2),
        row.avg_cost_per_booking,
        row.active_hosts,
    ) == KPI[sf]


def test_files_follow_from_rows_and_not_from_keys(spark):
    """Keys a thousand apart, over ten places, one of which has most rows."""
    rows = spark.range(0, 3_000_000, 1000).selectExpr("id AS key", "greatest(id / 1000 % 20 - 10, 0) AS place")
    files = frames.in_files(rows, "place", "key", 100).groupBy("place", "slice", "part").count().collect()
    assert sum(row["count"] for row in files) == 3000
    assert max(row["count"] for row in files) <= 100
    assert len(files) <= 17 + 9 * 2


def test_a_place_is_numbered_in_slices(spark, monkeypatch):
    monkeypatch.setattr(frames, "ROWS_PER_SLICE", 500)
    files = frames.in_files(spark.range(3000).selectExpr("id", "0 AS place"), "place", "id", 100)
    counts = files.groupBy("slice", "part").count().collect()
    assert len({row.slice for row in counts}) == 6
    assert (sum(row["count"] for row in counts), max(row["count"] for row in counts)) == (3000, 100)


def test_waiting_records_lie_in_more_files_as_they_grow(spark, db, monkeypatch):
    """Documents are made after the shuffle, and pulls stay few."""
    name = "stream_bounded_pulls"
    monkeypatch.setattr(frames, "RECORDS_WAITING", 20)
    waiting = frames.waiting_records(spark, SF_DIR)
    total = waiting.count()
    assert waiting.rdd.getNumPartitions() == frames.PULLS * -(-total // (frames.PULLS * 20)) > frames.PULLS
    plan = waiting._jdf.queryExecution().optimizedPlan().toString()
    assert "RepartitionByExpression [event_id" in plan
    got = queries()[name](spark, SF_DIR)
    cursor = db.execute(oracle_sql()[name])
    names = [column[0] for column in cursor.description]
    assert rows_of(got.columns, got.collect()) == rows_of(names, cursor.fetchall())
