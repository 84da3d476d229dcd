from __future__ import annotations

import tempfile
from pathlib import Path

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyarrow.parquet import ParquetFile
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from apptlake.operators import keyed
from apptlake.operators.dedup import newest
from apptlake.operators.keyed import (
    append_new,
    bucket_count,
    current,
    merge_into_table,
    upsert,
    upsert_within,
)
from samples import values

DDL = "k string, d int, v int"
KEYS = ["k", "d"]


def rows(spark, *data):
    return spark.createDataFrame(list(data), DDL)


def table(spark, folder):
    return values(current(spark, folder, DDL))


def files_of(folder):
    return {path for path in Path(folder).rglob("*.parquet")}


def test_missing_table_is_empty_and_first_upsert_creates_it(spark, folder):
    assert table(spark, folder) == [] and bucket_count(spark, folder) is None
    assert upsert(rows(spark), folder, KEYS) == 0
    assert upsert(rows(spark, ("a", 1, 1)), folder, KEYS, buckets=4) == 1
    assert table(spark, folder) == [("a", 1, 1)] and bucket_count(spark, folder) == 4


def test_matches_are_replaced_others_kept_and_inserted(spark, folder):
    upsert(rows(spark, ("a", 1, 1), ("b", 1, 1)), folder, KEYS)
    upsert(rows(spark, ("b", 1, 2), ("c", 1, 2)), folder, KEYS)
    assert table(spark, folder) == [("a", 1, 1), ("b", 1, 2), ("c", 1, 2)]


def test_rows_with_a_null_key_match_nothing_and_all_stay(spark, folder):
    batch = [("a", None, 1), ("a", None, 1), ("a", None, 2)]
    upsert(rows(spark, *batch), folder, KEYS, buckets=2)
    assert table(spark, folder) == batch
    upsert(rows(spark, ("a", None, 1), ("z", 1, 1)), folder, KEYS)
    assert table(spark, folder) == sorted([*batch, ("a", None, 1), ("z", 1, 1)], key=str)


def test_null_safe_keys_match_one_another(spark, folder):
    upsert(rows(spark, ("a", None, 1)), folder, KEYS, null_safe=True)
    upsert(rows(spark, ("a", None, 2)), folder, KEYS, null_safe=True)
    assert table(spark, folder) == [("a", None, 2)]
    with pytest.raises(Exception, match="several source rows for one key"):
        upsert(rows(spark, ("a", None, 2), ("a", None, 3)), folder, KEYS, null_safe=True)


def test_a_batch_that_runs_twice_changes_nothing(spark, folder):
    upsert(rows(spark, ("a", 1, 1)), folder, KEYS)
    upsert(rows(spark, ("b", 1, 1)), folder, KEYS)
    upsert(rows(spark, ("a", 1, 1)), folder, KEYS)
    assert table(spark, folder) == [("a", 1, 1), ("b", 1, 1)]


def test_a_repeated_source_key_fails_and_leaves_the_table_alone(spark, folder):
    upsert(rows(spark, ("a", 1, 1)), folder, KEYS)
    with pytest.raises(Exception, match="several source rows for one key"):
        upsert(rows(spark, ("a", 1, 2), ("a", 1, 3)), folder, KEYS)
    assert table(spark, folder) == [("a", 1, 1)]


def test_an_order_keeps_what_came_late_from_undoing_what_is_newer(spark, folder):
    upsert(rows(spark, ("a", 1, 9), ("b", 1, 1)), folder, KEYS, newest("v"))
    upsert(rows(spark, ("a", 1, 3), ("b", 1, 3)), folder, KEYS, newest("v"))
    assert table(spark, folder) == [("a", 1, 9), ("b", 1, 3)]


def test_only_buckets_of_the_batch_are_rewritten_and_their_number_stays(spark, folder):
    upsert(rows(spark, *((f"k{n}", 1, n) for n in range(200))), folder, KEYS, buckets=16)
    before = files_of(folder)
    upsert(rows(spark, ("k7", 1, 0)), folder, KEYS, buckets=99)
    after = files_of(folder)
    assert len(before) == 16 and len(before & after) == 15 and len(after) == 16
    assert bucket_count(spark, folder) == 16 and len(table(spark, folder)) == 200


def test_the_table_is_read_as_it_is(spark, folder):
    upsert(rows(spark, ("a", 1, 9)), folder, KEYS)
    plan = current(spark, folder, DDL)._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan and "Exchange" not in plan


def test_a_column_added_later_is_null_in_older_rows(spark, folder):
    upsert(rows(spark, ("a", 1, 9)), folder, KEYS)
    upsert(rows(spark, ("b", 1, 9)).withColumn("w", F.lit("new")), folder, KEYS)
    found = values(current(spark, folder, f"{DDL}, w string"))
    assert found == [("a", 1, 9, None), ("b", 1, 9, "new")]


def test_merge_into_needs_a_table_with_row_level_merge(spark, folder):
    spark.sql(f"CREATE TABLE plain (k string, v int) USING parquet LOCATION '{folder}/plain'")
    try:
        with pytest.raises(PySparkException):
            merge_into_table(spark.sql("select 'a' k, 1 v"), "plain", ["k"])
    finally:
        spark.sql("DROP TABLE plain")


KEY = st.tuples(st.sampled_from("ab"), st.sampled_from([1, 2, None]))
BATCH = st.dictionaries(KEY, st.integers(0, 9), max_size=4)


@settings(max_examples=6, deadline=None)
@given(st.lists(BATCH, min_size=1, max_size=4), st.integers(1, 3))
def test_upserts_act_like_merge_into_a_dictionary(spark, batches, buckets):
    want, unmatched = {}, []
    with tempfile.TemporaryDirectory() as folder:
        for batch in batches:
            want.update({key: value for key, value in batch.items() if None not in key})
            unmatched += [(*key, value) for key, value in batch.items() if None in key]
            data = [(*key, value) for key, value in batch.items()]
            assert upsert(rows(spark, *data), folder, KEYS, buckets=buckets) == len(batch)
        assert table(spark, folder) == sorted([*((*k, v) for k, v in want.items()), *unmatched], key=str)


PLACED = "k string, day string, n int, days array<string>"


def within(spark, folder, *data):
    source = spark.createDataFrame(list(data), PLACED)
    upsert_within(source, folder, ["k"], "day", "days", newest("n"), 2)
    read = spark.read.schema("k string, n int, buckets int, day string, bucket int").parquet(folder)
    return values(read.where("k IS NOT NULL"), "k", "day", "n")


def test_a_row_that_moves_to_another_day_leaves_the_first(spark, folder):
    within(spark, folder, ("a", "d1", 1, ["d1"]), ("b", "d1", 1, ["d1"]), ("c", "d3", 1, ["d3"]))
    untouched = [path for path in files_of(folder) if "day=d3" in str(path)]
    found = within(spark, folder, ("a", "d2", 2, ["d1", "d2"]), (None, "d2", 2, ["d2"]))
    assert found == [("a", "d2", 2), ("b", "d1", 1), ("c", "d3", 1)]
    found = within(spark, folder, ("b", "d2", 2, ["d1"]), ("a", "d1", 1, ["d1", "d2"]))
    assert found == [("a", "d2", 2), ("b", "d2", 2), ("c", "d3", 1)]
    assert set(untouched) <= files_of(folder)


VERSIONED = "k string, n int, v string"


def test_appends_take_what_is_newer_than_all_stored(spark, folder):
    def add(*data):
        append_new(spark.createDataFrame(list(data), VERSIONED), folder, ["k"], ["n"], 2)
        return values(spark.read.schema(VERSIONED).parquet(folder), "k", "n", "v")

    assert add(("a", 2, "x"), ("b", 5, "x"), (None, 1, "x")) == [("a", 2, "x"), ("b", 5, "x"), (None, 1, "x")]
    # Replays and older versions go, newer ones and new keys are added.
    found = add(("a", 2, "x"), ("b", 4, "old"), ("c", 1, "x"), (None, 1, "x"), (None, 1, "y"))
    assert found == [("a", 2, "x"), ("b", 5, "x"), ("c", 1, "x"), (None, 1, "x"), (None, 1, "y")]
    assert ("a", 3, "z") in add(("a", 3, "z"))


def largest_file(folder):
    return max(ParquetFile(path).metadata.num_rows for path in files_of(folder))


def test_a_large_bucket_is_dealt_to_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_TASK", 50)
    source = [(f"k{n}", 1, n) for n in range(400)]
    assert upsert(rows(spark, *source), folder, KEYS, buckets=1) == 400
    assert table(spark, folder) == sorted(source, key=str) and largest_file(folder) < 200
    newer = [(f"k{n}", 1, -n) for n in range(200, 600)]
    assert upsert(rows(spark, *newer, (None, 1, 1), (None, 1, 1)), folder, KEYS) == 402
    assert table(spark, folder) == sorted([*source[:200], *newer, (None, 1, 1), (None, 1, 1)], key=str)
    assert largest_file(folder) < 200
    with pytest.raises(Exception, match="several source rows for one key"):
        upsert(rows(spark, *newer, ("k7", 1, 1), ("k7", 1, 2)), folder, KEYS)


def test_a_large_bucket_below_days_is_dealt_to_several_tasks(spark, folder, monkeypatch):
    monkeypatch.setattr(keyed, "ROWS_PER_TASK", 50)
    within(spark, folder, *[(f"k{n}", "d1", 1, ["d1"]) for n in range(600)])
    assert largest_file(folder) < 200
    found = within(spark, folder, *[(f"k{n}", "d2", 2, ["d1"]) for n in range(300)])
    assert found == sorted([(f"k{n}", "d2", 2) if n < 300 else (f"k{n}", "d1", 1) for n in range(600)], key=str)
    assert largest_file(folder) < 200
