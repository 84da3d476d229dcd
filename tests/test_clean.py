from __future__ import annotations

from datetime import date, datetime

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from apptlake import schemas
from apptlake.operators.clean import SILVER_COLUMNS, clean_bookings, clean_spend
from apptlake.operators.conform import conform, empty_frame, fields_of
from apptlake.operators.dedup import latest_per_key, newest
from samples import FACEBOOK, YOUTUBE, bronze, values


def test_silver_columns_and_types(spark):
    rows = clean_bookings(bronze(spark, [{}]))
    assert tuple(rows.columns) == SILVER_COLUMNS
    declared = {f.name: f.dataType for f in fields_of(schemas.SILVER_BOOKINGS)}
    assert {f.name: f.dataType for f in rows.schema} == declared


def test_rows_without_email_or_id_are_dropped(spark):
    rows = bronze(
        spark, [{"booking_id": None}, {"invitee_email": None, "booking_id": "b"}, {"booking_id": "c"}]
    )
    assert values(clean_bookings(rows), "booking_id") == [("c",)]


def test_latest_event_stands_for_a_booking_whatever_its_kind(spark):
    rows = bronze(
        spark,
        [
            {"utm_source": "first"},
            {"utm_source": "last", "booking_date": datetime(2026, 3, 5), "event": "invitee.canceled"},
        ],
    )
    assert values(clean_bookings(rows), "utm_source") == [("last",)]
    assert values(clean_bookings(rows, created_only=True), "utm_source") == [("first",)]


def test_ties_go_to_the_later_arrival_then_the_later_file_then_the_later_ingest(spark):
    later = datetime(2026, 3, 2)
    ties = [
        {"utm_source": "file 1", "_source_file": "1", "_ingested_at": later},
        {"utm_source": "file 2", "_source_file": "2"},
        {"utm_source": "file 2 later", "_source_file": "2", "_ingested_at": later},
    ]
    assert values(clean_bookings(bronze(spark, ties)), "utm_source") == [("file 2 later",)]
    arrived = [*ties, {"utm_source": "s1", "sequence": 1}, {"utm_source": "s0", "sequence": 0}]
    assert values(clean_bookings(bronze(spark, arrived)), "utm_source") == [("s1",)]


def test_rules_may_name_channels_of_their_own(spark):
    rows = bronze(spark, [{"event_type": "https://x/podcast"}])
    rules = {"podcast": "podcast_ads"}
    assert values(clean_bookings(rows, rules), "channel") == [("podcast_ads",)]


def test_channel_filter_comes_after_the_choice_of_the_latest(spark):
    rows = bronze(
        spark,
        [
            {"event_type": FACEBOOK},
            {"event_type": "other", "booking_date": datetime(2026, 3, 5)},
            {"booking_id": "b", "event_type": None},
            {"booking_id": "c", "event_type": YOUTUBE},
        ],
    )
    assert values(clean_bookings(rows), "booking_id", "channel") == [("c", "youtube_paid_ads")]


def test_clean_spend(spark):
    rows = spark.createDataFrame(
        [
            ("fb", "2026-03-01", 5.0),
            ("fb", "2026-03-01", 7.0),
            ("fb", "not a day", 1.0),
            ("fb", None, 2.0),
            ("fb", None, 3.0),
            (None, "2026-03-01", 1.0),
            ("yt", "2026-03-01", None),
        ],
        schemas.SPEND,
    )
    assert values(clean_spend(rows)) == [
        ("fb", None, 1.0),
        ("fb", None, 3.0),
        ("fb", date(2026, 3, 1), 7.0),
    ]


@settings(max_examples=15, deadline=None)
@given(
    rows=st.lists(
        st.tuples(st.integers(0, 4), st.integers(0, 9)), min_size=1, max_size=30, unique=True
    ),
    parts=st.integers(1, 6),
)
def test_dedup_does_not_depend_on_order_or_partitioning(spark, rows, parts):
    want = {}
    for key, rank in rows:
        want[key] = max(rank, want.get(key, -1))
    df = spark.createDataFrame(rows[::-1], "key int, rank int").repartition(parts)
    assert values(latest_per_key(df, ["key"], newest("rank"))) == sorted(want.items(), key=str)


def test_null_keys_are_one_group(spark):
    df = spark.createDataFrame([(None, 1), (None, 2), (1, 3)], "key int, rank int")
    assert values(latest_per_key(df, ["key"], newest("rank"))) == [(1, 3), (None, 2)]


def test_a_hot_key_is_cut_down_before_the_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("key"), "id")
    plan = latest_per_key(df, ["key"], newest("id"))._jdf.queryExecution().executedPlan().toString()
    assert "Partial" in plan and plan.count("WindowGroupLimit") == 2
    assert plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_conform_adds_casts_and_orders_columns(spark):
    df = spark.createDataFrame([("2026-03-01", 7, "drop")], "day string, n int, extra string")
    row = conform(df, "n bigint, missing double, day date")
    assert row.dtypes == [("n", "bigint"), ("missing", "double"), ("day", "date")]
    assert tuple(row.first()) == (7, None, date(2026, 3, 1))


def test_empty_frame_has_the_declared_columns(spark):
    empty = empty_frame(spark, schemas.BRONZE)
    assert empty.count() == 0
    assert [f.dataType for f in empty.schema] == [f.dataType for f in fields_of(schemas.BRONZE)]
