from __future__ import annotations

from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from apptlake import schemas
from apptlake.operators.clean import clean_bookings
from apptlake.operators.conform import empty_frame, fields_of
from apptlake.plans import gold, serving
from samples import TIKTOK, YOUTUBE, bronze, values


def silver(spark, rows):
    return clean_bookings(bronze(spark, rows))


def spends(spark, rows):
    return spark.createDataFrame(rows, schemas.SILVER_SPENDS)


def types(ddl):
    return [(f.name, f.dataType) for f in fields_of(ddl)]


def test_daily_counts_keep_a_group_without_source(spark):
    rows = silver(
        spark,
        [
            {"booking_id": "a"},
            {"booking_id": "b"},
            {"booking_id": "c", "utm_source": None},
            {"booking_id": "d", "booking_date": datetime(2026, 3, 1, 23, 59, 59)},
            {"booking_id": "e", "booking_date": datetime(2026, 3, 2)},
        ],
    )
    daily = gold.bookings_by_source_daily(rows)
    assert [(f.name, f.dataType) for f in daily.schema] == types(schemas.GOLD_BOOKINGS_BY_SOURCE_DAILY)
    assert values(daily) == [
        (date(2026, 3, 1), "news", 3),
        (date(2026, 3, 1), None, 1),
        (date(2026, 3, 2), "news", 1),
    ]


def test_distribution_names_the_weekday(spark):
    rows = silver(spark, [{"booking_id": "a"}, {"booking_id": "b", "booking_date": None}])
    table = gold.booking_time_distribution(gold.bookings_by_source_daily(rows))
    assert [(f.name, f.dataType) for f in table.schema] == types(
        schemas.GOLD_BOOKING_TIME_DISTRIBUTION
    )
    assert values(table) == [("Sunday", date(2026, 3, 1), "news", 1), (None, None, "news", 1)]


def test_cost_per_booking_with_both_sides_unmatched(spark):
    rows = silver(
        spark,
        [
            {"booking_id": "a"},
            {"booking_id": "b"},
            {"booking_id": "c", "event_type": TIKTOK},
        ],
    )
    spent = spends(
        spark,
        [
            ("facebook_paid_ads", date(2026, 3, 1), 0.1),
            ("facebook_paid_ads", date(2026, 3, 2), 0.2),
            ("linkedin_paid_ads", date(2026, 3, 1), 9.0),
        ],
    )
    table = gold.cpb_by_channel(rows, spent)
    assert [(f.name, f.dataType) for f in table.schema] == types(schemas.GOLD_CPB_BY_CHANNEL)
    assert values(table) == [
        ("facebook_paid_ads", 2, 0.3, 0.15),
        ("tiktok_paid_ads", 1, 0.0, 0.0),
    ]


def test_spend_that_is_no_number_is_left_out_of_the_sum(spark):
    rows = silver(spark, [{"event_type": YOUTUBE}])
    spent = spends(
        spark,
        [("youtube_paid_ads", date(2026, 3, 1), float("nan")), ("youtube_paid_ads", None, 4.0)],
    )
    assert values(gold.cpb_by_channel(rows, spent)) == [("youtube_paid_ads", 1, 4.0, 4.0)]


def test_meeting_load_goes_by_start_week_and_known_hosts(spark):
    rows = silver(
        spark,
        [
            {"booking_id": "a", "start_time": datetime(2026, 3, 1, 23)},
            {"booking_id": "b", "start_time": datetime(2026, 3, 2, 0)},
            {"booking_id": "c", "start_time": datetime(2026, 3, 8, 12)},
            {"booking_id": "d", "host_email": None},
            {"booking_id": "e", "start_time": None},
        ],
    )
    table = gold.employee_meeting_load(rows)
    assert [(f.name, f.dataType) for f in table.schema] == types(schemas.GOLD_EMPLOYEE_MEETING_LOAD)
    assert values(table) == [
        ("host@example.com", None, 1),
        ("host@example.com", date(2026, 2, 23), 1),
        ("host@example.com", date(2026, 3, 2), 2),
    ]


def test_sketches_of_days_add_up_to_the_hosts_of_a_range(spark):
    rows = spark.range(20_000).selectExpr(
        "string(id) booking_id", "timestamp'2026-03-01 09:00:00' + make_interval(0, 0, 0, int(id % 20)) booking_date",
        "'c' channel", "current_timestamp() start_time", "current_timestamp() end_time",
        "if(id % 7 = 0, null, concat('host', id % 6000)) host_email", "'h' host_name", "'s' utm_source",
    )
    daily = gold.active_hosts_daily(rows)
    assert daily.count() == 20
    for first, last in ((1, 1), (3, 9), (1, 20)):
        days = date(2026, 3, first), date(2026, 3, last)
        exact = rows.where(F.to_date("booking_date").between(*map(F.lit, days))).agg(F.count_distinct("host_email"))
        found = serving.active_hosts(daily, *days).first().active_hosts
        assert abs(found - exact.first()[0]) <= 0.02 * exact.first()[0]
    assert serving.active_hosts(daily, date(2027, 1, 1)).first().active_hosts == 0


def test_counts_by_all_columns_in_one_pass_equal_those_of_each(spark):
    rows = silver(
        spark,
        [
            {"booking_id": str(n), "utm_source": "ab"[n % 2] if n % 5 else None, "event_type": (TIKTOK, YOUTUBE)[n % 2],
             "host_email": f"h{n % 4}" if n % 4 else None, "start_time": datetime(2026, 3, 1 + n % 9) if n % 3 else None}
            for n in range(40)
        ],
    )
    spent = spends(spark, [("tiktok_paid_ads", date(2026, 3, 1), 3.0)])
    counts = gold.booking_counts(rows)
    assert values(gold.daily_of(counts)) == values(gold.bookings_by_source_daily(rows))
    assert values(gold.load_of(counts)) == values(gold.employee_meeting_load(rows))
    assert values(gold.cost_of(counts, spent)) == values(gold.cpb_by_channel(rows, spent))
    assert sum(r.booking_count for r in gold.daily_of(counts).collect()) == 40


def test_empty_silver_gives_empty_gold(spark):
    none = empty_frame(spark, schemas.SILVER_BOOKINGS)
    daily = gold.bookings_by_source_daily(none)
    assert daily.isEmpty()
    assert gold.booking_time_distribution(daily).isEmpty()
    assert gold.cpb_by_channel(none, empty_frame(spark, schemas.SILVER_SPENDS)).isEmpty()
    assert gold.employee_meeting_load(none).isEmpty()


def test_amounts_out_of_range_fail_and_missing_ones_do_not_count(spark):
    rows = silver(spark, [{"booking_id": "a"}])
    spent = [("facebook_paid_ads", date(2026, 3, 1), amount) for amount in (5.0, float("nan"), None)]
    assert gold.cpb_by_channel(rows, spends(spark, spent)).first().total_spend == 5.0
    huge = [("facebook_paid_ads", date(2026, 3, 1), 1e23)]
    with pytest.raises(Exception, match="amount out of range"):
        gold.cpb_by_channel(rows, spends(spark, huge)).collect()
