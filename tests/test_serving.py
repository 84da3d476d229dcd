from __future__ import annotations

from datetime import date, datetime

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from apptlake import schemas
from apptlake.operators.conform import empty_frame
from apptlake.operators.filters import Selection, only_days, only_values, typed_days
from apptlake.plans import serving
from samples import daily, live, values

D1, D2, D3 = date(2026, 3, 1), date(2026, 3, 2), date(2026, 3, 3)
TODAY = date(2026, 3, 4)
EVERYTHING = Selection()


def cpb(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.GOLD_CPB_BY_CHANNEL)


def load(spark, *rows):
    return spark.createDataFrame(list(rows), schemas.GOLD_EMPLOYEE_MEETING_LOAD)


def no_live(spark):
    return empty_frame(spark, schemas.LIVE_SERVING)


def no_daily(spark):
    return empty_frame(spark, schemas.GOLD_BOOKINGS_BY_SOURCE_DAILY)


def test_labelled_names_missing_sources_and_drops_bad_days(spark):
    text = spark.createDataFrame(
        [("2026-03-01", None, 1), ("2026-03-01 10:00:00", "a", 2), ("soon", "a", 3), (None, "a", 4)],
        "booking_date string, utm_source string, booking_count bigint",
    )
    assert values(serving.labelled(text)) == [(D1, "(no utm_source)", 1), (D1, "a", 2)]


def test_typed_days_can_keep_rows_with_bad_days(spark):
    df = spark.createDataFrame([("x", "bad")], "host string, week string")
    assert values(typed_days(df, "week", drop_bad=False)) == [("x", None)]


def test_live_counts_only_after_the_last_batch_day(spark):
    batch = daily(spark, [(D1, "news", 5), (D2, "news", 6)])
    stream = live(
        spark,
        [
            {"booking_id": "a", "booking_date": D2},
            {"booking_id": "b", "booking_date": D3},
            {"booking_id": "c", "booking_date": D3},
            {"booking_id": "d", "booking_date": D3, "utm_source": None},
            {"booking_id": "e", "booking_date": None},
        ],
    )
    merged = serving.combined_daily(batch, stream)
    assert values(merged) == [(D1, "news", 5), (D2, "news", 6), (D3, "news", 2)]


def test_without_a_batch_all_live_days_count(spark):
    merged = serving.combined_daily(no_daily(spark), live(spark, [{}]))
    assert values(merged) == [(D2, "news", 1)]


@settings(max_examples=10, deadline=None)
@given(
    batch_days=st.sets(st.integers(1, 9)),
    live_days=st.lists(st.integers(1, 9), max_size=8),
)
def test_no_live_row_on_or_before_the_batch_end(spark, batch_days, live_days):
    batch = daily(spark, [(date(2026, 3, day), "b", 1) for day in sorted(batch_days)])
    stream = live(
        spark,
        [
            {"booking_id": str(i), "booking_date": date(2026, 3, day), "utm_source": "l"}
            for i, day in enumerate(live_days)
        ],
    )
    last = max(batch_days, default=0)
    rows = serving.combined_daily(batch, stream).where("utm_source = 'l'").collect()
    assert sum(row.booking_count for row in rows) == sum(day > last for day in live_days)
    assert all(row.booking_date.day > last for row in rows)


def test_date_range_is_inclusive_and_source_choice_applies(spark):
    table = daily(spark, [(D1, "a", 1), (D2, "a", 2), (D3, "a", 3), (D2, "b", 4)])
    chosen = serving.in_selection(table, Selection(D1, D2, ["a"]))
    assert values(chosen) == [(D1, "a", 1), (D2, "a", 2)]
    assert serving.in_selection(table, EVERYTHING).count() == 4


def test_an_empty_choice_gives_an_empty_view_of_the_same_columns(spark):
    table = daily(spark, [(D1, "a", 1)])
    nothing = serving.in_selection(table, Selection(sources=[]))
    assert nothing.isEmpty() and nothing.columns == table.columns
    assert only_values(table, "utm_source", None).count() == 1
    assert only_days(table, "booking_date", None, None).count() == 1


def test_channels_by_cost_and_leaderboard(spark):
    table = cpb(spark, ("a", 5, 1.0, 0.2), ("b", 9, 0.9, 0.1), ("c", 7, None, None))
    by_cost = serving.channels_by_cost(table, EVERYTHING)
    assert [row.channel for row in by_cost.collect()] == ["b", "a", "c"]
    board = serving.channel_leaderboard(table, Selection(channels=["a", "c"]))
    assert [row.channel for row in board.collect()] == ["c", "a"]


def test_kpi_summary(spark):
    figures = serving.kpi_summary(
        daily(spark, [(D1, "a", 3), (D2, "a", 1)]),
        live(spark, [{"booking_id": "x", "utm_source": None}, {"booking_id": "y"}]),
        cpb(spark, ("a", 5, 10.0, 2.0), ("b", 1, 2.0, 2.0)),
        load(spark, ("h1", D1, 1), ("h1", D2, 1), ("h2", D1, 1), (None, D1, 1)),
    )
    assert figures.first().asDict() == {
        "total_bookings": 4,
        "live_bookings": 2,
        "total_spend": 12.0,
        "active_hosts": 2,
        "avg_cost_per_booking": 3.0,
    }


def test_live_count_can_be_of_one_day(spark):
    stream = live(spark, [{"booking_id": "x", "booking_date": D1}, {"booking_id": "y"}])
    tables = no_daily(spark), stream, cpb(spark), load(spark)
    assert serving.kpi_summary(*tables, as_of=D2).first().live_bookings == 1


def test_kpi_summary_of_nothing_is_zero(spark):
    figures = serving.kpi_summary(no_daily(spark), no_live(spark), cpb(spark), load(spark))
    assert tuple(figures.first()) == (0, 0, 0.0, 0, 0.0)


def test_live_by_channel_leaves_out_unknown_channels(spark):
    stream = live(
        spark,
        [{"booking_id": "a"}, {"booking_id": "b", "channel": "x"}, {"booking_id": "c", "channel": "x"},
         {"booking_id": "d", "channel": None}],
    )
    ordered = [tuple(row) for row in serving.live_by_channel(stream).collect()]
    assert ordered == [("x", 2), ("facebook_paid_ads", 1)]


def test_recent_live_bookings_put_unknown_times_last(spark):
    stream = live(
        spark,
        [{"booking_id": f"b{day:02}", "start_time": datetime(2026, 3, day)} for day in range(1, 10)]
        + [{"booking_id": "x", "start_time": None}, {"booking_id": "y", "start_time": None}],
    )
    recent = serving.recent_live_bookings(stream)
    assert [row.booking_id for row in recent.collect()] == [
        *[f"b{day:02}" for day in range(9, 0, -1)],
        "x",
    ]
    assert "TakeOrderedAndProject" in recent._jdf.queryExecution().executedPlan().toString()


def test_heatmap_has_seven_days_and_a_column_per_source(spark):
    table = spark.createDataFrame(
        [("Monday", D2, "a", 1), ("Monday", D2, "a", 2), ("Sunday", D1, "b", 4)],
        schemas.GOLD_BOOKING_TIME_DISTRIBUTION,
    )
    grid = serving.weekday_source_heatmap(table, ["a", "b", "c"])
    rows = [tuple(row) for row in grid.collect()]
    assert grid.columns == ["day_of_week", "a", "b", "c"]
    assert rows[0] == ("Monday", 3, 0, 0) and rows[6] == ("Sunday", 0, 4, 0)
    assert [row[0] for row in rows] == list(serving.WEEKDAYS)
    assert sum(sum(row[1:]) for row in rows) == 7
    assert values(serving.weekday_source_totals(table)) == [("Monday", "a", 3), ("Sunday", "b", 4)]


def test_live_meetings_all_count_in_the_current_week(spark):
    stream = live(
        spark,
        [
            {"booking_id": "a", "start_time": datetime(2026, 5, 1)},
            {"booking_id": "b"},
            {"booking_id": "c", "host_email": None},
        ],
    )
    batch = load(spark, ("host@example.com", date(2026, 3, 2), 7))
    merged = serving.meeting_load_combined(batch, stream, TODAY)
    assert values(merged) == [
        ("host@example.com", date(2026, 3, 2), 2),
        ("host@example.com", date(2026, 3, 2), 7),
    ]
    by_week = serving.meeting_load_combined(batch, stream, TODAY, by_start_week=True)
    assert ("host@example.com", date(2026, 4, 27), 1) in values(by_week)
    guarded = serving.meeting_load_combined(batch, stream, TODAY, after_batch=D2)
    assert values(guarded) == values(batch)


def test_host_averages_count_rows_as_weeks(spark):
    table = load(spark, ("h1", D2, 7), ("h1", D2, 2), ("h2", D2, 3), (None, D2, 9))
    rows = [tuple(row) for row in serving.host_averages(table).collect()]
    assert rows == [("h1", 9, 2, 4.5), ("h2", 3, 1, 3.0)]


def test_weekly_trends(spark):
    table = load(spark, ("h1", D3, 7), ("h2", D1, 2), ("h1", D1, 1), ("h1", None, 5))
    assert [tuple(r) for r in serving.weekly_trend_all(table).collect()] == [(D1, 3), (D3, 7)]
    host = serving.host_weekly_trend(table, "h1")
    assert [row.week_start_date for row in host.collect()] == [D1, D3, None]


def test_filter_domain_lists_every_choice_in_order(spark):
    rows = serving.filter_domain(
        daily(spark, [(D1, "b", 1), (D2, "a", 1)]),
        cpb(spark, ("ch", 1, 1.0, 1.0), (None, 1, 1.0, 1.0)),
        load(spark, ("h", D1, 1), (None, D1, 1)),
        TODAY,
    )
    assert [tuple(row) for row in rows.collect()] == [
        ("channel", "ch"),
        ("host", "h"),
        ("max_date", "2026-03-04"),
        ("min_date", "2026-03-01"),
        ("source", "a"),
        ("source", "b"),
    ]


@pytest.mark.parametrize(("today", "last"), [(D1, D2), (D3, D3)])
def test_last_choice_is_never_before_today(spark, today, last):
    bounds = serving.date_bounds(daily(spark, [(D1, "a", 1), (D2, "a", 1)]), today)
    assert tuple(bounds.first()) == (D1, last)
    assert tuple(serving.date_bounds(no_daily(spark), today).first()) == (today, today)


def test_batch_freshness(spark):
    assert serving.batch_freshness(daily(spark, [(D2, "a", 1)])).first()[0] == "2026-03-02"
    assert serving.batch_freshness(no_daily(spark)).first()[0] == "N/A"


def test_distinct_values_are_sorted_without_null(spark):
    table = daily(spark, [(D1, "b", 1), (D1, None, 1), (D1, "a", 1), (D2, "a", 1)])
    assert [row[0] for row in serving.distinct_values(table, "utm_source").collect()] == ["a", "b"]
