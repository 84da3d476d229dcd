"""Serving views: gold tables merged with live bookings, filtered and summarised.

Every view is a lazy frame. An empty input gives an empty view of the same columns.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.functions.times import WEEKDAYS
from apptlake.functions.values import labelled_source, ratio_or_zero
from apptlake.operators.filters import Selection, only_days, only_values, typed_days

# A day before any data: with no batch yet, every live booking is newer.
FIRST_DAY = "0001-01-01"


def monday_of(day: date) -> date:
    return day - timedelta(days=day.weekday())


def labelled(gold: DataFrame) -> DataFrame:
    """A gold table by booking day, made ready: typed days and named sources."""
    return typed_days(gold, "booking_date").withColumn(
        "utm_source", labelled_source(F.col("utm_source"))
    )


def live_by_day(live: DataFrame) -> DataFrame:
    """Live bookings per day and source; those without a source are left out here."""
    known = live.where(F.col("booking_date").isNotNull() & F.col("utm_source").isNotNull())
    return known.groupBy("booking_date", "utm_source").agg(F.count(F.lit(1)).alias("booking_count"))


def combined_daily(daily: DataFrame, live: DataFrame) -> DataFrame:
    """Batch counts, plus live counts of the days after the batch's last one.

    ``daily`` is the labelled daily table. Its last day is a scalar subquery, so it reaches
    the live scan as a plain filter value.
    """
    last_day = daily.agg(F.coalesce(F.max("booking_date"), F.lit(FIRST_DAY).cast("date"))).scalar()
    newer = live_by_day(live.where(F.col("booking_date") > last_day))
    return daily.select("booking_date", "utm_source", "booking_count").unionByName(newer)


def in_selection(df: DataFrame, chosen: Selection) -> DataFrame:
    """Days and sources chosen; for the combined daily view and the time distribution."""
    return only_values(
        only_days(df, "booking_date", chosen.start, chosen.end), "utm_source", chosen.sources
    )


def daily_trend(daily: DataFrame) -> DataFrame:
    return daily.orderBy("booking_date", "utm_source")


def channels_by_cost(cpb: DataFrame, chosen: Selection) -> DataFrame:
    return only_values(cpb, "channel", chosen.channels).orderBy(
        F.asc_nulls_last("cost_per_booking"), "channel"
    )


def channel_leaderboard(cpb: DataFrame, chosen: Selection) -> DataFrame:
    return (
        only_values(cpb, "channel", chosen.channels)
        .select("channel", "total_bookings", "total_spend", "cost_per_booking")
        .orderBy(F.desc_nulls_last("total_bookings"), "channel")
    )


def kpi_summary(
    daily: DataFrame,
    live: DataFrame,
    cpb: DataFrame,
    meeting_load: DataFrame,
    as_of: date | None = None,
) -> DataFrame:
    """One row of headline figures.

    ``daily`` and ``cpb`` come filtered. Spend is of all dates, hosts are of the batch only,
    and every live row counts unless ``as_of`` names the day to count.
    """
    counted = live if as_of is None else live.where(F.col("booking_date") == F.lit(as_of))
    bookings = daily.agg(
        F.coalesce(F.sum("booking_count"), F.lit(0)).cast("bigint").alias("total_bookings")
    )
    spent = cpb.agg(F.coalesce(F.sum("total_spend"), F.lit(0.0)))
    hosts = meeting_load.agg(F.count_distinct("host_email"))
    figures = bookings.select(
        "total_bookings",
        counted.agg(F.count(F.lit(1))).scalar().alias("live_bookings"),
        spent.scalar().alias("total_spend"),
        hosts.scalar().alias("active_hosts"),
    )
    return figures.withColumn(
        "avg_cost_per_booking", ratio_or_zero(F.col("total_spend"), F.col("total_bookings"))
    )


def active_hosts(hosts: DataFrame, start: date | None = None, end: date | None = None) -> DataFrame:
    """About how many hosts had bookings from ``start`` to ``end``: one small sketch a day is read
    and merged, not the bookings. Up to some hundreds of hosts the number is exact."""
    chosen = only_days(hosts, "booking_date", start, end)
    merged = F.hll_sketch_estimate(F.hll_union_agg("hosts"))
    return chosen.agg(F.coalesce(merged, F.lit(0)).alias("active_hosts"))


def live_by_channel(live: DataFrame) -> DataFrame:
    return (
        live.where(F.col("channel").isNotNull())
        .groupBy("channel")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), "channel")
    )


def recent_live_bookings(live: DataFrame, n: int = 10) -> DataFrame:
    """The live bookings that start last; a report of ``n`` rows."""
    return (
        live.select("booking_id", "channel", "utm_source", "host_name", "start_time")
        .orderBy(F.desc_nulls_last("start_time"), "booking_id")
        .limit(n)
    )


def weekday_source_totals(distribution: DataFrame) -> DataFrame:
    """Bookings per weekday and source in long form, for any number of sources."""
    return distribution.groupBy("day_of_week", "utm_source").agg(
        F.sum("booking_count").alias("booking_count")
    )


def weekday_source_heatmap(distribution: DataFrame, sources: Sequence[str]) -> DataFrame:
    """Seven rows, Monday first, one column per source, zero where there was nothing.

    The sources are named by the caller, so the columns do not depend on the data.
    """
    counts = (
        distribution.where(F.col("day_of_week").isin(*WEEKDAYS))
        .groupBy("day_of_week")
        .pivot("utm_source", list(sources))
        .agg(F.sum("booking_count"))
    )
    names = F.array(*[F.lit(name) for name in WEEKDAYS])
    days = distribution.sparkSession.range(1).select(
        F.posexplode(names).alias("position", "day_of_week")
    )
    # At most seven rows on either side: the weekdays are filtered above.
    return (
        days.join(F.broadcast(counts), "day_of_week", "left")
        .fillna(0, subset=list(sources))
        .orderBy("position")
        .drop("position")
    )


def meeting_load_combined(
    meeting_load: DataFrame,
    live: DataFrame,
    today: date,
    by_start_week: bool = False,
    after_batch: date | None = None,
) -> DataFrame:
    """Batch meeting load, plus live meetings per host in the current week.

    Live meetings all count in the week of ``today``. ``by_start_week`` puts them in the
    week they start, and ``after_batch`` leaves out those booked up to that day.
    """
    hosted = live.where(F.col("host_email").isNotNull())
    if after_batch is not None:
        hosted = hosted.where(F.col("booking_date") > F.lit(after_batch))
    week = F.lit(monday_of(today))
    if by_start_week:
        week = F.trunc(F.to_date("start_time"), "week")
    live_load = hosted.groupBy("host_email", week.alias("week_start_date")).agg(
        F.count(F.lit(1)).alias("meeting_count")
    )
    return typed_days(meeting_load, "week_start_date", drop_bad=False).unionByName(live_load)


def host_averages(meeting_load: DataFrame) -> DataFrame:
    """Meetings per host over the weeks listed; a week listed twice counts as two."""
    return (
        meeting_load.where(F.col("host_email").isNotNull())
        .groupBy("host_email")
        .agg(
            F.sum("meeting_count").alias("total_meetings"),
            F.count("meeting_count").alias("weeks_active"),
        )
        .withColumn(
            "avg_meetings_per_week",
            F.try_divide(F.col("total_meetings"), F.col("weeks_active")),
        )
        .orderBy(F.desc_nulls_last("avg_meetings_per_week"), "host_email")
    )


def weekly_trend_all(meeting_load: DataFrame) -> DataFrame:
    return (
        meeting_load.where(F.col("week_start_date").isNotNull())
        .groupBy("week_start_date")
        .agg(F.sum("meeting_count").alias("meeting_count"))
        .orderBy("week_start_date")
    )


def host_weekly_trend(meeting_load: DataFrame, host: str) -> DataFrame:
    return meeting_load.where(F.col("host_email") == host).orderBy(
        F.asc_nulls_last("week_start_date"), "meeting_count"
    )


def _known_values(df: DataFrame, column: str) -> DataFrame:
    return df.select(column).where(F.col(column).isNotNull()).distinct()


def distinct_values(df: DataFrame, column: str) -> DataFrame:
    return _known_values(df, column).orderBy(column)


def date_bounds(daily: DataFrame, today: date) -> DataFrame:
    """First and last day to choose from: the last is never before ``today``."""
    return daily.agg(
        F.coalesce(F.min("booking_date"), F.lit(today)).alias("min_date"),
        F.greatest(F.max("booking_date"), F.lit(today)).alias("max_date"),
    )


def filter_domain(
    daily: DataFrame, cpb: DataFrame, meeting_load: DataFrame, today: date
) -> DataFrame:
    """What can be chosen, one row per choice, since there may be many sources and hosts."""
    days = date_bounds(daily, today).select(
        F.stack(
            F.lit(2),
            F.lit("min_date"),
            F.col("min_date").cast("string"),
            F.lit("max_date"),
            F.col("max_date").cast("string"),
        ).alias("field", "value")
    )
    choices = days
    for field, table, column in (
        ("source", daily, "utm_source"),
        ("channel", cpb, "channel"),
        ("host", meeting_load, "host_email"),
    ):
        values = _known_values(table, column)
        choices = choices.unionByName(
            values.select(F.lit(field).alias("field"), F.col(column).alias("value"))
        )
    return choices.orderBy("field", "value")


def batch_freshness(daily: DataFrame) -> DataFrame:
    """Last day the batch covers, as text, or N/A before the first batch."""
    last = F.max("booking_date").cast("string")
    return daily.agg(F.coalesce(last, F.lit("N/A")).alias("batch_through"))
