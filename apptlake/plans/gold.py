"""The gold aggregates over silver bookings and spend.

All count bookings by some columns, so one pass over silver counts them all, as grouping sets. All group on few, small values: Spark sums per map task before the shuffle, so a hot
source or host costs its reducer one row per map task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.functions.times import week_start, weekday_name
from apptlake.functions.values import money_sum, ratio_or_zero

# What bookings are counted by.
DAILY = ("booking_date", "utm_source")
WEEKLY = ("host_email", "week_start_date")
CHANNEL = ("channel",)
HOSTS = ("booking_date", "host_email")

# Size of a sketch of distinct hosts (log2 of its cells): within 0.6 % in two of three cases.
SKETCH_SIZE = 15


def booking_counts(silver: DataFrame, *sets: tuple[str, ...]) -> DataFrame:
    """Bookings counted by each of the sets of columns, in one pass: ``counted_by`` says by which
    (names joined by a comma), the columns of other sets are null. All sets by default."""
    sets = sets or (DAILY, WEEKLY, CHANNEL, HOSTS)
    names = list(dict.fromkeys(name for columns in sets for name in columns))
    places = {
        "booking_date": F.to_date("booking_date"),
        "week_start_date": week_start(F.col("start_time")),
    }
    rows = silver.select("booking_id", *[places.get(name, F.col(name)).alias(name) for name in names])
    count = F.count("booking_id").alias("booking_count")
    if len(sets) == 1:
        return rows.groupBy(*names).agg(count).withColumn("counted_by", F.lit(",".join(names)))
    counts = rows.groupingSets([[F.col(c) for c in columns] for columns in sets], *names).agg(
        count, F.grouping_id().alias("_set")
    )
    # A set's number has a bit for each column that is not in it.
    label = F.coalesce(
        *[
            F.when(F.col("_set") == int("".join("01"[name not in columns] for name in names), 2), ",".join(columns))
            for columns in sets
        ]
    )
    return counts.withColumn("counted_by", label).drop("_set")


def _counted_by(counts: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    return counts.where(F.col("counted_by") == ",".join(columns)).select(*columns, "booking_count")


def daily_of(counts: DataFrame) -> DataFrame:
    """Bookings per day and source; bookings without a source are a group of their own."""
    return _counted_by(counts, DAILY)


def bookings_by_source_daily(silver: DataFrame) -> DataFrame:
    return daily_of(booking_counts(silver, DAILY))


def booking_time_distribution(daily: DataFrame) -> DataFrame:
    """The daily table with the weekday's name.

    A day has one weekday, so naming it after the aggregation gives the same groups and
    saves a second pass over the bookings.
    """
    return daily.select(
        weekday_name(F.col("booking_date")).alias("day_of_week"),
        "booking_date",
        "utm_source",
        "booking_count",
    )


def cost_of(counts: DataFrame, spends: DataFrame) -> DataFrame:
    """Bookings, spend and cost per booking of each channel that has bookings.

    Both sides are one row per channel before they meet; a channel without spend cost nothing.
    """
    booked = _counted_by(counts, CHANNEL).withColumnRenamed("booking_count", "total_bookings")
    spent = spends.groupBy("channel").agg(money_sum(F.col("spend")).alias("_spent"))
    total = F.coalesce("_spent", F.lit(0.0))
    return booked.join(spent, "channel", "left").select(
        "channel",
        "total_bookings",
        total.alias("total_spend"),
        ratio_or_zero(total, F.col("total_bookings")).alias("cost_per_booking"),
    )


def cpb_by_channel(silver: DataFrame, spends: DataFrame) -> DataFrame:
    return cost_of(booking_counts(silver, CHANNEL), spends)


def load_of(counts: DataFrame) -> DataFrame:
    """Meetings per known host and week, by when the meeting takes place."""
    hosted = _counted_by(counts, WEEKLY).where(F.col("host_email").isNotNull())
    return hosted.withColumnRenamed("booking_count", "meeting_count")


def employee_meeting_load(silver: DataFrame) -> DataFrame:
    return load_of(booking_counts(silver, WEEKLY))


def hosts_of(counts: DataFrame) -> DataFrame:
    """Hosts with bookings per day as a sketch, from which the distinct hosts of any days follow."""
    hosted = _counted_by(counts, HOSTS).where(F.col("host_email").isNotNull())
    sketch = F.hll_sketch_agg("host_email", F.lit(SKETCH_SIZE)).alias("hosts")
    return hosted.groupBy("booking_date").agg(sketch)


def active_hosts_daily(silver: DataFrame) -> DataFrame:
    return hosts_of(booking_counts(silver, HOSTS))
