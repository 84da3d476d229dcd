"""The given ``events`` and ``orders`` tables as bookings, spend and webhook records.

``events`` stand for webhook events and ``orders`` for spend, by the rules of FIXTURES.md.
Views of one side, batch or live, take every row; where both sides meet, a cutoff day parts them.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from apptlake.functions.channels import channel_of, is_paid
from apptlake.operators.clean import clean_bookings, clean_spend
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.operators.filters import Selection
from apptlake.operators.flatten import CREATED
from apptlake.operators.keyed import BUCKET, NUMBER, in_buckets
from apptlake.plans import gold
from apptlake.plans.serving import labelled, meeting_load_combined
from apptlake.session import pin_utc, scratch_path
from apptlake.sources.tables import stored
from apptlake.streaming.live import live_snapshot

# Declared, so that no job has to read footers before the query starts.
EVENTS = """
    event_id bigint,
    ts timestamp_ntz,
    user_id bigint,
    event_type string,
    value double,
    props string
"""
ORDERS = """
    o_orderkey bigint,
    o_custkey bigint,
    o_orderstatus string,
    o_totalprice double,
    o_orderdate timestamp_ntz,
    o_orderpriority string
"""

RULES = {
    "click": "facebook_paid_ads",
    "signup": "youtube_paid_ads",
    "purchase": "tiktok_paid_ads",
}
ORDER = ("booking_date", "event_id")

CUTOFF = date(2024, 1, 24)
TODAY = date(2024, 1, 31)
RANGES = [(date(2024, 1, 1), date(2024, 1, 7)), (date(2024, 1, 5), date(2024, 1, 20)), (date(2024, 1, 1), TODAY)]
# Parts of the keyed tables and of each day of the live table, and pulls that the waiting files make.
BUCKETS, LIVE_BUCKETS, PULLS = 4, 4, 4
# Records of a waiting file, of which a pull has as many as its share of the records needs.
RECORDS_WAITING = 250_000
SOURCES = ["(no utm_source)", "src0", "src1", "src2", "src3", "src4"]
CHANNELS = ["facebook_paid_ads", "tiktok_paid_ads", "youtube_paid_ads"]
CHOSEN = Selection(date(2024, 1, 1), date(2024, 1, 31), SOURCES, CHANNELS)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pin_utc(spark).read.schema(ORDERS).parquet(f"{sf_dir}/orders.parquet")


# Columns of a booking event, by the rules of FIXTURES.md; ``k`` is the number in ``props``.
# The number is taken out in a step of its own, so that the JSON is read once per row.
WITH_NUMBER = ("*", "cast(get_json_object(props, '$.k') AS int) AS k")
BOOKING = {
    "booking_id": "concat('inv/', event_id - CASE WHEN event_id % 10 = 9 THEN 1 ELSE 0 END)",
    "booking_date": "cast(ts AS timestamp)",
    "invitee_email": "concat('user', user_id, '@example.com')",
    "start_time": "cast(ts AS timestamp) + make_interval(0, 0, 0, 0, k)",
    "end_time": "cast(ts AS timestamp) + make_interval(0, 0, 0, 0, k, 30)",
    "host_email": "CASE WHEN user_id % 20 <> 0"
    " THEN concat('host', user_id % 20, '@example.com') END",
    "host_name": "CASE WHEN user_id % 20 <> 0 THEN concat('Host ', user_id % 20) END",
    "utm_source": "CASE WHEN k >= 10 THEN concat('src', k % 5) END",
    "event": f"CASE WHEN event_id % 7 = 0 THEN 'invitee.canceled' ELSE '{CREATED}' END",
}


def bronze(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flat, typed booking events, ``event_id`` giving the order of arrival."""
    columns = [f"{rule} AS {name}" for name, rule in BOOKING.items()]
    numbered = events(spark, sf_dir).selectExpr(*WITH_NUMBER)
    return numbered.selectExpr("event_type", "event_id", *columns)


def silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_bookings(bronze(spark, sf_dir), RULES, ORDER)


# Rows of a folder that are numbered in one task, and records of a file.
ROWS_PER_SLICE, RECORDS_PER_FILE = 1_000_000, 1_000


def in_files(rows: DataFrame, place: str, key: str, records: int = RECORDS_PER_FILE) -> DataFrame:
    """Deal the rows of each ``place`` to files of so many records, all full but the last of a slice.

    ``slice`` and ``part`` name the file. Files follow from the number of rows, whatever their keys
    are, and a place with many rows is numbered in slices, so that no task has it whole.
    """
    slices = -(-rows.count() // ROWS_PER_SLICE) or 1
    sliced = rows.withColumn("slice", F.pmod(F.xxhash64(key), F.lit(slices)))
    nth = F.row_number().over(Window.partitionBy(place, "slice").orderBy(key))
    return sliced.withColumn("part", F.floor((nth - 1) / records))


def raw_spend(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spend records; some priorities have no channel."""
    channel = """CASE o_orderpriority
        WHEN '1-URGENT' THEN 'facebook_paid_ads'
        WHEN '2-HIGH' THEN 'youtube_paid_ads'
        WHEN '4-NOT SPECIFIED' THEN 'linkedin_paid_ads' END AS channel"""
    return orders(spark, sf_dir).selectExpr(
        channel,
        "date_format(o_orderdate, 'yyyy-MM-dd') AS date",
        "o_totalprice AS spend",
        "o_orderkey",
        "o_orderstatus",
    )


def spends(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean_spend(raw_spend(spark, sf_dir), newest("o_orderkey"))


def batch_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the batch has seen: events up to and including the cutoff day."""
    seen = bronze(spark, sf_dir).where(F.to_date("booking_date") <= F.lit(CUTOFF))
    return clean_bookings(seen, RULES, ORDER)


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Live bookings: created events of paid channels from the cutoff day on."""
    return _live_of(bronze(spark, sf_dir).where(F.to_date("booking_date") >= F.lit(CUTOFF)))


def all_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same from all events, for views of the live side alone."""
    return _live_of(bronze(spark, sf_dir))


def _live_of(rows: DataFrame) -> DataFrame:
    created = rows.where(F.col("event") == CREATED).withColumn(
        "channel", channel_of(F.col("event_type"), RULES)
    )
    paid = created.where(is_paid(F.col("channel"), RULES))
    return latest_per_key(paid, ["booking_id"], newest(*ORDER)).select(
        "booking_id",
        F.to_date("booking_date").alias("booking_date"),
        "channel",
        "utm_source",
        "host_email",
        "host_name",
        "start_time",
        "end_time",
    )


def stored_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch's bookings as a table, for views that draw on several gold tables."""
    return stored(batch_silver(spark, sf_dir), scratch_path(spark, "silver"))


def stored_live(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live bookings as a table, for views that look at them more than once."""
    return stored(live(spark, sf_dir), scratch_path(spark, "live"))


def live_by_folder(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The live bookings from a table of the live layer's layout, a folder for each day."""
    folder = scratch_path(spark, "live-table")
    text = {name: F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS") for name in ("start_time", "end_time")}
    day = F.col("booking_date").cast("string")
    rows = live(spark, sf_dir).withColumns(text | {"booking_date": day, "day": day})
    placed = in_buckets(rows, ["booking_id"], 1).repartition("day")
    placed.write.partitionBy(NUMBER, "day", BUCKET).mode("overwrite").parquet(folder)
    return live_snapshot(spark, folder)


def stored_daily(spark: SparkSession, silver_rows: DataFrame) -> DataFrame:
    return stored(daily(silver_rows), scratch_path(spark, "daily"))


def daily(silver_rows: DataFrame) -> DataFrame:
    """The batch's daily table, labelled for serving."""
    return labelled(gold.bookings_by_source_daily(silver_rows))


def distribution(silver_rows: DataFrame) -> DataFrame:
    days = gold.bookings_by_source_daily(silver_rows)
    return labelled(gold.booking_time_distribution(days))


def cpb(spark: SparkSession, sf_dir: str, silver_rows: DataFrame) -> DataFrame:
    return gold.cpb_by_channel(silver_rows, spends(spark, sf_dir))


def meeting_load(
    spark: SparkSession, sf_dir: str, silver_rows: DataFrame, live_rows: DataFrame | None = None
) -> DataFrame:
    rows = live(spark, sf_dir) if live_rows is None else live_rows
    return meeting_load_combined(gold.employee_meeting_load(silver_rows), rows, TODAY)


def records(spark: SparkSession, sf_dir: str) -> DataFrame:
    return as_records(events(spark, sf_dir))


def waiting_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records by ranges of arrival, a file to each. Rows are dealt before documents are made
    of them, so that neither the search for the ranges nor the shuffle handles these."""
    rows = events(spark, sf_dir)
    files = PULLS * (-(-rows.count() // (PULLS * RECORDS_WAITING)) or 1)
    return as_records(rows.repartitionByRange(files, "event_id"))


def record_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same records, arriving file by file."""
    return as_records(pin_utc(spark).readStream.schema(EVENTS).parquet(f"{sf_dir}/events*.parquet"))


def _iso(time: str) -> str:
    return f"concat(replace(cast({time} AS string), ' ', 'T'), 'Z')"


# Further texts of a document, and when some are missing.
TEXTS = {
    "invitee_first_name": "concat('First ', user_id % 100)",
    "invitee_last_name": "CASE WHEN user_id % 3 <> 0 THEN concat('Last ', user_id % 7) END",
    "invitee_status": "CASE WHEN event_id % 7 = 0 THEN 'canceled' ELSE 'active' END",
    "invitee_timezone": "CASE WHEN user_id % 2 = 0 THEN 'Europe/Paris' ELSE 'UTC' END",
    "event_uri": "concat('ev/', event_id)",
    "event_name": "concat('Meeting ', user_id % 20)",
    "event_status": "CASE WHEN event_id % 7 = 0 THEN 'canceled' ELSE 'active' END",
    "utm_medium": "CASE WHEN k % 3 <> 0 THEN concat('medium', k % 3) END",
    "utm_campaign": "CASE WHEN k % 4 <> 0 THEN concat('campaign', k % 4) END",
    "utm_content": "CASE WHEN k % 2 <> 0 THEN 'odd' END",
    "utm_term": "CASE WHEN k % 5 <> 0 THEN concat('term', k) END",
}

# A booking event as the JSON document a webhook sends.
DOCUMENT = f"""to_json(struct(
    {BOOKING["event"]} AS event,
    {_iso("ts")} AS created_at,
    struct(
        {BOOKING["booking_id"]} AS uri,
        {BOOKING["invitee_email"]} AS email,
        {TEXTS["invitee_first_name"]} AS first_name,
        {TEXTS["invitee_last_name"]} AS last_name,
        {TEXTS["invitee_status"]} AS status,
        {TEXTS["invitee_timezone"]} AS timezone,
        CASE WHEN value >= 50 THEN 'true' WHEN value >= 10 THEN 'false' END AS rescheduled,
        struct(
            concat('https://booking.example/event_types/', event_type) AS event_type,
            {TEXTS["event_uri"]} AS uri,
            {TEXTS["event_name"]} AS name,
            {TEXTS["event_status"]} AS status,
            {_iso(BOOKING["start_time"])} AS start_time,
            {_iso(BOOKING["end_time"])} AS end_time,
            filter(
                array(struct(
                    {BOOKING["host_email"]} AS user_email,
                    {BOOKING["host_name"]} AS user_name)),
                host -> host.user_email IS NOT NULL) AS event_memberships) AS scheduled_event,
        struct(
            {BOOKING["utm_source"]} AS utm_source,
            {TEXTS["utm_medium"]} AS utm_medium,
            {TEXTS["utm_campaign"]} AS utm_campaign,
            {TEXTS["utm_content"]} AS utm_content,
            {TEXTS["utm_term"]} AS utm_term) AS tracking,
        array(struct(
            'amount' AS question,
            cast(value AS string) AS answer,
            0 AS position)) AS questions_and_answers) AS payload)) AS value"""


# Bodies as they come when senders fail: cut off in the middle.
CUT_OFF = "CASE WHEN event_type = 'error' THEN substring(value, 1, 20) ELSE value END AS value"


def rough_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The records with the bodies of error events cut off."""
    rows = events(spark, sf_dir).selectExpr(*WITH_NUMBER)
    bodies = rows.selectExpr(f"{BOOKING['booking_id']} AS key", DOCUMENT, "event_id", "event_type")
    return bodies.selectExpr("key", CUT_OFF, "event_id AS sequence")


def as_records(rows: DataFrame) -> DataFrame:
    """Events as webhook records: key, JSON body and arrival number."""
    return rows.selectExpr(*WITH_NUMBER).selectExpr(
        f"{BOOKING['booking_id']} AS key", DOCUMENT, "event_id AS sequence"
    )
