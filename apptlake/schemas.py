"""Declared schemas, as DDL text, of every input and table."""

from __future__ import annotations

# Field names of the webhook document, the spend file and the tables.
WEBHOOK = """
    event string,
    created_at string,
    payload struct<
        uri: string,
        email: string,
        first_name: string,
        last_name: string,
        status: string,
        timezone: string,
        rescheduled: string,
        scheduled_event: struct<
            event_type: string,
            uri: string,
            name: string,
            start_time: string,
            end_time: string,
            status: string,
            event_memberships: array<struct<user_email: string, user_name: string>>>,
        tracking: struct<
            utm_source: string,
            utm_medium: string,
            utm_campaign: string,
            utm_content: string,
            utm_term: string>,
        questions_and_answers: array<struct<question: string, answer: string, position: int>>>
"""

# The part of the document the live layer uses; the parser skips the rest.
LIVE_WEBHOOK = """
    event string,
    created_at string,
    payload struct<
        uri: string,
        scheduled_event: struct<
            event_type: string,
            start_time: string,
            end_time: string,
            event_memberships: array<struct<user_email: string, user_name: string>>>,
        tracking: struct<utm_source: string>>
"""

SPEND = "channel string, date string, spend double"

BRONZE = """
    booking_date timestamp,
    booking_id string,
    invitee_email string,
    invitee_first_name string,
    invitee_last_name string,
    invitee_status string,
    invitee_timezone string,
    event_type string,
    event_uri string,
    event_name string,
    start_time timestamp,
    end_time timestamp,
    event_status string,
    host_email string,
    host_name string,
    utm_source string,
    utm_medium string,
    utm_campaign string,
    utm_content string,
    utm_term string,
    was_rescheduled boolean,
    questions_and_answers array<struct<question: string, answer: string, position: int>>,
    sequence bigint,
    _ingested_at timestamp,
    _source_file string,
    ingest_date date
"""

# The bronze columns that come from the document itself, in order.
FLAT_COLUMNS = tuple(line.split()[0] for line in BRONZE.strip().splitlines()[:-4])

# Bronze as stored: bodies that gave no payload are kept beside the readable ones, and what a
# document has beyond the declared fields as one VARIANT.
BRONZE_STORED = f"{BRONZE}, _corrupt_record string, readable boolean, extra variant"

SILVER_BOOKINGS = """
    booking_id string,
    booking_date timestamp,
    channel string,
    start_time timestamp,
    end_time timestamp,
    host_email string,
    host_name string,
    utm_source string
"""

SILVER_COLUMNS = tuple(line.split()[0] for line in SILVER_BOOKINGS.strip().splitlines())

# Change rows of the bookings: of any channel, with what orders the events of a booking.
BOOKING_CHANGES = f"{SILVER_BOOKINGS}, sequence bigint, _source_file string, _ingested_at timestamp"

SILVER_SPENDS = "channel string, date date, spend double"

GOLD_BOOKINGS_BY_SOURCE_DAILY = "booking_date date, utm_source string, booking_count bigint"

GOLD_BOOKING_TIME_DISTRIBUTION = (
    "day_of_week string, booking_date date, utm_source string, booking_count bigint"
)

GOLD_CPB_BY_CHANNEL = (
    "channel string, total_bookings bigint, total_spend double, cost_per_booking double"
)

# Distinct hosts per day as mergeable sketches.
GOLD_ACTIVE_HOSTS_DAILY = "booking_date date, hosts binary"

GOLD_EMPLOYEE_MEETING_LOAD = "host_email string, week_start_date date, meeting_count bigint"

# The live table keeps times as ISO text; the serving form below types them.
LIVE_ITEMS = """
    booking_id string,
    booking_date string,
    event_type string,
    start_time string,
    end_time string,
    host_email string,
    host_name string,
    utm_source string,
    channel string,
    ingested_at string
"""

LIVE_SERVING = """
    booking_id string,
    booking_date date,
    channel string,
    utm_source string,
    host_email string,
    host_name string,
    start_time timestamp,
    end_time timestamp
"""

# Raw landing: the body as received, with the fields that place and order it.
LANDING = "value string, key string, invitee_id string, sequence bigint, date string"
