"""Hand-made webhook documents and small frames."""

from __future__ import annotations

import json
from datetime import date, datetime

from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE

FACEBOOK, YOUTUBE, TIKTOK = (f"https://api.example.com/{path}" for path in CHANNEL_BY_EVENT_TYPE)

BRONZE_SHORT = (
    "booking_id string, booking_date timestamp, invitee_email string, event_type string,"
    " start_time timestamp, end_time timestamp, host_email string, host_name string,"
    " utm_source string, event string, _ingested_at timestamp, _source_file string,"
    " sequence bigint"
)


def document(uri="https://api.example.com/inv/a1", **changes):
    """A complete document; keyword arguments replace parts of it."""
    payload = {
        "uri": uri,
        "email": "guest@example.com",
        "first_name": "Ada",
        "last_name": "Byron",
        "status": "active",
        "timezone": "UTC",
        "rescheduled": False,
        "scheduled_event": {
            "event_type": changes.get("event_type", FACEBOOK),
            "uri": "https://api.example.com/events/e1",
            "name": "Intro",
            "start_time": changes.get("start_time", "2026-03-02T10:00:00.000000Z"),
            "end_time": "2026-03-02T10:30:00.000000Z",
            "status": "active",
            "event_memberships": changes.get(
                "memberships", [{"user_email": "host@example.com", "user_name": "Host"}]
            ),
        },
        "tracking": changes.get("tracking", {"utm_source": "news", "utm_medium": "mail"}),
        "questions_and_answers": [{"question": "Why?", "answer": "Because", "position": 0}],
    }
    payload.update(changes.get("payload", {}))
    return {
        "event": changes.get("event", "invitee.created"),
        "created_at": changes.get("created_at", "2026-03-01T09:00:00.000000Z"),
        "payload": payload,
    }


def records(spark, bodies):
    """Documents or raw text as records, numbered in order."""
    rows = [
        (None, body if isinstance(body, str) or body is None else json.dumps(body), number)
        for number, body in enumerate(bodies)
    ]
    return spark.createDataFrame(rows, "key string, value string, sequence bigint")


def bronze(spark, rows):
    """Short bronze rows from dictionaries, defaults filled in."""
    default = {
        "booking_id": "a",
        "booking_date": datetime(2026, 3, 1, 9),
        "invitee_email": "guest@example.com",
        "event_type": FACEBOOK,
        "start_time": datetime(2026, 3, 2, 10),
        "end_time": datetime(2026, 3, 2, 10, 30),
        "host_email": "host@example.com",
        "host_name": "Host",
        "utm_source": "news",
        "event": "invitee.created",
        "_ingested_at": datetime(2026, 3, 1, 12),
        "_source_file": "f",
        "sequence": None,
    }
    return spark.createDataFrame([tuple({**default, **row}.values()) for row in rows], BRONZE_SHORT)


def daily(spark, rows):
    return spark.createDataFrame(rows, "booking_date date, utm_source string, booking_count bigint")


def live(spark, rows):
    """Live serving rows from dictionaries."""
    default = {
        "booking_id": "a",
        "booking_date": date(2026, 3, 2),
        "channel": "facebook_paid_ads",
        "utm_source": "news",
        "host_email": "host@example.com",
        "host_name": "Host",
        "start_time": datetime(2026, 3, 2, 10),
        "end_time": datetime(2026, 3, 2, 10, 30),
    }
    return spark.createDataFrame(
        [tuple({**default, **row}.values()) for row in rows],
        "booking_id string, booking_date date, channel string, utm_source string,"
        " host_email string, host_name string, start_time timestamp, end_time timestamp",
    )


def values(df, *columns):
    """Rows as sorted tuples."""
    rows = [tuple(row) for row in (df.select(*columns) if columns else df).collect()]
    return sorted(rows, key=str)
