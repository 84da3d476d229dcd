"""Marketing channel of a booking, from the event type it was booked under."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# Event-type path looked for in the event type's URI, and the channel it stands for.
CHANNEL_BY_EVENT_TYPE = {
    "event_types/d639ecd3-8718-4068-955a-436b10d72c78": "facebook_paid_ads",
    "event_types/dbb4ec50-38cd-4bcd-bbff-efb7b5a6f098": "youtube_paid_ads",
    "event_types/bb339e98-7a67-4af2-b584-8dbf95564312": "tiktok_paid_ads",
}
OTHER_CHANNEL = "other_event"


def channel_of(event_type: Column, rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE) -> Column:
    """First rule whose text occurs in the event type; no rule, or no event type, is "other"."""
    hits = [F.when(event_type.contains(text), F.lit(channel)) for text, channel in rules.items()]
    return F.coalesce(*hits, F.lit(OTHER_CHANNEL))


def is_paid(channel: Column, rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE) -> Column:
    """A channel that some rule stands for."""
    return channel.isin(*dict.fromkeys(rules.values()))
