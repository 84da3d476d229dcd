"""Bronze to silver: keep identified rows, one per key, of paid channels."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE, channel_of, is_paid
from apptlake.functions.times import spend_day
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.operators.flatten import CREATED
from apptlake.schemas import SILVER_COLUMNS

# The latest event of a booking: by its own time, then by arrival. When a run happened to read it
# comes last, so that silver does not depend on how events fall into runs.
BOOKING_ORDER = ("booking_date", "sequence", "_source_file", "_ingested_at")


def latest_events(
    bronze: DataFrame,
    rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    order_by: Sequence[str] = BOOKING_ORDER,
    created_only: bool = False,
) -> DataFrame:
    """The latest event of each booking, of any channel, with the columns that order events.

    The channel is worked out before the shuffle, which then carries it in place of the longer
    event type. Event kinds are not looked at unless ``created_only`` is set (the frame then
    needs an ``event`` column).
    """
    identified = bronze.where(F.col("invitee_email").isNotNull() & F.col("booking_id").isNotNull())
    if created_only:
        identified = identified.where(F.col("event") == CREATED)
    carried = [name for name in SILVER_COLUMNS if name != "channel"]
    carried += [name for name in order_by if name not in carried]
    channel = channel_of(F.col("event_type"), rules)
    classified = identified.select(*carried, channel.alias("channel"))
    return latest_per_key(classified, ["booking_id"], newest(*order_by))


def clean_bookings(
    bronze: DataFrame,
    rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    order_by: Sequence[str] = BOOKING_ORDER,
    created_only: bool = False,
) -> DataFrame:
    """Silver bookings: the latest event of each booking, if that event is of a paid channel.

    The channel filter stays after the choice of the latest event, since a later event may
    move a booking to another channel.
    """
    latest = latest_events(bronze, rules, order_by, created_only)
    return latest.where(is_paid(F.col("channel"), rules)).select(*SILVER_COLUMNS)


def clean_spend(spend: DataFrame, order_by: Sequence[Column] | None = None) -> DataFrame:
    """Silver spend: one row per channel and written day, the day typed.

    Unless an order is given, the larger amount of a repeated (channel, day) is kept.
    """
    known = spend.where(F.col("channel").isNotNull() & F.col("spend").isNotNull())
    single = latest_per_key(known, ["channel", "date"], order_by or newest("spend"))
    return single.select("channel", spend_day(F.col("date")).alias("date"), "spend")
