"""The live layer: records as they arrive, kept as one item per booking."""

from __future__ import annotations

from collections.abc import Mapping
from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE
from apptlake.functions.times import instant, written_day
from apptlake.operators.conform import conform
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.operators.flatten import live_rows, parse_documents
from apptlake.operators.keyed import BUCKET, NUMBER, append_new, upsert_within
from apptlake.schemas import LIVE_ITEMS, LIVE_SERVING, LIVE_WEBHOOK
from apptlake.session import ROCKSDB
from apptlake.sources.tables import load_declared
from apptlake.streaming.progress import observed, started

# Fixed value: seconds between two pulls of the live stream.
PULL_SECONDS = 120

LIVE_KEY = ["booking_id"]
# What orders the items of a booking, for every reader of the table.
LIVE_ORDER = ("sequence", "ingested_at")
LIVE_TABLE = f"{LIVE_ITEMS}, sequence bigint"
# Parts of a day that are rewritten by themselves, for a new table.
LIVE_BUCKETS = 8
NO_DAY = "unknown"


def live_items(
    records: DataFrame, rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE
) -> DataFrame:
    """Records to live items, on a static or streaming frame; unreadable bodies give none,
    as they have no event kind."""
    parsed = parse_documents(records.select("value", "sequence"), LIVE_WEBHOOK)
    return live_rows(parsed, rules, keep=("sequence",))


def last_items(items: DataFrame) -> DataFrame:
    """The last item of each booking, and the ``days`` that its items were booked on.

    On a stream this is its state: the item that later ones are held against, and the days below
    which the booking may lie in the table. Each task sums up its own items first, so a booking with
    much of the traffic costs its state partition one row a task.
    """
    others = [F.col(name) for name in items.columns if name not in (*LIVE_ORDER, *LIVE_KEY)]
    last = F.max(F.struct(*LIVE_ORDER, *others)).alias("_last")
    days = F.collect_set(_day(F.col("booking_date"))).alias("days")
    keyed = items.where(F.col("booking_id").isNotNull()).groupBy(*LIVE_KEY).agg(last, days)
    return keyed.select(*[F.col("_last")[c].alias(c) if c not in LIVE_KEY else c for c in items.columns], "days")


def _day(booking_date: Column) -> Column:
    """The folder of an item; items without a readable day have one too."""
    return F.coalesce(booking_date, F.lit(NO_DAY))


def start_live(
    records: DataFrame,
    table: str,
    checkpoint: str,
    rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    pull_seconds: int | None = PULL_SECONDS,
    buckets: int = LIVE_BUCKETS,
) -> StreamingQuery:
    """Keep the live table up to date; ``pull_seconds=None`` takes what is there and stops.

    The stream keeps the last item of each booking as state, on disk (RocksDB). What a micro-batch
    changed is upserted into the table, one row per booking below the day it was booked, of which
    only the days and buckets that changed are rewritten. A batch that runs twice ends where it
    ended before; a restart goes on from the checkpoint. Items without an id cannot be kept by booking
    and are left out.
    """
    spark = records.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    items, counts = observed(live_items(records, rules), live=F.count(F.lit(1)))
    order = newest(*LIVE_ORDER)

    def write(batch: DataFrame, _: int) -> None:
        placed = batch.withColumn("day", _day(F.col("booking_date")))
        upsert_within(placed, table, LIVE_KEY, "day", "days", order, buckets)

    writer = (
        last_items(items)
        .writeStream.queryName(counts)
        .outputMode("update")
        .foreachBatch(write)
        .option("checkpointLocation", checkpoint)
    )
    return started(writer, pull_seconds)


def latest_items(items: DataFrame) -> DataFrame:
    """The last item of each booking, of a static frame. Items without an id are left out."""
    return latest_per_key(items.where(F.col("booking_id").isNotNull()), LIVE_KEY, newest(*LIVE_ORDER))


def _stored_items(spark: SparkSession, table: str) -> DataFrame:
    """The table's rows, with ``day``. Rows without an id only hold the place of a folder."""
    items = load_declared(spark, table, f"{LIVE_TABLE}, {NUMBER} int, day string, {BUCKET} int")
    return items.where(F.col("booking_id").isNotNull()).drop(NUMBER, BUCKET)


def live_table(spark: SparkSession, table: str, since: date | None = None) -> DataFrame:
    """Live items, one per booking as stored; empty if missing. ``since`` reads no items booked
    before."""
    items = _stored_items(spark, table)
    if since is not None:
        items = items.where(F.col("day") >= F.lit(since.isoformat()))
    return items.drop("day")


def live_snapshot(spark: SparkSession, table: str, since: date | None = None) -> DataFrame:
    """The live table as the serving views want it, with its times typed; empty if missing.

    The booking day is taken from the folder, so a filter on it, also by a value that another query
    finds, leaves folders of other days unread.
    """
    items = _stored_items(spark, table)
    if since is not None:
        items = items.where(F.col("day") >= F.lit(since.isoformat()))
    return typed_live(items.withColumn("booking_date", F.col("day")))


def typed_live(items: DataFrame) -> DataFrame:
    typed = items.withColumns(
        {
            "booking_date": written_day(F.col("booking_date")),
            "start_time": instant(F.col("start_time")),
            "end_time": instant(F.col("end_time")),
        }
    )
    return conform(typed, LIVE_SERVING)


def start_dedup_append(
    items: DataFrame, path: str, checkpoint: str, pull_seconds: int | None = None, buckets: int = LIVE_BUCKETS
) -> StreamingQuery:
    """Append-only variant: items are added as they come, and replays are not.

    A micro-batch keeps the last item of each booking and meets what is stored: an item is appended
    unless one of its booking as new or newer is there. The stream has no state to outgrow and no
    watermark that drops late items, so an item counts however late it comes. The last item of a
    booking is what ``appended`` reads.
    """

    def write(batch: DataFrame, _: int) -> None:
        content = [name for name in batch.columns if name not in LIVE_ORDER]
        known = F.coalesce("booking_id", F.concat(F.lit("no id/"), F.xxhash64(*content)))
        single = latest_per_key(batch, [known], newest(*LIVE_ORDER))
        append_new(single, path, LIVE_KEY, ["sequence"], buckets)

    writer = items.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return started(writer, pull_seconds)


def appended(spark: SparkSession, path: str) -> DataFrame:
    """The last item of each booking of an append-only table, and all items without an id."""
    items = load_declared(spark, path, f"{LIVE_TABLE}, _known string")
    return latest_per_key(items, ["_known"], newest(*LIVE_ORDER)).drop("_known")
