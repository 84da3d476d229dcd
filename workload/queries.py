"""Registered queries: each runs library operators over the whole given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake import schemas
from apptlake.functions.channels import channel_of, is_paid
from apptlake.functions.times import instant, written_day
from apptlake.functions.values import first_member
from apptlake.operators import clean
from apptlake.operators.conform import conform
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.operators.filters import only_values, typed_days
from apptlake.operators.flatten import (
    MEMBERSHIPS,
    bronze_rows,
    item_documents,
    live_rows,
    parse_documents,
)
from apptlake.operators.keyed import current, upsert, upsert_within
from apptlake.plans import gold, serving
from apptlake.plans.batch import GOLD
from apptlake.session import scratch_path
from apptlake.sources import files, landing
from apptlake.sources.documents import read_documents, read_spend_files
from apptlake.sources.records import file_records
from apptlake.sources.tables import load_declared, publish, published, stored
from apptlake.streaming import live as live_layer
from apptlake.streaming.ingest import start_bronze, start_tee
from apptlake.streaming.live import appended, last_items, live_items, start_dedup_append, start_live
from workload import frames

Query = Callable[[SparkSession, str], DataFrame]
REGISTERED: dict[str, Query] = {}


def query(run: Query) -> Query:
    REGISTERED[run.__name__] = run
    return run


def plain_times(df: DataFrame) -> DataFrame:
    """Timestamps without a zone, for comparison; the session zone is UTC."""
    zoned = [field.name for field in df.schema if field.dataType.typeName() == "timestamp"]
    return df.withColumns({name: F.col(name).cast("timestamp_ntz") for name in zoned})


def _as_text(df: DataFrame, day: str) -> DataFrame:
    """A day as ISO text where timestamps stand beside it, for comparison."""
    return plain_times(df).withColumn(day, F.col(day).cast("string"))


# ---- silver ----


@query
def silver_bookings(spark, sf_dir):
    return plain_times(frames.silver(spark, sf_dir))


@query
def clean_spend(spark, sf_dir):
    return frames.spends(spark, sf_dir)


@query
def dedup_bookings(spark, sf_dir):
    rows = latest_per_key(frames.bronze(spark, sf_dir), ["booking_id"], newest(*frames.ORDER))
    return rows.select("booking_id", "event_id", "event_type", "event")


@query
def classify_channel(spark, sf_dir):
    """By a caller's rules, which may know channels of their own."""
    rules = frames.RULES | {"view": "podcast_ads"}
    channel = channel_of(F.col("event_type"), rules)
    rows = frames.events(spark, sf_dir).select("event_id", channel.alias("channel"))
    return rows.withColumn("paid", is_paid(F.col("channel"), rules))


# ---- gold ----


def _published(spark, table: DataFrame, name: str) -> DataFrame:
    """The table as readers get it, once written."""
    folder = scratch_path(spark, "gold")
    publish(table, folder)
    return published(spark, folder, GOLD[name])


@query
def gold_bookings_by_source_daily(spark, sf_dir):
    daily = gold.bookings_by_source_daily(frames.silver(spark, sf_dir))
    return _published(spark, daily, "bookings_by_source_daily")


@query
def gold_booking_time_distribution(spark, sf_dir):
    daily = gold.bookings_by_source_daily(frames.silver(spark, sf_dir))
    return _published(spark, gold.booking_time_distribution(daily), "booking_time_distribution")


@query
def gold_cpb_by_channel(spark, sf_dir):
    cost = gold.cpb_by_channel(frames.silver(spark, sf_dir), frames.spends(spark, sf_dir))
    return _rounded(_published(spark, cost, "cpb_by_channel"), "cost_per_booking")


@query
def gold_employee_meeting_load(spark, sf_dir):
    load = gold.employee_meeting_load(frames.silver(spark, sf_dir))
    return _published(spark, load, "employee_meeting_load")


@query
def active_hosts_in_ranges(spark, sf_dir):
    """Distinct bookers' hosts over three ranges of days, from one sketch a day."""
    silver = frames.silver(spark, sf_dir).withColumn("host_email", F.coalesce("host_email", "booking_id"))
    hosts = _published(spark, gold.active_hosts_daily(silver), "active_hosts_daily")
    exact = silver.select(F.to_date("booking_date").alias("booking_date"), "host_email").distinct()
    exact = stored(exact, scratch_path(spark, "hosts"))
    rows = None
    for start, end in frames.RANGES:
        days = F.col("booking_date").between(F.lit(start), F.lit(end))
        counted = exact.where(days).agg(F.count_distinct("host_email").alias("hosts"))
        about = serving.active_hosts(hosts, start, end).select("active_hosts")
        near = F.abs(F.col("hosts") - about.scalar()) <= 0.02 * F.col("hosts")
        row = counted.select(F.lit(start.isoformat()).alias("start"), "hosts", near.alias("near"))
        rows = row if rows is None else rows.unionByName(row)
    return rows


# ---- serving ----


def _rounded(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, F.round(column, 6))


def _in_selection(df: DataFrame) -> DataFrame:
    return serving.in_selection(df, frames.CHOSEN)


def _batch_cpb(spark, sf_dir):
    return frames.cpb(spark, sf_dir, frames.silver(spark, sf_dir))


def _batch_distribution(spark, sf_dir):
    return _in_selection(frames.distribution(frames.silver(spark, sf_dir)))


def _meeting_load(spark, sf_dir):
    return frames.meeting_load(spark, sf_dir, frames.batch_silver(spark, sf_dir))


@query
def combined_daily(spark, sf_dir):
    daily = stored(
        frames.daily(frames.batch_silver(spark, sf_dir)), scratch_path(spark, "daily")
    )
    merged = serving.combined_daily(daily, frames.live_by_folder(spark, sf_dir))
    return serving.daily_trend(_in_selection(merged))


@query
def time_distribution_filtered(spark, sf_dir):
    return _batch_distribution(spark, sf_dir)


@query
def cpb_filtered(spark, sf_dir):
    chosen = serving.channels_by_cost(_batch_cpb(spark, sf_dir), frames.CHOSEN)
    return _rounded(chosen, "cost_per_booking")


@query
def channel_leaderboard(spark, sf_dir):
    board = serving.channel_leaderboard(_batch_cpb(spark, sf_dir), frames.CHOSEN)
    return _rounded(board, "cost_per_booking")


@query
def kpi_summary(spark, sf_dir):
    silver, live = frames.stored_silver(spark, sf_dir), frames.stored_live(spark, sf_dir)
    merged = serving.combined_daily(frames.stored_daily(spark, silver), live)
    cpb = only_values(frames.cpb(spark, sf_dir, silver), "channel", frames.CHANNELS)
    figures = serving.kpi_summary(
        _in_selection(merged), live, cpb, gold.employee_meeting_load(silver)
    )
    return _rounded(figures, "avg_cost_per_booking")


@query
def live_by_channel(spark, sf_dir):
    return serving.live_by_channel(frames.all_live(spark, sf_dir))


@query
def recent_live_bookings(spark, sf_dir):
    return plain_times(serving.recent_live_bookings(frames.all_live(spark, sf_dir)))


@query
def weekday_source_heatmap(spark, sf_dir):
    return serving.weekday_source_heatmap(_batch_distribution(spark, sf_dir), frames.SOURCES)


@query
def weekday_source_totals(spark, sf_dir):
    return serving.weekday_source_totals(_batch_distribution(spark, sf_dir))


@query
def meeting_load_combined(spark, sf_dir):
    return _meeting_load(spark, sf_dir)


@query
def host_averages(spark, sf_dir):
    return _rounded(serving.host_averages(_meeting_load(spark, sf_dir)), "avg_meetings_per_week")


@query
def weekly_trend_all(spark, sf_dir):
    return serving.weekly_trend_all(_meeting_load(spark, sf_dir))


@query
def host_weekly_trend(spark, sf_dir):
    return serving.host_weekly_trend(_meeting_load(spark, sf_dir), "host7@example.com")


@query
def filter_domain(spark, sf_dir):
    silver = frames.stored_silver(spark, sf_dir)
    return serving.filter_domain(
        frames.daily(silver),
        frames.cpb(spark, sf_dir, silver),
        frames.meeting_load(spark, sf_dir, silver),
        frames.TODAY,
    )


@query
def batch_freshness(spark, sf_dir):
    return serving.batch_freshness(frames.daily(frames.silver(spark, sf_dir)))


# ---- documents ----


@query
def parse_webhook(spark, sf_dir):
    """All columns of bronze, some bodies being cut off."""
    parsed = parse_documents(frames.rough_records(spark, sf_dir))
    flat = bronze_rows(parsed, keep=("sequence", "_corrupt_record"))
    answers = F.get("questions_and_answers", 0)
    return plain_times(
        flat.select(
            F.col("sequence").alias("event_id"),
            *[name for name in schemas.FLAT_COLUMNS if name != "questions_and_answers"],
            F.size("questions_and_answers").alias("answers"),
            answers["answer"].cast("double").alias("amount"),
            F.col("_corrupt_record").isNull().alias("well_formed"),
        )
    )


@query
def first_host(spark, sf_dir):
    parsed = parse_documents(frames.records(spark, sf_dir))
    return parsed.select(
        F.col("sequence").alias("event_id"),
        first_member(F.col(MEMBERSHIPS), "user_email").alias("host_email"),
        first_member(F.col(MEMBERSHIPS), "user_name").alias("host_name"),
    )


@query
def typed_times(spark, sf_dir):
    """Texts as written by different senders: with an offset, without, or no time at all."""
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    text = (
        F.when(F.col("event_type") == "error", F.concat(F.lit("at "), iso))
        .when(F.col("event_type") == "view", F.concat(iso, F.lit("-05:00")))
        .otherwise(F.concat(iso, F.lit("Z")))
    )
    texts = frames.events(spark, sf_dir).select("event_id", text.alias("created_at"))
    return plain_times(
        texts.select(
            "event_id",
            instant(F.col("created_at")).alias("booked_at"),
            written_day(F.col("created_at")).cast("string").alias("written_day"),
        )
    )


@query
def tolerant_dates(spark, sf_dir):
    text = F.when(F.col("event_type") == "error", "n/a").otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    rows = frames.events(spark, sf_dir).select("event_id", text.alias("booking_date"))
    return typed_days(rows, "booking_date")


@query
def conform_missing_columns(spark, sf_dir):
    partial = frames.silver(spark, sf_dir).select("booking_id", "channel", "start_time")
    return plain_times(conform(partial, schemas.LIVE_SERVING))


@query
def live_transform(spark, sf_dir):
    """Live items before any upsert, every created event of a paid channel; of the clock column the
    result has whether it is a time as it should be written."""
    items = live_items(frames.records(spark, sf_dir), frames.RULES)
    stamped = F.col("ingested_at").rlike("^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}$")
    return items.withColumn("stamped", stamped).drop("ingested_at")


@query
def live_items_json(spark, sf_dir):
    items = live_rows(
        parse_documents(frames.records(spark, sf_dir)), frames.RULES, keep=("sequence",)
    )
    stored = latest_per_key(items, ["booking_id"], newest("sequence"))
    return item_documents(
        stored.select("booking_id", "booking_date", "channel", "host_email", "utm_source")
    )


# ---- tables written and read back ----


@query
def scan_raw_json(spark, sf_dir):
    """Documents written over many lines, in files of a list each, a thousand documents at most, so
    that no file holds more than a task can read."""
    folder = scratch_path(spark, "raw-json")
    landed = landing.landing_rows(frames.records(spark, sf_dir))
    lines = F.replace("value", F.lit(',"'), F.lit(',\n  "'))
    lists = frames.in_files(landed, "date", "sequence").groupBy("date", "slice", "part").agg(
        F.concat(F.lit("[\n"), F.array_join(F.collect_list(lines), ",\n"), F.lit("\n]")).alias("value")
    )
    writer = lists.drop("slice", "part").write.mode("overwrite").partitionBy("date")
    writer.option("maxRecordsPerFile", 1).text(folder)
    documents = read_documents(spark, folder)
    return plain_times(
        bronze_rows(documents, keep=("date",)).select(
            "booking_id",
            "booking_date",
            "event_type",
            "host_email",
            "utm_source",
            F.col("date").cast("string").alias("landing_date"),
        )
    )


@query
def scan_spend(spark, sf_dir):
    """Spend as it is delivered, some amounts as text: files of one list each, a thousand records
    at most, so that no file holds more than a task can read."""
    folder = scratch_path(spark, "spend")
    rows = frames.raw_spend(spark, sf_dir)
    written = F.when(F.col("o_orderkey") % 2 == 0, F.to_json(F.struct("channel", "date", "spend")))
    as_text = F.struct("channel", "date", F.col("spend").cast("string").alias("spend"))
    record = F.coalesce(written, F.to_json(as_text))
    records = rows.select(F.substring("date", 1, 7).alias("month"), "o_orderkey", record.alias("record"))
    lists = (
        frames.in_files(records, "month", "o_orderkey")
        .groupBy("month", "slice", "part")
        .agg(F.concat_ws(",", F.collect_list("record")).alias("records"))
        .select("month", F.concat(F.lit("["), "records", F.lit("]")).alias("value"))
    )
    writer = lists.write.mode("overwrite").partitionBy("month")
    writer.option("maxRecordsPerFile", 1).text(folder)
    return read_spend_files(spark, folder).select("channel", "date", "spend")


@query
def land_raw(spark, sf_dir):
    folder = scratch_path(spark, "landing")
    landing.land(frames.rough_records(spark, sf_dir), folder)
    bodies = landing.latest_bodies(landing.stored(spark, folder))
    return bodies.select(
        "date", "invitee_id", "sequence", F.get_json_object("value", "$.event").alias("event")
    )


@query
def bronze_append_evolve(spark, sf_dir):
    """Bronze filled by the job in two runs, the documents of the second having a field that nobody
    declared; of the clock columns the result has whether they are filled."""
    inbox, folder, checkpoint = (scratch_path(spark, name) for name in ("landed", "bronze", "checkpoint"))
    # Parted by the day before documents are made, so that each is made once.
    events = frames.events(spark, sf_dir)
    early = F.to_date("ts") <= F.lit(frames.CUTOFF)
    rows, late = (landing.landing_rows(frames.as_records(events.where(part))) for part in (early, ~early))
    gained = F.concat(F.lit('{"payload":{"referrer":"web",'), F.substring_index("value", '"payload":{', -1))
    event = F.get_json_object("value", "$.event")
    created_at = F.get_json_object("value", "$.created_at")
    head = F.concat(F.lit('{"event":"'), event, F.lit('","created_at":"'), created_at, F.lit('",'))
    newer = F.concat(head, F.substring(gained, 2, 1 << 30))
    for part in (rows, late.withColumn("value", newer)):
        landing.land_rows(part, inbox)
        start_bronze(spark, inbox, folder, checkpoint).awaitTermination()
    table = load_declared(spark, folder, schemas.BRONZE_STORED)
    traced = F.col("_ingested_at").isNotNull() & F.col("ingest_date").isNotNull()
    return plain_times(
        table.where("readable").select(
            "booking_id", "booking_date", "utm_source", "sequence",
            (traced & F.col("_source_file").isNotNull()).alias("traced"),
            F.expr("variant_get(extra, \"$['payload.referrer']\", 'string')").alias("referrer"),
        )
    )


@query
def upsert_bookings(spark, sf_dir):
    """Events from the cutoff on, then those up to it, upserted by booking: as one pass would."""
    folder = scratch_path(spark, "bookings")
    rows = frames.bronze(spark, sf_dir).withColumnRenamed("event_id", "sequence")
    day, order = F.to_date("booking_date"), ("booking_date", "sequence")
    for part in (rows.where(day >= F.lit(frames.CUTOFF)), rows.where(day <= F.lit(frames.CUTOFF))):
        events = clean.latest_events(part, frames.RULES, order)
        upsert(events, folder, ["booking_id"], newest(*order), frames.BUCKETS)
    latest = current(spark, folder, schemas.BOOKING_CHANGES)
    paid = latest.where(is_paid(F.col("channel"), frames.RULES))
    return plain_times(paid.select(*clean.SILVER_COLUMNS))


@query
def upsert_spend(spark, sf_dir):
    """Spend of finished orders, then of the rest; pending orders have no readable day."""
    folder = scratch_path(spark, "spends")
    rows = frames.raw_spend(spark, sf_dir)
    pending = F.col("o_orderstatus") == "P"
    rows = rows.withColumn("date", F.when(pending, "unknown").otherwise(F.col("date")))
    finished = F.col("o_orderstatus") == "F"
    for part in (rows.where(finished), rows.where(pending), rows.where(~finished)):
        cleaned = clean.clean_spend(part, newest("o_orderkey"))
        upsert(cleaned, folder, ["date", "channel"], buckets=frames.BUCKETS)
    return current(spark, folder, schemas.SILVER_SPENDS)


# ---- streams ----


@query
def stream_live_bookings(spark, sf_dir):
    table, checkpoint = scratch_path(spark, "live"), scratch_path(spark, "checkpoint")
    stream = frames.record_stream(spark, sf_dir)
    start_live(
        stream, table, checkpoint, frames.RULES, pull_seconds=None, buckets=frames.LIVE_BUCKETS
    ).awaitTermination()
    return _as_text(live_layer.live_snapshot(spark, table), "booking_date")


@query
def stream_bounded_pulls(spark, sf_dir):
    """Records that wait in several files, pulled by so many bytes at a time: a file or some."""
    inbox, table, checkpoint = (scratch_path(spark, name) for name in ("inbox", "live", "checkpoint"))
    frames.waiting_records(spark, sf_dir).write.mode("overwrite").parquet(inbox)
    pull = -(-files.size_bytes(spark, inbox) // frames.PULLS)
    stream = file_records(spark, inbox, max_bytes_per_batch=pull)
    query = start_live(
        stream, table, checkpoint, frames.RULES, pull_seconds=None, buckets=frames.LIVE_BUCKETS
    )
    query.awaitTermination()
    pulls = sum(progress["numInputRows"] > 0 for progress in query.recentProgress)
    rows = _as_text(live_layer.live_snapshot(spark, table), "booking_date")
    return rows.withColumn("bounded", F.lit(pulls >= min(3, frames.PULLS)))


@query
def live_snapshot(spark, sf_dir):
    """A live table as the stream's sink writes it."""
    folder = scratch_path(spark, "live")
    items = last_items(live_items(frames.records(spark, sf_dir), frames.RULES))
    placed = items.withColumn("day", F.col("booking_date"))
    order = newest(*live_layer.LIVE_ORDER)
    upsert_within(placed, folder, live_layer.LIVE_KEY, "day", "days", order, frames.LIVE_BUCKETS)
    return _as_text(live_layer.live_snapshot(spark, folder), "booking_date")


@query
def tee_landing_and_live(spark, sf_dir):
    """The rows that each of the two sinks holds."""
    sinks = scratch_path(spark, "landing"), scratch_path(spark, "live")
    stream = frames.record_stream(spark, sf_dir)
    for query in start_tee(stream, *sinks, scratch_path(spark, "checkpoint"), frames.RULES):
        query.awaitTermination()
    landed = landing.stored(spark, sinks[0]).select(
        F.lit("landing").alias("sink"), "date", "sequence", F.col("key").alias("booking_id"),
        F.get_json_object("value", "$.event").alias("what"),
    )
    live = live_layer.live_table(spark, sinks[1]).select(
        F.lit("live").alias("sink"), F.col("booking_date").alias("date"), "sequence", "booking_id",
        F.col("channel").alias("what"),
    )
    return landed.unionByName(live)


@query
def stream_dedup_append(spark, sf_dir):
    """The last item of each booking from an append-only table, in all its columns but the clock's."""
    folder = scratch_path(spark, "appended")
    items = live_items(frames.record_stream(spark, sf_dir), frames.RULES)
    start_dedup_append(items, folder, scratch_path(spark, "checkpoint")).awaitTermination()
    return appended(spark, folder).drop("ingested_at")
