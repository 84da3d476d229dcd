"""The batch layer as jobs over path tables: landing, bronze, silver, gold."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake import schemas
from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE, is_paid
from apptlake.operators.clean import BOOKING_ORDER, SILVER_COLUMNS, clean_spend, latest_events
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.operators.keyed import BUCKETS, current, merge_into_table, upsert
from apptlake.plans import gold
from apptlake.plans.serving import labelled
from apptlake.session import scratch_path, sized_shuffles
from apptlake.sources import files
from apptlake.sources.documents import read_spend
from apptlake.sources.records import MAX_FILE_AGE
from apptlake.sources.tables import load_declared, load_or_empty, publish, published, stored
from apptlake.streaming.ingest import start_bronze
from apptlake.streaming.live import live_snapshot

BOOKING_KEY = ["booking_id"]
SPEND_KEY = ["date", "channel"]
# Spend is a row per channel and day.
SPEND_BUCKETS = 8
GOLD = {
    "bookings_by_source_daily": schemas.GOLD_BOOKINGS_BY_SOURCE_DAILY,
    "booking_time_distribution": schemas.GOLD_BOOKING_TIME_DISTRIBUTION,
    "cpb_by_channel": schemas.GOLD_CPB_BY_CHANNEL,
    "employee_meeting_load": schemas.GOLD_EMPLOYEE_MEETING_LOAD,
    "active_hosts_daily": schemas.GOLD_ACTIVE_HOSTS_DAILY,
}


@dataclass(frozen=True)
class Layout:
    """Where the tables of one deployment live, all below one root.

    ``landing_format`` is "json" where the landing is a folder of JSON documents that others
    deliver, one per file. ``merge_tables`` names catalog tables for "silver/bookings" and
    "silver/spends" whose format has MERGE; the path tables are then not used. ``buckets`` is how
    many parts of the bookings an upsert can rewrite by itself, for a new table. ``database`` names
    a catalog database whose tables are switched to each new run of gold.
    """

    root: str
    rules: Mapping[str, str] = field(default_factory=lambda: dict(CHANNEL_BY_EVENT_TYPE))
    landing_format: str = "parquet"
    merge_tables: Mapping[str, str] = field(default_factory=dict)
    buckets: int = BUCKETS
    database: str | None = None

    def path(self, name: str) -> str:
        return f"{self.root.rstrip('/')}/{name}"


def ingest_bronze(spark: SparkSession, layout: Layout) -> int:
    """Append what landed to bronze; returns how many bodies. Without a landing, nothing happens."""
    if not files.exists(spark, layout.path("landing")):
        return 0
    query = start_bronze(
        spark,
        layout.path("landing"),
        layout.path("bronze"),
        layout.path("checkpoints/bronze"),
        layout.landing_format,
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def bronze(spark: SparkSession, layout: Layout) -> DataFrame:
    """Flat events of all readable bodies. ``extra`` is null in files from before it was added."""
    rows = load_declared(spark, layout.path("bronze"), schemas.BRONZE_STORED)
    return rows.where("readable").drop("readable", "_corrupt_record")


def quarantine(spark: SparkSession, layout: Layout) -> DataFrame:
    """Bodies that gave no payload, as text, with the file and day they came by."""
    rows = load_declared(spark, layout.path("bronze"), schemas.BRONZE_STORED).where("NOT readable")
    return rows.select(F.col("_corrupt_record").alias("value"), "_source_file", "ingest_date")


def booking_changes(spark: SparkSession, layout: Layout) -> DataFrame:
    """The latest known event of each booking, of any channel."""
    name = "silver/bookings"
    if name in layout.merge_tables:
        return spark.table(layout.merge_tables[name])
    return current(spark, layout.path(name), schemas.BOOKING_CHANGES)


def silver_bookings(spark: SparkSession, layout: Layout) -> DataFrame:
    """Current bookings, one row each as stored. The latest event of a booking wins, in whatever
    order runs saw them; whether its channel is a paid one is asked on read, so a booking can move
    out of silver."""
    latest = booking_changes(spark, layout)
    return latest.where(is_paid(F.col("channel"), layout.rules)).select(*SILVER_COLUMNS)


def silver_spends(spark: SparkSession, layout: Layout) -> DataFrame:
    name = "silver/spends"
    if name in layout.merge_tables:
        return spark.table(layout.merge_tables[name])
    return current(spark, layout.path(name), schemas.SILVER_SPENDS)


def _upsert_bookings(layout: Layout, rows: DataFrame) -> int:
    latest, name = latest_events(rows, layout.rules), "silver/bookings"
    if name not in layout.merge_tables:
        order = newest(*BOOKING_ORDER)
        return upsert(latest, layout.path(name), BOOKING_KEY, order, layout.buckets)
    # MERGE replaces whatever is there, so an event that came late must not get so far.
    known = booking_changes(rows.sparkSession, layout)
    both = known.unionByName(latest.select(*known.columns))
    latest = both.join(latest.select("booking_id"), "booking_id", "left_semi")
    latest = latest_per_key(latest, BOOKING_KEY, newest(*BOOKING_ORDER))
    return merge_into_table(latest, layout.merge_tables[name], BOOKING_KEY)


def extend_silver_bookings(
    spark: SparkSession, layout: Layout, max_files_per_batch: int = 10_000
) -> int:
    """Upsert bookings from the bronze files that came since the last run; returns how many events.

    A checkpointed file stream knows which these are, so neither bronze nor silver is read
    or written again from the start.
    """
    if not files.exists(spark, layout.path("bronze")):
        return 0
    events = (
        spark.readStream.schema(schemas.BRONZE_STORED)
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
        .parquet(layout.path("bronze"))
        .where("readable")
    )

    # A checkpoint restores the shuffle partitions of the stream's first run, however much the
    # data has grown since; what the present tables need is what counts.
    held = files.size_bytes(spark, layout.path("silver/bookings"))
    held += files.size_bytes(spark, layout.path("bronze"))
    with sized_shuffles(spark, held) as partitions:
        pass

    def write(batch: DataFrame, _: int) -> None:
        batch.sparkSession.conf.set("spark.sql.shuffle.partitions", str(partitions))
        _upsert_bookings(layout, batch)

    query = (
        events.writeStream.foreachBatch(write)
        .option("checkpointLocation", layout.path("checkpoints/silver"))
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return sum(progress["numInputRows"] for progress in query.recentProgress)


def refresh_silver_bookings(spark: SparkSession, layout: Layout, since: date | None = None) -> bool:
    """Upsert bookings from all of bronze, or from the days ingested from ``since`` on.

    For backfills and repairs; daily runs use ``extend_silver_bookings``. No booking is deleted.
    """
    events = bronze(spark, layout)
    if since is not None:
        events = events.where(F.col("ingest_date") >= F.lit(since))
    if events.isEmpty():
        return False
    with sized_shuffles(spark, files.size_bytes(spark, layout.path("bronze"))):
        _upsert_bookings(layout, events)
    return True


def refresh_silver_spends(spark: SparkSession, layout: Layout, day: date | None = None) -> int:
    """Upsert one day's spend file, yesterday's by default; returns how many rows.

    A missing file changes nothing. A file that comes again replaces the amounts it names and
    leaves others as they are; rows without a readable day match nothing and are added again.
    """
    rows, name = clean_spend(read_spend(spark, layout.path("spend"), day)), "silver/spends"
    if name in layout.merge_tables:
        return merge_into_table(rows, layout.merge_tables[name], SPEND_KEY)
    return upsert(rows, layout.path(name), SPEND_KEY, buckets=SPEND_BUCKETS)


def refresh_gold(spark: SparkSession, layout: Layout) -> dict[str, int]:
    """Recompute the gold tables whole; returns the rows of each.

    Silver is read once, for the counts that all tables are made from; the time distribution is
    made from the daily table. Each table is published when it is whole.
    """
    scratch = scratch_path(spark, "counts")
    with sized_shuffles(spark, files.size_bytes(spark, layout.path("silver/bookings"))):
        counts = stored(gold.booking_counts(silver_bookings(spark, layout)), scratch)
    daily = gold.daily_of(counts)
    tables = {
        "bookings_by_source_daily": daily,
        "booking_time_distribution": gold.booking_time_distribution(daily),
        "cpb_by_channel": gold.cost_of(counts, silver_spends(spark, layout)),
        "employee_meeting_load": gold.load_of(counts),
        "active_hosts_daily": gold.hosts_of(counts),
    }
    rows = {}
    for name, table in tables.items():
        in_catalog = f"{layout.database}.{name}" if layout.database else None
        rows[name] = publish(table, layout.path(f"gold/{name}"), in_catalog)
    files.delete(spark, scratch)
    return rows


def gold_table(spark: SparkSession, layout: Layout, name: str) -> DataFrame:
    """A gold table as last published; empty before the first run."""
    return published(spark, layout.path(f"gold/{name}"), GOLD[name])


def run_batch(spark: SparkSession, layout: Layout, day: date | None = None) -> dict[str, int]:
    """One batch run over what is new; returns how many rows each step took or wrote.

    Bookings are in place before spend is touched, so a failing spend file cannot hold them up.
    """
    counts = {"bronze": ingest_bronze(spark, layout)}
    counts["silver_events"] = extend_silver_bookings(spark, layout)
    counts["silver_spends"] = refresh_silver_spends(spark, layout, day)
    return counts | refresh_gold(spark, layout)


@dataclass(frozen=True)
class ServingInputs:
    """What the serving views take: gold tables typed and labelled, and the live bookings."""

    daily: DataFrame
    distribution: DataFrame
    cpb: DataFrame
    meeting_load: DataFrame
    live: DataFrame
    hosts: DataFrame


def serving_inputs(spark: SparkSession, layout: Layout) -> ServingInputs:
    """Open the gold and live tables; one that is missing or does not open is empty."""

    def table(name: str) -> DataFrame:
        return load_or_empty(spark, layout.path(f"gold/{name}"), GOLD[name], published)

    return ServingInputs(
        labelled(table("bookings_by_source_daily")),
        labelled(table("booking_time_distribution")),
        table("cpb_by_channel"),
        table("employee_meeting_load"),
        live_snapshot(spark, layout.path("live")),
        table("active_hosts_daily"),
    )
