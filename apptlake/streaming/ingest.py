"""Streams that land raw records, feed the live table, and fill bronze from the landing.

Landing and bronze are appended to by Spark's file sink, whose log makes each batch count once
however often it runs. Only the sink writes to its folder: readers go by its log and would not see
other files.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from apptlake.functions.channels import CHANNEL_BY_EVENT_TYPE
from apptlake.operators.flatten import (
    CORRUPT,
    bronze_rows,
    is_unreadable,
    parse_documents,
    undeclared_fields,
    with_lineage,
)
from apptlake.schemas import LANDING
from apptlake.sources.landing import landing_rows
from apptlake.sources.records import MAX_FILE_AGE
from apptlake.streaming.live import start_live
from apptlake.streaming.progress import observed, started


def start_landing(
    records: DataFrame, landing: str, checkpoint: str, pull_seconds: int | None = None
) -> StreamingQuery:
    """Land every record as received, below the day its body was created.

    Bodies are the widest data there is, so they are not shuffled.
    """
    rows, name = observed(landing_rows(records), landed=F.count(F.lit(1)))
    writer = (
        rows.writeStream.format("parquet")
        .queryName(name)
        .option("path", landing)
        .option("checkpointLocation", checkpoint)
        .partitionBy("date")
    )
    return started(writer, pull_seconds)


def start_tee(
    records: DataFrame,
    landing: str,
    live_table: str,
    checkpoint: str,
    rules: Mapping[str, str] = CHANNEL_BY_EVENT_TYPE,
    pull_seconds: int | None = None,
) -> list[StreamingQuery]:
    """Send every record both to the landing and to the live table.

    Two queries, each with a checkpoint of its own: one that fails goes on from where it was
    without the other writing anything twice.
    """
    return [
        start_landing(records, landing, f"{checkpoint}/landing", pull_seconds),
        start_live(records, live_table, f"{checkpoint}/live", rules, pull_seconds),
    ]


def landed_bodies(
    spark: SparkSession, landing: str, fmt: str = "parquet", max_files_per_batch: int = 1_000
) -> DataFrame:
    """A stream of ``value``, ``sequence`` and ``source_file`` of a landing folder.

    ``fmt`` is "parquet" for what ``start_landing`` or ``land`` wrote, or "json" for a folder of
    files that each hold one document, over several lines or not.
    """
    reader = (
        spark.readStream.option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
    )
    source_file = F.col("_metadata.file_path").alias("source_file")
    if fmt == "json":
        texts = reader.text(landing, wholetext=True, recursiveFileLookup=True)
        return texts.select("value", F.lit(None).cast("bigint").alias("sequence"), source_file)
    return reader.schema(LANDING).parquet(landing).select("value", "sequence", source_file)


def bronze_of(bodies: DataFrame) -> DataFrame:
    """Flat rows of bodies, static or streaming. Those without a readable payload are marked and
    keep their text; of the others a misfit field is null and the rest is used. ``extra`` holds what
    a document has beyond the declared fields."""
    named = bodies.withColumn("extra", undeclared_fields(F.col("value")))
    parsed = parse_documents(named).withColumn("readable", ~is_unreadable())
    flat = bronze_rows(parsed, keep=("sequence", "source_file", CORRUPT, "readable", "extra"))
    kept = F.when(~F.col("readable"), F.col(CORRUPT))
    return with_lineage(flat, F.col("source_file")).drop("source_file").withColumn(CORRUPT, kept)


def start_bronze(
    spark: SparkSession,
    landing: str,
    bronze: str,
    checkpoint: str,
    fmt: str = "parquet",
    max_files_per_batch: int = 1_000,
) -> StreamingQuery:
    """Append what landed since the last run to bronze, readable bodies apart from others.

    The checkpoint remembers the files taken, so landing is not read again from the start.
    """
    rows = bronze_of(landed_bodies(spark, landing, fmt, max_files_per_batch))
    rows, name = observed(rows, kept=F.count_if("readable"), quarantined=F.count_if(~F.col("readable")))
    writer = (
        rows.writeStream.format("parquet")
        .queryName(name)
        .option("path", bronze)
        .option("checkpointLocation", checkpoint)
        .partitionBy("readable", "ingest_date")
    )
    return started(writer, None)
