"""Streams of webhook records: a key, a JSON body and a sequence number that orders arrivals."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake.functions.times import instant

RECORD = "key string, value string, sequence bigint"

# Age beyond which a file stream forgets files, measured against the newest it has seen. Spark's
# week would pass over files that arrive late; a hundred years covers any backlog.
MAX_FILE_AGE = "36500d"


def file_records(
    spark: SparkSession,
    path: str,
    fmt: str = "parquet",
    max_files_per_batch: int = 1000,
    max_bytes_per_batch: int | None = None,
) -> DataFrame:
    """Records that arrive as files in a folder, at most so many files per micro-batch, or so many
    bytes of files (always one file at least, as files cannot be parted)."""
    stream = spark.readStream.format(fmt).schema(RECORD).option("maxFileAge", MAX_FILE_AGE)
    if max_bytes_per_batch is not None:
        stream = stream.option("maxBytesPerTrigger", max_bytes_per_batch)
    else:
        stream = stream.option("maxFilesPerTrigger", max_files_per_batch)
    return stream.load(path)


def body_lines(spark: SparkSession, path: str, max_files_per_batch: int = 1000) -> DataFrame:
    """Bare JSON bodies, one per line, keyed by the booking's URI.

    Lines have no arrival number. Their order is the body's own ``created_at``, in microseconds;
    of equal ones a booking's last has no order here, so where that matters, take records with a
    sequence number.
    """
    lines = (
        spark.readStream.format("text")
        .option("maxFilesPerTrigger", max_files_per_batch)
        .option("maxFileAge", MAX_FILE_AGE)
        .load(path)
    )
    return lines.select(
        F.get_json_object("value", "$.payload.uri").alias("key"),
        "value",
        F.coalesce(
            F.unix_micros(instant(F.get_json_object("value", "$.created_at"))),
            F.unix_micros("_metadata.file_modification_time"),
        ).alias("sequence"),
    )


def kafka_records(
    spark: SparkSession, servers: str, topic: str, max_offsets_per_batch: int | None = None
) -> DataFrame:
    """Records of a Kafka topic keyed by booking URI; needs Spark's Kafka package.

    All partitions are read. A key stays in one partition, so its offsets order its records.
    A pull takes all there is, so that a stream that pulls at intervals cannot fall behind for
    good; ``max_offsets_per_batch`` bounds it, and with it the records per interval.
    """
    stream = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", servers)
        .option("subscribe", topic)
    )
    if max_offsets_per_batch is not None:
        stream = stream.option("maxOffsetsPerTrigger", max_offsets_per_batch)
    return stream.load().select(
        F.col("key").cast("string"),
        F.col("value").cast("string"),
        F.col("offset").alias("sequence"),
    )
