"""Raw landing: every body kept as received, placed by day, read as one body per place."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake.functions.values import last_segment
from apptlake.operators.dedup import latest_per_key, newest
from apptlake.schemas import LANDING
from apptlake.sources.tables import append


def landing_rows(records: DataFrame) -> DataFrame:
    """Add where a record lands: the day its body was created and the id ending its URI."""
    created_at = F.get_json_object("value", "$.created_at")
    uri = F.get_json_object("value", "$.payload.uri")
    return records.select(
        "value",
        "key",
        last_segment(uri).alias("invitee_id"),
        "sequence",
        F.substring(created_at, 1, 10).alias("date"),
    )


def land(records: DataFrame, path: str) -> int:
    """Append records below ``date=``, many to a file; returns how many."""
    return land_rows(landing_rows(records), path)


def land_rows(rows: DataFrame, path: str) -> int:
    """The same for rows that know where they land.

    Bodies are the widest data there is, so they are not shuffled: records of a batch are of
    one day or two, and a task writes one file for each.
    """
    return append(rows, path, "date")


def stored(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(LANDING).parquet(path)


def latest_bodies(landed: DataFrame) -> DataFrame:
    """A body landed twice for the same day and id counts once, as the later.

    Bodies without a day or an id cannot be told to be the same, so each one stays.
    """
    unknown = F.col("date").isNull() | F.col("invitee_id").isNull()
    known = latest_per_key(landed.where(~unknown), ["date", "invitee_id"], newest("sequence"))
    return known.unionByName(landed.where(unknown))
