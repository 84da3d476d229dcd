"""JSON inputs: webhook documents and dated spend files."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake.operators.conform import empty_frame
from apptlake.schemas import SPEND, WEBHOOK
from apptlake.sources import files


def read_documents(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Webhook documents below a folder, with the schema declared rather than inferred.

    ``one_per_file`` reads files that each hold one document over several lines. Such files
    cannot be split; folders of many lines per file (``one_per_file=False``) scale better.
    A ``date=`` folder level is found by partition discovery.
    """
    return spark.read.schema(WEBHOOK).option("multiLine", str(one_per_file).lower()).json(path)


def spend_file(folder: str, day: date) -> str:
    return f"{folder}/spend_data_{day.isoformat()}.json"


def yesterday() -> date:
    return date.today() - timedelta(days=1)


def read_spend_files(spark: SparkSession, path: str) -> DataFrame:
    """Spend records of all files below a path; a file holds one object or a list of them.

    Amounts may be written as numbers or as text. A file that cannot be read, a record of another
    shape and an amount that is no number fail the job, so that no spend is lost unseen.
    """
    # A number that is declared as text would be read again from the file, one seek for each.
    schema = "channel string, date string, spend variant, _corrupt_record string"
    rows = spark.read.schema(schema).option("multiLine", "true").json(path)
    rows = rows.withColumn("spend", F.col("spend").cast("string"))
    amount = F.col("spend").try_cast("double")
    unknown = F.coalesce("channel", "date", "spend").isNull()
    unread = F.col("spend").isNotNull() & amount.isNull()
    faulty = F.col("_corrupt_record").isNotNull() | unknown | unread
    text = F.coalesce("_corrupt_record", F.to_json(F.struct("channel", "date", "spend")))
    message = F.concat(F.lit("spend record that cannot be read: "), F.substring(text, 1, 200))
    # In the values themselves, as a later filter on them might otherwise come before the check.
    values = {"channel": F.col("channel"), "date": F.col("date"), "spend": amount}
    failed = F.raise_error(message)
    return rows.where(F.when(faulty, failed.cast("boolean")).otherwise(F.lit(True))).select(
        *[F.when(faulty, failed).otherwise(value).alias(name) for name, value in values.items()]
    )


def read_spend(spark: SparkSession, folder: str, day: date | None = None) -> DataFrame:
    """Spend records of one day's file; a day without a file gives no rows.

    The day defaults to yesterday.
    """
    path = spend_file(folder, day or yesterday())
    if not files.exists(spark, path):
        return empty_frame(spark, SPEND)
    return read_spend_files(spark, path)
