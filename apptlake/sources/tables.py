"""Path tables: full reads, tolerant reads, appends, and tables published as a whole."""

from __future__ import annotations

import logging
from collections.abc import Callable

from py4j.protocol import Py4JJavaError
from pyspark.errors import AnalysisException, PySparkException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from apptlake.operators.conform import conform, empty_frame, fields_of
from apptlake.sources import files

log = logging.getLogger(__name__)

# How Spark says that a folder has no files, and that a file sink's log has none.
NO_FILES = ("UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")


def read_table(
    spark: SparkSession, path: str, fmt: str = "parquet", merge: bool = False
) -> DataFrame:
    """Read a whole table; ``merge`` unites the columns of files written over time."""
    return spark.read.format(fmt).option("mergeSchema", str(merge).lower()).load(path)


def load_if_present(spark: SparkSession, path: str, ddl: str, fmt: str = "parquet") -> DataFrame:
    """Read a table in its expected shape; a missing or fileless one is empty.

    For jobs: a table that is there but cannot be read is an error.
    """
    if not files.exists(spark, path):
        return empty_frame(spark, ddl)
    try:
        return conform(spark.read.format(fmt).load(path), ddl)
    except AnalysisException as error:
        if error.getCondition() not in NO_FILES:
            raise
        return empty_frame(spark, ddl)


def load_declared(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """Read a Parquet table by its declared columns: files that lack one, written before it was
    added, give null there, and no footer is read to find the columns. A missing table is empty."""
    if not files.exists(spark, path):
        return empty_frame(spark, ddl)
    return spark.read.schema(ddl).parquet(path).select(*[field.name for field in fields_of(ddl)])


def load_or_empty(
    spark: SparkSession, path: str, ddl: str, load: Callable[..., DataFrame] = load_if_present
) -> DataFrame:
    """The same for serving views, which show what they can: any table that does not open is
    empty, with a warning."""
    try:
        return load(spark, path, ddl)
    except (PySparkException, Py4JJavaError) as error:
        log.warning("table at %s cannot be read, taken as empty: %s", path, error)
        return empty_frame(spark, ddl)


def counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    """Count rows while they are written, rather than by running the plan once more."""
    seen = Observation(name)
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def append(df: DataFrame, path: str, partition_by: str, fmt: str = "parquet") -> int:
    """Append rows and return how many; an empty input leaves the table as it was."""
    rows, seen = counted(df, f"append {path}")
    rows.write.format(fmt).mode("append").option("mergeSchema", "true").partitionBy(
        partition_by
    ).save(path)
    return seen.get["rows"]


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write a frame and read it back: what several consumers share is then worked out once."""
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


RUN = "run="
#: How Spark's writer says that a folder is whole; it writes this last.
WHOLE = "_SUCCESS"


def whole_runs(spark: SparkSession, path: str) -> list[str]:
    """Folders of a published table that were written to the end, oldest first."""
    names = sorted(name for name in files.child_names(spark, path) if name.startswith(RUN))
    return [f"{path}/{name}" for name in names if files.exists(spark, f"{path}/{name}/{WHOLE}")]


def publish(df: DataFrame, path: str, table: str | None = None, kept: int = 2) -> int:
    """Replace a whole table and return its new row count; readers see the old one or the new one.

    Every run writes a folder of its own below ``path``. ``published`` reads the last that is whole,
    so a run that fails changes nothing. With ``table``, a catalog table is made or switched to the
    new folder as well. The run before stays for those who are reading it; older ones go.
    """
    spark = df.sparkSession
    before = whole_runs(spark, path)
    number = int(before[-1].rsplit(RUN, 1)[1]) + 1 if before else 0
    folder = f"{path}/{RUN}{number:010d}"
    rows, seen = counted(df, f"publish {path}")
    rows.write.mode("overwrite").parquet(folder)
    if table is not None:
        if spark.catalog.tableExists(table):
            spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
            spark.catalog.refreshTable(table)
        else:
            spark.catalog.createTable(table, folder, "parquet", df.schema)
    for old in before[: len(before) + 1 - kept]:
        files.delete(spark, old)
    return seen.get["rows"]


def published(spark: SparkSession, path: str, ddl: str) -> DataFrame:
    """The last whole run of a published table in its expected shape; empty before the first."""
    runs = whole_runs(spark, path)
    return load_if_present(spark, runs[-1] if runs else path, ddl)
