"""Small helpers the operators share: word splitting, stored steps, sliced Arrow batches."""

from __future__ import annotations

import gc
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from apptlake.session import scratch_path
from apptlake.sources import files

#: Characters that part words (fixed values of the word pattern).
SPACES = " \t\n\x0b\f\r"
SPACE_CLASS = "[ \\t-\\r]"

#: Bytes of text worked on at once in a Python task, unless one text alone is longer.
SLICE_BYTES = 4 << 20


def text_of(column: str = "text") -> Column:
    """A text, empty for null."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def without(text: Column, characters: str) -> Column:
    """A text without some characters: one byte scan for each, much faster than translate()."""
    for character in characters:
        text = F.replace(text, F.lit(character), F.lit(""))
    return text


def trimmed(text: Column) -> Column:
    return F.btrim(text, F.lit(SPACES))


def words_of(trimmed_text: Column) -> Column:
    """Words of a trimmed text; none for an empty one."""
    return F.when(trimmed_text == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed_text, SPACE_CLASS + "+")
    )


def fenced(df: DataFrame) -> DataFrame:
    """The same rows; later filters stay above, rather than take copies of every expression along
    on their way to the scan (nested expressions would grow without bound)."""
    row = F.monotonically_increasing_id()
    return df.withColumn("_fence", row).where(F.col("_fence") >= 0).drop("_fence")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write a step to the shared scratch folder and read it back: cuts the lineage, and a lost
    executor costs the tasks it ran, not the steps before."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Scratch:
    """Steps of a job that go when its result is stored, so that they don't pile up on disk."""

    def __init__(self) -> None:
        self.made: list[tuple] = []

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(df.sparkSession, name)
        df.write.mode("overwrite").parquet(path)
        step = df.sparkSession.read.schema(df.schema).parquet(path)
        self.made.append((df.sparkSession, path, step))
        return step

    def done(self, *steps: DataFrame | None, sweep: SparkSession | None = None) -> None:
        """Delete steps that nothing will read again; a None or any other frame is passed over.

        Spark keeps the shuffle files of a query until the driver's memory is swept, which may take
        half an hour; with ``sweep`` it is done now.
        """
        for made in [m for m in self.made if any(m[2] is step for step in steps)]:
            files.delete(made[0], made[1])
            self.made.remove(made)
        if sweep is not None:
            gc.collect()
            sweep.sparkContext._jvm.System.gc()

    def __enter__(self) -> Scratch:
        return self

    def __exit__(self, *_) -> None:
        for spark, path, _ in self.made:
            files.delete(spark, path)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut a batch by the bytes of its texts, so that working memory does not follow row counts."""
    column = batch.column(batch.schema.get_field_index(text))
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False))
    start, base = 0, 0
    while start < batch.num_rows:
        end = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield batch.slice(start, end - start)
        start, base = end, ends[end - 1]


def keyed(docs: DataFrame, id_col: str, text_col: str, carry: Sequence[str] = ()) -> DataFrame:
    """``_key``, ``_text`` and ``_carried`` (a struct of other columns) of every row.

    The key is the id where ids are unique. Where some are missing or stand on several rows, it
    is the id with a hash of the text, so that only rows alike in both are taken for one.
    """
    ids = docs.select(F.col(id_col).alias("_id"))
    odd = ids.groupBy("_id").count().where("count > 1 OR _id IS NULL").limit(1)
    key = F.col(id_col)
    if odd.collect():
        key = F.struct(key.alias("doc_id"), F.xxhash64(text_of(text_col)).alias("_hash"))
    also = F.struct(*[F.col(c) for c in carry]) if carry else F.lit(None).cast("int")
    return docs.select(key.alias("_key"), text_of(text_col).alias("_text"), also.alias("_carried"))


def id_of(rows: DataFrame) -> Column:
    """The id in a ``_key``."""
    plain = not rows.schema["_key"].dataType.simpleString().startswith("struct")
    return F.col("_key") if plain else F.col("_key")["doc_id"]


def kind_of(rows: DataFrame, column: str = "_key") -> str:
    return rows.schema[column].dataType.simpleString()
