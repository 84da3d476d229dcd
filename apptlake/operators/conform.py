"""Give a frame an expected set of columns and types."""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType


@lru_cache(maxsize=None)
def fields_of(ddl: str) -> tuple[StructField, ...]:
    return tuple(StructType.fromDDL(ddl).fields)


def empty_frame(spark: SparkSession, ddl: str) -> DataFrame:
    nulls = [F.lit(None).cast(field.dataType).alias(field.name) for field in fields_of(ddl)]
    return spark.range(0).select(*nulls)


def conform(df: DataFrame, ddl: str) -> DataFrame:
    """Exactly the declared columns, in order: missing ones null, others cast if need be."""
    columns = []
    present = {field.name: field.dataType for field in df.schema}
    for field in fields_of(ddl):
        if field.name not in present:
            columns.append(F.lit(None).cast(field.dataType).alias(field.name))
        elif present[field.name] != field.dataType:
            columns.append(F.col(field.name).try_cast(field.dataType).alias(field.name))
        else:
            columns.append(F.col(field.name))
    return df.select(*columns)
