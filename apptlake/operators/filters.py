"""Filters behind the serving views. ``None`` means no restriction."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from apptlake.functions.times import tolerant_day


@dataclass(frozen=True)
class Selection:
    """What a reader picked: an inclusive date range, sources and channels."""

    start: date | None = None
    end: date | None = None
    sources: Sequence[str] | None = None
    channels: Sequence[str] | None = None


def only_values(df: DataFrame, column: str, values: Sequence[str] | None) -> DataFrame:
    """Rows whose column is one of the values; an empty list selects nothing."""
    if values is None:
        return df
    if not values:
        return df.where(F.lit(False))
    return df.where(F.col(column).isin(list(values)))


def only_days(df: DataFrame, column: str, start: date | None, end: date | None) -> DataFrame:
    """Rows from ``start`` to ``end``, both included."""
    if start is not None:
        df = df.where(F.col(column) >= F.lit(start))
    if end is not None:
        df = df.where(F.col(column) <= F.lit(end))
    return df


def typed_days(df: DataFrame, column: str, drop_bad: bool = True) -> DataFrame:
    """Make a column a date; unreadable values become null and, by default, lose their row."""
    is_date = df.schema[column].dataType.typeName() == "date"
    typed = df if is_date else df.withColumn(column, tolerant_day(F.col(column)))
    return typed.dropna(subset=[column]) if drop_bad else typed
