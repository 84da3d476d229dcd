"""Small value rules shared by the batch, live and serving layers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: label of bookings without a source in the batch views.
NO_SOURCE = "(no utm_source)"

# Sums of spend run in decimal, so that they do not depend on row order. Amounts are taken to
# six places, the nearest; smaller parts do not count.
MONEY = "decimal(28,6)"


def first_member(memberships: Column, field: str) -> Column:
    """A field of the first host; null when the list is missing or empty."""
    return F.get(memberships, 0)[field]


def labelled_source(source: Column) -> Column:
    return F.coalesce(source, F.lit(NO_SOURCE))


def ratio_or_zero(numerator: Column, denominator: Column) -> Column:
    return F.when(denominator > 0, numerator / denominator).otherwise(F.lit(0.0))


def money_sum(amount: Column) -> Column:
    """Total of the amounts. One too large for the type fails the job rather than drop out; what
    is no number (null, NaN) is left out."""
    exact = amount.try_cast(MONEY)
    number = amount.isNotNull() & ~F.isnan(amount.cast("double"))
    message = F.concat(F.lit("amount out of range: "), amount.cast("string"))
    too_large = number & exact.isNull()
    return F.sum(F.when(too_large, F.raise_error(message).cast(MONEY)).otherwise(exact)).cast("double")


def last_segment(uri: Column) -> Column:
    return F.element_at(F.split(uri, "/"), -1)
