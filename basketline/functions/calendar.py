"""Calendar parts of an invoice time."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SATURDAY, SUNDAY = 7, 1  # Spark's dayofweek()


def is_weekend(ts: Column) -> Column:
    return F.when(F.dayofweek(ts).isin(SUNDAY, SATURDAY), 1).otherwise(0)


def week_start(ts: Column) -> Column:
    """Monday of the week, as a date."""
    return F.date_trunc("week", F.to_date(ts)).cast("date")


def epoch_seconds(ts: Column) -> Column:
    return F.unix_timestamp(ts)
