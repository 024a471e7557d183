"""Ratios with a floor under the denominator, so that nothing divides by zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def floored(c: Column, floor) -> Column:
    return F.greatest(c, F.lit(floor))


def ratio(top: Column, bottom: Column, floor=1) -> Column:
    return top / floored(bottom, floor)
