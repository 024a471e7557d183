"""Lenient conversions: a bad cell becomes a default value, never a failed job.

They are kept short on purpose: normalising and validating is one generated method, and the JVM
does not compile a method of more than 8000 bytes, which would make it several times slower.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Every character Python's str.strip() removes; SQL trim() alone removes only the blank.
WHITESPACE = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


def stripped(c: Column) -> Column:
    return F.btrim(c.cast("string"), F.lit(WHITESPACE))


def text_or(c: Column, default: str) -> Column:
    return F.coalesce(c.cast("string"), F.lit(default))


# Fixed value: numbers the JVM reads but which are no numbers in a data file, such as 5d or 2.5F.
JVM_SUFFIX = r"[dDfF]\s*$"


def _as_double(c: Column, is_text: bool) -> Column:
    number = c.try_cast("double")
    return F.when(~c.rlike(JVM_SUFFIX), number) if is_text else number


def double_or_null(c: Column, is_text: bool = True) -> Column:
    """Finite double, else null."""
    number = _as_double(c, is_text)
    # NaN sorts above infinity in Spark, so one comparison drops both.
    return F.when(F.abs(number) < F.lit(math.inf), number)


def long_or_null(c: Column, is_text: bool = True) -> Column:
    """Whole number; a fraction is cut off. Direct first, so ids above 2**53 stay exact."""
    return F.coalesce(c.try_cast("bigint"), _as_double(c, is_text).try_cast("bigint"))


def double_or(c: Column, default: float, is_text: bool = True) -> Column:
    return F.coalesce(double_or_null(c, is_text), F.lit(float(default)))


def long_or(c: Column, default: int, is_text: bool = True) -> Column:
    return F.coalesce(long_or_null(c, is_text), F.lit(default).cast("bigint"))


# Fixed value: the layout of a wall-clock text, as a LIKE pattern.
WALL_CLOCK_LAYOUT = "____-__-__ __:__:__"


# Read besides ISO text unless the caller names others: month first, the time and its seconds optional.
DATE_FORMATS = ("M/d/yyyy[ H:mm[:ss]]",)
# What a column is tried on to find its own formats.
KNOWN_FORMATS = (
    *DATE_FORMATS,
    "d/M/yyyy[ H:mm[:ss]]",
    "d.M.yyyy[ H:mm[:ss]]",
    "yyyy/M/d[ H:mm[:ss]]",
    "d-MMM-yyyy[ H:mm[:ss]]",
    "yyyyMMdd[ HHmmss]",
)


def by_pattern(c: Column, pattern: str) -> Column:
    """The wall-clock time that a text says by a datetime pattern, null where it does not fit.

    Patterns are read as instants only. The text is read as one of UTC and counted from the epoch, so no session zone, nor
    an hour that it skips or repeats, has a part in it.
    """
    instant = F.try_to_timestamp(F.concat(c, F.lit(" +0000")), F.lit(f"{pattern} Z"))
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    return epoch + F.make_dt_interval(secs=F.unix_seconds(instant))


def formats_read(c: Column, formats: Sequence[str] = KNOWN_FORMATS) -> Column:
    """An aggregate: how many cells of a text column each format reads, of those that are no ISO text."""
    other = c.try_cast("timestamp_ntz").isNull()
    return F.array(*[F.count_if(other & by_pattern(c, f).isNotNull()) for f in formats])


def wall_clock(c: Column, formats: Sequence[str] = DATE_FORMATS, is_text: bool = True) -> tuple[Column, Column]:
    """(``yyyy-MM-dd HH:mm:ss`` text, timestamp) of a date cell, null when unreadable.

    Sub-seconds are cut. ISO text (or a date/time column) is read by a cast, which is cheaper than a pattern parser; of the
    ``formats`` the first that fits wins. Text that already has the layout is passed on, since writing a time
    out costs more than reading it.
    """
    iso = c.try_cast("timestamp_ntz")
    text = c.cast("string")
    as_is = iso.isNotNull() & text.like(WALL_CLOCK_LAYOUT)
    parsed = F.coalesce(iso, *[by_pattern(c, f) for f in formats]) if is_text else iso
    written = F.left(parsed.cast("string"), F.lit(19))
    return (
        F.when(as_is, text).otherwise(written),
        F.when(as_is, iso).otherwise(written.cast("timestamp_ntz")),
    )
