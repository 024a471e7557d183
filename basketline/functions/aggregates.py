"""Sums of doubles that are exact, so that they depend neither on row order nor on partitioning.

Adding doubles one by one rounds at each step, and in another order otherwise. Here a value is cut into
whole digits of base ``2**60``, which its binary form allows without error, and each digit is summed as a decimal.
The three digits reach from ``2**-90`` to ``2**93``; every double whose bits lie between is summed without any error, and the total
is rounded to a double once, at the end. What lies outside (a magnitude of 1e28 and more, bits below 1e-27, NaN and infinity)
is added as a plain double on top; it is 0 for anything like money.

``parts`` / ``merged`` / ``total`` / ``mean`` split the work into a first aggregation, further
merging aggregations and a final expression, so that a group may be pre-aggregated on a finer
key first.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS, LOWEST = 60, -90  # of a digit; of the lowest digit's unit
_UNITS = [2.0 ** (LOWEST + BITS * i) for i in range(3)]
_WIDE = "decimal(38,0)"

LONG_MIN, LONG_MAX = -(2**63), 2**63 - 1


def _whole(n: int) -> Column:
    return F.lit(n).cast(_WIDE)


def _names(name: str) -> tuple[str, ...]:
    return f"{name}__low", f"{name}__mid", f"{name}__high", f"{name}__rest", f"{name}__n"


def _digits(c: Column) -> list[Column]:
    """Low, middle and high digit of a double and what they leave; null digits where the high one does not fit."""
    scaled = c * (1 / _UNITS[2])
    high = scaled.try_cast("bigint")
    below = (scaled - high.cast("double")) * 2.0**BITS
    mid = below.cast("bigint")
    last = (below - mid.cast("double")) * 2.0**BITS
    low = last.cast("bigint")
    rest = F.when(high.isNull() | (F.abs(c) < _UNITS[0]), c).otherwise((last - low.cast("double")) * _UNITS[0])
    # 28 decimal places leave a sum room for 1e19 rows
    return [*[digit.cast("decimal(28,0)") for digit in (low, mid, high)], rest]


def parts(c: Column, name: str) -> list[Column]:
    sums = [F.sum(x) for x in _digits(c)]
    return [x.alias(n) for x, n in zip([*sums, F.count(c)], _names(name), strict=True)]


def part_columns(name: str) -> list[str]:
    return list(_names(name))


def merged(name: str) -> list[Column]:
    *digits, rest, n = _names(name)
    return [*[F.sum(d).cast(_WIDE).alias(d) for d in digits], F.sum(rest).alias(rest), F.sum(n).alias(n)]


def _carry(digit: Column) -> tuple[Column, Column]:
    """A sum of digits as one digit, 0 or more, and what goes to the next one up."""
    base = _whole(2**BITS)
    own = F.pmod(digit, base)
    return own, ((digit - own) / base).cast(_WIDE)


def _let(values: list[Column], use) -> Column:
    """``use`` of values that are computed once, however often it names them."""
    packed = F.struct(*[v.alias(f"v{i}") for i, v in enumerate(values)])
    return F.transform(F.array(packed), lambda s: use(*[s[f"v{i}"] for i in range(len(values))]))[0]


def _short(low: Column, mid: Column, high: Column) -> Column:
    """The nearest double where there is no high digit and the others are doubles already, so that one addition rounds; else null."""
    a, b = mid.try_cast("bigint"), low.try_cast("bigint")
    exact = [x.cast("double").try_cast("bigint") == x for x in (a, b)]
    return F.when((high == 0) & exact[0] & exact[1], a.cast("double") * _UNITS[1] + b.cast("double") * _UNITS[0])


def _rounded(low: Column, mid: Column, high: Column) -> Column:
    """The nearest double to the exact sum of the digits."""
    base = _whole(2**BITS)

    def carried(low, mid, high):
        own_low, up = _carry(low)
        return _let([own_low, mid + up, high], lambda a, b, c: _let([a, *_carry(b), c], lambda a, b, up, c: signed(a, b, c + up)))

    def signed(low, mid, high):
        # of a negative sum the digits of its magnitude: the complement, with a borrow from each digit that is not 0
        borrowed = mid + (low > 0).cast("int")
        negative = [F.pmod(-low, base), F.pmod(-borrowed, base), -high - (borrowed > 0).cast("int")]
        sides = [F.when(high < 0, n.cast(_WIDE)).otherwise(p) for n, p in zip(negative, (low, mid, high), strict=True)]
        sign = F.when(high < 0, -1.0).otherwise(1.0)
        return _let([*sides, sign], lambda a, b, c, s: s * nearest(a, b, c))

    def nearest(low, mid, high):
        # two digits hold more than the 53 bits of a double; whatever lies below shows in the last bit alone
        return (
            F.when(high >= base, _odd(high, (mid > 0) | (low > 0)) * _UNITS[2])
            .when(high > 0, _odd(high * base + mid, low > 0) * _UNITS[1])
            .when(mid > 0, _odd(mid * base + low, F.lit(False)) * _UNITS[0])
            .otherwise(low.cast("double") * _UNITS[0])
        )

    return _let([low.cast(_WIDE), mid.cast(_WIDE), high.cast(_WIDE)], carried)


def _odd(whole: Column, more: Column) -> Column:
    """A long whole number as a double, rounded as if ``more`` stood behind it."""
    return (whole.cast(_WIDE) + F.when(more & (whole % 2 == 0), 1).otherwise(0)).cast("double")


def _total(low: Column, mid: Column, high: Column, rest: Column, n: Column) -> Column:
    digits = [F.coalesce(d.cast(_WIDE), _whole(0)) for d in (low, mid, high)]
    return F.when(n > 0, F.coalesce(_short(low, mid, high), _rounded(*digits)) + rest)


def total(name: str) -> Column:
    return _total(*[F.col(c) for c in _names(name)])


def mean(name: str) -> Column:
    # An empty group has n = 0; nullif keeps it null instead of dividing by zero.
    return total(name) / F.nullif(F.col(_names(name)[-1]), F.lit(0).cast("bigint"))


def exact_sum(c: Column) -> Column:
    return _total(*[F.sum(x) for x in _digits(c)], F.count(c))


def exact_mean(c: Column) -> Column:
    return exact_sum(c) / F.nullif(F.count(c), F.lit(0).cast("bigint"))


def wide_sum(c: Column) -> Column:
    """Sum of whole numbers, or of such sums, that longs cannot overflow; a decimal."""
    return F.sum(c.cast("decimal(28,0)")).cast(_WIDE)


def as_long(c: Column) -> Column:
    """A wide sum as a long, held within a long's range."""
    return F.greatest(F.least(c, _whole(LONG_MAX)), _whole(LONG_MIN)).cast("bigint")
