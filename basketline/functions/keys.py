"""Content-derived keys, buckets and pseudo-random numbers, stable under repartitioning."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Separator and columns of the transaction hash.
TRANSACTION_SEPARATOR = "||"
TRANSACTION_COLUMNS = ("invoice_no", "stock_code", "invoice_date", "customer_id")


def transaction_id() -> Column:
    return F.sha2(F.concat_ws(TRANSACTION_SEPARATOR, *TRANSACTION_COLUMNS), 256)


def md5_word(*cols) -> Column:
    """First 32 bits of an md5 over the columns, as a bigint in [0, 2**32)."""
    digest = F.md5(F.concat_ws("|", *cols).cast("binary"))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("bigint")


def md5_bucket(*cols, buckets: int = 100) -> Column:
    """Bucket any SQL engine can recompute."""
    return md5_word(*cols) % F.lit(buckets)


def fast_bucket(*cols, buckets: int = 100) -> Column:
    """Bucket by Spark's own 64-bit hash: cheaper, but Spark-only."""
    return F.pmod(F.xxhash64(*cols), F.lit(buckets))


def md5_unit(*cols) -> Column:
    """Uniform number in [0, 1) derived from the columns."""
    return md5_word(*cols) / F.lit(4294967296.0)


# Cumulative Poisson(1) probabilities of 0..11. The largest 32-bit draw, 1 - 2**-32, lies between those of 11 and 12,
# so 12 is the largest weight that a draw can reach: the table is whole, not cut.
POISSON_ONE_CUTS = tuple(math.exp(-1) * math.fsum(1 / math.factorial(j) for j in range(k + 1)) for k in range(12))


def poisson_draw(*cols) -> Column:
    """Poisson(1) draw from an md5 over the columns: ``poisson_one(md5_unit(*cols))`` without the way over numbers.

    The digits of a digest are in the order of the number that they say, so it is held against the first eight
    digits of the smallest number at or above each cut.
    """
    digest = F.md5(F.concat_ws("|", *cols).cast("binary"))
    limits = [f"{math.ceil(cut * 2**32):08x}" for cut in POISSON_ONE_CUTS]
    weight = F.when(digest < limits[0], 0)
    for k, limit in enumerate(limits[1:], start=1):
        weight = weight.when(digest < limit, k)
    return weight.otherwise(len(limits))


def poisson_one(u: Column) -> Column:
    """Poisson(1) draw from a uniform number by the inverse distribution function."""
    weight = F.when(u < POISSON_ONE_CUTS[0], 0)
    for k, cut in enumerate(POISSON_ONE_CUTS[1:], start=1):
        weight = weight.when(u < cut, k)
    return weight.otherwise(len(POISSON_ONE_CUTS))
