"""Country repair and the country dimension join."""

from __future__ import annotations

import logging
from typing import Literal

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.operators.normalize import UNKNOWN
from basketline.schemas import COUNTRY_DIM

log = logging.getLogger(__name__)

JoinStrategy = Literal["auto", "broadcast", "merge"]

DEFAULT_REGION = UNKNOWN
DEFAULT_RISK = 3
BROADCAST_ROW_LIMIT = 100_000
# Enough to tell lines apart; hashing every column would keep every column in the scan.
SALT_COLUMNS = ("transaction_id", "invoice_no", "stock_code")

# Country, region, shipping risk score.
COUNTRY_ROWS = [
    ("United Kingdom", "europe", 1),
    ("Germany", "europe", 1),
    ("France", "europe", 1),
    ("Netherlands", "europe", 1),
    ("EIRE", "europe", 1),
    ("Australia", "apac", 2),
    ("Japan", "apac", 2),
    ("USA", "americas", 2),
    ("Canada", "americas", 2),
    ("unknown", "unknown", 3),
]


def country_dim(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame(COUNTRY_ROWS, COUNTRY_DIM)


def repair_country(df: DataFrame) -> DataFrame:
    blank = F.length(F.trim("country")) == 0
    return df.withColumn("country", F.when(blank, UNKNOWN).otherwise(F.col("country")))


def small_enough(dim: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT) -> bool:
    """Whether ``dim`` has at most ``row_limit`` rows; reads no more than that."""
    return dim.limit(row_limit + 1).count() <= row_limit


def require_unique(dim: DataFrame, key: str = "country") -> None:
    """Raise if a key is in the dimension twice: each of its lines would come out of the join twice."""
    twice = dim.groupBy(key).count().filter("count > 1").select(key).limit(5).collect()
    if twice:
        raise ValueError(f"the dimension has more than one row of {', '.join(str(r[0]) for r in twice)}")


def effective(strategy: JoinStrategy, dim: DataFrame, row_limit: int = BROADCAST_ROW_LIMIT) -> JoinStrategy:
    """The strategy that will be used: a broadcast of too large a dimension becomes a merge join, with a warning."""
    if strategy not in ("auto", "broadcast", "merge"):
        raise ValueError(f"unknown join strategy: {strategy}")
    if strategy == "broadcast" and not small_enough(dim, row_limit):
        log.warning("the dimension has more than %d rows: merge join instead of broadcast", row_limit)
        return "merge"
    return strategy


def heavy_keys(keys_of: DataFrame, tasks: int, key: str = "country") -> DataFrame:
    """(key, salts) of the keys with more than one task's share of the rows, and how many shares that is.

    Counted over all rows, folded before the shuffle. There are fewer such keys than ``tasks``, which bounds their broadcast.
    """
    counts = keys_of.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    shares = F.col("n") * tasks / counts.agg(F.sum("n")).scalar()
    return counts.withColumn("salts", F.ceil(shares).cast("int")).filter("salts > 1").select(key, "salts")


def _merged(lines: DataFrame, dim: DataFrame, measured: DataFrame, tasks: int) -> DataFrame:
    heavy = F.broadcast(heavy_keys(measured, tasks))
    spread = [c for c in SALT_COLUMNS if c in lines.columns] or [c for c in lines.columns if c != "country"]
    # lines without a country match nothing; they are spread over all tasks, so as not to meet in one
    salts = F.when(F.col("country").isNull(), tasks).otherwise(F.coalesce("salts", F.lit(1)))
    salt = F.pmod(F.xxhash64(*spread), salts).cast("int").alias("salt")
    salted = lines.join(heavy, "country", "left").select(*lines.columns, salt)
    copies = dim.join(heavy, "country", "left").withColumn(
        "salt", F.explode(F.sequence(F.lit(0), F.coalesce("salts", F.lit(1)) - 1))
    )
    return salted.join(copies.drop("salts").hint("merge"), ["country", "salt"], "left").drop("salt")


def enrich(
    lines: DataFrame,
    dim: DataFrame,
    strategy: JoinStrategy = "auto",
    row_limit: int = BROADCAST_ROW_LIMIT,
    measured: DataFrame | None = None,
    tasks: int | None = None,
) -> DataFrame:
    """Left join of a dimension with unique ``country``; unmatched rows get the defaults.

    ``auto`` leaves the choice to Catalyst and AQE, which know the sizes. ``broadcast`` asks for
    a broadcast, but only after counting the dimension; a larger one goes the ``merge`` way (see ``effective``).
    ``merge`` is a sort-merge join in which a country with more than one task's share of the lines is cut into as many
    salted shares, and the dimension copied for such countries only. The shares are counted on ``measured``, any frame
    with the lines' countries, such as the table that they come from (default: the lines themselves);
    ``tasks`` defaults to the session's shuffle partitions.
    """
    dim = dim.select("country", "region", "shipping_risk_score")
    strategy = effective(strategy, dim, row_limit)
    if strategy == "broadcast":
        joined = lines.join(F.broadcast(dim), "country", "left")
    elif strategy == "merge":
        tasks = tasks or int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        joined = _merged(lines, dim, lines if measured is None else measured, tasks)
    else:
        joined = lines.join(dim, "country", "left")
    filled = joined.fillna({"region": DEFAULT_REGION, "shipping_risk_score": DEFAULT_RISK})
    return filled.select(*lines.columns, "region", "shipping_risk_score")
