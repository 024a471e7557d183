"""Train / valid / test splits by time or by hash."""

from __future__ import annotations

from typing import Literal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from basketline.functions import calendar, keys
from basketline.session import stored

SPLIT = "split"
TRAIN, VALID, TEST = "train", "valid", "test"
# Percent of rows at or before the end of train and of valid.
TRAIN_PERCENT, VALID_PERCENT = 70, 85
HASH_COLUMNS = ("invoice_no", "customer_id")
SKETCH_K = 400
_SECONDS_PER_DAY = 86_400


def _named_split(position: Column, train_end, valid_end, inclusive: bool) -> Column:
    first, second = (
        (position <= train_end, position <= valid_end)
        if inclusive
        else (position < train_end, position < valid_end)
    )
    return F.when(first, TRAIN).when(second, VALID).when(position.isNotNull(), TEST)


def exact_cuts(df: DataFrame, percents=(TRAIN_PERCENT, VALID_PERCENT), ts: str = "invoice_ts") -> DataFrame:
    """One row ``q<percent>``: smallest second at or before which that percent of rows lies.

    An exact percentile aggregate keeps every distinct value in one buffer. Here rows are counted
    per day, running totals over the days (as many as the calendar has) tell which day holds each
    cut, and only that day's rows are counted per second. Null times are left out.
    """
    second = calendar.epoch_seconds(F.col(ts))
    # read twice, so written once
    times = stored(df.select(second.alias("second")).filter(F.col("second").isNotNull()))
    day = F.floor(F.col("second") / _SECONDS_PER_DAY)

    running = Window.orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_day = (
        times.groupBy(day.alias("day"))
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.sum("n").over(running))
        .withColumn("all", F.sum("n").over(Window.partitionBy()))
    )
    percent = F.explode(F.array(*[F.lit(p).cast("bigint") for p in percents])).alias("percent")
    reached = F.col("upto") * 100 >= F.col("percent") * F.col("all")
    begun = (F.col("upto") - F.col("n")) * 100 < F.col("percent") * F.col("all")
    # One row per percent.
    cut_days = (
        per_day.select("*", percent)
        .filter(reached & begun)
        .select("percent", "day", (F.col("upto") - F.col("n")).alias("before"), "all")
    )
    within = Window.partitionBy("percent").orderBy("second")
    per_second = (
        times.withColumn("day", day)
        .join(F.broadcast(cut_days), "day")
        .groupBy("percent", "before", "all", "second")
        .agg(F.count(F.lit(1)).alias("n"))
        .withColumn("upto", F.col("before") + F.sum("n").over(within))
        .filter(reached)
    )
    return per_second.agg(
        *[F.min(F.when(F.col("percent") == p, F.col("second"))).alias(f"q{p}") for p in percents]
    )


def approx_cuts(
    df: DataFrame, percents=(TRAIN_PERCENT, VALID_PERCENT), error: float = 0.01, ts: str = "invoice_ts"
) -> DataFrame:
    """The same within a rank error, in one pass over a quantile sketch."""
    second = calendar.epoch_seconds(F.col(ts))
    accuracy = F.lit(round(1 / error))
    return df.agg(
        *[F.percentile_approx(second, F.lit(p / 100), accuracy).alias(f"q{p}") for p in percents]
    )


def time_sketches(df: DataFrame, ts: str = "invoice_ts", k: int = SKETCH_K) -> DataFrame:
    """Per month a mergeable quantile sketch of the times, to be stored: new rows need a look at themselves only."""
    second = calendar.epoch_seconds(F.col(ts))
    timed = df.filter(F.col(ts).isNotNull())
    return timed.groupBy(F.trunc(F.col(ts).cast("date"), "month").alias("month")).agg(
        F.count(F.lit(1)).alias("row_count"), F.kll_sketch_agg_bigint(second, F.lit(k)).alias("times")
    )


def cuts_from_sketches(sketches: DataFrame, percents=(TRAIN_PERCENT, VALID_PERCENT)) -> DataFrame:
    """``exact_cuts`` within the rank error of the merged sketches, without reading any row again.

    A sketch of ``SKETCH_K`` has a rank error of about one percent. No sketches give a row of nulls.
    """
    merged = sketches.agg(F.kll_merge_agg_bigint("times").alias("times"))
    filled = F.kll_sketch_get_n_bigint("times") > 0  # an empty sketch has no quantile to ask for
    return merged.select(
        *[F.when(filled, F.kll_sketch_get_quantile_bigint("times", F.lit(p / 100))).alias(f"q{p}") for p in percents]
    )


def hash_split(position: Column) -> Column:
    """Split name from a 0..99 bucket."""
    return _named_split(position, TRAIN_PERCENT, VALID_PERCENT, inclusive=False)


def assign_hash_split(df: DataFrame, columns=HASH_COLUMNS, portable: bool = True) -> DataFrame:
    """``split_id`` and ``split`` by content hash; ``portable`` uses md5, else Spark's own hash."""
    bucket = keys.md5_bucket(*columns) if portable else keys.fast_bucket(*columns)
    return df.withColumn("split_id", bucket).withColumn(SPLIT, hash_split(F.col("split_id")))


def assign_temporal_split(
    df: DataFrame,
    mode: Literal["exact", "approx"] = "exact",
    error: float = 0.01,
    ts: str = "invoice_ts",
    hash_columns=HASH_COLUMNS,
    cuts: DataFrame | None = None,
) -> DataFrame:
    """Add ``event_ts`` (seconds) and ``split``: 70 / 15 / 15 percent in time order.

    ``cuts`` gives the two cuts instead of having them computed, such as ``cuts_from_sketches``.

    Rows of one second stay together on the earlier side; a row without a time is in no split.
    Only if no row has a time is everything split by hash instead.
    """
    if cuts is None:
        cuts = exact_cuts(df, ts=ts) if mode == "exact" else approx_cuts(df, error=error, ts=ts)
    both = cuts.select(F.struct("*")).scalar()
    train_end, valid_end = both[f"q{TRAIN_PERCENT}"], both[f"q{VALID_PERCENT}"]
    timed = df.withColumn("event_ts", calendar.epoch_seconds(F.col(ts)))
    by_time = _named_split(F.col("event_ts"), train_end, valid_end, inclusive=True)
    by_hash = hash_split(keys.md5_bucket(*hash_columns))
    return timed.withColumn(SPLIT, F.when(train_end.isNull(), by_hash).otherwise(by_time))


def parts(split: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train, valid, test) frames of a frame with a ``split`` column."""
    return tuple(split.filter(F.col(SPLIT) == name).drop(SPLIT) for name in (TRAIN, VALID, TEST))


def train_and_valid(split: DataFrame) -> DataFrame:
    """Train and valid rows stacked, for cross-validation."""
    train, valid, _ = parts(split)
    return train.unionByName(valid)


def split_counts(split: DataFrame) -> DataFrame:
    return split.groupBy(SPLIT).agg(F.count(F.lit(1)).alias("row_count"))
