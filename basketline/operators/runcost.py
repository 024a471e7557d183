"""Cost, throughput and efficiency of recorded runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.functions import aggregates as agg
from basketline.functions import ratios

# Profile text, dollars per core hour and per GB hour.
PROFILE_PATTERN = r"^E(\d+)_C(\d+)_M(\d+)$"
DOLLARS_PER_CORE_HOUR = 0.03
DOLLARS_PER_GB_HOUR = 0.004

STRONG, WEAK = "strong", "weak"


def with_profile(runs: DataFrame) -> DataFrame:
    """Executors, cores and memory of a profile such as ``E4_C4_M16``; null if it is not one."""
    parts = {
        name: F.regexp_extract("resource_profile", PROFILE_PATTERN, i).try_cast("int")
        for i, name in enumerate(("executors", "cores", "memory_gb"), start=1)
    }
    return runs.withColumns(parts)


def with_cost(runs: DataFrame) -> DataFrame:
    hourly = (
        F.lit(DOLLARS_PER_CORE_HOUR) * F.col("executors") * F.col("cores")
        + F.lit(DOLLARS_PER_GB_HOUR) * F.col("executors") * F.col("memory_gb")
    )
    priced = with_profile(runs).withColumn("estimated_cost_usd", hourly * (F.col("runtime_sec") / 3600))
    rows = F.col("result_rows")
    return priced.withColumns(
        {
            "throughput_rows_per_sec": ratios.ratio(rows, F.col("runtime_sec"), 0.001),
            "cost_per_1000_rows": ratios.ratio(F.col("estimated_cost_usd"), rows, 1) * 1000.0,
        }
    )


def with_efficiency(runs: DataFrame) -> DataFrame:
    """``strong_efficiency``: fastest strong run over this one; null for weak runs.

    The fastest runtime is a global aggregate, not a window: the two modes would make two tasks.
    """
    strong = F.col("mode") == STRONG
    fastest = runs.agg(F.min(F.when(strong, F.col("runtime_sec")))).scalar()
    runtime = F.when(F.col("runtime_sec") > 0, F.col("runtime_sec"))
    return runs.withColumn("strong_efficiency", F.when(strong, fastest / runtime))


def run_cost(runs: DataFrame) -> DataFrame:
    return with_efficiency(with_cost(runs))


def profile_costs(runs: DataFrame) -> DataFrame:
    """Mean runtime and mean cost per 1000 rows of each profile."""
    return (
        with_cost(runs)
        .groupBy("resource_profile")
        .agg(
            agg.exact_mean(F.col("runtime_sec")).alias("runtime_sec"),
            agg.exact_mean(F.col("cost_per_1000_rows")).alias("cost_per_1000_rows"),
        )
    )


def recommend(runs: DataFrame) -> DataFrame:
    """The fastest, the cheapest and the balanced profile.

    Balanced has the least sum of runtime and cost, each in multiples of the best one. Ties go to
    the smaller name. A profile without a known figure, or whose mean runtime is not positive and so was not
    measured, comes after all others.
    """
    profiles = profile_costs(runs)
    measured = F.col("runtime_sec") > 0
    runtime = F.when(measured, F.col("runtime_sec"))
    cost = F.when(measured, F.col("cost_per_1000_rows"))
    least = profiles.agg(F.struct(F.min(runtime).alias("runtime"), F.min(cost).alias("cost"))).scalar()
    both = F.try_divide(runtime, least["runtime"]) + F.try_divide(cost, least["cost"])
    row = ("resource_profile", "runtime_sec", "cost_per_1000_rows")

    def best(by) -> Column:
        return F.min_by(F.struct(*row), F.struct(by.isNull(), by, F.col("resource_profile")))

    picks = profiles.agg(
        best(runtime).alias("Fastest"), best(cost).alias("Cheapest"), best(both).alias("Balanced")
    )
    long = picks.unpivot([], ["Fastest", "Cheapest", "Balanced"], "recommendation", "pick")
    return long.select("recommendation", *[F.col(f"pick.{c}").alias(c) for c in row])
