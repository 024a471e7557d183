"""Sales, return and data-quality metrics per country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.functions import aggregates as agg
from basketline.functions import calendar, ratios
from basketline.operators.dedupe import dedupe

PLACE = ("country", "region")
LG_K = 12  # hashes that a distinct sketch keeps, as a power of two


def sales_metrics_from_baskets(summary: DataFrame) -> DataFrame:
    """Sales metrics from ``basket_summary`` rows.

    ``return_line_ratio`` is return lines per distinct invoice, so it may exceed 1;
    ``return_line_share`` is return lines per line.
    """
    totals = summary.groupBy(*PLACE).agg(
        F.count_distinct("invoice_no").alias("invoice_count"),
        F.count_distinct("customer_id").alias("customer_count"),
        *agg.merged("line_total"),
        F.sum("return_line_count").alias("return_line_count"),
        F.sum("line_count").alias("line_count"),
    )
    returns = F.col("return_line_count")
    return totals.select(
        *PLACE,
        "invoice_count",
        "customer_count",
        agg.total("line_total").alias("gross_revenue"),
        agg.mean("line_total").alias("avg_line_total"),
        "return_line_count",
        ratios.ratio(returns, F.col("invoice_count")).alias("return_line_ratio"),
        ratios.ratio(returns, F.col("line_count")).alias("return_line_share"),
    )


def sales_metrics(enriched: DataFrame) -> DataFrame:
    """Sales metrics straight from enriched lines.

    Two distinct counts make Spark write every input row three times. One row per invoice and
    customer is many times fewer than one per line, so lines are folded to that first.
    """
    summary = enriched.groupBy(*PLACE, "invoice_no", "customer_id").agg(
        *agg.parts(F.col("line_total"), "line_total"),
        F.sum("is_return").cast("bigint").alias("return_line_count"),
        F.count(F.lit(1)).alias("line_count"),
    )
    return sales_metrics_from_baskets(summary)


def dq_metrics(valid: DataFrame) -> DataFrame:
    """Data quality per country, exact, from valid lines *before* deduping.

    The duplicate ratio is the share of rows that deduping removes, counted while deduping: no
    distinct count of its own. A group of copies counts for the country of the row kept.
    """
    columns = ["transaction_id", "country", "quantity", "unit_price"]
    kept = dedupe(valid.select(*columns), copies="copies")
    totals = kept.groupBy("country").agg(
        F.sum("copies").alias("rows_before_dedupe"),
        F.count(F.lit(1)).alias("rows_after_cleaning"),
        *agg.parts(F.col("unit_price"), "unit_price"),
        agg.wide_sum(F.col("quantity")).alias("net_units"),
    )
    return _dq_columns(totals)


def dq_metrics_from_baskets(summary: DataFrame) -> DataFrame:
    """The same from ``basket_summary`` rows made of lines that carried their ``copies``."""
    totals = summary.groupBy("country").agg(
        F.sum("rows_before_dedupe").alias("rows_before_dedupe"),
        F.sum("line_count").alias("rows_after_cleaning"),
        *agg.merged("unit_price"),
        agg.wide_sum(F.col("net_units")).alias("net_units"),
    )
    return _dq_columns(totals)


def _dq_columns(totals: DataFrame) -> DataFrame:
    after, before = F.col("rows_after_cleaning"), F.col("rows_before_dedupe")
    return totals.select(
        "country",
        "rows_before_dedupe",
        "rows_after_cleaning",
        after.alias("unique_transactions"),
        agg.mean("unit_price").alias("avg_unit_price"),
        (F.col("net_units").cast("double") / after).alias("avg_quantity"),
        (1 - after / before).alias("duplicate_ratio"),
    )


def dq_metrics_approx(lines: DataFrame, rsd: float = 0.05) -> DataFrame:
    """One pass with a distinct sketch: cheaper, but the ratio is only as good as ``rsd``."""
    return (
        lines.groupBy("country")
        .agg(
            F.count(F.lit(1)).alias("rows_after_cleaning"),
            F.approx_count_distinct("transaction_id", rsd).alias("unique_transactions"),
            agg.exact_mean(F.col("unit_price")).alias("avg_unit_price"),
            (agg.wide_sum(F.col("quantity")).cast("double") / F.count("quantity")).alias("avg_quantity"),
        )
        .withColumn(
            "duplicate_ratio",
            F.greatest(F.lit(0.0), 1 - F.col("unique_transactions") / F.col("rows_after_cleaning")),
        )
    )


def dq_sketches(lines: DataFrame, lg_k: int = LG_K) -> DataFrame:
    """Per day and country what ``dq_metrics_from_sketches`` needs, to be stored: counts, sums and a distinct sketch.

    The sketch keeps the smallest hashes of a day's transactions, at most some thousands whatever their number, and a day
    is added without a look at the others. (A register sketch is smaller, but its united estimate depends on the order
    of the union.)
    """
    return lines.groupBy(F.to_date("invoice_ts").alias("day"), "country").agg(
        F.count(F.lit(1)).alias("line_count"),
        F.theta_sketch_agg("transaction_id", lg_k).alias("transactions"),
        *agg.parts(F.col("unit_price"), "unit_price"),
        agg.wide_sum(F.col("quantity")).alias("net_units"),
    )


def dq_metrics_from_sketches(sketches: DataFrame) -> DataFrame:
    """``dq_metrics_approx`` of any set of ``dq_sketches`` rows, days or countries left out as one likes.

    Sketches are united, never added: a transaction that occurs on two days counts once. The relative standard
    error is ``sketch_error(lg_k)``, and nothing up to ``2**lg_k`` transactions. The same lines give the same figures, however
    they were cut into sketches.
    """
    merged = sketches.groupBy("country").agg(
        F.sum("line_count").alias("rows_after_cleaning"),
        F.theta_sketch_estimate(F.theta_union_agg("transactions")).alias("unique_transactions"),
        *agg.merged("unit_price"),
        agg.wide_sum(F.col("net_units")).alias("net_units"),
    )
    rows = F.col("rows_after_cleaning")
    return merged.select(
        "country",
        "rows_after_cleaning",
        "unique_transactions",
        agg.mean("unit_price").alias("avg_unit_price"),
        (F.col("net_units").cast("double") / rows).alias("avg_quantity"),
        F.greatest(F.lit(0.0), 1 - F.col("unique_transactions") / rows).alias("duplicate_ratio"),
    )


def sketch_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct sketch of ``2**lg_k`` hashes."""
    return (2**lg_k - 1) ** -0.5


def weekly_returns(lines: DataFrame) -> DataFrame:
    """Return lines per country and week (weeks start on Monday)."""
    week = calendar.week_start(F.col("invoice_ts")).alias("week_start")
    return (
        lines.groupBy("country", week)
        .agg(
            F.count(F.lit(1)).alias("line_count"),
            F.sum("is_return").cast("bigint").alias("return_line_count"),
        )
        .withColumn("return_ratio", F.col("return_line_count") / F.col("line_count"))
    )


def place_rollup(invoices: DataFrame) -> DataFrame:
    """Invoices per region and country with their averages, largest first."""
    return (
        invoices.groupBy("region", "country")
        .agg(
            F.count(F.lit(1)).alias("invoice_rows"),
            agg.exact_mean(F.col("invoice_total")).alias("avg_invoice_total"),
            (agg.wide_sum(F.col("total_units")).cast("double") / F.count("total_units")).alias("avg_total_units"),
            F.avg("shipping_risk_score").alias("risk"),
        )
        .orderBy(F.desc("invoice_rows"), "region", "country")
    )
