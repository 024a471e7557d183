"""Report queries over the metric tables, which hold one row per country."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.functions import aggregates as agg
from basketline.operators.dedupe import TRANSACTION_KEY


def dq_kpis(dq: DataFrame) -> DataFrame:
    """KPI cards: total rows, mean duplicate ratio, mean price over countries."""
    return dq.agg(
        F.sum("rows_after_cleaning").alias("rows_after_cleaning"),
        agg.exact_mean(F.col("duplicate_ratio")).alias("avg_duplicate_ratio"),
        agg.exact_mean(F.col("avg_unit_price")).alias("avg_unit_price"),
    )


def duplicate_anomalies(dq: DataFrame) -> DataFrame:
    """Countries by share of duplicates, worst first."""
    return dq.select("country", "rows_after_cleaning", "duplicate_ratio").orderBy(
        F.desc("duplicate_ratio"), "country"
    )


def top_return_countries(sales: DataFrame, k: int = 10) -> DataFrame:
    """The ``k`` countries with most returns per invoice, revenue deciding ties."""
    return (
        sales.select("country", "region", "return_line_ratio", "gross_revenue")
        .orderBy(F.desc("return_line_ratio"), F.desc("gross_revenue"), "country")
        .limit(k)
    )


def region_ranking(enriched: DataFrame) -> DataFrame:
    """Region table by revenue. Customers and invoices are counted once per region.

    Read from lines, because distinct counts of countries do not add up to those of a region.
    """
    pairs = enriched.groupBy("region", "invoice_no", "customer_id").agg(
        *agg.parts(F.col("line_total"), "line_total")
    )
    return (
        pairs.groupBy("region")
        .agg(
            F.count_distinct("invoice_no").alias("invoice_count"),
            F.count_distinct("customer_id").alias("customer_count"),
            *agg.merged("line_total"),
        )
        .select(
            "region",
            "invoice_count",
            "customer_count",
            agg.mean("line_total").alias("avg_line_total"),
            agg.total("line_total").alias("gross_revenue"),
        )
        .orderBy(F.desc("gross_revenue"), "region")
    )


def country_quality(dq: DataFrame) -> DataFrame:
    """Countries by rows, for the quality chart."""
    return dq.select("country", "rows_after_cleaning").orderBy(F.desc("rows_after_cleaning"), "country")


def table_counts(valid: DataFrame, rejected: DataFrame, key_cols=TRANSACTION_KEY) -> DataFrame:
    """Long table of row counts: valid, rejected and deduplicated rows."""
    keys = valid.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))
    kept = keys.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("valid_rows"), F.count(F.lit(1)).alias("curated_rows")
    )
    curated = kept.unpivot([], ["valid_rows", "curated_rows"], "table_name", "row_count")
    others = rejected.agg(F.count(F.lit(1)).alias("row_count")).select(
        F.lit("rejected_rows").alias("table_name"), "row_count"
    )
    return curated.unionByName(others)
