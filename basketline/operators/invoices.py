"""Line to invoice rollup with basket and calendar features."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.functions import aggregates as agg
from basketline.functions import calendar
from basketline.schemas import INVOICE_KEYS, MODEL_FEATURES
from basketline.session import ROWS_PER_TASK, dealt

FEATURE_COLUMNS = MODEL_FEATURES.fieldNames()
BASKET_COLUMNS = FEATURE_COLUMNS[: FEATURE_COLUMNS.index("days_to_next_order")]


def giant_invoice(lines: DataFrame, more_than: int = ROWS_PER_TASK) -> bool:
    """Whether an invoice number has more lines than a task should hold."""
    counts = lines.groupBy("invoice_no").agg(F.count(F.lit(1)).alias("n"))
    return counts.agg(F.coalesce(F.max("n"), F.lit(0))).first()[0] > more_than


def basket_summary(
    enriched: DataFrame, one_line_per_item: bool = False, tasks: int | None = None, large: bool = False
) -> DataFrame:
    """Mergeable per-invoice totals: the one wide aggregation every gold table is derived from.

    An invoice with several timestamps gives several rows. ``one_line_per_item`` says that lines
    were deduplicated on a key made of invoice, item, time and customer; then each item occurs
    once in a group and counting lines replaces the exact distinct count and its extra shuffle.
    A ``copies`` column, if there is one, tells how many rows each line stood for before deduping.
    ``tasks`` (see ``session.tasks_for``) bounds what a task holds while it counts distinct items; a large invoice stays spread
    by its items. Of ``large`` lines (see ``session.is_large``) the invoices are counted first: if none is so large, whole invoices are
    dealt out, and the distinct count needs no second exchange. Units are wide decimals, which no quantities can overflow; the features hold them within a long's range.
    """
    copies = F.col("copies") if "copies" in enriched.columns else F.lit(1)
    items = F.count("stock_code") if one_line_per_item else F.count_distinct("stock_code")
    if tasks and not one_line_per_item:
        spread = [] if large and not giant_invoice(enriched) else ["stock_code"]
        enriched = dealt(enriched, tasks, *INVOICE_KEYS, *spread)
    return enriched.groupBy(*INVOICE_KEYS).agg(
        *agg.parts(F.col("line_total"), "line_total"),
        *agg.parts(F.col("unit_price"), "unit_price"),
        agg.wide_sum(F.col("quantity")).alias("net_units"),
        agg.wide_sum(F.abs(F.col("quantity").cast("decimal(20,0)"))).alias("total_units"),
        items.alias("unique_items"),
        F.max("is_return").alias("has_return_line"),
        F.sum("is_return").cast("bigint").alias("return_line_count"),
        F.count(F.lit(1)).alias("line_count"),
        F.sum(copies).alias("rows_before_dedupe"),
    )


def basket_features(summary: DataFrame) -> DataFrame:
    """The feature columns of ``basket_summary`` rows that need no look at other invoices."""
    return summary.withColumns(
        {
            "invoice_total": agg.total("line_total"),
            "total_units": agg.as_long(F.col("total_units")),
            "avg_unit_price": agg.mean("unit_price"),
            "is_weekend": calendar.is_weekend(F.col("invoice_ts")),
            "invoice_hour": F.hour("invoice_ts"),
            "invoice_year": F.year("invoice_ts"),
            "invoice_month": F.month("invoice_ts"),
        }
    ).select(*BASKET_COLUMNS)


def invoice_baskets(
    enriched: DataFrame, one_line_per_item: bool = False, tasks: int | None = None, large: bool = False
) -> DataFrame:
    return basket_features(basket_summary(enriched, one_line_per_item, tasks, large))
