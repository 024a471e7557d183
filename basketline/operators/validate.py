"""Row rules, reason codes and the valid / rejected split."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from basketline.functions import keys
from basketline.operators.normalize import MISSING_CUSTOMER
from basketline.schemas import CORRUPT

REASON = "validation_reason"

# Reason codes, highest priority first.
DATE_INVALID = "invoice_date_invalid"
QUANTITY_ZERO = "quantity_zero"
PRICE_INVALID = "unit_price_invalid"
CUSTOMER_MISSING = "missing_customer_id"
FIELD_MISSING = "missing_required_field"
# A line that its source's reader could not take apart; comes before all other reasons.
LINE_CORRUPT = "corrupt_record"
REASONS = (LINE_CORRUPT, DATE_INVALID, QUANTITY_ZERO, PRICE_INVALID, CUSTOMER_MISSING, FIELD_MISSING)


def _filled(name: str) -> Column:
    return F.length(F.trim(F.col(name))) > 0


def is_valid(columns: Collection[str] = ()) -> Column:
    """All rules hold. Null counts as a broken rule; a return (negative quantity) is valid.

    ``columns`` are those of the frame: a ``corrupt_record`` among them must be null.
    """
    rules = (
        _filled("invoice_no")
        & _filled("stock_code")
        & _filled("country")
        & F.col("invoice_ts").isNotNull()
        & (F.col("quantity") != 0)
        & (F.col("unit_price") > 0)
        & (F.col("customer_id") != MISSING_CUSTOMER)
    )
    if CORRUPT in columns:
        rules = F.col(CORRUPT).isNull() & rules
    return F.coalesce(rules, F.lit(False))


def reason(columns: Collection[str] = ()) -> Column:
    """Null for a valid row, else the first reason that applies."""
    first = F.when(is_valid(columns), F.lit(None))
    if CORRUPT in columns:
        first = first.when(F.col(CORRUPT).isNotNull(), LINE_CORRUPT)
    return (
        first.when(F.col("invoice_ts").isNull(), DATE_INVALID)
        .when(F.col("quantity") == 0, QUANTITY_ZERO)
        .when(F.col("unit_price") <= 0, PRICE_INVALID)
        .when(F.col("customer_id") == MISSING_CUSTOMER, CUSTOMER_MISSING)
        .otherwise(FIELD_MISSING)
    )


def with_bronze_columns(valid: DataFrame) -> DataFrame:
    return valid.withColumns(
        {
            "transaction_id": keys.transaction_id(),
            "invoice_year": F.year("invoice_ts"),
            "invoice_month": F.month("invoice_ts"),
        }
    )


def valid_lines(normalised: DataFrame) -> DataFrame:
    return with_bronze_columns(normalised.filter(is_valid(normalised.columns)).drop(CORRUPT))


def rejected_lines(normalised: DataFrame) -> DataFrame:
    columns = normalised.columns
    return normalised.filter(~is_valid(columns)).withColumn(REASON, reason(columns))


def split(normalised: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, rejected); every input row is in exactly one of them."""
    return valid_lines(normalised), rejected_lines(normalised)


def reason_counts(normalised: DataFrame) -> DataFrame:
    """Rows per reason, ``'valid'`` included."""
    label = F.coalesce(reason(normalised.columns), F.lit("valid")).alias("reason")
    return normalised.groupBy(label).agg(F.count(F.lit(1)).alias("row_count"))
