"""Source cells to typed, defaulted columns. Narrow: one projection, no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from basketline.functions import casts
from basketline.schemas import CORRUPT, SOURCE_COLUMNS

MISSING_CUSTOMER = "-1"
UNKNOWN = "unknown"


def rename_source(df: DataFrame, names: Mapping[str, str] = SOURCE_COLUMNS) -> DataFrame:
    """Keep the known source columns under their own names and drop every other one."""
    return df.select(*[F.col(f"`{source}`").alias(ours) for source, ours in names.items()])


def date_formats_of(df: DataFrame, formats: Sequence[str] = casts.KNOWN_FORMATS, column: str = "invoice_date") -> list[str]:
    """Which formats a text column is written in, the one that reads most cells first.

    One pass over that column. A cell such as 3/4/2011 fits day first as well as month first; those that fit one only,
    13/4/2011, decide for the column. Formats that read nothing are left out.
    """
    counts = df.agg(casts.formats_read(F.col(column), formats)).first()[0]
    order = sorted(range(len(formats)), key=lambda i: (-counts[i], i))
    return [formats[i] for i in order if counts[i]]


def normalise(
    df: DataFrame, ingested_at: str | None = None, date_formats: Sequence[str] = casts.DATE_FORMATS
) -> DataFrame:
    """Type and default the eight renamed source columns and derive the line columns.

    Missing ids become ``''``, missing text ``'unknown'``, unreadable numbers 0, a missing or
    unreadable customer ``'-1'``; an unreadable date stays null. Validation decides what that
    means, so no row is dropped here. ``ingested_at`` is the batch time, given by the caller so
    that a retry writes the same rows. A ``corrupt_record`` column is passed on.
    """
    is_text = {f.name: isinstance(f.dataType, StringType) for f in df.schema.fields}
    empty = F.lit("")
    corrupt = [c for c in (CORRUPT,) if c in df.columns]
    date_text, date_time = casts.wall_clock(F.col("invoice_date"), date_formats, is_text["invoice_date"])
    typed = df.select(
        F.coalesce(casts.stripped(F.col("invoice_no")), empty).alias("invoice_no"),
        F.coalesce(casts.stripped(F.col("stock_code")), empty).alias("stock_code"),
        casts.text_or(F.col("description"), UNKNOWN).alias("description"),
        casts.long_or(F.col("quantity"), 0, is_text["quantity"]).alias("quantity"),
        date_text.alias("invoice_date"),
        date_time.alias("invoice_ts"),
        casts.double_or(F.col("unit_price"), 0.0, is_text["unit_price"]).alias("unit_price"),
        casts.long_or(F.col("customer_id"), int(MISSING_CUSTOMER), is_text["customer_id"])
        .cast("string")
        .alias("customer_id"),
        casts.stripped(casts.text_or(F.col("country"), UNKNOWN)).alias("country"),
        *corrupt,
    )
    return typed.select(
        "invoice_no",
        "stock_code",
        "description",
        "quantity",
        "invoice_date",
        "invoice_ts",
        "unit_price",
        "customer_id",
        "country",
        (F.col("quantity") * F.col("unit_price")).alias("line_total"),
        (F.col("quantity") < 0).cast("int").alias("is_return"),
        F.lit(ingested_at).cast("string").alias("ingested_at_utc"),
        *corrupt,
    )


def record_cap(df: DataFrame, max_records: int, *order) -> DataFrame:
    """First ``max_records`` rows by ``order``; 0 means all. A trial-run feature, not a sampler."""
    if max_records <= 0:
        return df
    return df.orderBy(*order).limit(max_records)
