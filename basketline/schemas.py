"""Declared schemas. Nothing is inferred on read.

Times are ``timestamp_ntz``: an invoice time is a wall-clock reading without a zone, so no
result depends on the session time zone.
"""

from __future__ import annotations

from pyspark.sql.types import (
    DoubleType,
    IntegerType,
    LongType,
    MapType,
    StringType,
    StructField,
    StructType,
    TimestampNTZType,
)


def _struct(*fields) -> StructType:
    return StructType([StructField(name, kind, True) for name, kind in fields])


_TEXT, _LONG, _INT, _DOUBLE, _TIME = StringType(), LongType(), IntegerType(), DoubleType(), TimestampNTZType()

# Column names of a source sheet and our names for them.
SOURCE_COLUMNS = {
    "InvoiceNo": "invoice_no",
    "StockCode": "stock_code",
    "Description": "description",
    "Quantity": "quantity",
    "InvoiceDate": "invoice_date",
    "UnitPrice": "unit_price",
    "CustomerID": "customer_id",
    "Country": "country",
}

LONG = _LONG
CORRUPT = "corrupt_record"  # the text of a line that is not made of the cells it should have
BATCH = "ingest_batch"

NORMALISED = _struct(
    ("invoice_no", _TEXT),
    ("stock_code", _TEXT),
    ("description", _TEXT),
    ("quantity", _LONG),
    ("invoice_date", _TEXT),
    ("invoice_ts", _TIME),
    ("unit_price", _DOUBLE),
    ("customer_id", _TEXT),
    ("country", _TEXT),
    ("line_total", _DOUBLE),
    ("is_return", _INT),
    ("ingested_at_utc", _TEXT),
)

BRONZE = StructType(
    NORMALISED.fields
    + _struct(("transaction_id", _TEXT), ("invoice_year", _INT), ("invoice_month", _INT)).fields
)

# As stored: a batch is a folder.
BRONZE_STORED = StructType(BRONZE.fields + _struct((BATCH, _TEXT)).fields)

QUARANTINE = StructType(NORMALISED.fields + _struct((CORRUPT, _TEXT), ("validation_reason", _TEXT), (BATCH, _TEXT)).fields)

BATCHES = _struct(
    ("ingest_batch", _TEXT),
    ("row_count", _LONG),
    ("details", MapType(_TEXT, _TEXT)),
    ("written_at_utc", _TEXT),
)

COUNTRY_DIM = _struct(("country", _TEXT), ("region", _TEXT), ("shipping_risk_score", _LONG))

INVOICE_KEYS = ("invoice_no", "customer_id", "country", "region", "shipping_risk_score", "invoice_ts")

MODEL_FEATURES = _struct(
    ("invoice_no", _TEXT),
    ("customer_id", _TEXT),
    ("country", _TEXT),
    ("region", _TEXT),
    ("shipping_risk_score", _LONG),
    ("invoice_ts", _TIME),
    ("invoice_total", _DOUBLE),
    ("total_units", _LONG),
    ("unique_items", _LONG),
    ("avg_unit_price", _DOUBLE),
    ("has_return_line", _INT),
    ("is_weekend", _INT),
    ("invoice_hour", _INT),
    ("invoice_year", _INT),
    ("invoice_month", _INT),
    ("days_to_next_order", _INT),
    ("target_repeat_30d", _INT),
)

MODEL_METRICS = _struct(
    ("model_name", _TEXT), ("auc", _DOUBLE), ("f1_weighted", _DOUBLE), ("f1_positive", _DOUBLE)
)

RUNS = _struct(
    ("run_id", _LONG),
    ("mode", _TEXT),
    ("resource_profile", _TEXT),
    ("runtime_sec", _DOUBLE),
    ("result_rows", _LONG),
)

LINEAGE = _struct(
    ("timestamp_utc", _TEXT),
    ("pipeline_name", _TEXT),
    ("input_path", _TEXT),
    ("output_path", _TEXT),
    ("row_count", _LONG),
    ("extra", MapType(_TEXT, _TEXT)),
)
