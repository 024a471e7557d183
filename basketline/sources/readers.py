"""Readers with declared schemas. Text sources are mapped by the names in each file's header."""

from __future__ import annotations

from collections import defaultdict
from concurrent.futures import ThreadPoolExecutor
from datetime import date
from functools import reduce
from typing import Literal
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from basketline import schemas
from basketline.schemas import CORRUPT, SOURCE_COLUMNS

Missing = Literal["error", "null"]

HEADER_READERS = 16
# Whether a line is broken must not depend on the columns that a query takes from it.
STRICT = {"mode": "PERMISSIVE", "columnPruning": "false"}
# Where a line was read: enough to put lines in source order without moving them.
SOURCE_FILE, SOURCE_BLOCK = "source_file", "source_block"
_PLACE = {SOURCE_FILE: "_metadata.file_path", SOURCE_BLOCK: "_metadata.file_block_start"}


def read_source(
    spark: SparkSession,
    path: str | list[str],
    fmt: Literal["csv", "parquet", "json", "orc"] = "csv",
    missing: Missing = "error",
    max_records: int = 0,
    **options: str,
) -> DataFrame:
    """Raw lines under our column names, with what could not be read in ``corrupt_record``.

    Columns are found by name: their order does not matter and others are dropped. Delimited files may
    differ in their columns, as each is read by its own header. A known column that a source lacks is an error, or
    with ``missing="null"`` null in all its lines. Delimited and JSON text is read as strings, so one bad cell cannot fail
    the read or null its row; the normaliser types it. A line of too few or too many cells, or that is no JSON, keeps its
    text in ``corrupt_record`` and is rejected by validation. Parquet and ORC keep the types of their footers.

    ``max_records`` takes the first lines in source order (see ``first_records``); 0 means all.
    """
    if fmt == "csv":
        frames = _csv_frames(spark, path, missing, options)
    elif fmt == "json":
        named = [StructField(name, StringType()) for name in (*SOURCE_COLUMNS, CORRUPT)]
        reader = spark.read.schema(StructType(named)).option("columnNameOfCorruptRecord", CORRUPT)
        # the names of a JSON line are in the line itself, so a missing one is null there
        frames = [_mapped(reader.options(**options).json(path), {c: c for c in SOURCE_COLUMNS})]
    else:
        df = spark.read.options(**options).format(fmt).load(path)
        _require(df.columns, missing, str(path))
        frames = [_mapped(df, {c: c for c in SOURCE_COLUMNS if c in df.columns})]
    lines = reduce(DataFrame.unionByName, frames)
    if max_records > 0:
        lines = first_records(lines, max_records)
    return lines.drop(*_PLACE)


def _require(names: list[str], missing: Missing, where: str) -> None:
    lacking = [c for c in SOURCE_COLUMNS if c not in names]
    if lacking and missing == "error":
        raise ValueError(f"{where} has no column {', '.join(lacking)}; its columns are {', '.join(names)}")


def _mapped(df: DataFrame, positions: dict[str, str]) -> DataFrame:
    """Our columns of a file relation, the corrupt text, and where each line was read."""
    ours = [
        (F.col(f"`{positions[source]}`") if source in positions else F.lit(None).cast("string")).alias(name)
        for source, name in SOURCE_COLUMNS.items()
    ]
    corrupt = F.col(CORRUPT) if CORRUPT in df.columns else F.lit(None).cast("string").alias(CORRUPT)
    return df.select(*ours, corrupt, *[F.expr(e).alias(n) for n, e in _PLACE.items()])


def csv_headers(spark: SparkSession, path: str | list[str], options: dict[str, str]) -> dict[tuple[str, ...], list[str]]:
    """The files under ``path`` by their header. Reads the first line of each file and nothing else."""
    found = spark.read.options(**options).option("header", "false").schema("line string").csv(path).inputFiles()
    files = sorted(unquote(f) for f in found)

    def header(file: str) -> tuple[str, ...]:
        first = spark.read.options(**{**options, "header": "false", "inferSchema": "false"}).csv(file).limit(1).collect()
        return tuple((c or "").strip().removeprefix("\ufeff") for c in first[0]) if first else ()

    by_header: dict[tuple[str, ...], list[str]] = defaultdict(list)
    with ThreadPoolExecutor(HEADER_READERS) as pool:
        for file, names in zip(files, pool.map(header, files), strict=True):
            by_header[names].append(file)
    return by_header


def _csv_frames(spark: SparkSession, path: str | list[str], missing: Missing, options: dict[str, str]) -> list[DataFrame]:
    """One frame for each distinct header. Cells are bound by their place in it, so names may repeat or be odd."""
    frames = []
    for header, files in csv_headers(spark, path, options).items():
        if not header:  # an empty file has no lines
            continue
        _require(list(header), missing, files[0])
        cells = [StructField(f"cell_{i}", StringType()) for i in range(len(header))]
        reader = spark.read.schema(StructType([*cells, StructField(CORRUPT, StringType())]))
        reader = reader.options(**{**options, "header": "true", "columnNameOfCorruptRecord": CORRUPT, **STRICT})
        frames.append(_mapped(reader.csv(files), {c: f"cell_{header.index(c)}" for c in SOURCE_COLUMNS if c in header}))
    if not frames:
        names = [*SOURCE_COLUMNS.values(), CORRUPT, SOURCE_FILE]
        fields = [*[StructField(n, StringType()) for n in names], StructField(SOURCE_BLOCK, schemas.LONG)]
        return [spark.createDataFrame([], StructType(fields))]
    return frames


def first_records(lines: DataFrame, n: int) -> DataFrame:
    """The first ``n`` lines in source order: by file, then by place in the file.

    Lines are counted per block of a file. Those of all blocks before the one where the count is reached pass as
    they are, in as many tasks as there are blocks; only the lines of that one block are numbered.
    """
    block = F.struct(SOURCE_FILE, SOURCE_BLOCK)
    running = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    blocks = lines.groupBy(block.alias("block")).agg(F.count(F.lit(1)).alias("lines"))
    blocks = blocks.withColumn("before", F.sum("lines").over(running) - F.col("lines")).filter(F.col("before") < n)
    cut = blocks.agg(F.max(F.struct("block", (n - F.col("before")).alias("rest")))).scalar()
    columns = lines.columns
    whole = lines.filter(block < cut["block"])
    place = Window.partitionBy(SOURCE_FILE, SOURCE_BLOCK).orderBy("read_order")
    last = lines.filter(block == cut["block"]).withColumn("read_order", F.monotonically_increasing_id())
    last = last.withColumn("place", F.row_number().over(place)).filter(F.col("place") <= cut["rest"])
    return whole.unionByName(last.select(*columns))


def read_bronze(
    spark: SparkSession,
    path: str,
    countries: list[str] | None = None,
    start: date | None = None,
    end: date | None = None,
    batches: list[str] | None = None,
) -> DataFrame:
    """Bronze lines of all batches, or of those named, optionally of some countries and of the days ``start`` to
    ``end`` inclusive.

    The bounds are put on the partition columns too, so folders outside them are not listed.
    """
    df = spark.read.schema(schemas.BRONZE_STORED).parquet(path)
    if batches is not None:
        df = df.filter(F.col(schemas.BATCH).isin(*batches))
    if countries is not None:
        df = df.filter(F.col("country").isin(*countries))
    if start is not None:
        df = df.filter(F.col("invoice_year") >= start.year)
        df = df.filter(_month_number() >= start.year * 12 + start.month)
        df = df.filter(F.col("invoice_ts") >= F.lit(start).cast("timestamp_ntz"))
    if end is not None:
        df = df.filter(F.col("invoice_year") <= end.year)
        df = df.filter(_month_number() <= end.year * 12 + end.month)
        df = df.filter(F.col("invoice_ts") < F.date_add(F.lit(end), 1).cast("timestamp_ntz"))
    return df


def _month_number():
    return F.col("invoice_year") * 12 + F.col("invoice_month")


def read_gold(spark: SparkSession, path: str, schema=None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)
