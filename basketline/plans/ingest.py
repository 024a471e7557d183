"""Raw lines to bronze and quarantine."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import datetime, timezone
from typing import Literal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.functions import casts
from basketline.operators import normalize, validate
from basketline.sources import lineage, sinks


@dataclass(frozen=True)
class IngestCounts:
    valid: int
    rejected: int
    reasons: dict[str, int] = field(default_factory=dict)

    @property
    def total(self) -> int:
        return self.valid + self.rejected


def ingest(
    raw: DataFrame,
    bronze_path: str,
    quarantine_path: str,
    batch_id: str | None = None,
    ingested_at: str | None = None,
    date_formats: Sequence[str] | Literal["detect"] = casts.DATE_FORMATS,
    partitions: Sequence[str] = sinks.BRONZE_PARTITIONS,
    log_path: str | None = None,
    source_name: str = "",
) -> IngestCounts:
    """Normalise, validate and write both tables; rows and reasons are counted from the files written.

    ``raw`` has our column names (see ``read_source``, which also caps a trial run). The two writes read the source once each
    and hold nothing in memory: there is no shuffle before the split, so reading again is cheaper
    than caching the source. ``date_formats="detect"`` reads the date column once more, to see how it is written.

    The step may be repeated: rows of the same batch are replaced. Without a ``batch_id`` the batch is named
    after the files that ``raw`` reads; a folder that has grown since is another batch, so read its new files alone.
    """
    ingested_at = ingested_at or datetime.now(timezone.utc).strftime("%Y-%m-%dT%H:%M:%SZ")
    spark = raw.sparkSession
    with lineage.recorded(spark, log_path, "ingest", source_name, bronze_path) as run:
        batch_id = batch_id or sinks.batch_of(raw)
        formats = normalize.date_formats_of(raw) if date_formats == "detect" else date_formats
        valid, rejected = validate.split(normalize.normalise(raw, ingested_at, formats))
        by_reason = {r: F.count_if(F.col(validate.REASON) == r) for r in validate.REASONS}
        written = sinks.write_bronze(valid, bronze_path, batch_id, partitions)
        found = sinks.write_quarantine(rejected, quarantine_path, batch_id, by_reason)
        reasons = {r: found[r] for r in validate.REASONS if found[r]}
        counts = IngestCounts(valid=written, rejected=found["rows"], reasons=reasons)
        run.row_count = counts.valid
        run.extra.update(
            raw_rows=counts.total,
            invalid_rows=counts.rejected,
            storage_format="parquet_snappy",
            batch_id=batch_id,
            date_formats="; ".join(formats),
            **{f"rejected_{r}": n for r, n in reasons.items()},
        )
    return counts
