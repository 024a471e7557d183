"""Bronze lines to the gold tables."""

from __future__ import annotations

import time
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.operators import dedupe, enrich, invoices, labels, metrics
from basketline.session import checkpoint_dir, dropped, is_large, stored, tasks_for
from basketline.sources import lineage, readers, sinks

LINE_COLUMNS = (
    "transaction_id",
    "invoice_no",
    "stock_code",
    "quantity",
    "unit_price",
    "customer_id",
    "country",
    "line_total",
    "is_return",
    "invoice_ts",
)
TABLES = ("sales_metrics", "dq_metrics", "model_features")


def clean_lines(
    bronze: DataFrame,
    copies: str | None = None,
    tasks: int | None = None,
    large: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Deduplicated lines with repaired country."""
    return enrich.repair_country(dedupe.dedupe(bronze, copies=copies, tasks=tasks, large=large, folder=folder))


def curated_lines(
    bronze: DataFrame,
    dim: DataFrame,
    strategy: enrich.JoinStrategy = "auto",
    columns: Sequence[str] | None = None,
    tasks: int | None = None,
    large: bool = False,
) -> DataFrame:
    """Deduplicated, repaired and enriched lines.

    Deduping moves every column it is given, so a caller who needs few should name them; the rows
    kept have the same values either way, as long as ``dedupe.SURVIVOR_ORDER`` is among them.
    """
    if columns is not None:
        bronze = bronze.select(*dict.fromkeys(["transaction_id", *dedupe.SURVIVOR_ORDER, *columns]))
    lines = clean_lines(bronze, tasks=tasks, large=large)
    return enrich.enrich(lines, dim, strategy, measured=_measured(bronze, lines, large))


def _countries(bronze: DataFrame) -> DataFrame:
    """What the merge join measures: the country alone, which a bronze table holds in its folder names."""
    return enrich.repair_country(bronze.select("country"))


def _measured(bronze: DataFrame, lines: DataFrame, large: bool) -> DataFrame:
    """Large lines come from files of their own; bronze may be a plan that would be worked out once more."""
    return lines if large else _countries(bronze)


def basket_summary(
    bronze: DataFrame,
    dim: DataFrame,
    strategy: enrich.JoinStrategy = "auto",
    tasks: int | None = None,
    large: bool = False,
) -> DataFrame:
    """Invoice totals from bronze, reading only the columns they need.

    The transaction key holds invoice, item, time and customer, so after deduping an item occurs
    once per invoice group and a plain count gives the distinct items. Totals of ``large`` bronze are written at once, since
    they are the last to read the lines that deduping wrote.
    """
    folder = f"{checkpoint_dir(bronze.sparkSession)}/dedupe/{uuid.uuid4()}" if large else None
    lines = clean_lines(bronze.select(*LINE_COLUMNS), copies="copies", tasks=tasks, large=large, folder=folder)
    joined = enrich.enrich(lines, dim, strategy, measured=_measured(bronze, lines, large))
    summary = invoices.basket_summary(joined, one_line_per_item=True, tasks=tasks)
    if folder:
        summary = stored(summary, tasks)
        dropped(bronze.sparkSession, folder)
    return summary


def curate(
    bronze: DataFrame,
    gold_path: str,
    dim: DataFrame | None = None,
    strategy: enrich.JoinStrategy = "auto",
    horizon_days: int = labels.DEFAULT_HORIZON_DAYS,
    csv_path: str | None = None,
    log_path: str | None = None,
    source_name: str = "",
) -> int:
    """Write ``sales_metrics``, ``dq_metrics`` and ``model_features``; gives the curated lines.

    Lines are read once. They shrink to one row per invoice, which is written as
    ``basket_summary``; every gold table then comes from that written table, so nothing is cached
    and a lost executor costs no recomputation of the wide part.
    """
    spark = bronze.sparkSession
    with lineage.recorded(spark, log_path, "curate", source_name, gold_path) as run:
        started = time.perf_counter()
        dim = enrich.country_dim(spark) if dim is None else dim
        enrich.require_unique(dim)
        strategy = enrich.effective(strategy, dim)
        summary_path = f"{gold_path}/basket_summary"
        sinks.write_table(basket_summary(bronze, dim, strategy, tasks_for(bronze), is_large(bronze)), summary_path)
        summary = readers.read_gold(spark, summary_path)

        sales = metrics.sales_metrics_from_baskets(summary)
        dq = metrics.dq_metrics_from_baskets(summary)
        sinks.write_table(sales, f"{gold_path}/sales_metrics")
        sinks.write_single_file(dq, f"{gold_path}/dq_metrics")
        features = labels.with_repeat_label(invoices.basket_features(summary), horizon_days)
        sinks.write_table(features, f"{gold_path}/model_features")
        if csv_path:
            for name in ("sales_metrics", "dq_metrics"):
                table = readers.read_gold(spark, f"{gold_path}/{name}")
                sinks.export_csv(table, f"{csv_path}/{name}_csv")

        run.row_count = summary.agg(F.coalesce(F.sum("line_count"), F.lit(0))).first()[0]
        run.extra.update(join_mode=strategy, runtime_sec=f"{time.perf_counter() - started:.3f}")
    return run.row_count
