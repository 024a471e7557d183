"""Timed headline operators: prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the local cores. The raw lines and
the bronze table are written once, as files the way a source and the ingest step deliver them. Every
operator then runs from those files to a ``noop`` sink, which computes all rows and columns: once
to warm up and three times for the median. ``value`` is the sum over the operators. The ``curate``
entries write the gold tables for real; that is the step the recorded runs time.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time
from pathlib import Path

from basketline.ml import models
from basketline.operators import (
    bootstrap,
    dedupe,
    enrich,
    invoices,
    labels,
    metrics,
    normalize,
    reports,
    runcost,
    scoring,
    splits,
    validate,
)
from basketline.plans import curate, train
from basketline.sources import readers, sinks
from suite import fixtures as fx
from suite.compare import local_session

RUNS = 3
HORIZON, LABEL = 180, "target_repeat_180d"


def noop(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def seconds_of(work) -> float:
    started = time.perf_counter()
    work()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cores = int(os.environ.get("BENCH_CPUS", "8"))
    spark = local_session(cores, os.environ.get("BENCH_MEMORY", "16g"))
    out = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    once, seconds = {}, {}

    def say(name: str, value: float) -> float:
        print(f"{name} {value:.3f}", file=sys.stderr, flush=True)
        return round(value, 3)

    def timed(name: str, work) -> None:
        work()
        seconds[name] = say(name, statistics.median(seconds_of(work) for _ in range(RUNS)))

    def timed_query(name: str, make) -> None:
        timed(name, lambda: noop(make()))

    raw_path, bronze_path, gold = (f"{out}/{name}" for name in ("raw", "bronze", "gold"))
    raw_lines = fx.raw_lines(spark, sf_dir).repartition(cores)
    once["raw_write"] = say("raw_write", seconds_of(lambda: raw_lines.write.parquet(raw_path)))
    raw = spark.read.parquet(raw_path)
    lines = normalize.normalise(raw, fx.INGESTED_AT)
    years = ("country", "invoice_year")
    write = lambda: sinks.write_bronze(validate.valid_lines(lines), bronze_path, "bench", years)
    once["bronze_write"] = say("bronze_write", seconds_of(write))
    by_month = lambda: sinks.write_bronze(validate.valid_lines(lines), f"{out}/bronze_by_month", "bench")
    once["bronze_write_by_month"] = say("bronze_write_by_month", seconds_of(by_month))
    bronze = readers.read_bronze(spark, bronze_path)
    dim = fx.dim(spark, sf_dir)
    sales = ("invoice_no", "customer_id", "line_total", "is_return", "invoice_ts")

    timed_query("normalise", lambda: lines)
    timed_query("valid_lines", lambda: validate.valid_lines(lines))
    timed_query("reason_counts", lambda: validate.reason_counts(lines))
    timed_query("dedupe", lambda: dedupe.dedupe(bronze))
    for strategy in ("auto", "broadcast", "merge"):
        joined = lambda s=strategy: enrich.enrich(bronze, dim, s)
        timed_query(f"enrich_{strategy}", joined)
    timed_query("basket_summary", lambda: curate.basket_summary(bronze, dim))
    timed_query("sales_metrics", lambda: metrics.sales_metrics(curate.curated_lines(bronze, dim, "auto", sales)))
    timed_query("dq_metrics_exact", lambda: metrics.dq_metrics(bronze))
    timed_query("dq_metrics_approx", lambda: metrics.dq_metrics_approx(bronze))
    timed_query("weekly_returns", lambda: metrics.weekly_returns(bronze))
    for strategy in ("broadcast", "merge"):
        step = lambda s=strategy: curate.curate(bronze, gold, dim, s)
        timed(f"curate_{strategy}", step)

    summary = readers.read_gold(spark, f"{gold}/basket_summary")
    features = readers.read_gold(spark, f"{gold}/model_features")
    baskets = invoices.basket_features(summary)
    timed_query("repeat_label_days", lambda: labels.with_repeat_label(baskets))
    timed_query("repeat_label_window", lambda: labels.with_repeat_label(baskets, strategy="window"))
    timed_query("place_rollup", lambda: metrics.place_rollup(features))
    timed_query("temporal_split_exact", lambda: splits.assign_temporal_split(features))
    timed_query("temporal_split_approx", lambda: splits.assign_temporal_split(features, "approx"))
    gold_sales = readers.read_gold(spark, f"{gold}/sales_metrics")
    timed_query("top_return_countries", lambda: reports.top_return_countries(gold_sales))
    scored = fx.order_scores(spark, sf_dir)
    timed_query("auc_rank", lambda: scoring.rank_auc(scored))
    judged = fx.scored(spark, sf_dir)
    timed_query("auc_bootstrap_ci", lambda: bootstrap.bootstrap_interval(judged, ["doc_id"]))
    runs = fx.runs(spark, sf_dir)
    timed_query("run_cost", lambda: runcost.run_cost(runs))
    timed_query("run_recommendation", lambda: runcost.recommend(runs))

    training = train.prepare(labels.with_repeat_label(baskets, HORIZON), LABEL)
    fit = lambda: noop(
        train.fit_all(training, {"lr": models.logistic_regression(LABEL)}).scored("lr")
    )
    once["lr_fit_and_score"] = say("lr_fit_and_score", seconds_of(fit))

    line = {
        "metric": "headline_operators_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(Path(sf_dir).name.removeprefix("sf")),
        "once": once,
        "rows": {"raw": raw.count(), "bronze": bronze.count(), "invoices": features.count()},
        "runs": RUNS,
        "cores": cores,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
