"""Registered queries: name -> function of (spark, sf_dir). Each reads whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.ml.feature import StringIndexer
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.functions import casts
from basketline.ml import models, signals
from basketline.operators import (
    bootstrap,
    dedupe,
    enrich,
    evaluation,
    invoices,
    labels,
    metrics,
    normalize,
    reports,
    runcost,
    sampling,
    scoring,
    splits,
    validate,
)
from basketline.plans import train
from basketline.session import checkpoint_dir, cut_lineage, stored
from basketline.sources import lineage
from suite import fixtures as fx

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

ML_HORIZON = 180  # days; at 30 the fixture has too few repeats for trees to find a split
ML_LABEL = f"target_repeat_{ML_HORIZON}d"


def query(f: Query) -> Query:
    QUERIES[f.__name__] = f
    return f


# Normalise and validate


@query
def normalize_lines(spark, sf):
    return fx.normalised(spark, sf)


@query
def source_columns(spark, sf):
    """Source names to ours, whatever their order; the others are dropped."""
    return normalize.rename_source(fx.source_lines(spark, sf))


@query
def month_first_dates(spark, sf):
    """Order times as a sheet writes them, month first and without leading zeros, read back."""
    orders = fx.table(spark, sf, "orders")
    hours = F.make_interval(hours=(F.col("o_orderkey") % 24).cast("int"))
    sheet = F.date_format(F.col("o_orderdate") + hours, "M/d/yyyy H:mm")
    text, time = casts.wall_clock(F.col("sheet"))
    return orders.select("o_orderkey", sheet.alias("sheet")).select("o_orderkey", text.alias("text"), time.alias("time"))


@query
def date_formats(spark, sf):
    """How many order dates each known format reads, written day first."""
    sheet = fx.table(spark, sf, "orders").select(F.date_format("o_orderdate", "d/M/yyyy").alias("sheet"))
    counts = sheet.agg(casts.formats_read(F.col("sheet")).alias("counts"))
    named = F.arrays_zip(F.array(*map(F.lit, casts.KNOWN_FORMATS)).alias("date_format"), F.col("counts").alias("cells"))
    return counts.select(F.inline(named))


@query
def record_cap(spark, sf):
    lines = fx.normalised(spark, sf)
    return normalize.record_cap(lines, 1000, *lines.columns)


@query
def valid_lines(spark, sf):
    return fx.valid(spark, sf)


@query
def quarantine_reasons(spark, sf):
    return validate.rejected_lines(fx.normalised(spark, sf))


@query
def reason_counts(spark, sf):
    return validate.reason_counts(fx.normalised(spark, sf))


@query
def table_counts(spark, sf):
    return reports.table_counts(*validate.split(fx.normalised(spark, sf)))


# Dedupe and enrich


@query
def dedupe_transactions(spark, sf):
    tasks, large = fx.line_tasks(spark, sf), fx.many_lines(spark, sf)
    return dedupe.dedupe(fx.valid(spark, sf), copies="copies", tasks=tasks, large=large)


@query
def duplicate_counts(spark, sf):
    return dedupe.duplicate_counts(fx.valid(spark, sf))


@query
def country_repair(spark, sf):
    lines = fx.raw_lines(spark, sf).fillna({"country": "  "})
    return enrich.repair_country(lines).groupBy("country").agg(F.count(F.lit(1)).alias("row_count"))


@query
def enrich_auto(spark, sf):
    return fx.enriched(spark, sf)


@query
def enrich_broadcast(spark, sf):
    return fx.enriched(spark, sf, strategy="broadcast")


@query
def enrich_merge(spark, sf):
    return fx.enriched(spark, sf, strategy="merge")


# Invoices and label


def baskets(spark, sf) -> DataFrame:
    return invoices.basket_features(fx.basket_summary(spark, sf))


@query
def invoice_features(spark, sf):
    return baskets(spark, sf)


@query
def invoice_features_distinct(spark, sf):
    """The same with an exact distinct count of items, which no earlier step has to prepare."""
    columns = ["invoice_no", "customer_id", "invoice_ts", "stock_code", "line_total", "is_return"]
    tasks, large = fx.line_tasks(spark, sf), fx.many_lines(spark, sf)
    return invoices.invoice_baskets(fx.enriched(spark, sf, *columns), tasks=tasks, large=large)


@query
def repeat_label(spark, sf):
    return labels.with_repeat_label(baskets(spark, sf))


@query
def repeat_label_180(spark, sf):
    return labels.with_repeat_label(baskets(spark, sf), ML_HORIZON)


@query
def repeat_label_window(spark, sf):
    return labels.with_repeat_label(baskets(spark, sf), strategy="window")


@query
def repeat_label_censored(spark, sf):
    return labels.with_repeat_label(baskets(spark, sf), censor=True)


@query
def basket_signals(spark, sf):
    keys = ["invoice_no", "customer_id", "country", "invoice_ts"]
    rows = signals.with_basket_signals(baskets(spark, sf)).select(*keys, *signals.SIGNALS)
    # Two engines' logarithms may differ in the last bit, so it is shown to nine places.
    return rows.withColumn("log_invoice_total", F.round("log_invoice_total", 9))


# Metrics and reports

SALES_LINES = ("invoice_no", "customer_id", "line_total", "is_return")


@query
def sales_metrics(spark, sf):
    return metrics.sales_metrics(fx.enriched(spark, sf, *SALES_LINES))


@query
def sales_metrics_from_baskets(spark, sf):
    return metrics.sales_metrics_from_baskets(fx.basket_summary(spark, sf))


@query
def dq_metrics_exact(spark, sf):
    return metrics.dq_metrics(fx.valid(spark, sf))


@query
def dq_metrics_from_baskets(spark, sf):
    return metrics.dq_metrics_from_baskets(fx.basket_summary(spark, sf))


@query
def dq_metrics_approx(spark, sf):
    return metrics.dq_metrics_approx(fx.enriched(spark, sf, "quantity", "unit_price"))


@query
def distinct_sketch_flags(spark, sf):
    """Distinct transactions from stored sketches by day against the exact count, and against one sketch of all lines."""
    lines = fx.valid(spark, sf)
    by_day = metrics.dq_metrics_from_sketches(metrics.dq_sketches(lines))
    one_day = lines.withColumn("invoice_ts", F.lit("2000-01-01").cast("timestamp_ntz"))
    at_once = metrics.dq_metrics_from_sketches(metrics.dq_sketches(one_day))
    exact = lines.groupBy("country").agg(
        F.count(F.lit(1)).alias("row_count"), F.count_distinct("transaction_id").alias("exact")
    )
    joined = exact.join(by_day, "country").join(at_once.select("country", F.struct("*").alias("once")), "country")
    allowed = 3 * metrics.sketch_error() * F.col("exact")
    return joined.select(
        "country",
        "row_count",
        (F.abs(F.col("unique_transactions") - F.col("exact")) <= allowed).alias("within_error"),
        (F.struct(*by_day.columns) == F.col("once")).alias("equals_one_pass"),
    )


@query
def dq_approx_flags(spark, sf):
    """The one-pass approximate metrics against the exact distinct count."""
    lines = fx.valid(spark, sf)
    exact = lines.groupBy("country").agg(F.count_distinct("transaction_id").alias("exact"))
    found = metrics.dq_metrics_approx(lines).join(exact, "country")
    close = F.abs(F.col("unique_transactions") / F.col("exact") - 1) <= 3 * 0.05
    return found.select("country", "rows_after_cleaning", "avg_unit_price", close.alias("within_error"))


@query
def dq_kpis(spark, sf):
    return reports.dq_kpis(dq_metrics_exact(spark, sf))


@query
def dup_anomalies(spark, sf):
    return reports.duplicate_anomalies(dq_metrics_exact(spark, sf))


@query
def country_quality(spark, sf):
    return reports.country_quality(dq_metrics_exact(spark, sf))


@query
def weekly_returns(spark, sf):
    return metrics.weekly_returns(fx.enriched(spark, sf, "invoice_ts", "is_return"))


@query
def return_ratio(spark, sf):
    columns = ["country", "return_line_count", "return_line_ratio", "return_line_share"]
    return sales_metrics(spark, sf).select(*columns)


@query
def top_return_countries(spark, sf):
    return reports.top_return_countries(sales_metrics(spark, sf))


@query
def region_ranking(spark, sf):
    return reports.region_ranking(fx.enriched(spark, sf, "invoice_no", "customer_id", "line_total"))


@query
def country_rollup_sorted(spark, sf):
    return metrics.place_rollup(baskets(spark, sf))


# Splits and samples

SPLIT_COLUMNS = ["invoice_no", "customer_id", "country", "invoice_ts"]


def invoice_times(spark, sf) -> DataFrame:
    return baskets(spark, sf).select(*SPLIT_COLUMNS)


@query
def temporal_cuts(spark, sf):
    return splits.exact_cuts(invoice_times(spark, sf))


@query
def temporal_split_exact(spark, sf):
    return splits.assign_temporal_split(invoice_times(spark, sf))


@query
def temporal_split_approx(spark, sf):
    return splits.assign_temporal_split(invoice_times(spark, sf), "approx")


@query
def split_counts(spark, sf):
    return splits.split_counts(splits.assign_temporal_split(invoice_times(spark, sf)))


@query
def hash_split_md5(spark, sf):
    return splits.assign_hash_split(invoice_times(spark, sf))


@query
def hash_split_fast(spark, sf):
    return splits.assign_hash_split(invoice_times(spark, sf), portable=False)


@query
def union_train_valid(spark, sf):
    return splits.train_and_valid(splits.assign_temporal_split(invoice_times(spark, sf)))


@query
def md5_sample(spark, sf):
    return sampling.hashed_sample(invoice_times(spark, sf), SPLIT_COLUMNS, 0.2)


@query
def bernoulli_sample(spark, sf):
    return sampling.bernoulli_sample(invoice_times(spark, sf), 0.6)


@query
def poisson_sample(spark, sf):
    return sampling.bootstrap_sample(fx.scored(spark, sf))


@query
def stratified_sample(spark, sf):
    labelled = labels.with_repeat_label(baskets(spark, sf), ML_HORIZON)
    return sampling.stratified_sample(labelled, ML_LABEL, {0: 0.9, 1: 0.9})


def _near(part, share: float, whole):
    """Whether ``part`` of ``whole`` rows is a fair draw of that share: within five standard deviations."""
    return F.abs(part - whole * share) <= 5 * F.sqrt(whole * max(share * (1 - share), 0.04))


@query
def approx_cut_flags(spark, sf):
    """Both approximate ways to the cuts against the share of rows at or before them."""
    times = cut_lineage(invoice_times(spark, sf).withColumn("second", F.unix_timestamp("invoice_ts")))
    total = times.agg(F.count("second")).scalar()
    flags = []
    for mode, cuts in (
        ("one pass", splits.approx_cuts(times)),
        ("stored sketches", splits.cuts_from_sketches(splits.time_sketches(times))),
    ):
        cut = cuts.unpivot([], ["q70", "q85"], "cut_name", "cut").withColumn("upto", F.lit(None).cast("bigint"))
        one = cuts.select(F.struct("*")).scalar()
        upto = times.agg(*[F.count_if(F.col("second") <= one[c]).alias(c) for c in ("q70", "q85")])
        share = upto.unpivot([], ["q70", "q85"], "cut_name", "n")
        wanted = F.substring("cut_name", 2, 2).cast("double") / 100
        flags.append(
            cut.drop("upto").join(share, "cut_name").select(
                F.lit(mode).alias("mode"), "cut_name", (F.abs(F.col("n") / total - wanted) <= 0.02).alias("within_error")
            )
        )
    return flags[0].unionByName(flags[1])


@query
def draw_flags(spark, sf):
    """The draws that only Spark can repeat: their sizes are fair, and each row is one of the table's.

    Each draw is checked on its own, so that its joins' files go before those of the next one come.
    """
    whole_rows, scored = stored(baskets(spark, sf)), fx.scored(spark, sf)
    times = whole_rows.select(*SPLIT_COLUMNS)
    labelled = stored(labels.with_repeat_label(whole_rows, ML_HORIZON))
    fast = splits.assign_hash_split(times, portable=False)
    draws = {
        "bernoulli": (times, sampling.bernoulli_sample(times, 0.6), 0.6),
        "poisson": (scored, sampling.bootstrap_sample(scored), 1.0),
        "stratified": (labelled, sampling.stratified_sample(labelled, ML_LABEL, {0: 0.9, 1: 0.9}), 0.9),
        "hash train": (times, fast.filter("split = 'train'").select(*times.columns), 0.7),
        "hash test": (times, fast.filter("split = 'test'").select(*times.columns), 0.15),
    }
    rows = []
    for name, (whole, draw, share) in draws.items():
        counts = whole.agg(F.count(F.lit(1)).alias("table_rows")).join(
            draw.agg(F.count(F.lit(1)).alias("drawn")), how="inner"
        )
        strange = draw.join(whole, [draw[c].eqNullSafe(whole[c]) for c in whole.columns], "left_anti")
        fair = _near(F.col("drawn"), share, F.col("table_rows"))
        rows.append(
            stored(counts.select(
                F.lit(name).alias("draw"), "table_rows", fair.alias("fair_size"),
                (strange.agg(F.count(F.lit(1))).scalar() == 0).alias("rows_of_table"),
            ))
        )
    return reduce(DataFrame.unionByName, rows)


# Evaluation


@query
def confusion(spark, sf):
    return scoring.confusion(fx.scored(spark, sf))


@query
def f1_weighted(spark, sf):
    return scoring.f1_scores(scoring.confusion(fx.scored(spark, sf))).select("f1_weighted")


@query
def f1_positive(spark, sf):
    return scoring.f1_scores(scoring.confusion(fx.scored(spark, sf))).select("f1_positive")


@query
def auc_rank(spark, sf):
    return scoring.rank_auc(fx.scored(spark, sf))


@query
def auc_rank_orders(spark, sf):
    """AUC over every order, with nearly as many scores as rows."""
    return scoring.rank_auc(fx.order_scores(spark, sf))


@query
def auc_bootstrap(spark, sf):
    return bootstrap.bootstrap_auc(fx.scored(spark, sf), ["doc_id"])


@query
def auc_bootstrap_ci(spark, sf):
    return bootstrap.bootstrap_interval(fx.scored(spark, sf), ["doc_id"])


@query
def business_value(spark, sf):
    return scoring.expected_profit(scoring.confusion(fx.scored(spark, sf)))


@query
def profit_per_1000(spark, sf):
    return scoring.profit_per_thousand(scoring.confusion(fx.order_scores(spark, sf)))


@query
def evaluation_long(spark, sf):
    return evaluation.evaluation_long(fx.scored(spark, sf), ["doc_id"])


# Run cost


@query
def run_cost(spark, sf):
    return runcost.run_cost(fx.runs(spark, sf))


@query
def profile_costs(spark, sf):
    return runcost.profile_costs(fx.runs(spark, sf))


@query
def run_recommendation(spark, sf):
    return runcost.recommend(fx.runs(spark, sf))


# Models


_TRAINING: dict[tuple[str, str], train.Training] = {}


def training(spark, sf) -> train.Training:
    """The split frames with their vectors, and the models fitted on them so far; several queries need the same."""
    key = spark.sparkContext.applicationId, sf
    if key not in _TRAINING:
        labelled = labels.with_repeat_label(baskets(spark, sf), ML_HORIZON)
        _TRAINING[key] = train.prepare(labelled, ML_LABEL)
    return _TRAINING[key]


def fitted(spark, sf, *names: str) -> train.Training:
    """The training with these models, each at the settings that ``plans.train`` gives it."""
    done = training(spark, sf)
    estimators = train.default_estimators(ML_LABEL)
    train.fit_all(done, {n: estimators[n] for n in names if n in estimators and n not in done.fitted})
    if train.TUNED in names and train.TUNED not in done.fitted:
        train.tune(done)
    control = train.control_estimators(ML_LABEL)
    train.fit_control(done, {n: control[n] for n in names if n in control and n not in [*done.fitted, *done.unfitted]})
    return done


@query
def category_index(spark, sf):
    rows = cut_lineage(baskets(spark, sf).select("region", "country"))
    indexer = StringIndexer(
        inputCols=list(models.CATEGORIES),
        outputCols=[f"{c}_idx" for c in models.CATEGORIES],
        handleInvalid="keep",
    )
    return indexer.fit(rows).transform(rows).distinct()


@query
def lr_scores(spark, sf):
    return fitted(spark, sf, "mllib_lr").scored("mllib_lr")


@query
def feature_vectors(spark, sf):
    """Length, sum of the category slots and numeric part of every model input vector."""
    vectors = training(spark, sf)
    rows = vectors.train.unionByName(vectors.valid).unionByName(vectors.test)
    values = vector_to_array("features")
    n = len(models.NUMERIC)
    shown = F.transform(F.slice(values, 1, n), lambda x: x)
    slots = F.slice(values, n + len(signals.SIGNALS) + 1, F.size(values))
    return rows.select(
        "invoice_no", "customer_id", "invoice_ts",
        *[shown[i].alias(c) for i, c in enumerate(models.NUMERIC)],
        F.aggregate(slots, F.lit(0.0), lambda a, x: a + x).alias("slots_set"),
    )


@query
def rf_scores(spark, sf):
    return fitted(spark, sf, "mllib_rf").scored("mllib_rf")


@query
def gbt_scores(spark, sf):
    return fitted(spark, sf, "mllib_gbt").scored("mllib_gbt")


@query
def rf_cv(spark, sf):
    """The whole grid of 12 points on 3 folds."""
    return fitted(spark, sf, train.TUNED).scored(train.TUNED)


@query
def rf_cv_forward(spark, sf):
    """Depth tuned on folds in time order."""
    done = training(spark, sf)
    if "forward" not in done.fitted:
        grid = {"maxDepth": (8, 12)}
        train.tune(done, "forward", forward=True, estimator=models.random_forest(ML_LABEL, numTrees=80), grid=grid)
    return done.scored("forward")


CONTROL = ("sample_lr", "sample_rf")


@query
def sampled_control(spark, sf):
    return fitted(spark, sf, *CONTROL).comparison(CONTROL)


@query
def model_comparison(spark, sf):
    """All six models at their own settings."""
    names = ("mllib_lr", "mllib_rf", "mllib_gbt", train.TUNED, *CONTROL)
    return fitted(spark, sf, *names).comparison(names)


@query
def reloaded_scores_flags(spark, sf):
    """A saved and reloaded pipeline scores every test row like the fitted one."""
    done = fitted(spark, sf, "mllib_lr")
    path = f"{checkpoint_dir(spark)}/models/{uuid.uuid4()}"
    models.save(done.fitted["mllib_lr"], path)
    labelled = labels.with_repeat_label(baskets(spark, sf), ML_HORIZON)
    _, _, test = splits.parts(splits.assign_temporal_split(labelled))
    again = models.score(models.load(path), test).select("invoice_no", "customer_id", "invoice_ts", "score", "pred")
    before = done.scored("mllib_lr").select("invoice_no", "customer_id", "invoice_ts", F.struct("score", "pred").alias("before"))
    same = F.struct("score", "pred") == F.col("before")
    inside = F.col("score").between(0, 1) & (F.col("pred") == (F.col("score") > 0.5).cast("int"))
    both = again.join(before, ["invoice_no", "customer_id", "invoice_ts"])
    return both.agg(F.count(F.lit(1)).alias("test_rows"), F.every(same).alias("same_scores"), F.every(inside).alias("sound"))


@query
def run_log_health(spark, sf):
    """Monitoring queries over a log: every event is a run, a failed one where its value is small."""
    return lineage.run_health(fx.run_log(spark, sf))


@query
def run_log_latest(spark, sf):
    return lineage.latest_runs(fx.run_log(spark, sf)).drop("extra")


@query
def run_log_join_modes(spark, sf):
    return lineage.runtime_by_join_mode(fx.run_log(spark, sf))
