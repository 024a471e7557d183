"""Rollup, label, metrics and splits against brute force on small frames."""

from __future__ import annotations

import random
from datetime import datetime, timedelta
from fractions import Fraction
from functools import reduce

import pytest
from pyspark.sql import functions as F

from basketline import session
from basketline.functions import aggregates as agg
from basketline.operators import invoices, labels, metrics, splits
from suite import fixtures as fx
from suite.queries import QUERIES

SCHEMA = (
    "invoice_no string, customer_id string, country string, region string, shipping_risk_score bigint, "
    "invoice_ts timestamp_ntz"
)
START = datetime(2011, 1, 1)


def frame(spark, rows):
    return spark.createDataFrame([(no, c, "X", "r", 1, ts) for no, c, ts in rows], SCHEMA)


def brute_gaps(rows):
    gaps = {}
    for customer in {c for _, c, _ in rows}:
        own = sorted((ts, no) for no, c, ts in rows if c == customer)
        for (ts, no), after in zip(own, [*own[1:], None], strict=True):
            gaps[no] = None if after is None else (after[0].date() - ts.date()).days
    return gaps


def test_gaps_equal_brute_force_with_a_hot_customer(spark):
    rng = random.Random(7)
    rows = []
    for i in range(400):
        customer = "hot" if i % 3 == 0 else str(rng.randrange(25))
        minutes = rng.choice([0, 1, 1439, 1440]) + 1440 * rng.randrange(40)
        rows.append((f"{i:04d}", customer, START + timedelta(minutes=minutes)))
    for strategy in ("days", "window"):
        found = labels.days_to_next(frame(spark, rows), strategy).collect()
        assert {r.invoice_no: r.days_to_next_order for r in found} == brute_gaps(rows)


def test_label_edges(spark):
    days = [0, 0, 30, 61, 61]
    rows = [(str(i), "c", START + timedelta(days=d, minutes=i)) for i, d in enumerate(days)]
    out = {r.invoice_no: r for r in labels.with_repeat_label(frame(spark, rows)).collect()}
    assert [out[str(i)].days_to_next_order for i in range(5)] == [0, 30, 31, 0, None]
    assert [out[str(i)].target_repeat_30d for i in range(5)] == [1, 1, 0, 1, 0]
    censored = {r.invoice_no: r for r in labels.with_repeat_label(frame(spark, rows), censor=True).collect()}
    assert [censored[str(i)].target_repeat_30d for i in range(5)] == [1, 1, 0, 1, None]
    midnight = [("a", "c", datetime(2011, 1, 1, 23, 59)), ("b", "c", datetime(2011, 1, 2, 0, 0))]
    gap = labels.days_to_next(frame(spark, midnight)).filter("invoice_no = 'a'").first()
    assert gap.days_to_next_order == 1


def test_customer_windows_run_over_days_only(spark):
    rows = [("a", "c", START)]
    plan = labels.days_to_next(frame(spark, rows))._jdf.queryExecution().optimizedPlan().toString()
    window = next(line for line in plan.splitlines() if "Window" in line)
    assert "lead(day" in window and "partial" not in window


def test_one_invoice_with_two_times_gives_two_rows(spark):
    lines = frame(spark, [("a", "c", START), ("a", "c", START + timedelta(hours=1)), ("a", "c", START)])
    lines = lines.selectExpr(
        "*", "'S' stock_code", "2L quantity", "1.5D unit_price", "3.0D line_total", "0 is_return"
    )
    out = sorted(invoices.invoice_baskets(lines).collect(), key=lambda r: r.invoice_ts)
    assert [(r.invoice_total, r.total_units, r.unique_items) for r in out] == [(6.0, 4, 1), (3.0, 2, 1)]
    assert (out[0].is_weekend, out[0].avg_unit_price) == (1, 1.5)


def exactly(values):
    total = sum(map(Fraction, values))
    return total.numerator / total.denominator


SUMS = [
    [3e-9, 3e-9], [1e20, 1.0, -1e20], [-1e20, -1.0, 1e20], [0.1] * 1000, [-0.1] * 999 + [1e9, -1e9], [9e27] * 300, [-9e27] * 300 + [1.0],
    [1.0, 2**-53], [1.0, 2**-53, 2**-90], [-1.0, -(2**-53), -(2**-90)], [2.0**-90], [2.0**52 + 1, 0.5, 1e-20], [-(2.0**30), 2.0**-30], [1e-5, -1e-5],
]


def test_sums_of_doubles_are_exact_in_any_cut(spark):
    """Rounded once, whatever the order, the partitions and the steps in which groups are merged."""
    rng = random.Random(1)
    groups = SUMS + [[rng.uniform(-1, 1) * 2.0 ** rng.randint(-30, 85) for _ in range(rng.randint(1, 30))] for _ in range(150)]
    rows = [(i, v) for i, g in enumerate(groups) for v in [*g, None]]
    for seed, n in ((1, 2), (2, 7)):
        df = spark.createDataFrame(random.Random(seed).sample(rows, len(rows)), "g int, x double").repartition(n)
        once = {r.g: r.s for r in df.groupBy("g").agg(agg.exact_sum(F.col("x")).alias("s")).collect()}
        first = df.groupBy("g", (F.rand(seed) * 3).cast("int").alias("h")).agg(*agg.parts(F.col("x"), "x"))
        merged = first.groupBy("g").agg(*agg.merged("x")).select("g", agg.total("x").alias("s"), agg.mean("x").alias("m"))
        twice = {r.g: (r.s, r.m) for r in merged.collect()}
        for i, g in enumerate(groups):
            assert once[i] == twice[i][0] == exactly(g) and twice[i][1] == exactly(g) / len(g)


def test_sums_of_money_are_rounded_by_one_addition(spark):
    """Sums without a high digit whose others are doubles go the short way, all others the long one, to the same number."""
    groups = [[19.99, 0.01, -3.5], [0.1] * 5, [], [1e20, 1.0], [2.0**30, 0.1], [0.1, 2.0**23], [-0.07, -1234.56], [0.1] * 20]
    df = spark.createDataFrame([(i, v) for i, g in enumerate(groups) for v in [*g, None]], "g int, x double")
    sums = df.groupBy("g").agg(*agg.parts(F.col("x"), "x"))
    digits = [F.col(c) for c in agg.part_columns("x")[:3]]
    got = {r.g: (r.short, r.s) for r in sums.select("g", agg._short(*digits).alias("short"), agg.total("x").alias("s")).collect()}
    for i in (0, 1, 6):
        assert got[i][0] == got[i][1] == exactly(groups[i])
    assert got[2] == (None, None) and all(got[i] == (None, exactly(groups[i])) for i in (3, 4, 7))
    assert got[5][1] == exactly(groups[5])


def test_what_lies_outside_the_digits_is_added_plainly(spark):
    nothing, inf = float("nan"), float("inf")
    rows = [(0, 1e300), (0, 1.0), (1, inf), (1, 1.0), (2, nothing), (3, 1e-300), (3, 1e-300), (4, None), (5, -1e300), (5, 1e300), (5, 2.5)]
    df = spark.createDataFrame(rows, "g int, x double")
    got = {r.g: r.s for r in df.groupBy("g").agg(agg.exact_sum(F.col("x")).alias("s")).collect()}
    assert (got[0], got[1], got[3], got[4], got[5]) == (1e300, inf, 2e-300, None, 2.5) and got[2] != got[2]


def test_units_cannot_overflow(spark):
    """Two lines of 9e18 units: totals are held within a long's range, means are right."""
    rows = [("a", "c", "X", "r", 1, START, f"S{i}", q, 1.5, 1.5, 0) for i, q in enumerate([9 * 10**18, 9 * 10**18, -(2**63)])]
    lines = spark.createDataFrame(rows, SCHEMA + ", stock_code string, quantity bigint, unit_price double, line_total double, is_return int")
    assert invoices.invoice_baskets(lines).first().total_units == 2**63 - 1
    named = lines.withColumn("transaction_id", F.col("stock_code"))
    mean = (18 * 10**18 - 2**63) / 3
    assert metrics.dq_metrics(named).first().avg_quantity == mean
    assert metrics.dq_metrics_approx(named).first().avg_quantity == mean


def test_exact_sum_does_not_depend_on_order_and_falls_back(spark):
    values = [0.1] * 1000 + [1e9, -1e9, 0.2]
    expected = 100.2
    for seed in (1, 2):
        shuffled = random.Random(seed).sample(values, len(values))
        df = spark.createDataFrame([(v,) for v in shuffled], "x double").repartition(5)
        assert df.agg(agg.exact_sum(F.col("x"))).first()[0] == expected
    huge = spark.createDataFrame([(1e300,), (1e300,), (None,)], "x double")
    assert huge.agg(agg.exact_sum(F.col("x"))).first()[0] == 2e300
    assert huge.filter("x < 0").agg(agg.exact_mean(F.col("x"))).first()[0] is None


def test_metrics_add_up(spark, sf_dir):
    valid = fx.valid(spark, sf_dir)
    dq = metrics.dq_metrics(valid).collect()
    assert sum(r.rows_before_dedupe for r in dq) == valid.count()
    assert sum(r.rows_after_cleaning for r in dq) == 5581
    assert all(0 <= r.duplicate_ratio < 1 for r in dq)
    approx = {r.country: r for r in metrics.dq_metrics_approx(valid).collect()}
    for row in dq:
        assert abs(approx[row.country].unique_transactions / row.unique_transactions - 1) <= 3 * 0.05


def test_sketches_are_merged_not_added(spark, sf_dir):
    """A transaction on two days counts once; however days are put together, the figures are those of one pass."""
    valid = fx.valid(spark, sf_dir)
    again = valid.unionByName(valid.withColumn("invoice_ts", F.col("invoice_ts") + F.expr("INTERVAL 400 DAYS")))
    stored = metrics.dq_sketches(again)
    years = [stored.filter(F.year("day") == y) for y in range(1980, 2010)]
    whole = {r.country: r for r in metrics.dq_metrics_from_sketches(stored).collect()}
    parts = {r.country: r for r in metrics.dq_metrics_from_sketches(reduce(lambda a, b: b.unionByName(a), years)).collect()}
    assert whole == parts
    for r in metrics.dq_metrics(valid).collect():
        # fewer transactions than the sketch has room for: exact
        assert whole[r.country].unique_transactions == r.unique_transactions
        assert whole[r.country].rows_after_cleaning == 2 * r.rows_before_dedupe


def test_cuts_from_stored_sketches(spark):
    rng = random.Random(8)
    rows = [(str(i), "c", START + timedelta(minutes=rng.randrange(400_000))) for i in range(3000)] + [("x", "c", None)]
    df = frame(spark, rows)
    cuts = splits.cuts_from_sketches(splits.time_sketches(df))
    split = splits.assign_temporal_split(df, cuts=cuts)
    counts = {r.split: r.row_count for r in splits.split_counts(split).collect()}
    assert abs(counts["train"] - 2100) <= 60 and abs(counts["valid"] - 450) <= 120
    none = splits.cuts_from_sketches(splits.time_sketches(df.filter("invoice_ts IS NULL")))
    assert none.first().q70 is None


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_temporal_split_is_disjoint_and_covering(spark, mode):
    rng = random.Random(3)
    rows = [(str(i), "c", START + timedelta(hours=rng.randrange(300))) for i in range(500)]
    df = frame(spark, [*rows, ("late", "c", None)])
    split = splits.assign_temporal_split(df, mode)
    train, valid, test = (p.collect() for p in splits.parts(split))
    assert len(train) + len(valid) + len(test) == 500
    assert max(r.event_ts for r in train) < min(r.event_ts for r in valid)
    assert max(r.event_ts for r in valid) < min(r.event_ts for r in test)
    assert abs(len(train) - 350) <= 20 and abs(len(test) - 75) <= 20
    if mode == "exact":
        seconds = sorted((ts - datetime(1970, 1, 1)).total_seconds() for _, _, ts in rows)
        assert tuple(splits.exact_cuts(df).first()) == (seconds[349], seconds[424])
    assert splits.train_and_valid(split).count() == len(train) + len(valid)


@pytest.mark.parametrize("mode", ["exact", "approx"])
def test_split_without_times_goes_by_hash(spark, mode):
    df = frame(spark, [(str(i), "c", None) for i in range(300)])
    counts = {r.split: r.row_count for r in splits.split_counts(splits.assign_temporal_split(df, mode)).collect()}
    assert sum(counts.values()) == 300 and set(counts) == {"train", "valid", "test"}
    assert splits.assign_temporal_split(df.limit(0), mode).count() == 0


def test_label_and_cuts_work_their_rows_out_once(spark):
    """Both read their rows twice, so these are written first and no longer part of the plan."""
    rows = spark.range(8).selectExpr(
        "string(id) invoice_no", "'c' customer_id", "'x' country", "'y' region", "1L shipping_risk_score",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(id) invoice_ts",
    )
    for frame in (labels.with_repeat_label(rows), labels.with_repeat_label(rows, censor=True), splits.exact_cuts(rows)):
        assert "Range (" not in frame._jdf.queryExecution().executedPlan().toString()


def test_tasks_follow_the_rows(spark, sf_dir, monkeypatch):
    """More lines than the session's shuffle partitions are made for: both folds and the distinct count get more of them."""
    few = fx.line_tasks(spark, sf_dir)
    queries = ("hash_split_fast", "invoice_features_distinct", "dedupe_transactions")
    expected = {name: sorted(map(repr, QUERIES[name](spark, sf_dir).collect())) for name in queries}
    monkeypatch.setattr(session, "ROWS_PER_TASK", 100)
    tasks = fx.line_tasks(spark, sf_dir)
    assert few is None and tasks == -(-fx.table(spark, sf_dir, "lineitem").count() // 100)
    for name in queries:
        frame = QUERIES[name](spark, sf_dir)
        dealt = [line for line in frame._jdf.queryExecution().executedPlan().toString().splitlines() if f", {tasks}), REPARTITION_BY_NUM" in line]
        assert len(dealt) == (3 if name == "invoice_features_distinct" else 2)
        assert sorted(map(repr, frame.collect())) == expected[name]


def test_rows_read_twice_are_stored_in_columns(spark):
    """A checkpoint of rows is not compressed; a column that no file format has still goes that way."""
    rows = spark.range(8).selectExpr(
        "string(id) invoice_no", "'c' customer_id", "'x' country", "'y' region", "1L shipping_risk_score",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(id) invoice_ts",
    )
    for frame in (labels.with_repeat_label(rows), splits.exact_cuts(rows)):
        assert "FileScan parquet" in frame._jdf.queryExecution().executedPlan().toString()
    untyped = labels.with_repeat_label(rows.withColumn("nothing", F.lit(None)))
    assert sorted(untyped.drop("nothing").collect()) == sorted(labels.with_repeat_label(rows).collect())


def test_whole_invoices_are_dealt_out_unless_one_is_giant(spark, monkeypatch):
    """Distinct items of large lines take one exchange; a giant invoice is spread by its items, as in smaller tables."""
    lines = spark.range(600).selectExpr(
        "CASE WHEN id < 300 THEN 'big' ELSE string(id DIV 3) END invoice_no", "string(least(id, 0)) customer_id",
        "string(least(id, 0)) country", "string(least(id, 0)) region", "least(id, 0) shipping_risk_score",
        "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(least(id, 0)) invoice_ts", "string(id % 40) stock_code", "1L quantity",
        "2.5D unit_price", "2.5D line_total", "0 is_return",
    )
    expected = sorted(map(repr, invoices.invoice_baskets(lines).collect()))
    for limit, exchanges in ((1000, 1), (100, 2)):
        monkeypatch.setattr(invoices.giant_invoice, "__defaults__", (limit,))
        frame = invoices.invoice_baskets(lines, tasks=7, large=True)
        plan = frame._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange hashpartitioning") == exchanges
        assert sorted(map(repr, frame.collect())) == expected


def test_draws_are_checked_one_after_the_other(spark, sf_dir):
    """The result reads five written rows; joins that it still held would keep the files of all of them at once."""
    flags = QUERIES["draw_flags"](spark, sf_dir)
    plan = flags._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Subquery" not in plan
    assert sorted(r.draw for r in flags.collect()) == ["bernoulli", "hash test", "hash train", "poisson", "stratified"]
    assert all(r.fair_size and r.rows_of_table for r in flags.collect())
