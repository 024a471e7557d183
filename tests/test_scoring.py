"""Evaluation operators against MLlib's evaluators and brute force."""

from __future__ import annotations

import hashlib
import random

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from basketline.functions.keys import POISSON_ONE_CUTS, md5_unit, poisson_draw, poisson_one
from basketline.operators import bootstrap, evaluation, runcost, sampling, scoring

SCHEMA = "id bigint, label int, score double, pred int"


def scored(spark, n=600, ties=True, seed=5):
    rng = random.Random(seed)
    rows = []
    for i in range(n):
        score = rng.random() if not ties or i % 3 else 0.5
        label = int(rng.random() < 0.3 + 0.4 * score)
        rows.append((i, label, score, int(score > 0.5)))
    return rows, spark.createDataFrame(rows, SCHEMA).repartition(4)


def brute_auc(rows):
    pos = [(s, w) for label, s, w in rows if label == 1]
    neg = [(s, w) for label, s, w in rows if label == 0]
    wins = sum(a * b * ((p > q) + 0.5 * (p == q)) for p, a in pos for q, b in neg)
    return wins / (sum(w for _, w in pos) * sum(w for _, w in neg))


@pytest.mark.parametrize("ties", [True, False])
def test_auc(spark, ties):
    rows, df = scored(spark, ties=ties)
    auc = scoring.rank_auc(df).first().auc
    assert auc == pytest.approx(brute_auc([(label, s, 1) for _, label, s, _ in rows]), abs=1e-12)
    evaluator = BinaryClassificationEvaluator(rawPredictionCol="score", numBins=0)
    assert auc == pytest.approx(evaluator.evaluate(df.withColumn("label", F.col("label").cast("double"))))


def test_auc_edges(spark):
    same = spark.createDataFrame([(1, 1, 0.5, 1), (2, 0, 0.5, 1)], SCHEMA)
    assert scoring.rank_auc(same).first().auc == 0.5
    assert scoring.rank_auc(same.filter("label = 1")).first().auc is None
    assert scoring.rank_auc(same.withColumn("score", F.lit(None).cast("double"))).count() <= 1


def test_auc_takes_three_exchanges_and_folds_a_hot_score(spark):
    """However many weights; the score that a third of the rows share crosses the shuffle once per task."""
    _, df = scored(spark)
    for auc in (scoring.rank_auc(df), bootstrap.bootstrap_auc(df.select("id", "label", "score"), ["id"], replicates=7)):
        plan = auc._jdf.queryExecution().executedPlan().toString()
        # besides the one that spreads the rows to be hashed: by score, by slice, by replicate
        assert plan.count("Exchange hashpartitioning(") - plan.count("Exchange hashpartitioning(id") == 3
        assert "partial_sum" in plan and "rangepartitioning" not in plan


def test_draws_on_digests_are_those_on_numbers(spark):
    rows = spark.range(3000).select(poisson_draw("id", F.lit(7)).alias("a"), poisson_one(md5_unit("id", F.lit(7))).alias("b"))
    assert rows.filter("a <> b").count() == 0 and rows.filter("a = 0").count() > 900


def test_f1(spark):
    _, df = scored(spark)
    ours = scoring.f1_scores(scoring.confusion(df)).first()
    doubles = df.select(F.col("label").cast("double"), F.col("pred").cast("double").alias("prediction"))
    assert ours.f1_weighted == pytest.approx(MulticlassClassificationEvaluator(metricName="f1").evaluate(doubles))
    by_label = MulticlassClassificationEvaluator(metricName="fMeasureByLabel", metricLabel=1.0)
    assert ours.f1_positive == pytest.approx(by_label.evaluate(doubles))
    one_class = scoring.f1_scores(scoring.confusion(df.filter("label = 0 AND pred = 0"))).first()
    assert (one_class.f1_positive, one_class.f1_weighted) == (0.0, 1.0)


def test_profit(spark):
    rows, df = scored(spark)
    worth = {(1, 1): 30, (0, 1): -5, (1, 0): -20, (0, 0): 2}
    expected = sum(worth[label, pred] for _, label, _, pred in rows)
    row = scoring.profit_per_thousand(scoring.confusion(df)).first()
    assert (row.expected_profit, row.test_count) == (expected, 600)
    assert row.profit_per_1000 == pytest.approx(expected / 600 * 1000)


def brute_weight(row_id, rep):
    word = int(hashlib.md5(f"{row_id}|{rep}".encode()).hexdigest()[:8], 16)
    return sum(word / 4294967296.0 >= cut for cut in POISSON_ONE_CUTS)


def test_bootstrap_equals_brute_force(spark):
    rows, df = scored(spark, n=120)
    found = {r.rep: r.auc for r in bootstrap.bootstrap_auc(df, ["id"], replicates=6).collect()}
    for rep in range(6):
        weighted = [(label, s, brute_weight(i, rep)) for i, label, s, _ in rows]
        assert found[rep] == pytest.approx(brute_auc(weighted), abs=1e-12)
    ci = bootstrap.bootstrap_interval(df, ["id"], replicates=20).first()
    assert ci.auc_ci_low_95 <= ci.auc_ci_median <= ci.auc_ci_high_95


def test_evaluation_table(spark):
    _, df = scored(spark, n=90)
    table = evaluation.evaluation_long(df, ["id"], replicates=5, counts={"train_count": df.limit(7)})
    values = {r.metric: r.value for r in table.collect()}
    assert values["train_count"] == 7 and values["test_count"] == 90 and len(values) == 9


def test_samples(spark):
    _, df = scored(spark)
    sample = {r.id for r in sampling.hashed_sample(df, ["id"], 0.3).collect()}
    assert sample == {r.id for r in sampling.hashed_sample(df.repartition(7), ["id"], 0.3).collect()}
    assert 100 < len(sample) < 260
    assert sampling.stratified_sample(df, "label", {1: 1.0}).filter("label = 0").count() == 0


def test_run_costs(spark):
    rows = [(0, "strong", "E4_C4_M16", 0.6638715419976506, 37), (1, "strong", "E8_C4_M16", 0.34385691700299503, 37)]
    rows += [(2, "weak", "E4_C4_M16", 0.19378212499577785, 30), (3, "weak", "other", 0.0, 0)]
    schema = "run_id bigint, mode string, resource_profile string, runtime_sec double, result_rows bigint"
    out = {r.run_id: r for r in runcost.run_cost(spark.createDataFrame(rows, schema)).collect()}
    assert out[0].estimated_cost_usd == pytest.approx(1.3572484858618634e-4)
    assert out[0].throughput_rows_per_sec == pytest.approx(55.73367385000958)
    assert out[0].cost_per_1000_rows == pytest.approx(0.003668239150978009)
    assert out[0].strong_efficiency == pytest.approx(0.5179570071166146)
    assert out[1].strong_efficiency == 1.0 and out[2].strong_efficiency is None
    assert out[3].estimated_cost_usd is None
    picks = {r.recommendation: r.resource_profile for r in runcost.recommend(
        spark.createDataFrame(rows[:2], schema)).collect()}
    assert picks["Fastest"] == "E8_C4_M16" and picks["Cheapest"] == "E4_C4_M16"


def test_recommendation_of_unmeasured_and_of_tiny_costs(spark):
    """A run of 0 s was not measured; costs far below 1e-8 still tell profiles apart."""
    schema = "run_id bigint, mode string, resource_profile string, runtime_sec double, result_rows bigint"
    rows = [(0, "strong", "E4_C4_M16", 2.0, 10**12), (1, "strong", "E8_C4_M16", 1.9, 10**12), (2, "weak", "E1_C1_M1", 0.0, 5), (3, "weak", "odd", 9.0, 1)]
    picks = {r.recommendation: r for r in runcost.recommend(spark.createDataFrame(rows, schema)).collect()}
    assert {n: r.resource_profile for n, r in picks.items()} == {"Fastest": "E8_C4_M16", "Cheapest": "E4_C4_M16", "Balanced": "E4_C4_M16"}
    assert 0 < picks["Cheapest"].cost_per_1000_rows < 1e-8


def test_poisson_weights_are_not_capped(spark):
    draws = spark.createDataFrame([(0.0,), (0.9985,), (0.99999,), (1 - 2.0**-32,)], "u double")
    assert [r[0] for r in draws.select(poisson_one(F.col("u"))).collect()] == [0, 5, 8, 12]


def test_profit_and_count_have_one_denominator(spark):
    rows = spark.createDataFrame([(1, 1), (0, 0), (None, 1), (1, None)], "label int, pred int")
    row = scoring.profit_per_thousand(scoring.confusion(rows)).first()
    assert (row.expected_profit, row.test_count, row.profit_per_1000) == (32.0, 2, 16000.0)
    assert scoring.profit_per_thousand(scoring.confusion(rows.limit(0))).first().profit_per_1000 is None
