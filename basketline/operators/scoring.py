"""Evaluation of a binary classifier as DataFrame aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# Worth of one true positive, false positive, false negative, true negative.
PAYOFF = {"tp": 30, "fp": -5, "fn": -20, "tn": 2}
_COUNT = "decimal(18,0)"  # pair counts outgrow a bigint


def confusion(df: DataFrame, label: str = "label", pred: str = "pred") -> DataFrame:
    return df.groupBy(
        F.col(label).cast("int").alias("label"), F.col(pred).cast("int").alias("pred")
    ).agg(F.count(F.lit(1)).alias("row_count"))


def _cells(counts: DataFrame) -> DataFrame:
    """Confusion rows to one row tp, fp, fn, tn."""

    def cell(label: int, pred: int) -> Column:
        hit = (F.col("label") == label) & (F.col("pred") == pred)
        return F.coalesce(F.sum(F.when(hit, F.col("row_count"))), F.lit(0))

    return counts.agg(
        cell(1, 1).alias("tp"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(0, 0).alias("tn")
    )


def _f1(hits: Column, wrong: Column) -> Column:
    """2 TP / (2 TP + FP + FN); 0 where the class neither occurs nor is predicted."""
    return F.coalesce(2 * hits / F.nullif(2 * hits + wrong, F.lit(0).cast("bigint")), F.lit(0.0))


def f1_scores(counts: DataFrame) -> DataFrame:
    """One row: positive-class F1 and F1 averaged over both classes by their frequency."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    wrong = fp + fn
    positive, negative = _f1(tp, wrong), _f1(tn, wrong)
    rows = F.nullif(tp + fp + fn + tn, F.lit(0).cast("bigint"))
    return _cells(counts).select(
        positive.alias("f1_positive"),
        ((positive * (tp + fn) + negative * (tn + fp)) / rows).alias("f1_weighted"),
    )


def expected_profit(counts: DataFrame, payoff: Mapping[str, float] = PAYOFF) -> DataFrame:
    worth = sum((F.col(cell) * F.lit(value) for cell, value in payoff.items()), F.lit(0))
    return _cells(counts).select(worth.cast("double").alias("expected_profit"))


def profit_per_thousand(counts: DataFrame, payoff: Mapping[str, float] = PAYOFF) -> DataFrame:
    """``test_count`` is the rows that the profit is made of: those with a label and a prediction."""
    worth = sum((F.col(cell) * F.lit(value) for cell, value in payoff.items()), F.lit(0)).cast("double")
    rows = F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")
    return _cells(counts).select(
        worth.alias("expected_profit"),
        rows.alias("test_count"),
        (worth / F.nullif(rows, F.lit(0).cast("bigint")) * 1000).alias("profit_per_1000"),
    )


SLICES = 64


def _slice_of(score: Column, bounds: Sequence[float], first: int = 0) -> Column:
    """In which of the slices between sorted bounds a score lies: a binary search, six comparisons deep."""
    if not bounds:
        return F.lit(first)
    middle = len(bounds) // 2
    return F.when(score <= bounds[middle], _slice_of(score, bounds[:middle], first)).otherwise(
        _slice_of(score, bounds[middle + 1 :], first + middle + 1)
    )


def weighted_aucs(
    df: DataFrame, weights: Sequence[Column], label: str = "label", score: str = "score"
) -> DataFrame:
    """(rep, auc): the exact area under the ROC curve by each of the whole-number weights, ties counting one half.

    A model gives nearly as many scores as rows, so one running total over all of them would be
    one task. A quantile sketch of the scores gives bounds that cut them into slices. Rows are folded to one per score
    before they are shuffled, so a score that many rows share is one row, and all weights travel in it as a vector; they are
    laid out only where their slice is. A running total inside each slice gives the
    pairs within it, and a second one over the ``SLICES`` slices adds the pairs across: three exchanges, however many
    weights there are. Twice the pair count is an integer, so the
    result does not depend on the order of additions. Null when one class is missing.
    """
    n = range(len(weights))
    rows = df.filter(F.col(label).isNotNull() & F.col(score).isNotNull()).select(
        F.col(score).alias("score"), (F.col(label) == 1).alias("hit"), *[w.alias(f"w{i}") for i, w in enumerate(weights)]
    )
    at = F.array(*[F.lit((i + 1) / SLICES) for i in range(SLICES - 1)])
    # at most SLICES - 1 numbers; a subquery for each comparison would have to be planned as often
    bounds = sorted(set(rows.agg(F.percentile_approx("score", at, 10 * SLICES)).first()[0] or ()))

    def summed(name: str, counted: Column) -> list[Column]:
        return [F.coalesce(F.sum(F.when(counted, F.col(f"w{i}"))), F.lit(0)).alias(f"{name}{i}") for i in n]

    folded = rows.groupBy(_slice_of(F.col("score"), bounds).alias("slice"), "score").agg(
        *summed("pos", F.col("hit")), *summed("neg", ~F.col("hit"))
    )
    laid_out = F.array(*[F.struct(F.lit(i).alias("rep"), F.col(f"pos{i}").alias("pos"), F.col(f"neg{i}").alias("neg")) for i in n])
    counts = folded.repartition("slice").select("slice", "score", F.inline(laid_out))
    pos, neg = F.col("pos").cast(_COUNT), F.col("neg").cast(_COUNT)
    earlier = (Window.unboundedPreceding, -1)
    in_slice = Window.partitionBy("slice", "rep").orderBy("score").rowsBetween(*earlier)
    across = Window.partitionBy("rep").orderBy("slice").rowsBetween(*earlier)

    def before(window) -> Column:
        return F.coalesce(F.sum("neg").over(window), F.lit(0)).cast(_COUNT)

    slices = (
        counts.withColumn("before", before(in_slice))
        .groupBy("slice", "rep")
        .agg(F.sum(pos * (2 * F.col("before") + neg)).alias("pairs"), F.sum("pos").alias("pos"), F.sum("neg").alias("neg"))
    )
    sums = (
        slices.withColumn("before", before(across))
        .groupBy("rep")
        .agg(
            F.sum(F.col("pairs") + pos * 2 * F.col("before")).cast("double").alias("pairs"),
            F.sum("pos").cast("double").alias("pos"),
            F.sum("neg").cast("double").alias("neg"),
        )
    )
    return sums.select("rep", (F.col("pairs") / F.nullif(2 * F.col("pos") * F.col("neg"), F.lit(0.0))).alias("auc"))


def rank_auc(df: DataFrame, label: str = "label", score: str = "score") -> DataFrame:
    return weighted_aucs(df, [F.lit(1)], label, score).agg(F.max("auc").alias("auc"))
