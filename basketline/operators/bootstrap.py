"""Bootstrap confidence interval of the AUC in one job."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketline.functions import keys
from basketline.operators.scoring import weighted_aucs

REPLICATES = 60
# Lower bound, median and upper bound of a 95 % interval.
PERCENTILES = {"auc_ci_low_95": 0.025, "auc_ci_median": 0.5, "auc_ci_high_95": 0.975}


def with_weights(df: DataFrame, row_id: Sequence[str], replicates: int = REPLICATES) -> DataFrame:
    """``df`` with ``weights``: how often each replicate draws the row, a Poisson(1) number for each.

    A weight comes from a hash of the ``row_id`` columns and the replicate, so a retry or another partitioning
    draws the same resample.
    """
    replicate = F.sequence(F.lit(0), F.lit(replicates - 1))
    return df.withColumn("weights", F.transform(replicate, lambda rep: keys.poisson_draw(*row_id, rep)))


def bootstrap_auc(
    df: DataFrame, row_id: Sequence[str], label: str = "label", score: str = "score", replicates: int = REPLICATES
) -> DataFrame:
    """One ``auc`` per replicate ``rep``. A row stays one row with a vector of weights, and vectors are added per score.

    The rows are spread by id first: each is hashed ``replicates`` times, and a scan split sized for
    the input would be a task that many times too long.
    """
    scored = df.select(*row_id, label, score).repartition(*row_id)
    weighted = with_weights(scored, row_id, replicates).select(label, score, "weights")
    return weighted_aucs(weighted, [F.col("weights")[i] for i in range(replicates)], label, score)


def bootstrap_interval(
    df: DataFrame, row_id: Sequence[str], label: str = "label", score: str = "score", replicates: int = REPLICATES
) -> DataFrame:
    """One row with the bounds; the percentiles are taken over ``replicates`` values."""
    aucs = bootstrap_auc(df, row_id, label, score, replicates)
    return aucs.agg(
        *[
            F.expr(f"percentile_disc({p}) WITHIN GROUP (ORDER BY auc)").alias(name)
            for name, p in PERCENTILES.items()
        ]
    )
