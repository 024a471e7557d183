"""A saved pipeline to the evaluation table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from basketline.ml import models
from basketline.operators import evaluation, sampling, splits
from basketline.operators.bootstrap import REPLICATES
from basketline.session import cut_lineage
from basketline.sources import lineage, sinks

STRATUM_FRACTION = 0.9
ROW_ID = ("invoice_no", "customer_id", "country", "invoice_ts")


def scored_test_split(
    gold_features: DataFrame, model_path: str, label: str = models.LABEL
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(train sample, valid sample, scored test rows); train and valid are stratified samples."""
    split = cut_lineage(splits.assign_temporal_split(gold_features.dropna(subset=[label])))
    train, valid, test = splits.parts(split)
    fractions = {0: STRATUM_FRACTION, 1: STRATUM_FRACTION}
    scored = cut_lineage(models.score(models.load(model_path), test))
    return (
        sampling.stratified_sample(train, label, fractions),
        sampling.stratified_sample(valid, label, fractions),
        scored,
    )


def evaluate(
    gold_features: DataFrame,
    model_path: str,
    output_path: str,
    label: str = models.LABEL,
    replicates: int = REPLICATES,
    csv_path: str | None = None,
    log_path: str | None = None,
    source_name: str = "",
) -> DataFrame:
    """Write the (metric, value) table of the test split and give it back as a frame."""
    spark = gold_features.sparkSession
    with lineage.recorded(spark, log_path, "evaluate", source_name, output_path) as run:
        train, valid, scored = scored_test_split(gold_features, model_path, label)
        table = evaluation.evaluation_long(
            scored,
            ROW_ID,
            label=label,
            replicates=replicates,
            counts={"train_count": train, "valid_count": valid},
        )
        sinks.write_single_file(table, output_path)
        written = spark.read.parquet(output_path)
        if csv_path:
            sinks.export_csv(written, f"{csv_path}/evaluation_csv")
        run.row_count = scored.count()
        run.extra.update(target=label, bootstrap=f"n={replicates}")
    return written
