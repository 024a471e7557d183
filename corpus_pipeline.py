"""From raw documents to mixed, encoded training text: quality, lines, near duplicates, mix, pieces.

Every stage takes null ids, texts, languages and sources, empty and long texts, repeated rows and further columns, and
gives the columns it got; the last one adds ``piece_ids``. An empty table passes as an empty table.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession

from basketline.llm import batches, line_dedup, mixing, near_dups, piece_coding, quality_model
from basketline.llm.queries import vocabulary
from basketline.llm.tables import table, unpacked
from basketline.session import checkpoint_dir

#: No stage but the first could be said in SQL; the stages are tested against plain versions instead.
ORACLE_SQL = None


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier does not reject; it learns from ``docs`` and the labels.

    A null text is scored like an empty one. Without labels every score is one half, and all stay.
    """
    batches.small_batches(spark)
    out = quality_model.scored(docs, quality_model.train(docs, table(spark, sf_dir, "labels"))).filter("score >= 0.5")
    return out.select(*unpacked(out, docs.columns))


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat an earlier one or differ from it by a word; one left without words goes.

    A null text stays. Rows equal in id and text are one document.
    """
    return line_dedup.dedup_lines(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates, the one with the smallest id; texts without words all stay."""
    batches.small_batches(spark)
    return near_dups.one_of_each(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target says; empty and null texts are never taken."""
    return mixing.mixed(docs)


def pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document with the ids of its pieces; a null text has none."""
    batches.small_batches(spark)
    return piece_coding.encoded(docs, vocabulary("piece_bpe_32k.model"))


STAGES = [("quality", quality), ("line_dedup", lines), ("near_dups", near_duplicates), ("mix", mix), ("pieces", pieces)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, each written as Parquet below the shared checkpoint folder and read again."""
    docs = table(spark, sf_dir, "documents")
    checkpoint_dir(spark)
    top = f"{spark.sparkContext.getCheckpointDir()}/corpus"
    for i, (name, stage) in enumerate(STAGES):
        path = f"{top}/{i}_{name}_{spark.sparkContext.startTime}_{hashlib.sha256(sf_dir.encode()).hexdigest()[:16]}"
        stage(spark, docs, sf_dir).write.mode("overwrite").parquet(path)
        docs = spark.read.parquet(path)
    return docs
