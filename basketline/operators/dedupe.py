"""One row per key, always the same one."""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DoubleType, FloatType, StringType

from basketline.session import checkpoint_dir, dealt, dropped, written

TRANSACTION_KEY = ("transaction_id",)

# The survivor is the smallest row in this column order; other columns follow by name. The
# columns the later stages use come first, so dropping the rest before deduping picks a row
# with the same values.
SURVIVOR_ORDER = ("country", "quantity", "unit_price")
# Hashes of repeated keys that are sent to every task; with more of them all rows are folded, a slice at a time.
BROADCAST_HASHES = 1_000_000
SLICE_ROWS = 20_000_000


def dedupe(
    df: DataFrame,
    key_cols: Sequence[str] = TRANSACTION_KEY,
    copies: str | None = None,
    tasks: int | None = None,
    large: bool = False,
    folder: str | None = None,
) -> DataFrame:
    """Keep the smallest row of each key; ``copies`` names a column for the rows it stood for.

    Written as a ``min`` over a struct of all other columns instead of a ranking window: the
    aggregate folds copies before the shuffle, so a key holding a third of all rows sends one
    row per task, and the copy count comes with it at no cost. That fold sorts what its task holds, which would be a whole
    split of the source, however wide its rows have become. So rows are first dealt out in shuffle partitions, by key and by
    the task that they come from: the copies of a hot key stay spread. ``tasks`` (see ``session.tasks_for``) deals more rows
    than the session's shuffle partitions are made for to more of them, before either fold.

    These two exchanges carry whole rows, mostly of keys that occur once. With ``large`` (see ``session.is_large``) rows are
    written once, hashes of their keys are counted, and only rows whose hash occurs again are exchanged and folded.
    ``folder`` names where, for a caller who can tell when the result is done with.
    """
    if large and all(_hashes_as_it_groups(df.schema[c].dataType) for c in key_cols):
        return _fold_repeated(df, key_cols, copies, tasks, folder or f"{checkpoint_dir(df.sparkSession)}/dedupe/{uuid.uuid4()}")
    return _fold(df, key_cols, copies, tasks)


def _hashes_as_it_groups(kind: DataType) -> bool:
    """Whether values that group together surely have one hash: not those of parts, with several zeros or a collation."""
    if isinstance(kind, StringType):
        return kind == StringType()
    return not isinstance(kind, DoubleType | FloatType) and kind.simpleString().split("<")[0] not in ("array", "struct", "map", "variant")


def _fold(df: DataFrame, key_cols: Sequence[str], copies: str | None, tasks: int | None) -> DataFrame:
    leading = [c for c in SURVIVOR_ORDER if c in df.columns and c not in key_cols]
    rest = leading + sorted(c for c in df.columns if c not in key_cols and c not in leading)
    aggs = [F.min(F.struct(*rest)).alias("kept")]
    if copies:
        aggs.append(F.count(F.lit(1)).alias(copies))
    out = [F.col(c) if c in key_cols else F.col(f"kept.{c}").alias(c) for c in df.columns]
    spread = dealt(df.withColumn("_task", F.spark_partition_id()), tasks, *key_cols, "_task")
    if tasks:  # a fold of its own, as Spark would send what it folds for the next one to the session's partitions
        spread = dealt(spread.groupBy(*key_cols, "_task").agg(*aggs), tasks, *key_cols)
        aggs = [F.min("kept").alias("kept"), *([F.sum(copies).alias(copies)] if copies else [])]
    return spread.groupBy(*key_cols).agg(*aggs).select(*out, *([copies] if copies else []))


def _fold_repeated(
    df: DataFrame, key_cols: Sequence[str], copies: str | None, tasks: int | None, folder: str
) -> DataFrame:
    """The same over rows that are written first. A hash that two keys share costs them a fold, which tells them apart."""
    rows = written(df, f"{folder}/rows", tasks)
    key_hash = F.xxhash64(*key_cols)
    counted = rows.groupBy(key_hash.alias("_hash")).agg(F.count(F.lit(1)).alias("n"))
    repeated = written(counted.filter("n > 1").select("_hash"), f"{folder}/repeated", tasks)
    if repeated.count() <= BROADCAST_HASHES:
        met = key_hash == F.col("_hash")
        again = written(_fold(rows.join(F.broadcast(repeated), met, "left_semi"), key_cols, copies, tasks), f"{folder}/kept", tasks)
        once = rows.join(F.broadcast(repeated), met, "left_anti")
        return (once.withColumn(copies, F.lit(1).cast("bigint")) if copies else once).unionByName(again)
    slices = -(-rows.count() // SLICE_ROWS)
    kept = []
    for i in range(slices):
        part = rows.filter(F.pmod(key_hash, F.lit(slices)) == i)
        kept.append(written(_fold(part, key_cols, copies, tasks and -(-tasks // slices)), f"{folder}/kept_{i}"))
    dropped(df.sparkSession, f"{folder}/rows")
    return reduce(DataFrame.unionByName, kept)


def duplicate_counts(df: DataFrame, key_cols: Sequence[str] = TRANSACTION_KEY) -> DataFrame:
    """One row: rows in, rows kept, rows dropped."""
    per_key = df.groupBy(*key_cols).agg(F.count(F.lit(1)).alias("n"))
    return per_key.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("rows_in"),
        F.count(F.lit(1)).alias("rows_kept"),
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("rows_dropped"),
    )
