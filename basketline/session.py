"""Session settings the library is written for, and the checkpoint folder."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import CalendarIntervalType, NullType

# What a caller should put on the session builder. Shuffle partitions are left to the
# cluster: AQE coalesces small ones and splits skewed ones at run time.
RECOMMENDED = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.compression.codec": "snappy",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
}


def configured(builder: SparkSession.Builder, **extra: str) -> SparkSession.Builder:
    """Put the recommended settings, then the caller's own, on a builder."""
    for key, value in {**RECOMMENDED, **extra}.items():
        builder = builder.config(key, value)
    return builder


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder of the session.

    A cluster names it in ``spark.checkpoint.dir``. Only a single-machine session that names
    none gets a temporary folder; on a cluster a missing setting is an error, because files on
    one machine are lost with that machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        if not sc.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="basketline-checkpoint-")
    sc.setCheckpointDir(named)
    return named


#: Rows of a shuffle partition that a task can sort and fold in a few hundred MB, however many columns they have.
ROWS_PER_TASK = 200_000


def tasks_for(rows_of: DataFrame) -> int | None:
    """Shuffle partitions for as many rows as ``rows_of`` has, where the session's own would be too large; else None.

    Counted exactly; for a table of files Spark reads only what the files say of themselves.
    """
    tasks = -(-rows_of.count() // ROWS_PER_TASK)
    return tasks if tasks > int(rows_of.sparkSession.conf.get("spark.sql.shuffle.partitions")) else None


#: Rows from which a table is written in between, for its shuffles to end before the next ones begin.
LARGE_ROWS = 10_000_000


def is_large(rows_of: DataFrame) -> bool:
    return rows_of.count() > LARGE_ROWS


def dealt(df: DataFrame, tasks: int | None, *columns: str) -> DataFrame:
    """Rows of equal ``columns`` in one shuffle partition: of ``tasks``, or else of the session's, which AQE may join."""
    return df.repartition(tasks, *columns) if tasks else df.repartition(*columns)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder now and go on from the files.

    Used before iterative fits, which would otherwise replay the whole plan on every pass.
    """
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


#: Setting of Spark 4.1: files of a query's shuffles go when the query ends, not when the driver next collects garbage.
SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def written(df: DataFrame, path: str, tasks: int | None = None) -> DataFrame:
    """Write ``df`` to ``path`` now and go on from there; of its shuffles nothing stays on disk.

    ``tasks`` raises the shuffle partitions until then, where the session's are made for fewer rows.
    """
    spark = df.sparkSession
    settings = {SHUFFLES_GO: "true"}
    if tasks and tasks > int(spark.conf.get("spark.sql.shuffle.partitions")):
        settings["spark.sql.shuffle.partitions"] = str(tasks)
    before = {key: spark.conf.get(key, None) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        df.write.option("compression", "zstd").parquet(path)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)
    return spark.read.schema(df.schema).parquet(path)


def stored(df: DataFrame, tasks: int | None = None) -> DataFrame:
    """``cut_lineage`` in compressed columns, which take a fraction of a checkpoint's disk. Its partitions are not kept."""
    if any(isinstance(f.dataType, NullType | CalendarIntervalType) for f in df.schema):
        return cut_lineage(df)  # no file format has a column of these
    return written(df, f"{checkpoint_dir(df.sparkSession)}/tables/{uuid.uuid4()}", tasks)


def dropped(spark: SparkSession, path: str) -> None:
    """Give back the disk of a table that nothing reads any more."""
    spark.range(0).write.mode("overwrite").parquet(path)
