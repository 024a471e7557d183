"""Retail inputs derived from the given TPC-H-like tables, with dirt so that every rule fires.

Whole tables, no row limits. The modulo conditions break cells of some rows; none drops a row.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from basketline.functions import keys
from basketline.operators import enrich, normalize, validate
from basketline.plans import curate
from basketline.schemas import SOURCE_COLUMNS
from basketline.session import is_large, tasks_for
from basketline.sources import lineage

INGESTED_AT = "2024-01-01T00:00:00Z"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def raw_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    col = F.col
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity", "l_returnflag")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    nations = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_retailprice")
    buyers = orders.join(customers, col("o_custkey") == col("c_custkey")).join(
        nations, col("c_nationkey") == col("n_nationkey")
    )
    # lines meet their parts first, when they are narrowest; an order's lines come out next to each other
    joined = lines.join(parts, col("l_partkey") == col("p_partkey")).join(
        buyers, col("l_orderkey") == col("o_orderkey")
    )

    def broken(key: str, every: int):
        return col(key) % every == 0

    units = col("l_quantity").cast("int")
    hours = F.make_interval(hours=(col("o_orderkey") % 24).cast("int"))
    return joined.select(
        col("o_orderkey").cast("string").alias("invoice_no"),
        F.when(broken("l_partkey", 79), "  ").otherwise(col("l_partkey").cast("string")).alias("stock_code"),
        F.when(~broken("l_partkey", 67), col("p_name")).alias("description"),
        F.when(broken("l_orderkey", 97), "n/a")
        .when(col("l_returnflag") == "R", (-units).cast("string"))
        .otherwise(units.cast("string"))
        .alias("quantity"),
        F.when(broken("l_orderkey", 71), "not-a-date")
        .otherwise((col("o_orderdate") + hours).cast("string"))
        .alias("invoice_date"),
        F.when(broken("l_partkey", 89), 0.0).otherwise(col("p_retailprice")).alias("unit_price"),
        F.when(~broken("o_custkey", 83), col("o_custkey")).alias("customer_id"),
        F.when(~broken("l_orderkey", 73), col("n_name")).alias("country"),
    )


def source_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw lines under the names of a source sheet, in another order and with a column that nobody knows."""
    lines = raw_lines(spark, sf_dir)
    names = {ours: source for source, ours in SOURCE_COLUMNS.items()}
    renamed = [F.col(c).alias(names[c]) for c in reversed(lines.columns)]
    return lines.select(F.lit("x").alias("Remark"), *renamed)


def normalised(spark: SparkSession, sf_dir: str) -> DataFrame:
    return normalize.normalise(raw_lines(spark, sf_dir), INGESTED_AT)


def valid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return validate.valid_lines(normalised(spark, sf_dir))


def line_tasks(spark: SparkSession, sf_dir: str) -> int | None:
    """Shuffle partitions for the lines, of which there are no more than items."""
    return tasks_for(table(spark, sf_dir, "lineitem"))


def many_lines(spark: SparkSession, sf_dir: str) -> bool:
    return is_large(table(spark, sf_dir, "lineitem"))


def dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nations; lines without a country use the defaults of the left join."""
    nations = table(spark, sf_dir, "nation")
    regions = table(spark, sf_dir, "region")
    return nations.join(regions, F.col("n_regionkey") == F.col("r_regionkey")).select(
        F.col("n_name").alias("country"),
        F.lower("r_name").alias("region"),
        (1 + F.col("n_regionkey") % 3).cast("bigint").alias("shipping_risk_score"),
    )


def enriched(
    spark: SparkSession, sf_dir: str, *columns: str, strategy: enrich.JoinStrategy = "auto"
) -> DataFrame:
    """Curated lines; with ``columns`` only those (and what deduping needs) are moved."""
    tasks, large = line_tasks(spark, sf_dir), many_lines(spark, sf_dir)
    return curate.curated_lines(valid(spark, sf_dir), dim(spark, sf_dir), strategy, columns or None, tasks, large)


def basket_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    tasks, large = line_tasks(spark, sf_dir), many_lines(spark, sf_dir)
    return curate.basket_summary(valid(spark, sf_dir), dim(spark, sf_dir), tasks=tasks, large=large)


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labels with a score and a prediction taken from the document length."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    return (
        table(spark, sf_dir, "labels")
        .select("doc_id", F.col("quality").alias("label"))
        .join(documents, "doc_id")
        .select(
            "doc_id",
            "label",
            F.col("n_chars").cast("double").alias("score"),
            (F.col("n_chars") >= 1000).cast("int").alias("pred"),
        )
    )


def runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "value", "user_id")
    executors = (4 + 4 * (F.col("event_id") % 3)).cast("string")
    return events.select(
        F.col("event_id").alias("run_id"),
        F.when(F.col("event_id") % 2 == 0, "strong").otherwise("weak").alias("mode"),
        F.concat(F.lit("E"), executors, F.lit("_C4_M16")).alias("resource_profile"),
        F.col("value").alias("runtime_sec"),
        (F.col("user_id") + 1).alias("result_rows"),
    )


def order_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every order with a 0/1 label and its total as score: one score per row, few ties."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        (keys.md5_bucket("o_orderkey") < F.least(F.floor(F.col("o_totalprice") / 5000), F.lit(95)))
        .cast("int")
        .alias("label"),
        F.col("o_totalprice").alias("score"),
        (F.col("o_totalprice") >= 200000).cast("int").alias("pred"),
    )


def run_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as a lineage log: a pipeline per event type, a join mode per user, a failure where the value is below 10."""
    events = table(spark, sf_dir, "events")
    failed = F.when(F.col("value") < 10, lineage.FAILED).otherwise("")
    return events.select(
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp_utc"),
        F.concat("event_type", failed).alias("pipeline_name"),
        F.lit("in").alias("input_path"),
        F.concat(F.lit("out/"), F.col("event_id").cast("string")).alias("output_path"),
        F.col("event_id").alias("row_count"),
        F.create_map(
            F.lit("join_mode"), F.when(F.col("user_id") % 2 == 0, "broadcast").otherwise("merge"),
            F.lit("runtime_sec"), F.col("value").cast("string"),
        ).alias("extra"),
    )
